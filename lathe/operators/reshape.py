"""Variants, option products and reshaping."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rx import as_col, present


def explode_variants(products: DataFrame, variants: str, keep_base: bool = False, pos: str = "variant_pos") -> DataFrame:
    """One row per variant; products without variants keep one row.

    ``keep_base``: the product row itself stays as position -1.
    """
    arr = F.col(variants)
    if keep_base:
        arr = F.array_prepend(F.coalesce(arr, F.array().cast(products.schema[variants].dataType)), F.lit(None).cast(products.schema[variants].dataType.elementType))
    rest = [c for c in products.columns if c != variants]
    out = products.select(*rest, F.posexplode_outer(arr).alias(pos, "variant"))
    return out.withColumn(pos, F.col(pos) - 1) if keep_base else out


def option_product(df: DataFrame, colors: str, sizes: str, skip: str = "custom") -> DataFrame:
    """Colours times sizes of one product, custom sizes skipped. Both lists sit in the row."""
    wanted = F.filter(F.col(sizes), lambda s: ~F.lower(s).contains(skip))
    rest = [c for c in df.columns if c not in (colors, sizes)]
    step = df.select(*rest, F.posexplode_outer(colors).alias("color_pos", "color"), wanted.alias("__s"))
    keep = [c for c in step.columns if c != "__s"]
    return step.select(*keep, F.posexplode_outer("__s").alias("size_pos", "size"))


def changed_variants(baseline: DataFrame, variants: DataFrame, key: str, signature, name: str, finish: str) -> DataFrame:
    """Variants that differ from their baseline, the baseline where none does.

    Names of variants get " - finish".
    """
    base_sig = baseline.select(key, F.struct(*signature).alias("__sig"))
    mine = variants.join(base_sig, key).filter(~F.struct(*signature).eqNullSafe(F.col("__sig"))).drop("__sig")
    mine = mine.withColumn(name, F.concat(F.col(name), F.lit(" - "), F.col(finish)))
    alone = baseline.join(mine.select(key).distinct(), key, "left_anti")
    return mine.unionByName(alone, allowMissingColumns=True)


def first_group_to_columns(groups, fields) -> list[Column]:
    """The first size group fills fixed columns. ``groups``: array<struct(name, dims map)>."""
    first = F.get(as_col(groups), F.lit(0))["dims"]
    return [F.try_element_at(first, F.lit(f)).alias(f) for f in fields]


def later_groups_to_extras(groups) -> Column:
    """Every further group becomes one "k: v | k: v" entry under its name."""
    later = F.slice(as_col(groups), F.lit(2), F.greatest(F.size(as_col(groups)) - 1, F.lit(0)))
    text = F.transform(
        later,
        lambda g: F.struct(g["name"].alias("key"), F.array_join(F.transform(F.map_entries(g["dims"]), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), " | ").alias("value")),
    )
    return F.map_from_entries(text)


def split_to_rows(df: DataFrame, column: str, separator: str, pos: str = "pos", out: str = "part") -> DataFrame:
    """J6."""
    parts = F.transform(F.split(F.col(column), separator), lambda p: F.trim(p))
    return df.select("*", F.posexplode(parts).alias(pos, out)).filter(F.col(out) != "")


def pairs_from_list(values) -> Column:
    """[k, v, k, v] to an array of (key, value); an odd last item is dropped."""
    v = as_col(values)
    n = F.floor(F.size(v) / 2).cast("int")
    idx = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.struct(F.get(v, i * 2).alias("key"), F.get(v, i * 2 + 1).alias("value")))


def header_row_map(headers, cells) -> Column:
    """Header row and value row of a transposed table to a map."""
    pairs = F.filter(F.arrays_zip(as_col(headers).alias("h"), as_col(cells).alias("c")), lambda p: p["h"].isNotNull())
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["h"], p["c"])))



def summary_text(fields: dict) -> Column:
    """K84: "k: v | k: v" of the non-empty attributes."""
    return F.concat_ws(" | ", *[F.when(present(c).isNotNull(), F.concat(F.lit(f"{name}: "), present(c))) for name, c in fields.items()])
