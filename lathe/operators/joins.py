"""Joins of listings, details, lookups and previous output.

Right sides that should hold one row per key are de-duplicated after the key
is cleaned, by an order the caller may give, so no join fans out by accident
(``master_assembly`` keeps every detail row, as is its use). Nothing is broadcast by hand:
the optimizer does it below its size threshold. A hot key on the left is
split by AQE, or spread up front with ``salts``.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rx import as_col, first_present, is_blank, present, strip
from ..functions.urls import with_scheme
from .dedup import keep_first


def lookup_join(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None, how: str = "left", salts: int = 1, spread=None) -> DataFrame:
    """Equi join on trimmed text keys; the right key column is dropped.

    ``salts`` > 1 repeats the right side that many times and spreads the rows
    of every left key over as many tasks, by the hash of ``spread``. Such a join
    is shuffled and merged: a broadcast would need no salt, and every task
    would hold the right side ``salts`` times.
    """
    right_key = right_key or key
    r = right.withColumnRenamed(right_key, "__rk").withColumn("__rk", strip(F.col("__rk").cast("string")))
    salted = left
    if salts > 1:
        names = [spread] if isinstance(spread, str) else list(spread or left.columns)
        salted = left.withColumn("__salt", F.pmod(F.xxhash64(*names), F.lit(salts)))
        r = r.withColumn("__rsalt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))).hint("merge")
    # The trimmed key is a column: a sort would work an expression out at each comparison.
    keyed = salted.withColumn("__lk", strip(F.col(key).cast("string")))
    cond = F.col("__lk") == F.col("__rk")
    if salts > 1:
        cond = cond & (F.col("__salt") == F.col("__rsalt"))
    return keyed.join(r, cond, how).drop("__lk", "__rk", "__salt", "__rsalt")


def unique(right: DataFrame, key: str, order=None) -> DataFrame:
    """One row per trimmed key: the first by ``order``, by all sortable columns where none is given."""
    order = order or [c for c, kind in right.dtypes if "map<" not in kind and "variant" not in kind]
    return keep_first(right.withColumn(key, strip(F.col(key).cast("string"))), key, order)


def merge_results(main: DataFrame, results: DataFrame, url: str, result_url: str, order, salts: int = 1, spread=None) -> DataFrame:
    """Keys are trimmed first, then the right side is made unique, then joined."""
    clean = results.withColumn(result_url, strip(F.col(result_url)))
    return lookup_join(main, keep_first(clean, result_url, order), url, result_url, salts=salts, spread=spread)


def master_assembly(listing: DataFrame, detail: DataFrame, url: str, out_cols, base_wins=("Image URL",), detail_suffix: str = " (detail)") -> DataFrame:
    """base listing left join detail; clashes suffixed, base columns win where named. A detail that repeats repeats the row."""
    clash = [c for c in detail.columns if c in listing.columns and c != url]
    d = detail.withColumnsRenamed({c: c + detail_suffix for c in clash})
    joined = lookup_join(listing, d, url)
    for c in clash:
        a, b = F.col(f"`{c}`"), F.col(f"`{c}{detail_suffix}`")
        joined = joined.withColumn(c, first_present(a, b) if c in base_wins else first_present(b, a))
    have = set(joined.columns)
    return joined.select(*[F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c) for c in out_cols])


def restore_progress(current: DataFrame, previous: DataFrame, key: str, columns, order=None) -> DataFrame:
    """blank or missing values are taken from the previous output, whose first row per key counts."""
    old = unique(previous, key, order).select(key, *[F.col(c).alias(f"__old_{c}") for c in columns])
    joined = lookup_join(current, old, key)
    restored = {c: F.coalesce(present(c), F.col(f"__old_{c}")) for c in columns}
    return joined.withColumns(restored).drop(*[f"__old_{c}" for c in columns])


def pending(todo: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """Todo rows whose key is not done. Duplicates stay; null keys stay."""
    seen = done.select(F.col(done_key or key).alias("__done")).filter(F.col("__done").isNotNull()).distinct()
    return todo.join(seen, F.col(key) == F.col("__done"), "left_anti")


def resume_unmarked(inputs: DataFrame, existing: DataFrame, key: str, flag: str) -> DataFrame:
    """inputs whose previous output is not yet marked "Yes"."""
    return pending(inputs, existing.filter(F.col(flag) == "Yes"), key)


def join_on_url(left: DataFrame, right: DataFrame, url: str, right_url: str, order=None) -> DataFrame:
    """both sides get a scheme first, so inputs without "http" still join; the first result per URL counts."""
    a = left.withColumn("__u", with_scheme(url))
    b = unique(right.withColumn("__ru", with_scheme(right_url)).drop(right_url), "__ru", order)
    return a.join(b, F.col("__u") == F.col("__ru"), "left").drop("__u", "__ru")


def enrich(listing: DataFrame, detail: DataFrame, url: str, detail_wins, extras: str | None = None, order=None) -> DataFrame:
    """detail wins for the listed columns where present; extras maps merge, detail last. The first detail per URL counts."""
    detail = unique(detail, url, order)
    names = [c for c in detail.columns if c != url]
    d = detail.withColumnsRenamed({c: f"__d_{c}" for c in names})
    joined = lookup_join(listing, d, url)
    for c in detail_wins:
        joined = joined.withColumn(c, first_present(f"__d_{c}", c) if c in listing.columns else present(f"__d_{c}"))
    if extras:
        empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
        base = F.coalesce(F.col(extras), empty) if extras in listing.columns else empty
        joined = joined.withColumn(extras, merge_maps(base, F.coalesce(F.col(f"__d_{extras}"), empty)))
    return joined.drop(*[f"__d_{c}" for c in names])


def merge_maps(first: Column, second: Column) -> Column:
    """Union of two string maps; the second wins. Independent of the session's duplicate-key policy."""
    keep = F.map_filter(first, lambda k, v: ~F.map_contains_key(second, k))
    return F.map_concat(keep, second)


def precedence(*candidates) -> Column:
    """F8: first present value."""
    return first_present(*candidates)


def fill_if_blank(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.coalesce(present(column), as_col(value)))


def resolve_list(df: DataFrame, ids: str, lookup: DataFrame, lookup_id: str, lookup_name: str, row_key, out: str, separator: str = " | ") -> DataFrame:
    """comma list of ids to names in id order; unknown ids vanish.

    The exploded list joins the lookup on the id, and only the row key with
    its short list comes back.
    """
    keys = [row_key] if isinstance(row_key, str) else list(row_key)
    parts = df.select(*keys, F.posexplode(F.split(ids, ",")).alias("__pos", "__id")).withColumn("__id", F.trim("__id"))
    names = lookup.select(F.col(lookup_id).cast("string").alias("__lid"), F.col(lookup_name).alias("__name"))
    hits = parts.join(names, F.col("__id") == F.col("__lid"))
    listed = hits.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__pos", "__name"))).alias("__l"))
    text = F.array_join(F.transform("__l", lambda x: x["__name"]), separator)
    return df.join(listed.select(*keys, text.alias(out)), keys, "left")


def resolve_list_literal(ids, mapping: dict, separator: str = " | ") -> Column:
    """F9 for a fixed map held in code: no join at all."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    names = F.transform(F.split(as_col(ids), ","), lambda i: F.try_element_at(m, F.trim(i)))
    return F.array_join(F.filter(names, lambda n: n.isNotNull()), separator)


def zip_or_default(keys, values, default: Column) -> Column:
    """map from two lists, only if they are equally long."""
    k, v = as_col(keys), as_col(values)
    return F.when(F.size(k) == F.size(v), F.map_from_arrays(k, v)).otherwise(default)


def variant_image(images, variant_id) -> Column:
    """first image that lists the variant, else the first image.

    ``images``: array of struct(src, variant_ids).
    """
    imgs = as_col(images)
    mine = F.filter(imgs, lambda im: F.array_contains(im["variant_ids"], as_col(variant_id)))
    return F.coalesce(F.get(mine, F.lit(0))["src"], F.get(imgs, F.lit(0))["src"])


def fill_from_lookup(df: DataFrame, lookup: DataFrame, key: str, columns, order=None) -> DataFrame:
    """per column, the looked-up value of the first row of the key, else what the row had."""
    side = unique(lookup, key, order).select(key, *[F.col(c).alias(f"__m_{c}") for c in columns])
    joined = lookup_join(df, side, key)
    return joined.withColumns({c: first_present(f"__m_{c}", c) for c in columns}).drop(*[f"__m_{c}" for c in columns])


def fill_missing(df: DataFrame, other: str, columns) -> DataFrame:
    """blanks taken from a second struct of the same fields."""
    return df.withColumns({c: first_present(c, f"{other}.{c}") for c in columns})


def one_to_many(companies: DataFrame, people: DataFrame, key: str, people_key: str) -> DataFrame:
    """one row per person, one blank row where there is nobody.

    Written as an inner join plus the companies left over: in an inner join
    AQE may split the people of one large company over many tasks, which a
    left outer join forbids on its right side.
    """
    p = people.withColumnRenamed(people_key, "__pk")
    staffed = companies.join(p, F.col(key) == F.col("__pk")).drop("__pk")
    alone = companies.join(p.select("__pk").distinct(), F.col(key) == F.col("__pk"), "left_anti")
    return staffed.unionByName(alone, allowMissingColumns=True)


def contains_either_way(df: DataFrame, text_col: str, rules: list[tuple[str, str]], out: str, default: str | None = None) -> DataFrame:
    """first rule whose key is inside the name, or the name inside the key.

    The rule list is a fixed table in code, so this is a chain of conditions
    on each row and needs neither a join nor a shuffle.
    """
    name = F.lower(F.trim(F.col(text_col)))
    pick = F.when(F.lit(False), F.lit(None).cast("string"))
    for key, value in rules:
        k = F.lit(key)
        pick = pick.when(name.contains(k) | F.contains(k, name), F.lit(value))
    return df.withColumn(out, pick.otherwise(F.lit(default).cast("string")))


def label_column(label, label_map: dict[str, str], soft: dict[str, str] | None = None) -> Column:
    """Exact lower-case label, then "contains" words in fixed order."""
    l = F.lower(F.trim(as_col(label)))
    m = F.create_map(*[F.lit(x) for kv in label_map.items() for x in kv])
    pick = F.try_element_at(m, l)
    for word, target in (soft or {}).items():
        pick = F.coalesce(pick, F.when(l.contains(word), F.lit(target)))
    return pick


def override_by_text(raw, url, text, overrides: list[tuple[str, str, str]]) -> Column:
    """first (url part, optional text part, value) that fits, else the raw value."""
    u, t = F.lower(as_col(url)), F.lower(F.coalesce(as_col(text), F.lit("")))
    pick = F.when(F.lit(False), F.lit(None).cast("string"))
    for url_part, text_part, value in overrides:
        pick = pick.when(u.contains(url_part) & (t.contains(text_part) if text_part else F.lit(True)), F.lit(value))
    return pick.otherwise(as_col(raw))


def retry_rows(df: DataFrame, retry: DataFrame, key: str) -> DataFrame:
    """F18."""
    return df.join(retry.select(key).distinct(), key, "left_semi")


def unresolved(df: DataFrame, required) -> DataFrame:
    """Rows with any required field blank."""
    miss = F.lit(False)
    for c in required:
        miss = miss | is_blank(c)
    return df.filter(miss)
