"""Schema, rename and dynamic column operators."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rx import first_present, present

# The standard catalogue columns, in order.
CATALOG_COLUMNS = (
    "Manufacturer",
    "Source",
    "Image URL",
    "Product Name",
    "SKU",
    "Product Family Id",
    "Description",
    "Weight",
    "Width",
    "Depth",
    "Diameter",
    "Length",
    "Height",
    "Seat Width",
    "Seat Depth",
    "Seat Height",
    "Arm Height",
    "Arm Width",
    "List Price",
)

# Other spellings of listing headers.
ALIASES = {
    "Product URL": ("product url", "url", "product link"),
    "Image URL": ("image url", "image"),
    "Product Name": ("product name", "name"),
    "SKU": ("sku",),
}


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def to_raw(df: DataFrame) -> DataFrame:
    """Null rule on ingest: all columns text, every spelling of missing becomes NULL."""
    return df.select(*[present(q(c)).alias(c) for c in df.columns])


def to_export(df: DataFrame) -> DataFrame:
    """Export view: NULL shown as the empty string."""
    return df.select(*[F.coalesce(q(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def ensure_columns(df: DataFrame, names) -> DataFrame:
    """C1."""
    missing = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(None).cast("string") for n in missing}) if missing else df


def standard_first(df: DataFrame, names=CATALOG_COLUMNS) -> DataFrame:
    """All standard columns (blank if absent), then the rest as they were."""
    full = ensure_columns(df, names)
    rest = [c for c in df.columns if c not in names]
    return full.select(*[q(c) for c in (*names, *rest)])


def exact_columns(df: DataFrame, names) -> DataFrame:
    """C3."""
    return ensure_columns(df, names).select(*[q(n) for n in names])


def constant(df: DataFrame, name: str, value: str) -> DataFrame:
    """C4."""
    return df.withColumn(name, F.lit(value))


def source_column(df: DataFrame, url: str, name: str = "Source", url_col: str = "Product URL") -> DataFrame:
    """Decided by the schema, not row by row."""
    return df.withColumn(name, q(url_col) if url_col in df.columns else F.lit(url))


def header_key(name: str) -> str:
    """C10."""
    return " ".join(name.lower().replace("_", " ").split())


def resolve_aliases(df: DataFrame, aliases=None) -> DataFrame:
    """First column that spells an alias gets the standard name."""
    wanted, taken = {}, set(df.columns)
    for target, spellings in (aliases or ALIASES).items():
        if target in taken:
            continue
        for c in df.columns:
            if c not in wanted and header_key(c) in (header_key(target), *spellings):
                wanted[c] = target
                break
    return df.withColumnsRenamed(wanted)


def url_column(df: DataFrame) -> str:
    """First column whose name contains "url"."""
    for c in df.columns:
        if "url" in c.lower():
            return c
    raise ValueError(f"no column contains 'url': {df.columns}")


def positional_names(df: DataFrame, forced: dict[int, str]) -> DataFrame:
    """Names by position (0-based)."""
    return df.toDF(*[forced.get(i, c) for i, c in enumerate(df.columns)])


def trim_headers(df: DataFrame) -> DataFrame:
    """C9."""
    return df.toDF(*[c.strip() for c in df.columns])


def realign(df: DataFrame, names) -> DataFrame:
    """C11: values by header name; blanks are not carried."""
    full = ensure_columns(df, names)
    return full.select(*[present(q(n)).alias(n) for n in names])


def drop_first_column(df: DataFrame) -> DataFrame:
    """C12."""
    return df.select(*[q(c) for c in df.columns[1:]])


def require_columns(df: DataFrame, names) -> DataFrame:
    """D15."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df


def default_from(df: DataFrame, target: str, source: str) -> DataFrame:
    """C18."""
    have = target in df.columns
    return df.withColumn(target, first_present(q(target), q(source)) if have else q(source))


def free_name(name: str, taken) -> str:
    """C13: "Width" beside an existing "Width" becomes "Width (2)"."""
    if name not in taken:
        return name
    n = 2
    while f"{name} ({n})" in taken:
        n += 1
    return f"{name} ({n})"


MAX_DYNAMIC_COLUMNS = 5000


def key_list(long: DataFrame, key: str, order: str | None = None) -> list[str]:
    """The attribute names of a long table, sorted or by first appearance.

    They become column headers, so this one small aggregate is read at plan
    time. More keys than a table can have columns are an error: such data
    belongs in the long form or a map.
    """
    if order is None:
        rows = long.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(key)
    else:
        rows = long.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("__o")).orderBy("__o", key).select(key)
    names = [r[0] for r in rows.limit(MAX_DYNAMIC_COLUMNS + 1).collect()]
    if len(names) > MAX_DYNAMIC_COLUMNS:
        raise ValueError(f"more than {MAX_DYNAMIC_COLUMNS} distinct keys in {key!r}; keep them as a map")
    return names


def widen(long: DataFrame, ids, key: str, value: str, keys: list[str], order: str, last: bool = False, rename=None) -> DataFrame:
    """Long to wide with a known key list; first (or last) value by order.

    ``min_by`` per key is one map-side combined aggregate: the copies of a
    pair meet as one row per map task.
    """
    ids = [ids] if isinstance(ids, str) else list(ids)
    agg = F.max_by if last else F.min_by
    names = rename or {}
    return long.groupBy(*ids).agg(*[agg(F.when(F.col(key) == k, F.col(value)), F.when(F.col(key) == k, F.col(order))).alias(names.get(k, k)) for k in keys])


def spread_specs(df: DataFrame, long: DataFrame, ids, key: str, value: str, order: str) -> DataFrame:
    """Sorted spec columns joined to the base table, clashing names suffixed."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    keys = key_list(long, key)
    taken, rename = set(df.columns), {}
    for k in keys:
        rename[k] = free_name(k, taken)
        taken.add(rename[k])
    return df.join(widen(long, ids, key, value, keys, order, rename=rename), ids, "left")


def explode_extras(df: DataFrame, ids, extras: str) -> DataFrame:
    """Long form (ids, key, value) of a map column."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    return df.select(*ids, F.explode(extras).alias("key", "value"))


def grouped_columns(fixed, details, packaging, rest=()) -> list[str]:
    """C14: fixed, sorted details, sorted packaging, then the rest."""
    listed = [*fixed, *sorted(details), *sorted(packaging)]
    return [*listed, *[c for c in rest if c not in listed]]


def live_keys(long: DataFrame, category: str) -> DataFrame:
    """(category, key) pairs with at least one non-empty value."""
    return long.filter(present("value").isNotNull()).select(category, "key").distinct()


def category_columns(long: DataFrame, category: str, order: str) -> DataFrame:
    """Per category the live keys by first appearance, as one array.

    The grouped side holds one row per (category, key): as many as there are
    columns, never as many as there are products.
    """
    firsts = long.filter(present("value").isNotNull()).groupBy(category, "key").agg(F.min(order).alias("__o"))
    return firsts.groupBy(category).agg(F.transform(F.array_sort(F.collect_list(F.struct("__o", "key"))), lambda x: x["key"]).alias("columns"))


def routed(long: DataFrame, keys, fixed, order, key: str = "key", value: str = "value", extras: str = "extras") -> DataFrame:
    """C17: one row per ``keys``: the fixed columns, and a map of all other pairs.

    Keys are trimmed and title-cased; pairs without a key or value are nothing.
    A fixed column keeps its first value, an extra its last, at the place where
    its key came first. A first step leaves one row for each product and key, so a
    product's pairs meet only once they are distinct.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    pairs = long.select(*keys, F.initcap(F.trim(key)).alias("__key"), F.trim(value).alias("__value"), F.col(order).alias("__order"))
    pairs = pairs.where((F.col("__key") != "") & (F.col("__value") != ""))
    first = F.min_by("__value", "__order").alias("__first")
    each = pairs.groupBy(*keys, "__key").agg(first, F.max_by("__value", "__order").alias("__last"), F.min("__order").alias("__at"))
    columns = [F.max(F.when(F.col("__key") == c, F.col("__first"))).alias(c) for c in fixed]
    other = F.collect_list(F.when(~F.col("__key").isin(*fixed), F.struct("__at", "__key", "__last")))
    entries = F.transform(F.array_sort(other), lambda x: F.struct(x["__key"].alias("key"), x["__last"].alias("value")))
    return each.groupBy(*keys).agg(*columns, F.map_from_entries(entries).alias(extras))


def route_keys(long: DataFrame, fixed) -> DataFrame:
    """C17: marks each pair as a fixed column or an extra."""
    return long.withColumn("target", F.when(F.col("key").isin(*fixed), F.lit("fixed")).otherwise(F.lit("extra")))
