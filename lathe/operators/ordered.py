"""Order-aware operators that never put a whole key into one task (H1-H11, I).

A plain window over a category sends all rows of the category to one task.
Here the rows are range-partitioned by their keys and then their order, and
stored once: a hot key, or a hot first order column (one source with a third of
all rows), spreads over as many partitions as it fills, and a partition holds
few pieces of keys. Rows are numbered inside (key, partition) groups, the
groups' totals are added up on the small aggregated side, and joined back. So
the input is read twice, for the bounds and for the shuffle, and the work runs
when the operator is called. The order columns together should be unique
inside a key.
"""

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.rx import as_col, is_blank
from ..session import stored


def _order(cols):
    return [F.col(c).asc() if isinstance(c, str) else c for c in cols]


def _names(cols):
    return [cols] if isinstance(cols, str) else list(cols)


def _join_back(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe join of the small per-range side; both are hashed on the same columns."""
    side = side.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)} | {"__range": "__side_range"})
    cond = F.col("__range") == F.col("__side_range")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return df.join(side, cond, "left").drop("__side_range", *[f"__k{i}" for i in range(len(keys))])


def laid_out(df: DataFrame, order: list[str], keys=(), ranges: int | None = None) -> DataFrame:
    """The rows stored in (keys, order), with ``__at``, a place that grows inside a partition, and ``__range``, the partition.

    Without ``ranges`` there are as many partitions as the session's shuffles have, before AQE joins small ones.
    """
    cols = [*keys, *_order(order)]
    spread = df.repartitionByRange(ranges, *cols) if ranges else df.repartitionByRange(*cols)
    laid = stored(spread.sortWithinPartitions(*cols).withColumn("__at", F.monotonically_increasing_id()), "laid")
    # monotonically_increasing_id is the partition number followed by 33 bits of the row's place.
    return laid.withColumn("__range", F.shiftright("__at", 33))


def numbered(df: DataFrame, order, out: str = "Index", start: int = 0, label: str = "numbered", ranges: int | None = None) -> DataFrame:
    """Gap-free numbers over all rows in order: one range shuffle, no window over rows.

    The rows are range-partitioned, sorted and stored once with their place in
    their partition; a prefix sum over the partition totals, one row for each
    partition, turns places into numbers. Rows alike in all order columns
    share a partition, so end the order with a column that tells rows apart.
    An empty input gives an empty output; a column called ``out`` is replaced.
    """
    cols = _order(_names(order))
    rows = df.drop(out)
    spread = rows.repartitionByRange(ranges, *cols) if ranges else rows.repartitionByRange(*cols)
    laid = stored(spread.sortWithinPartitions(*cols).withColumn("__at", F.monotonically_increasing_id()), label)
    # monotonically_increasing_id is the partition number followed by 33 bits of the row's place.
    totals = laid.groupBy(F.shiftright("__at", 33).alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    # One row for each shuffle partition: small whatever the input.
    joined = laid.join(F.broadcast(offsets), F.shiftright("__at", 33) == F.col("__part"))
    return joined.withColumn(out, F.col("__offset") + place + F.lit(start)).drop("__at", "__part", "__offset")


def running_sum(df: DataFrame, value, order, keys=(), out: str = "running", ranges: int | None = None, start: int = 0) -> DataFrame:
    """Sum of ``value`` over all rows up to this one, per key, in order; NULL before the first value."""
    order, keys = _names(order), _names(keys)
    work = laid_out(df.withColumn("__value", as_col(value)), order, keys, ranges)
    totals = work.groupBy(*keys, "__range").agg(F.sum("__value").alias("__total"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "__range", F.sum("__total").over(before).alias("__offset"))
    inside = Window.partitionBy(*keys, "__range").orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = work.withColumn("__local", F.sum("__value").over(inside))
    joined = _join_back(local, offsets, keys)
    total = F.when(F.coalesce("__offset", "__local").isNotNull(), F.coalesce("__offset", F.lit(0)) + F.coalesce("__local", F.lit(0)) + F.lit(start))
    return joined.withColumn(out, total).drop("__at", "__range", "__value", "__local", "__offset")


def running_index(df: DataFrame, order, keys=(), out: str = "Index", ranges: int | None = None, start: int = 0) -> DataFrame:
    """H1 with keys, H2 without: gap-free 1..n in order; a column called ``out`` is replaced. No window over rows."""
    order, keys = _names(order), _names(keys)
    if not keys:
        return numbered(df, order, out, start)
    work = laid_out(df.drop(out), order, keys, ranges)
    totals = work.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "__range", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__offset"))
    joined = _join_back(work, offsets, keys)
    return joined.withColumn(out, F.col("__at") + F.col("__offset") + F.lit(1 + start)).drop("__at", "__range", "__offset")


def index_across(df: DataFrame, category: str, category_order: str, order, out: str = "Index", ranges: int | None = None) -> DataFrame:
    """H2: one running index over categories in their configured order.

    The rows are numbered in (category order, category, order) as a whole, so a
    category with most of the rows is cut into ranges like any other part of
    the order and no row is shuffled by its category.
    """
    return numbered(df, [category_order, category, *_names(order)], out, ranges=ranges)


def index_missing(df: DataFrame, target: str, order, start: int = 0, out: str = "serial", ranges: int | None = None) -> DataFrame:
    """The number advances only on rows whose ``target`` is missing."""
    return running_sum(df, F.when(is_blank(target), 1).otherwise(0).cast("bigint"), order, (), out, ranges, start)


def batch_number(df: DataFrame, order, size: int = 50, out: str = "batch", ranges: int | None = None) -> DataFrame:
    """H5/B9."""
    numbered = running_index(df, order, (), "__i", ranges)
    return numbered.withColumn(out, F.ceil(F.col("__i") / size).cast("bigint")).drop("__i")


def carry_forward(df: DataFrame, value, order, keys=(), out: str = "section", ranges: int | None = None) -> DataFrame:
    """H7/H9: the last non-null ``value`` at or before this row, per key."""
    order, keys = _names(order), _names(keys)
    work = laid_out(df.withColumn("__value", as_col(value)), order, keys, ranges)
    seen = work.filter(F.col("__value").isNotNull())
    rank = F.struct(*[F.col(c) for c in order])
    totals = work.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__n"))
    lasts = seen.groupBy(*keys, "__range").agg(F.max_by("__value", rank).alias("__last"))
    per_range = _join_back(totals, lasts, keys)
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    priors = per_range.select(*keys, "__range", F.last("__last", ignorenulls=True).over(before).alias("__prior"))
    inside = Window.partitionBy(*keys, "__range").orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = work.withColumn("__local", F.last("__value", ignorenulls=True).over(inside))
    joined = _join_back(local, priors, keys)
    return joined.withColumn(out, F.coalesce("__local", "__prior")).drop("__at", "__range", "__value", "__local", "__prior")


def next_value(df: DataFrame, value, order, keys=(), out: str = "next", ranges: int | None = None) -> DataFrame:
    """H8: the first non-null ``value`` strictly after this row, per key."""
    order, keys = _names(order), _names(keys)
    work = laid_out(df.withColumn("__value", as_col(value)), order, keys, ranges)
    rank = F.struct(*[F.col(c) for c in order])
    totals = work.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__n"))
    firsts = work.filter(F.col("__value").isNotNull()).groupBy(*keys, "__range").agg(F.min_by("__value", rank).alias("__first"))
    per_range = _join_back(totals, firsts, keys)
    after = Window.partitionBy(*keys).orderBy("__range").rowsBetween(1, Window.unboundedFollowing)
    later = per_range.select(*keys, "__range", F.first("__first", ignorenulls=True).over(after).alias("__later"))
    # first() over "1..unbounded" scans quadratically; last() over the reversed order does not.
    flipped = [F.col(c).desc() for c in order]
    inside = Window.partitionBy(*keys, "__range").orderBy(*flipped).rowsBetween(Window.unboundedPreceding, -1)
    local = work.withColumn("__local", F.last("__value", ignorenulls=True).over(inside))
    joined = _join_back(local, later, keys)
    return joined.withColumn(out, F.coalesce("__local", "__later")).drop("__at", "__range", "__value", "__local", "__later")


def sheet_order(df: DataFrame, category: str, order: str, out: str = "sheet_ord") -> DataFrame:
    """Categories numbered by first appearance. One row per category."""
    firsts = df.groupBy(category).agg(F.min(order).alias("first_ord"))
    return firsts.withColumn(out, F.dense_rank().over(Window.orderBy("first_ord", category)).cast("bigint"))


def top_n(df: DataFrame, n: int, order, keys=()) -> DataFrame:
    """First n rows per key.

    ``row_number() <= n`` is pushed below the shuffle as a group limit, so a
    map task sends at most n rows of a key.
    """
    w = Window.partitionBy(*_names(keys)).orderBy(*_order(_names(order)))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def sort_nulls_last(df: DataFrame, *cols: str) -> DataFrame:
    """Range-partitioned global sort, missing values at the end."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def sort_by_category(df: DataFrame, category_dim: DataFrame, category: str, order: str, serial: str | None = None) -> DataFrame:
    """Configured category order, then source order; categories that are not configured come last.

    ``serial`` names a column for the row's gap-free number in this order; then
    ``order`` must tell rows apart.
    """
    dim = category_dim.select(F.col("category").alias("__c"), F.col("ord").alias("__cat_ord"))
    joined = df.join(dim, F.col(category) == F.col("__c"), "left").drop("__c")
    if serial:
        placed = F.coalesce("__cat_ord", F.lit((1 << 31) - 1))
        return numbered(joined.withColumn("__cat_ord", placed), ["__cat_ord", order], serial).drop("__cat_ord")
    return joined.orderBy(F.col("__cat_ord").asc_nulls_last(), F.col(order)).drop("__cat_ord")
