"""Counts, fill reports and ordered concatenation."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.rx import is_blank, present


def fill_report(df: DataFrame, columns) -> DataFrame:
    """G1: per column rows, non-null and non-blank counts; one pass over the data."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggs += [F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.count_if(~is_blank(F.col(f"`{c}`"))).alias(f"f{i}")]
    one = df.agg(*aggs)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("rows").alias("row_count"), F.col(f"n{i}").alias("non_null"), F.col(f"f{i}").alias("filled")) for i, c in enumerate(columns)])
    return one.select(F.inline(entries)).withColumn("all_blank", F.col("filled") == 0)


# Metric names of the audit report, in order.
AUDIT_METRICS = {
    "total": "Total Websites Audited",
    "reachable": "Successfully Crawled",
    "failed": "Failed to Crawl",
    "excellent": "Excellent SEO Status",
    "good": "Good SEO Status",
    "fair": "Fair SEO Status",
    "poor": "Poor SEO Status",
    "perfect_alt": "Sites with Perfect Alt Tags",
    "missing_alt": "Sites Missing Alt Tags",
    "mean_links": "Average Internal Links",
}


def audit_summary(audit: DataFrame) -> DataFrame:
    """metric/amount pairs. Unreachable rows have no missing alts and count as perfect."""
    one = audit.agg(
        F.count(F.lit(1)).cast("double").alias("total"),
        F.count_if(F.col("http_status").isNotNull()).cast("double").alias("reachable"),
        F.count_if(F.col("http_status").isNull()).cast("double").alias("failed"),
        *[F.count_if(F.col("overall_seo_status") == s).cast("double").alias(s.lower()) for s in ("Excellent", "Good", "Fair", "Poor")],
        F.count_if(F.col("images_missing_alt") == 0).cast("double").alias("perfect_alt"),
        F.count_if(F.col("images_missing_alt") > 0).cast("double").alias("missing_alt"),
        F.bround(F.coalesce(F.avg("internal_links_count"), F.lit(0.0)), 1).alias("mean_links"),
    )
    pairs = [F.struct(F.lit(name).alias("metric"), F.col(c).alias("amount")) for c, name in AUDIT_METRICS.items()]
    return one.select(F.inline(F.array(*pairs)))


def filled_counts(df: DataFrame, *columns: str) -> DataFrame:
    """G3/G15."""
    return df.agg(*[F.count_if(~is_blank(c)).alias(f"{c}_filled") for c in columns])


def category_counts(df: DataFrame, category: str) -> DataFrame:
    """G4."""
    return df.groupBy(category).agg(F.count(F.lit(1)).alias("products"))


def first_value(df: DataFrame, keys, value: str, order: str, out: str) -> DataFrame:
    """G5."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(out))


def distinct_concat(df: DataFrame, keys, value: str, order, out: str, separator: str = ", ") -> DataFrame:
    """Distinct non-blank values per key in order of first appearance.

    Two steps: the first keeps one row per (key, value) with its earliest
    order, combined map-side, so the list only ever holds distinct values.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    firsts = df.filter(~is_blank(value)).groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("__o"))
    listed = firsts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__o", value))).alias("__l"))
    return listed.select(*keys, F.array_join(F.transform("__l", lambda x: x[value]), separator).alias(out))


def variant_label(*options, separator: str = " / "):
    """Non-empty options joined; ``concat_ws`` skips nulls."""
    return F.concat_ws(separator, *[present(o) for o in options])


def keyword_pages(hits: DataFrame, site: str, order: str, url: str, flags, last: bool = True) -> DataFrame:
    """G9 (last page wins) and G10 (first page wins): found flag and source per keyword."""
    pick = F.max_by if last else F.min_by
    aggs = []
    for f in flags:
        aggs.append(F.when(F.bool_or(f), F.lit("Yes")).otherwise(F.lit("No")).alias(f"{f}_found"))
        aggs.append(F.coalesce(pick(F.when(F.col(f), F.col(url)), F.when(F.col(f), F.col(order))), F.lit("")).alias(f"{f}_source"))
    return hits.groupBy(site).agg(*aggs)


def sorted_set(df: DataFrame, keys, value: str, out: str, separator: str = ", ") -> DataFrame:
    """Distinct values, sorted so the text is always the same."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(present(value))), separator).alias(out))


def change_count(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Rows whose new value differs from the old, per column."""
    return df.agg(*[F.count_if(~F.col(new).eqNullSafe(F.col(old))).alias(f"{old}_changed") for old, new in pairs.items()])


def status_report(df: DataFrame, status: str = "status") -> DataFrame:
    """G14."""
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("rows"))


def failed_keys(df: DataFrame, key: str, status: str = "status") -> DataFrame:
    """The dead-letter table."""
    return df.filter(F.col(status) == "failed").select(key).distinct()


def done_keys(df: DataFrame, key: str) -> DataFrame:
    """G16."""
    return df.select(key).filter(~is_blank(key)).distinct()


def union_all(frames) -> DataFrame:
    """By name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
