"""URL rules by a sort-merge range join.

Hosts are written backwards, label by label, so a rule's host and all its
subdomains are one interval of keys. URLs and rules are sorted together by
key; one sweep keeps a stack of the rules whose interval is open, which are
nested, and of those the longest whose path begins the URL's path decides.
Splitters sampled over (key, id) deal the keys to ranges, so a host that a
third of all URLs share spreads over many ranges; a rule is sent to each range
its interval meets. The splitters are the only rows the driver sees, 64 for
each range at most.

Defined cases: a null URL or one without "://" has an empty host and path and
meets no rule; equal rules give one result, of rules on the same host and path
"block" wins; null fields of a rule are empty, and an empty host meets every
URL that has one; other columns of either table are not read.
"""

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ends a label in a key; sorts before any character of a host name.
END = "\x01"
AFTER = "\x02"
SAMPLES = 64
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 2)


def host_key(host: Column) -> Column:
    labels = F.reverse(F.split(host, r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, END), F.lit(END)))


def splitters(urls: DataFrame, ranges: int) -> list[tuple[str, int]]:
    """Bounds between ranges, from a sample drawn by hash: at most about ``SAMPLES`` rows a range."""
    total = urls.count()
    if total == 0 or ranges < 2:
        return []
    rate = max(1, total // (SAMPLES * ranges))
    seen = sorted((r[0], r[1]) for r in urls.where(F.pmod("mark", F.lit(rate)) == 0).select("key", "mark").collect())
    step = max(1, -(-len(seen) // ranges))
    return sorted(set(seen[step::step]))


class Open:
    """Stack of open rules: (key, end, path, rule, verdict)."""

    def __init__(self):
        self.stack: list[tuple] = []

    def at(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def best(self, host: str, path: str):
        for key, rule_host, rule_path, rule, verdict in reversed(self.stack):
            if path.startswith(rule_path) and (host == rule_host or not rule_host or host.endswith("." + rule_host)):
                return rule, verdict
        return None, None


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url", ranges: int | None = None) -> DataFrame:
    """Per row: id, host, path, rule (null: none), verdict. ``rules``: host, path, verdict.

    The longest host decides, of its rules the longest path.
    """
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType.simpleString()
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    u = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    u = u.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    u = u.withColumn("key", host_key(F.col("host"))).withColumn("mark", F.xxhash64("id", "path"))
    bounds = splitters(u, ranges)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("host", "path", "verdict")]
    r = rules.select(*text).groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn("key", host_key(F.col("host")))

    def place_urls(batches):
        for b in batches:
            part = [bisect_right(bounds, k) for k in zip(b.column("key").to_pylist(), b.column("mark").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), b.column("key"), b.column("host"), b.column("path"), pa.nulls(len(part), pa.string()), b.column("id")], names)

    def place_rules(batches):
        low = [k for k, _ in bounds]
        for b in batches:
            out = []
            for key, host, path, verdict in zip(*(b.column(c).to_pylist() for c in ("key", "host", "path", "verdict"))):
                # The interval of an empty host begins after the URLs without one.
                first, last = bisect_left(low, key), bisect_right(low, key[:-1] + AFTER) if key else len(low)
                out += [(p, key, host, path, verdict) for p in range(first, last + 1)]
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.string()) for c in cols[1:]), pa.nulls(len(out), b_id)], names)

    def sweep(batches):
        part, stack = None, Open()
        for b in batches:
            out = []
            for p, key, host, path, verdict, i in zip(*(b.column(c).to_pylist() for c in names)):
                if p != part:
                    part, stack = p, Open()
                stack.at(key)
                if verdict is not None:
                    stack.stack.append((key, host, path, host + path, verdict))
                else:
                    out.append((i, host, path, *(stack.best(host, path) if host else (None, None))))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b_id), *(pa.array(c, pa.string()) for c in cols[1:])], ["id", "host", "path", "rule", "verdict"])

    names = ["part", "key", "host", "path", "verdict", "id"]
    from pyspark.sql.pandas.types import to_arrow_type

    b_id = to_arrow_type(pages.schema[id_col].dataType)
    shape = f"part int, key string, host string, path string, verdict string, id {kind}"
    events = u.mapInArrow(place_urls, shape).union(r.mapInArrow(place_rules, shape))
    # Rules come before the URLs of their key, shorter paths below longer ones on the stack.
    dealt = events.repartition(ranges, "part").sortWithinPartitions("part", "key", F.col("verdict").isNull(), F.length("path"), "path")
    judged = dealt.mapInArrow(sweep, f"id {kind}, host string, path string, rule string, verdict string")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
