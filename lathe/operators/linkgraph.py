"""Bounded reachability on a landed link table (M5)."""

from pyspark.sql import DataFrame, functions as F

from ..functions.html import links
from ..functions.urls import canonical
from ..session import bucketed, fresh_dir
from .ordered import running_index, top_n


def link_table(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (src, pos, dst) of landed pages, canonical on both ends."""
    out = pages.select(F.col(url).alias("__u"), F.posexplode(links(html)).alias("pos", "__l"))
    return out.select(F.rtrim(F.substring_index("__u", "#", 1), F.lit("/")).alias("src"), "pos", canonical("__u", "__l").alias("dst"))


def steps(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """(site, url, parent, pos) of the links that lead from the frontier to pages of its sites, once each."""
    step = frontier.join(edges, frontier["url"] == edges["src"]).select("site", F.col("dst").alias("url"), F.col("rank").alias("parent"), "pos")
    return step.filter(F.col("url").startswith(F.col("site"))).groupBy("site", "url").agg(F.min("parent").alias("parent"), F.min(F.struct("parent", "pos"))["pos"].alias("pos"))


def reachable(seeds: DataFrame, edges: DataFrame, seed: str = "url", max_pages: int | None = None, max_depth: int | None = None) -> DataFrame:
    """Pages a crawl of each seed would visit: (site, url, depth, rank).

    Breadth first inside the seed's prefix; a level is ordered by parent and
    link position. ``max_pages`` per site and ``max_depth`` are the caller's
    limits; without them the rounds end when a level adds no page.

    The edges are stored once in buckets of their source, pruned to links inside
    an origin, so the pages behind them are read once and no round shuffles
    them. A round joins the frontier with them, drops what the levels written
    so far have, and writes its own level; nothing is written twice. Ranks
    inside a site are running numbers over ranges of the order, so a large
    site is not one task.
    """
    spark, levels = edges.sparkSession, fresh_dir(edges.sparkSession, "levels")
    first = seeds.select(F.rtrim(F.col(seed), F.lit("/")).alias("site")).distinct().select("site", F.col("site").alias("url"), F.lit(0).alias("depth"), F.lit(1).cast("bigint").alias("rank"))
    first.write.parquet(f"{levels}/level=0")
    shape, depth = first.schema, 0
    # A page inside the seed's prefix can only lead to pages of the same origin.
    inside = edges.filter(F.substring_index("src", "/", 3) == F.substring_index("dst", "/", 3)).select("src", "pos", "dst")
    with bucketed(inside, "src", "edges") as links_of:
        while True:
            frontier = spark.read.schema(shape).parquet(f"{levels}/level={depth}")
            depth += 1
            if frontier.isEmpty() or (max_depth is not None and depth > max_depth):
                break
            visited = spark.read.schema(shape).parquet(*[f"{levels}/level={d}" for d in range(depth)])
            fresh = steps(frontier, links_of).join(visited.select("site", "url"), ["site", "url"], "left_anti")
            if max_pages is not None:
                fresh = top_n(fresh, max_pages, ["parent", "pos", "url"], ["site"])
            fresh = running_index(fresh, ["parent", "pos", "url"], ["site"], "place")
            sizes = visited.groupBy("site").agg(F.max("rank").alias("known"))
            ranked = fresh.join(sizes, "site").withColumn("rank", (F.col("known") + F.col("place")).cast("bigint"))
            if max_pages is not None:
                ranked = ranked.filter(F.col("rank") <= max_pages)
            ranked.select("site", "url", F.lit(depth).alias("depth"), "rank").write.parquet(f"{levels}/level={depth}")
    return spark.read.schema(shape).parquet(*[f"{levels}/level={d}" for d in range(depth)])
