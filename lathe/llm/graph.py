"""Connected components of links by hooking and pointer jumping."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node of its component.

    Each round gives every node its smallest neighbour as parent, jumps along
    parents until all point at roots (a path doubles with each jump), and
    contracts the links to those between different roots, of which at most
    half as many are left. Minima combine before the shuffle, so a hub costs
    one row per task; each step is written to the shared folder, so lineage
    stays short. Rounds end when no link is left.
    """
    edges = stored(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "links")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("parent")), "parents")
        moved = True
        while moved:
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            jumped = stored(parent.join(up, "parent", "left").select("node", "parent", F.coalesce("above", "parent").alias("above")), "parents")
            moved = not jumped.where("parent <> above").isEmpty()
            parent = jumped.select("node", F.col("above").alias("parent"))
        if roots is None:
            roots = parent.select("node", F.col("parent").alias("root"))
        else:
            up = parent.select(F.col("node").alias("root"), "parent")
            roots = roots.join(up, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
        roots = stored(roots, "roots")
        a = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        b = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = stored(edges.join(a, "a").join(b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")).where("a <> b").distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots
