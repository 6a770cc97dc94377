"""Near copies by shingle Jaccard: SimHash tries and MinHash bands propose, exact sets decide.

A text is the set of its runs of ``width`` words. First its SimHash of these
runs goes through the tries of ``simhash``: nodes of one fingerprint and the
forests of fingerprints within its radius are compared whole, and what is similar
is linked. At Jaccard 0.8 fingerprints differ in about 10 of 64 bits, more than
a trie can be walked with, so bands decide the rest: buckets whose nodes the
tries have all joined are done, the others go on.

Sets whose minima under
``ROWS`` permutations agree in one of ``BANDS`` bands meet in a bucket: at
Jaccard 0.8 a pair misses every bucket once in 14,000 times, above 0.8 more
rarely. Equal sets are one node throughout.

Stars: the pivot of a bucket is the node whose own buckets are fullest, so the
original rather than one of its copies. All nodes of a bucket are compared with
the pivot, which costs the size of the buckets. A group around another text
has buckets, and pivots, of its own.

Rest: two nodes that met but are still in different components are told by
their differences from the bucket's first pivot. Nodes x and y are similar
if |x - y| is at most ``(1 - s) / (1 + s)`` of |x| + |y|, and |x - y| is
|Dx| + |Dy| - 2 |Dx & Dy| for their differences D. One of them does not link to
the pivot, so they must share differences, and how many follows from their
sizes. Differences that no other component has come first, then the rarest;
pairs that share none of the first ones, or too late a one, are never made
(prefix and position filter). What is left is compared whole. So every pair
that meets in a bucket is decided, and only pairs that share rare differences
are made.

Links are transitive (components). Defined cases: a null or empty text, or one
without a word, is the empty set and equal to others like it; a text of fewer
words than a shingle is one shingle; equal texts and repeated ids share a
component; components of null ids only have a null id; other columns, whatever
their names, are not read. Words are cut as in ``simhash``. Shingles and sets
are known by 64-bit hashes.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from . import simhash
from .batches import slices
from .graph import components

WIDTH, SIMILARITY, SEED = 5, 0.8, 42
BANDS, ROWS = 24, 5
#: Shingles whose permutations are worked on at once.
FRONT = 2048
_DRAW = np.random.RandomState(SEED)
FLIP, TIMES = (_DRAW.randint(0, 1 << 32, (2, BANDS * ROWS), np.uint64) << np.uint64(32) | _DRAW.randint(0, 1 << 32, (2, BANDS * ROWS), np.uint64))
TIMES = TIMES | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles of a UTF-8 text as sorted hashes."""
    from xxhash import xxh64_intdigest as h

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter((h(w, SEED) for w in words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(width, len(words))):
        out = mixed(out + each[i : i + n])
    return np.unique(out)


def node_of(found: np.ndarray) -> int:
    """Number of a set, as a signed long."""
    from xxhash import xxh64_intdigest as h

    n = h(found.tobytes(), SEED)
    return n - (1 << 64) if n >> 63 else n


def bands(found: np.ndarray) -> np.ndarray:
    """Bucket of a set in each band, as signed longs."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), FRONT):
        least = np.minimum(least, ((found[i : i + FRONT, None] ^ FLIP) * TIMES).min(axis=0))
    key = np.arange(BANDS, dtype=np.uint64)
    for r in least.reshape(BANDS, ROWS).T:
        key = mixed(key + r)
    return key.view(np.int64)


def alike(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def decoded(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, np.uint64) for v in column.to_pylist()]


def compared(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b, linked, apart) of pairs (a, b): ``apart`` is b's differences from a, as longs."""

    def run(batches):
        for batch in slices(batches):
            a, b = decoded(batch.column(2)), decoded(batch.column(3))
            linked = pa.array([alike(x, y, similarity) for x, y in zip(a, b)], pa.bool_())
            apart = pa.array([np.setxor1d(x, y, assume_unique=True).view(np.int64) for x, y in zip(a, b)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), linked, apart], ["a", "b", "linked", "apart"])

    both = pairs.join(sets.withColumnsRenamed({"node": "b", "set": "set_b"}), "b").join(sets.withColumnsRenamed({"node": "a", "set": "set_a"}), "a")
    return stored(both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long, linked boolean, apart array<long>"), "compared")


def rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of ``nodes`` with the root of their component."""
    roots = components(links).withColumnRenamed("root", "found")
    return nodes.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("found", "node")).drop("found")


def within_radius(each: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that join whatever lies within the radius of SimHash: the tries' forests, not all pairs."""
    prints = each.select("node", "fp").distinct()
    lead = stored(prints.groupBy("fp").agg(F.min("node").alias("lead")), "prints")
    equal = prints.join(lead, "fp").where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    forest = simhash.links(lead).join(lead.withColumnsRenamed({"fp": "a", "lead": "node_a"}), "a").join(lead.withColumnsRenamed({"fp": "b", "lead": "node_b"}), "b")
    return equal.union(forest.select(F.least("node_a", "node_b"), F.greatest("node_a", "node_b")).distinct())


def pivots(members: DataFrame) -> DataFrame:
    """(key, pivot) of buckets: the member that meets the most others over all its buckets, then the smallest."""
    best = F.max(F.struct("meets", (-F.col("node")).alias("minus"), "node"))
    return members.groupBy("key").agg(best.getField("node").alias("pivot"))


def open_buckets(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    apart = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    return members.join(apart, "key", "left_semi")


def sharing(met: DataFrame, stars: DataFrame, sizes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different components under one pivot that may be similar by their differences from it.

    ``met`` has (pivot, node, root), ``stars`` what ``compared`` says of (pivot, node).
    """
    f = (1 - similarity) / (1 + similarity)
    size = sizes.withColumnsRenamed({"node": "pivot", "size": "pivot_size"})
    apart = stars.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "linked", "apart")
    each = met.join(apart, ["pivot", "node"]).join(sizes, "node").join(size, "pivot").withColumn("n", F.size("apart"))
    # Half the sum of two nodes' excess is what they must share; a partner's is at least this.
    each = each.withColumn("excess", F.col("n") - f * F.col("size")).withColumn("partner", F.when(F.col("linked"), f * F.col("pivot_size")).otherwise(-f * F.col("pivot_size")))
    need = F.greatest(F.lit(1), F.ceil((F.col("excess") + F.col("partner")) / 2 - 1e-6))
    each = each.withColumn("first", F.col("n") - need + 1).where("first > 0")
    entry = stored(each.select("pivot", "node", "root", "n", "excess", "first", F.explode("apart").alias("e")), "differences")
    held = entry.groupBy("pivot", "e").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("holders"))
    common = entry.join(held.where("low < high").select("pivot", "e", "holders"), ["pivot", "e"])
    mine = Window.partitionBy("pivot", "node")
    # Differences of one component only come first: nothing else is known of their places than how many they are.
    place = F.row_number().over(mine.orderBy("holders", "e")) + F.col("n") - F.count(F.lit(1)).over(mine)
    common = stored(common.withColumn("place", place).where("place <= first").select("pivot", "node", "root", "n", "excess", "e", "place"), "prefixes")
    left = common.withColumnsRenamed({"node": "a", "root": "root_a", "n": "n_a", "excess": "excess_a", "place": "place_a"})
    right = common.withColumnsRenamed({"node": "b", "root": "root_b", "n": "n_b", "excess": "excess_b", "place": "place_b"})
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) + 1
    enough = most >= (F.col("excess_a") + F.col("excess_b")) / 2 - 1e-6
    return left.join(right, ["pivot", "e"]).where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & enough).select("a", "b").distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """Per row: id, node (long, the set), component_id (smallest id of the linked sets)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def measure(batches):
        for batch in slices(batches):
            sets = [shingles(t or b"", width) for t in batch.column(1).to_pylist()]
            fp = np.array([simhash.simhash(t or b"", width) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            columns = pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(fp), pa.array([bands(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["id", "text", "node", "size", "fp", "bands"])

    def cut(batches):
        for batch in slices(batches):
            sets = [shingles(t or b"", width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "set"])

    each = stored(rows.mapInArrow(measure, f"id {kind}, text binary, node long, size long, fp long, bands array<long>"), "sets")
    met = each.select("node", "size", F.explode("bands").alias("key")).distinct()
    shared = met.groupBy("key").agg(F.count(F.lit(1)).alias("meets")).where("meets > 1")
    members = stored(met.join(shared, "key"), "buckets")
    weight = members.groupBy("node").agg(F.sum("meets").alias("meets"))
    members = stored(members.drop("meets").join(weight, "node").withColumn("root", F.col("node")), "members")
    sizes = members.select("node", "size").distinct()
    close = stored(within_radius(each), "close")
    wanted = sizes.select("node").union(close.select("a")).union(close.select("b"))
    texts = each.select("node", "text").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    sets = stored(texts.select("node", "text").mapInArrow(cut, "node long, set binary"), "shingles")

    links = stored(compared(close, sets, similarity).where("linked").select("a", "b"), "links")
    members = stored(open_buckets(rooted(members, links)), "left")
    first = stored(pivots(members), "pivots")
    around = members.join(first, "key").where(F.col("node") != F.col("pivot"))
    stars = compared(around.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), sets, similarity)
    links = stored(links.union(stars.where("linked").select("a", "b")), "links")
    members = stored(rooted(members, links), "rooted")
    met = open_buckets(members).join(first, "key").where(F.col("node") != F.col("pivot")).select("pivot", "node", "root").distinct()
    pairs = sharing(stored(met, "open"), stars, sizes, similarity)
    links = links.union(compared(pairs, sets, similarity).where("linked").select("a", "b"))
    least = each.groupBy("node").agg(F.min("id").alias("least"))
    placed = stored(rooted(least, links), "placed")
    classes = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    return each.select("id", "node").join(classes, "node").select(F.col("id").alias(id_col), "node", "component_id")
