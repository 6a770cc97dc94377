"""SimHash near-duplicates by a binary trie joined with itself.

Fingerprints are 64-bit paths of a binary trie. Two of them link at ``RADIUS``
differing bits or fewer. Of two bits, either the first half holds at most one
or the second half holds none, so two tries are walked: bits in order with at
most one error in the first 32, and halves swapped with no error in the first
32. Walking a node against its sibling costs one error and is pruned when the
errors allowed at that depth are spent.

On the cluster a fingerprint enters each node it can reach within the errors
allowed so far: its own and, per 1 bit above, the sibling's. A node that more
than ``NODE_ROWS`` entries reach is split deeper, entries and errors alike, so
a dense group is spread instead of meeting in one task; a whole path is
reached by at most 2,081 fingerprints. In a node the pairs of child nodes are
walked with whole arrays, and a spanning forest of the links leaves the task,
not the links. Forests are then joined to components.

Defined cases: a null or empty text, or one without a word, has fingerprint
zero and links like any other; a text of fewer words than a shingle has one
shingle; equal texts and repeated ids share a fingerprint and a component;
components of null ids only have a null id; other columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .graph import components

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Entries that may meet in one node; more than a whole path can be reached by.
NODE_ROWS = 4096
#: Bits by which an overfull node is split.
STEP = 4
#: Node pairs worked on at once inside a task.
FRONT = 1 << 18


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of one UTF-8 text, as an unsigned number."""
    from xxhash import xxh64_intdigest as h

    words = text.lower().split()
    if not words:
        return 0
    runs = [b" ".join(r) for r in zip(*(words[i:] for i in range(shingle)))] if len(words) >= shingle else [b" ".join(words)]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(runs), 1 << 16):
        part = np.fromiter((h(r, seed) for r in runs[i : i + (1 << 16)]), "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(runs), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, fp): the fingerprint as a signed long. Bytes are lower-cased in A-Z
    and cut at ASCII white space only, as bytes.lower and bytes.split do."""

    def run(batches):
        for batch in batches:
            fp = [simhash(t or b"", shingle, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fp, np.uint64).view(np.int64))], [id_col, "fp"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").cast("binary")).mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, fp long")


def spend(trie: np.ndarray, bit: int) -> np.ndarray:
    """Errors that may be spent up to and including a bit, by trie."""
    return np.where(trie == 0, 1 if bit < 32 else RADIUS, 0 if bit < 32 else RADIUS)


def descend(entries: dict[str, np.ndarray], start: int, end: int) -> dict[str, np.ndarray]:
    """Entries with those that leave them for a sibling at bits start..end.

    The first error is spent by the path with a 1 there, so each pair of
    nodes is walked once; a second error in either direction.
    """
    e = {k: v.copy() for k, v in entries.items()}
    for bit in range(start, end):
        mask = np.uint64(1 << (63 - bit))
        own = (e["path"].view(np.uint64) & mask) != 0
        may = (e["spent"] < spend(e["trie"], bit)) & (own | (e["spent"] > 0))
        new = {k: v[may] for k, v in e.items()}
        new["path"] = (new["path"].view(np.uint64) ^ mask).view(np.int64)
        new["spent"] = new["spent"] + 1
        e = {k: np.concatenate([v, new[k]]) for k, v in e.items()}
    return e


def near_pairs(values: np.ndarray, radius: int = RADIUS, start: int = 0):
    """Index pairs of sorted distinct 64-bit values within ``radius`` bits, in any order.

    Nodes are index ranges of the sorted values. Pairs of nodes are split bit
    by bit; a pair is dropped when its differing bits exceed the radius and
    compared outright once it is small.
    """
    n = len(values)
    zeros = {}
    stack = [(start, *(np.array([x], np.int64) for x in (0, n, 0, n, 0)))]
    while stack:
        bit, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > FRONT:
            half = len(alo) // 2
            stack.append((bit, alo[half:], ahi[half:], blo[half:], bhi[half:], err[half:]))
            stack.append((bit, alo[:half], ahi[:half], blo[:half], bhi[:half], err[:half]))
            continue
        small = ((ahi - alo) * (bhi - blo) <= 4) | (bit == 64)
        if small.any():
            al, an, bl, bn = alo[small], (ahi - alo)[small], blo[small], (bhi - blo)[small]
            count = an * bn
            which = np.repeat(np.arange(len(al)), count)
            k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            i, j = al[which] + k // bn[which], bl[which] + k % bn[which]
            hit = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= radius)
            yield i[hit], j[hit]
            alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        if bit not in zeros:
            zeros[bit] = np.r_[0, np.cumsum((values >> np.uint64(63 - bit)) & np.uint64(1) == 0)]
        z = zeros[bit]
        amid, bmid = alo + z[ahi] - z[alo], blo + z[bhi] - z[blo]
        same = alo == blo
        kids = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1)]
        kids.append(tuple(x[~same] for x in (amid, ahi, blo, bmid, err + 1)))
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*kids))
        live = (ahi > alo) & (bhi > blo) & (err <= radius)
        stack.append((bit + 1, *(x[live] for x in (alo, ahi, blo, bhi, err))))


def forest(values: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Per value the index of the smallest value it is linked to, over any number of links."""
    root = np.arange(len(values))
    for i, j in near_pairs(values, radius):
        while len(i):
            a, b = root[i], root[j]
            low = np.minimum(a, b)
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            while (root[root] != root).any():
                root = root[root]
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
    return root


def links(prints: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that join whatever lies within the radius."""
    spark, kind = prints.sparkSession, "trie int, path long, spent int, fp long"
    n = prints.count()
    depth = 1
    while n / 2**depth * (1 + depth / 2) > node_rows / 2 and depth < 32:
        depth += 1

    def enter(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            swapped = np.bitwise_or(fp.view(np.uint64) << np.uint64(32), fp.view(np.uint64) >> np.uint64(32)).view(np.int64)
            for t, path in ((0, fp), (1, swapped)):
                e = {"trie": np.full(len(fp), t, np.int32), "path": path, "spent": np.zeros(len(fp), np.int32), "fp": fp}
                yield record(descend(e, 0, depth))

    def deeper(start: int, end: int):
        def run(batches):
            for batch in batches:
                yield record(descend({c: batch.column(c).to_numpy() for c in ("trie", "path", "spent", "fp")}, start, end))

        return run

    def record(e):
        return pa.RecordBatch.from_arrays([pa.array(e[c]) for c in ("trie", "path", "spent", "fp")], ["trie", "path", "spent", "fp"])

    def meet(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy()
        if group.column("spent").to_numpy().min() > 0:
            fp = fp[:0]
        values = np.unique(fp.view(np.uint64))
        root = forest(values)
        at = np.flatnonzero(root != np.arange(len(values)))
        return pa.table({"a": values[at].view(np.int64), "b": values[root[at]].view(np.int64)})

    def node(d: int):
        return F.shiftrightunsigned("path", 64 - d)

    entries, found = prints.select("fp").mapInArrow(enter, kind), []
    while True:
        entries = stored(entries.withColumn("node", node(depth)), "entries")
        heavy = stored(entries.groupBy("trie", "node").count().where(F.col("count") > node_rows).select("trie", "node"), "heavy")
        last = depth == 64 or heavy.isEmpty()
        ready = entries if last else entries.join(heavy, ["trie", "node"], "left_anti")
        found.append(ready.groupBy("trie", "node").applyInArrow(meet, "a long, b long"))
        if last:
            break
        end = min(64, depth + STEP)
        entries = entries.join(heavy, ["trie", "node"], "left_semi").drop("node").mapInArrow(deeper(depth, end), kind)
        depth = end
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: id, fp (long), component_id (smallest id of the linked fingerprints)."""
    each = stored(fingerprints(docs, id_col, text_col, **options), "fingerprints")
    prints = stored(each.groupBy("fp").agg(F.min(id_col).alias("least")), "prints")
    roots = components(links(prints))
    rooted = prints.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return each.join(classes, "fp").select(id_col, "fp", "component_id")
