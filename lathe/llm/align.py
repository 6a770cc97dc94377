"""Alignment of two tokenizers over the bytes of the same text.

A is a byte-level BPE file, B a piece model that puts a space in front; both
are read over space+text. The ends of A's and of B's tokens are two sorted
lists, and overlaps and groups come out of merging them. The merge of all texts of a
chunk is divided along its path: a binary search on every ``STEP``-th diagonal
finds how many ends of A lie before it, so the pieces between diagonals are independent and
of equal work however long a text is, and they advance in lockstep, one
end at a step. A piece emits its overlapping pairs of tokens and counts the
places where both end; a prefix sum of those counts over the pieces joins the
groups that cross a border.

How many documents hold a pair of ids linked is counted over the corpus: each
chunk sends a pair once with its documents, and gets a pair's count back once;
a pair that is in every text costs one row for each chunk. The counts meet the chunk's
own rows again by its number, in one task of bounded size.

Defined cases: a null or empty text, or one whose tokens do not give back its
bytes (the piece model rewrites some), has no tokens, zeros, and an empty
``groups_sha256``; strings of special tokens are plain text; texts are read
whole; equal texts and repeated ids are documents of their own; other columns,
whatever their names, are not read; an empty table gives an empty one.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .ahobpe import digests
from .bpe import chunks, codec, table
from .pieces import BYTE_PATTERN, PieceIds, is_plain, ragged

#: Ends merged by a piece of the path.
STEP = 64
#: Characters of texts in a chunk.
CHUNK = 1_000_000


class Pair:
    """Both tokenizers: ids of texts and the bytes of every id."""

    def __init__(self, bpe_path: str, piece_path: str):
        import sentencepiece

        self.a = codec(bpe_path)
        self.known = PieceIds(self.a.merge)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = table([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        self.size_b = n
        self.digits = table([b"%d," % i for i in range(max(self.a.size, n))])

    def encode_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [BYTE_PATTERN.findall(t) if is_plain(t) else [t[x:y] for _, (x, y) in self.a.cut(t)] for t in texts]
        ids, n = self.known.ids([p for c in cut for p in c])
        ends = np.r_[0, np.cumsum(n)][np.cumsum([0] + [len(c) for c in cut])]
        return ids.astype(np.int64), np.diff(ends)

    def encode_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = self.b.encode(texts, num_threads=1)
        n = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter((i for e in each for i in e), np.int64, int(n.sum())), n


@lru_cache(maxsize=2)
def pair(bpe_path: str, piece_path: str) -> Pair:
    """Loaded once in a worker."""
    return Pair(bpe_path, piece_path)


def diagonals(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path crosses every ``step``-th diagonal; of equal ends A's comes first."""
    d = np.arange(0, len(a) + len(b), step)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        before = open_.copy()
        before[open_] = a[mid[open_]] <= b[d[open_] - 1 - mid[open_]]
        low = np.where(before, mid + 1, low)
        high = np.where(open_ & ~before, mid, high)
    return low, d - low


def merged(a: np.ndarray, b: np.ndarray, step: int = STEP):
    """Overlaps and groups of two lists of ends over the same bytes.

    Returns the overlapping pairs as two arrays of token numbers, and the
    group of each token of A and of B.
    """
    i, j = diagonals(a, b, step)
    shape, total = (len(i), step), len(a) + len(b)
    last = np.iinfo(np.int64).max
    a_end, b_end = np.r_[a, last], np.r_[b, last]
    a_start, b_start = np.r_[0, a], np.r_[0, b]
    at_a, at_b = np.empty(shape, np.int32), np.empty(shape, np.int32)
    link, from_a, closes = np.zeros(shape, bool), np.zeros(shape, bool), np.zeros(shape, bool)
    for k in range(step):
        ea, eb, sa, sb = a_end[i], b_end[j], a_start[i], b_start[j]
        take = ea <= eb
        at_a[:, k], at_b[:, k], from_a[:, k] = i, j, take
        link[:, k] = (sa < eb) & (sb < ea)
        # A's end came first if both are at this place: the group ends with B's.
        closes[:, k] = ~take & (sa == eb)
        i, j = np.minimum(i + take, len(a)), np.minimum(j + ~take, len(b))
    inside = np.cumsum(closes, axis=1) - closes
    here = closes.sum(axis=1)
    group = (inside + (np.cumsum(here) - here)[:, None]).ravel()[:total]
    at_a, at_b, link, from_a = (x.ravel()[:total] for x in (at_a, at_b, link, from_a))
    return at_a[link], at_b[link], group[from_a], group[~from_a]


def group_bytes(ids_a, ids_b, group_a, group_b, digits) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of all tokens, and where each group ends."""
    groups = int(group_a[-1]) + 1 if len(group_a) else 0
    to_a = np.r_[0, np.cumsum(np.bincount(group_a, minlength=groups))]
    to_b = np.r_[0, np.cumsum(np.bincount(group_b, minlength=groups))]
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    ids[np.arange(len(ids_a)) + to_b[group_a]] = ids_a
    ids[np.arange(len(ids_b)) + to_a[group_b + 1]] = ids_b
    flat, n = ragged(*digits, ids)
    ends = np.r_[0, np.cumsum(n)]
    flat[ends[to_a[1:] + to_b[:-1]] - 1] = ord("|")
    stops = ends[to_a[1:] + to_b[1:]]
    flat[stops - 1] = ord(";")
    return flat, stops


class Aligned:
    """A chunk of texts: counts and groups of each, and its linked pairs of ids."""

    def __init__(self, p: Pair, texts: list[str], step: int = STEP):
        lead = [" " + t for t in texts]
        ids_a, n_a = p.encode_a(lead)
        ids_b, n_b = p.encode_b(texts)
        raw_a, len_a = ragged(*p.a.bytes, ids_a)
        raw_b, len_b = ragged(*p.b_bytes, ids_b)
        ends_a, ends_b = np.r_[0, np.cumsum(n_a)], np.r_[0, np.cumsum(n_b)]
        byte_a, byte_b = np.r_[0, np.cumsum(len_a)][ends_a], np.r_[0, np.cumsum(len_b)][ends_b]
        view_a, view_b = memoryview(raw_a.tobytes()), memoryview(raw_b.tobytes())
        good = np.array([t != " " and view_a[byte_a[k] : byte_a[k + 1]] == view_b[byte_b[k] : byte_b[k + 1]] == t.encode() for k, t in enumerate(lead)], bool)
        keep_a, keep_b = np.repeat(good, n_a), np.repeat(good, n_b)
        ids_a, ids_b, end_a, end_b = ids_a[keep_a], ids_b[keep_b], np.cumsum(len_a[keep_a]), np.cumsum(len_b[keep_b])
        self.n_a, self.n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        at_a, at_b, group_a, group_b = merged(end_a, end_b, step)
        flat, stops = group_bytes(ids_a, ids_b, group_a, group_b, p.digits)
        # Texts end where both tokenizers end, so groups and links never cross them.
        groups = np.r_[group_a, group_a[-1] + 1 if len(group_a) else 0][np.r_[0, np.cumsum(self.n_a)]]
        self.n_groups = np.diff(groups)
        self.group_text, self.group_ends = flat, np.r_[0, stops][groups]
        text_of = np.repeat(np.arange(len(texts)), self.n_a)[at_a]
        self.n_links = np.bincount(text_of, minlength=len(texts))
        pairs = p.a.size * p.size_b
        each, self.times = np.unique(text_of * pairs + ids_a[at_a] * p.size_b + ids_b[at_b], return_counts=True)
        self.pairs = each % pairs
        self.n_pairs = np.bincount(each // pairs, minlength=len(texts))
        self.seen, self.docs = np.unique(self.pairs, return_counts=True)


ROW = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, pairs array<long>, times array<long>, seen array<long>, docs array<long>"


def aligned(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, with_groups: bool = False) -> DataFrame:
    """Per row: ``key``, its counts and distinct pairs; the pairs of a whole chunk lie in its first row."""
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))

    def lists(values, n):
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(values))

    def run(batches):
        p, block = pair(bpe_path, piece_path), TaskContext.get().partitionId() << 32
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for start, stop in chunks(texts, chunk):
                x = Aligned(p, texts[start:stop])
                n = stop - start
                block += 1
                first = np.r_[len(x.seen), np.zeros(n - 1, np.int64)]
                shas = [s if g else "" for s, g in zip(digests(x.group_text, x.group_ends[1:], 1), x.n_groups)]
                out = [b.column(0).slice(start, n), *map(pa.array, (x.n_a, x.n_b, x.n_groups, x.n_links)), pa.array(shas, pa.string())]
                out += [pa.array(np.full(n, block)), lists(x.pairs, x.n_pairs), lists(x.times, x.n_pairs), lists(x.seen, first), lists(x.docs, first)]
                if with_groups:
                    text = memoryview(x.group_text.tobytes())
                    out.append(pa.array([str(text[s : max(s, e - 1)], "ascii") for s, e in zip(x.group_ends, x.group_ends[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names)

    shape = f"key {rows.schema['key'].dataType.simpleString()}, {ROW}" + ", groups string" * with_groups
    names = ["key", *(f.split(" ")[0] for f in ROW.split(", "))] + ["groups"] * with_groups
    return rows.mapInArrow(run, shape)


def align_tokenizers(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if asked, groups."""
    found = stored(aligned(docs, bpe_path, piece_path, id_col, text_col, with_groups=with_groups), "aligned")
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    seen = found.where(F.size("seen") > 0).select("block", F.explode(F.arrays_zip("seen", "docs")).alias("s")).select("block", F.col("s.seen").alias("pair"), F.col("s.docs").alias("docs"))
    counts = seen.groupBy("pair").agg(F.sum("docs").alias("count"))
    # An id of A meets at most as many ids of B as the model has.
    highest = Window.partitionBy(F.expr(f"pair div {size_b}"))
    counts = counts.withColumn("best", F.col("count") == F.max("count").over(highest))
    told = seen.select(F.col("block").alias("of"), "pair").join(counts, "pair")
    mine = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"] + ["groups"] * with_groups

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = right.column("pair").to_numpy()
        order = np.argsort(pairs)
        pairs, count, best = pairs[order], right.column("count").to_numpy()[order], right.column("best").to_numpy()[order]
        left = left.combine_chunks()
        here, times = (left.column(c).combine_chunks() for c in ("pairs", "times"))
        n = here.value_lengths().to_numpy()
        at, times = np.searchsorted(pairs, here.flatten().to_numpy()), times.flatten().to_numpy()
        ends = np.cumsum(n)

        def total(values):
            sums = np.r_[0, np.cumsum(values)]
            return pa.array(sums[ends] - sums[ends - n])

        out = left.select(mine)
        return out.append_column("n_best", total(times * best[at])).append_column("count_sum", total(times * count[at]))

    kind = found.schema["key"].dataType.simpleString()
    shape = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string{', groups string' * with_groups}, n_best long, count_sum long"
    rows = found.select(*mine, "block", "pairs", "times")
    out = rows.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(look, shape)
    return out.select(F.col("key").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * with_groups)
