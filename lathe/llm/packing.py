"""Packing of documents into fixed windows by non-negative least squares.

Documents are cut at every full window; what is left of each is a tail. Tails
are counted by length in ``BINS`` steps, short ones by their exact length. Shallow combinations of lengths that
fill a window are enumerated, repeat counts are solved against the histogram
(non-negative least squares), rounded down, and what remains is packed
greedily on the histogram. Only the histogram, one number for each length
step, reaches the driver; every tail then takes the next free slot of its
length, found from its rank. Ranks are counted within a task and shifted by
the totals of the tasks before, so a length that a third of all documents
share is numbered in parallel.

Defined cases: a null or empty text is the end token alone; a long text gives
many pieces; repeated rows and ids, also null ids, are pieces of their own;
an empty table gives an empty result; other columns are not read.
"""

import os
import zlib
from functools import cached_property, lru_cache
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .batches import slices
from .bpe import chunks
from .pieces import WORD_PATTERN, PieceIds, is_plain, special_tokens

WINDOW = 4096
#: Length steps of a window; a tail takes its length rounded up to a step.
BINS = 256
#: Tails of up to so many tokens keep their exact length and fill what the others leave.
FINE = 256
#: Tails in a combination that least squares may use; the greedy rest has no such limit.
DEPTH = 3


class Words:
    """Ids of whole texts from a word-level BPE file, by the tokenizers library.

    Plain text is cut here and each distinct piece encoded once; any other
    text goes to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path = path
        self.special = tuple(special_tokens(path))
        # For pieces that are normalised and cut already: bytes and merges only.
        self.of_pieces = Tokenizer.from_file(path)
        self.of_pieces.no_truncation()
        self.of_pieces.no_padding()
        self.of_pieces.normalizer = None
        self.of_pieces.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.known = PieceIds(self._encode_pieces)

    @cached_property
    def tokenizer(self):
        """The library's own, of as many MB as the one for pieces: read with the first text that is not plain."""
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(self.path)
        whole.no_truncation()
        whole.no_padding()
        return whole

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        e = self.of_pieces.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        return np.bincount(np.array(e.word_ids, np.int64), minlength=len(pieces)), np.array(e.ids, np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        cut, at = [], []
        for i, t in enumerate(texts):
            if is_plain(t) and not any(s in t for s in self.special):
                cut.append(WORD_PATTERN.findall(t.lower()))
                at.append(i)
            else:
                out[i] = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.int32)
        flat = [p for c in cut for p in c]
        if at:
            ids, n = self.known.ids(flat)
            ends = np.r_[0, np.cumsum(n)][np.cumsum([len(c) for c in cut])]
            for i, e in zip(at, np.split(ids, ends[:-1])):
                out[i] = e
        return out


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


def token_pieces(docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``window`` tokens, each with its checksum, its length
    step (0: a full window), the task that cut it and its number there."""
    step = max(1, window // BINS)
    fine = FINE if step > 1 else 0
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        w, task, seen = words(path), TaskContext.get().partitionId(), np.zeros(window + step + 1, np.int64)
        for batch in slices(batches):
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                row, start, length, crc, total, bins, rank, ids = [], [], [], [], [], [], [], []
                for i, e in enumerate(w.encode(texts[a:b]), a):
                    e = np.append(e, end_id).astype("<u4")
                    for s in range(0, len(e), window):
                        piece = e[s : s + window]
                        k = 0 if len(piece) == window else len(piece) if len(piece) <= fine else min(-(-len(piece) // step) * step, window // step * step)
                        row.append(i)
                        start.append(s)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(e))
                        bins.append(k)
                        rank.append(seen[k])
                        seen[k] += 1
                        if with_ids:
                            ids.append(piece.astype(np.int32))
                out = [keys.take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (start, length, crc, total)), pa.array(bins, pa.int32()), pa.array([task] * len(row), pa.int32()), pa.array(rank, pa.int64())]
                yield pa.RecordBatch.from_arrays(out + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names)

    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "bin", "task", "rank"] + ["ids"] * with_ids
    fields = f"{id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long, bin int, task int, rank long"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, fields + ", ids array<int>" * with_ids)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Least squares of ``a @ x = b`` with x >= 0, by the active-set method."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(1.0, float(np.abs(b).max()))
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        j = int(np.argmax(gain))
        if gain[j] <= 1e-9 * scale:
            break
        active[j] = True
        while active.any():
            at = np.flatnonzero(active)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if s.min() > 0:
                x[at] = s
                break
            low = s <= 0
            t = np.min(x[at][low] / (x[at][low] - s[low]).clip(1e-300))
            x[at] += t * (s - x[at])
            active[at[low & (x[at] <= 1e-12 * scale)]] = False
            x[~active] = 0
        if not active[j]:
            break
    return x


def combinations(bins: list[int], full: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Multisets of at most ``depth`` of the steps that fill a window exactly."""
    have, out = set(bins), []
    for k in range(1, depth + 1):
        for head in combinations_with_replacement(sorted(bins, reverse=True), k - 1):
            last = full - sum(head)
            if last in have and (not head or last <= head[-1]):
                out.append((*head, last))
    return out


def plan(histogram: dict[int, int], full: int = BINS, depth: int = DEPTH, fine: int = 0) -> list[tuple[tuple[int, ...], int]]:
    """(combination, repeats), together using every tail of the histogram once; lengths up to ``fine`` only fill what is left."""
    left = {b: n for b, n in histogram.items() if n > 0}
    bins, out = sorted(b for b in left if b > fine), []
    mixes = combinations(bins, full, depth)
    if mixes:
        row = {b: i for i, b in enumerate(bins)}
        a = np.zeros((len(bins), len(mixes)))
        for j, m in enumerate(mixes):
            for b in m:
                a[row[b], j] += 1
        counts = np.array([left[b] for b in bins], float)
        for j in np.argsort(-(x := nnls(a, counts)), kind="stable"):
            m = mixes[j]
            n = min(int(x[j] + 1e-6), *(left[b] // m.count(b) for b in set(m)))
            if n > 0:
                out.append((m, n))
                for b in m:
                    left[b] -= n
    while any(left.values()):
        mix, room = [], full
        for b in sorted((b for b in left if left[b]), reverse=True):
            k = min(room // b, left[b])
            mix += [b] * k
            room -= k * b
        n = min(left[b] // mix.count(b) for b in set(mix))
        out.append((tuple(mix), n))
        for b in mix:
            left[b] -= n
    return out


def slots(steps: list[tuple[tuple[int, ...], int]], full_windows: int) -> dict[int, np.ndarray]:
    """Per step, the slots that its tails fill in order of their rank: columns
    first rank, first sequence, tails to a sequence, place in the sequence."""
    rows: dict[int, list] = {0: [(0, 0, 1, 0)]}
    taken: dict[int, int] = {}
    sequence = full_windows
    for mix, n in steps:
        for b in sorted(set(mix), reverse=True):
            m = mix.count(b)
            rows.setdefault(b, []).append((taken.get(b, 0), sequence, m, mix.index(b)))
            taken[b] = taken.get(b, 0) + n * m
        sequence += n
    return {b: np.array(r, np.int64) for b, r in rows.items()}


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; at most ``window`` tokens to a sequence."""
    pieces = stored(pieces, "pieces")
    step = max(1, window // BINS)
    totals = pieces.groupBy("task", "bin").count()
    before = totals.withColumn("before", F.sum("count").over(Window.partitionBy("bin").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)))
    histogram = {r["bin"]: r["n"] for r in totals.groupBy("bin").agg(F.sum("count").alias("n")).collect()}
    table = slots(plan({b: n for b, n in histogram.items() if b}, window // step * step, fine=FINE if step > 1 else 0), histogram.get(0, 0))

    def place(batches):
        for batch in batches:
            bins = batch.column("bin").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            sequence, place = np.zeros(len(bins), np.int64), np.zeros(len(bins), np.int64)
            for b in np.unique(bins):
                at, t = np.flatnonzero(bins == b), table[int(b)]
                k = np.searchsorted(t[:, 0], rank[at], side="right") - 1
                inside = rank[at] - t[k, 0]
                sequence[at] = t[k, 1] + inside // t[k, 2]
                place[at] = t[k, 3] + inside % t[k, 2]
            out = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*out, pa.array(sequence), pa.array(place)], [*kept, "sequence_id", "place"])

    kept = [c for c in pieces.columns if c not in ("bin", "task", "rank")]
    fields = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in kept)
    ranked = pieces.join(before.select("task", "bin", F.coalesce("before", F.lit(0)).alias("before")), ["task", "bin"])
    placed = ranked.mapInArrow(place, f"{fields}, sequence_id long, place long")
    earlier = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("place")


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, **columns) -> DataFrame:
    return pack(token_pieces(docs, path, end_id, window, **columns), window)
