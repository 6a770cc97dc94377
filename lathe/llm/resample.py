"""Importance resampling towards a target distribution by hashed n-grams.

Features of a text are its runs of 1 to ``RUN`` words. A feature's bucket is
the CRC-32 of its bytes modulo ``BUCKETS``. CRCs are taken of the distinct
features of a chunk of texts: features of equal length form the rows of one
uint8 matrix, all CRCs of a matrix are updated column by column, and the
buckets are scattered back to the places of the features. A feature longer
than ``LONG`` bytes is a matrix of its own, of blocks whose CRCs are then
joined, so one endless word costs its length.

Corpus and target counts are sums over all rows, added up in each task before
the shuffle; ``BUCKETS`` gains, a fixed number, go to the tasks that weigh the
texts. The draw is a Gumbel top-k: the rank comes from one range-partitioned
sort and offsets of its partitions, so no task holds more than its range.

Defined cases: a null text has no words; equal texts and repeated ids are rows
of their own, ranked in the order they are stored where score and id are equal; null
ids rank after others of the same score and are seeded as an empty text;
texts are read whole; an empty table gives an empty result, an empty target
only moves all gains; other columns, whatever their names, are not read.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from ..session import stored
from .bpe import chunks

BUCKETS, RUN, SEED, LEAST_WORDS, DRAW_PERCENT = 10_000, 2, 7, 20, 25
#: Bytes of a feature whose CRC is taken in blocks, and of a block.
LONG, BLOCK = 1024, 64
#: A-Z to lower case; bytes of ASCII that are no letter or digit end a word.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1)
    return c


TABLE = _table()


def columns(matrix: np.ndarray, start: int) -> np.ndarray:
    """CRC registers of all rows of a uint8 matrix, updated column by column."""
    crc = np.full(len(matrix), start, np.uint32)
    for col in np.ascontiguousarray(matrix.T):
        crc = TABLE[(crc ^ col) & 0xFF] ^ (crc >> 8)
    return crc


def _skip() -> list[list[int]]:
    """What BLOCK zero bytes make of each byte of the register."""
    tables = []
    for k in range(4):
        crc = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(BLOCK):
            crc = TABLE[crc & 0xFF] ^ (crc >> 8)
        tables.append(crc.tolist())
    return tables


SKIP = _skip()


def long_crc(feature: bytes) -> int:
    """CRC-32 of one long feature: blocks as rows of a matrix, joined from the left.

    The register's start is the flip of the first four bytes, and zeros in
    front of a register of zero change nothing, so blocks fill up in front.
    """
    flat = np.zeros(-(-len(feature) // BLOCK) * BLOCK, np.uint8)
    at = len(flat) - len(feature)
    flat[at:] = np.frombuffer(feature, np.uint8)
    flat[at : at + 4] ^= 0xFF
    a, b, c, d = SKIP
    crc = 0
    for block in columns(flat.reshape(-1, BLOCK), 0).tolist():
        crc = a[crc & 0xFF] ^ b[crc >> 8 & 0xFF] ^ c[crc >> 16 & 0xFF] ^ d[crc >> 24] ^ block
    return crc ^ 0xFFFFFFFF


def crc32s(features: list[bytes]) -> np.ndarray:
    """CRC-32 of every feature, by matrices of features of equal length."""
    out = np.zeros(len(features), np.uint32)
    lens = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lens, kind="stable")
    sizes, starts = np.unique(lens[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, starts[1:])):
        if size > LONG:
            out[rows] = [long_crc(features[i]) for i in rows]
        else:
            matrix = np.frombuffer(b"".join([features[i] for i in rows]), np.uint8).reshape(len(rows), size)
            out[rows] = columns(matrix, 0xFFFFFFFF) ^ np.uint32(0xFFFFFFFF)
    return out


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


def buckets_of(texts: list[str], run: int = RUN, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, its features, and the buckets of all features, text by text."""
    cut = [words_of(t) for t in texts]
    n = np.array([len(c) for c in cut], np.int64)
    flat = [w for c in cut for w in c]
    known: dict[bytes, int] = {}
    word = np.array([known.setdefault(w, len(known)) for w in flat], np.int64)
    text = np.repeat(np.arange(len(texts)), n)
    code, place, where, found = np.zeros(len(word), np.int64), np.arange(len(word)), [], []
    for k in range(1, run + 1):
        if k > 1:
            keep = place + k - 1 < len(word)
            keep[keep] = text[place[keep]] == text[place[keep] + k - 1]
            code, place = code[keep], place[keep]
        # Number the distinct runs; a run is the one before it and one more word.
        _, first, code = np.unique(code * max(1, len(known)) + word[place + k - 1], return_index=True, return_inverse=True)
        crc = crc32s([b" ".join(flat[p : p + k]) for p in place[first].tolist()])
        where.append(text[place])
        found.append((crc % np.uint32(buckets)).astype(np.int32)[code])
    where, found = np.concatenate(where), np.concatenate(found)
    return n, np.bincount(where, minlength=len(texts)), found[np.argsort(where, kind="stable")]


def features(docs: DataFrame, id_col: str, text_col: str, run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(key, n_words, n_features, buckets) of every row."""

    def cut(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for a, z in chunks(texts):
                words, n, found = buckets_of(texts[a:z], run, buckets)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(found))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array(words), pa.array(n), lists], ["key", "n_words", "n_features", "buckets"])

    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(cut, f"key {kind}, n_words long, n_features long, buckets array<int>")


def counts(found: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows; each task adds up its own first."""

    def add(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(b.column(0).flatten().to_numpy(), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    each = found.select("buckets").mapInArrow(add, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in each.collect():  # one row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln(target share / corpus share)), add-one smoothed."""
    s_all, t_all = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    each = zip(corpus.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in each], np.int64)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = DRAW_PERCENT,
) -> DataFrame:
    """Per row: id, n_features, weight, score and, if drawn, rank (1, 2, 3...)."""
    found = stored(features(docs, id_col, text_col, run, buckets), "features")
    wanted = target.select(F.lit(None).cast("long").alias("key"), F.col(target_col).alias("text"))
    gain = gains(counts(found, buckets), counts(features(wanted, "key", "text", run, buckets), buckets))

    def weigh(batches):
        for b in batches:
            n = b.column(2).to_numpy()
            total = np.r_[0, np.cumsum(gain[b.column(3).flatten().to_numpy()])]
            ends = np.cumsum(n)
            weight = (total[ends] - total[ends - n]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(weight)], ["key", "n_words", "n_features", "weight"])

    kind = found.schema["key"].dataType.simpleString()
    weighed = found.mapInArrow(weigh, f"key {kind}, n_words long, n_features long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("key"), seed)).withColumn("row", F.monotonically_increasing_id())
    scored = stored(scored, "scored")
    eligible = scored.where(F.col("n_words") >= least_words)
    drawn = percent * eligible.count() // 100
    ranked = numbered(eligible, [F.desc("score"), F.asc_nulls_last("key"), F.asc("row")], "rank", label="ranked")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select(F.col("key").alias(id_col), "n_features", "weight", "score", "rank")
