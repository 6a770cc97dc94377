"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a trigram binds
(multiplies) the vectors of its letters, each permuted by its place. A text
bundles (adds) the vectors of its trigrams, a language prototype those of its
training texts, and a text gets the language of the nearest prototype by
cosine, after the mean of all prototypes is taken off both.

Training reads a bounded sample of ``TRAIN_ROWS`` labelled rows, drawn by hash;
a task adds up one vector per language before anything is shuffled, and the
driver gets ``DIMS`` numbers for each language.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
long texts are read whole; equal texts get equal results; without any training
row every text is ``und`` with score 0; ties go to the first language in
order; other columns are not read.
"""

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import slices, with_text

DIMS = 1024
#: 0: no letter; 1-26: a-z; the others share the remaining classes by code point.
CLASSES = 64
TRAIN_ROWS = 20_000
SEED = 7
#: Texts, and characters of texts, that share one matrix product.
BATCH_ROWS, BATCH_CHARS = 256, 1_000_000
#: Cosine differences are multiplied by this before they become a probability.
SHARPNESS = 30.0


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == "L":
            out[c] = c - 96 if 97 <= c <= 122 else 27 + c % (CLASSES - 27)
    return out


@lru_cache(maxsize=1)
def letter_vectors() -> np.ndarray:
    """(place, class, dimension): vectors permuted by place."""
    base = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (CLASSES, DIMS))
    return np.stack([np.roll(base, place, axis=1) for place in range(3)])


def classes_of(text: str) -> np.ndarray:
    """Letter classes with one blank at each end and for each run of other characters."""
    c = letter_classes()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    c = np.concatenate([[0], c, [0]]).astype(np.int32)
    return c[np.r_[True, (c[1:] > 0) | (c[:-1] > 0)]]


def bundles(texts: list[str]) -> np.ndarray:
    """One row of ``DIMS`` for each text: the sum of its trigram vectors."""
    keys = []
    for i, t in enumerate(texts):
        c = classes_of(t)
        if len(c) > 2:
            keys.append((i << 18) | (c[:-2] << 12) | (c[1:-1] << 6) | c[2:])
    if not keys:
        return np.zeros((len(texts), DIMS), np.float32)
    keys = np.sort(np.concatenate(keys).astype(np.int32))
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    count, keys = np.diff(np.r_[first, len(keys)]), keys[first]
    grams, column = np.unique(keys & 0x3FFFF, return_inverse=True)
    v = letter_vectors()
    bound = v[0][grams >> 12] * v[1][(grams >> 6) & 63] * v[2][grams & 63]
    counts = np.zeros((len(texts), len(grams)), np.float32)
    counts[keys >> 18, column] = count
    return counts @ bound.astype(np.float32)


def groups(texts: list[str]):
    """Slices of a batch for one product each; a long text has its own."""
    start = chars = 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= BATCH_ROWS or chars + len(t) > BATCH_CHARS):
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes (languages x ``DIMS``)."""
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    share = max(1, -(-rows.count() // train_rows))
    rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)

    def add(batches):
        total: dict[str, np.ndarray] = {}
        for b in slices(batches):
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for s, e in groups(texts):
                for lang, x in zip(langs[s:e], unit(bundles(texts[s:e]))):
                    total[lang] = total.get(lang, 0) + x.astype(np.float64)
        for lang, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMS), pa.array(range(DIMS), pa.int32()), pa.array(x)], ["lang", "dim", "value"])

    sums = rows.mapInArrow(add, "lang string, dim int, value double").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    found = sums.collect()
    langs = sorted({r["lang"] for r in found})
    out = np.zeros((len(langs), DIMS))
    for r in found:
        out[langs.index(r["lang"]), r["dim"]] = r["value"]
    return langs, unit(out)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score``, in place of columns of these names."""
    langs, prototypes = model
    mean = prototypes.mean(axis=0) if langs else np.zeros(DIMS)
    ways = unit(prototypes - mean).astype(np.float32)
    mean = mean.astype(np.float32)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    ready, at = with_text(docs, kept, text_col)

    def run(batches):
        for b in slices(batches):
            texts = [t or "" for t in b.column(at).to_pylist()]
            for s, e in groups(texts):
                x = bundles(texts[s:e])
                empty = ~(x != 0).any(axis=1)
                pred, score = ["und"] * (e - s), np.zeros(e - s)
                if langs:
                    cosine = unit(unit(x) - mean) @ ways.T
                    p = np.exp(SHARPNESS * (cosine - cosine.max(axis=1, keepdims=True)).astype(np.float64))
                    p = p / p.sum(axis=1, keepdims=True)
                    best = cosine.argmax(axis=1)
                    pred = ["und" if z else langs[k] for z, k in zip(empty, best)]
                    score = np.where(empty, 0.0, p[np.arange(e - s), best])
                part = b.slice(s, e - s)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), pa.array(pred, pa.string()), pa.array(score)], [*kept, "lang_pred", "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return ready.mapInArrow(run, f"{fields}, lang_pred string, score double".lstrip(", "))


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; of a null id, of the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 4, held: int = 2) -> DataFrame:
    """Per row: id, held_out, lang_pred, score; trained on the rows not held out."""
    model = train(docs.where(fold(F.col(id_col), parts) != held), lang_col, text_col)
    told = docs.select(F.col(id_col), (fold(F.col(id_col), parts) == held).alias("held_out"), F.col(text_col).alias("__body"))
    return identify(told, model, "__body").drop("__body")
