"""Toxicity by compression distance.

Two zstandard dictionaries are trained on windows of labelled text, one of
ordinary and one of toxic rows. A window that the toxic dictionary compresses
to fewer bytes speaks for toxicity. A third one is an addition: the ordinary
content followed by the words that mark toxic texts, those met in many
different contexts there and (almost) never in ordinary ones; contexts are
counted rather than uses, so copies of one text prove nothing. The largest
savings of both against the ordinary dictionary, their frequency and the
number of windows are calibrated on labelled texts
that the dictionaries have not seen, so that score 0.7 is the threshold of the
best F1 there among those that at most 1 % of ordinary texts reach.

Training reads bounded samples of labelled rows, drawn by hash: ``TOXIC_ROWS``
and ``ORDINARY_ROWS``, of them ``TOXIC_WINDOWS`` and ``ORDINARY_WINDOWS``. Scoring reads every window of every text.

Defined cases: a null or empty text counts as one window without savings;
without rows of both labels every score is 0; of repeated labels of an id a
toxic one counts; long texts are read whole; equal texts get equal scores;
other columns are not read.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices, with_text
from .langid import fold

WORDS = 12
DICT_BYTES, LEVEL = 1 << 16, 6
TOXIC_ROWS, ORDINARY_ROWS, TOXIC_WINDOWS, ORDINARY_WINDOWS, MARK_WORDS = 4000, 8000, 50_000, 50_000, 2000
#: A mark word has so many contexts in toxic texts, as a share of them, and is so many times as frequent there.
LEAST_CONTEXTS, LEAST_SHARE, LEAST_RATIO = 3, 0.004, 60.0
THRESHOLD = 0.7
#: Largest share of ordinary calibration rows at or above the threshold.
FALSE_ALARMS = 0.01
NO_WORD = re.compile(r"[^\w\s]|[\d_]")


def words_of(text: str) -> list[str]:
    return NO_WORD.sub("", text.lower()).split()


def windows(text: str) -> list[bytes]:
    w = words_of(text)
    return [f" {' '.join(w[i : i + WORDS])} ".encode() for i in range(0, len(w), WORDS)]


def packer(content: bytes):
    """Compressed length under a dictionary of this content."""
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    c = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
    return lambda window: len(c.compress(window))


def features(texts: list[str], ordinary, toxic, marked) -> np.ndarray:
    out = np.zeros((len(texts), 14))
    for i, t in enumerate(texts):
        saved = np.array([(n - toxic(w), n - marked(w)) for w in windows(t) for n in [ordinary(w)]] or [(0, 0)])
        for k, d in enumerate(np.sort(saved, axis=0)[::-1].T):
            top = np.r_[d[:4], np.zeros(4)][:4]
            # The trained pair's bytes differ both ways, so its mean keeps the sign.
            out[i, 7 * k : 7 * k + 7] = [*top, 10 * (d >= 3).mean(), d.clip(0).mean(), np.log1p(len(d)) if k else d.mean()]
    return out


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and scale of the features, and weights with the constant last."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a, w = np.c_[(x - mean) / scale, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a @ w).clip(-30, 30)))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w)), a.T @ (p - y) + 1e-2 * w)
    return mean, scale, w


class Model:
    def __init__(self, ordinary: bytes, toxic: bytes, marked: bytes, mean, scale, weights):
        self.ordinary, self.toxic, self.marked = ordinary, toxic, marked
        self.mean, self.scale, self.weights = mean, scale, weights

    def scores(self, texts: list[str], packers) -> np.ndarray:
        z = np.c_[(features(texts, *packers) - self.mean) / self.scale, np.ones(len(texts))] @ self.weights
        return 1 / (1 + np.exp(-z.clip(-30, 30)))


def logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS) -> Model | None:
    """Dictionaries and calibration from labelled rows; None without both labels."""
    told = labels.where(F.col(id_col).isNotNull() & F.col(toxic_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(toxic_col).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in told.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    share = F.when(F.col("toxic") == 1, -(-counts[1] // toxic_rows)).otherwise(-(-counts[0] // ordinary_rows))
    told = told.where(F.pmod(F.xxhash64("id"), share) == 0)
    # About toxic_rows + ordinary_rows ids at most, whatever the input: texts are not shuffled.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(told), "id")
    rows = rows.select("text", "toxic", F.pmod(F.hash("id"), F.lit(4)).alias("part")).persist()
    try:
        return fit(rows)
    finally:
        rows.unpersist()


def fit(rows: DataFrame) -> Model | None:
    def contexts(batches):
        uses: Counter = Counter()
        for b in slices(batches):
            marks = set()
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of(text or "")
                if toxic:
                    marks.update(zip(w, [None, *w], [*w[1:], None]))
                else:
                    uses.update(w)
            yield pa.RecordBatch.from_pylist([{"word": w, "before": a, "after": z, "uses": 0} for w, a, z in marks], shape)
        yield pa.RecordBatch.from_pylist([{"word": w, "uses": n} for w, n in uses.items()], shape)

    def cut(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([w for t in b.column(0).to_pylist() for w in windows(t or "")], pa.binary())], ["window"])

    shape = pa.schema([("word", pa.string()), ("before", pa.string()), ("after", pa.string()), ("uses", pa.int64())])
    seen = rows.where("part < 3")
    n = {r["toxic"]: r["n"] for r in seen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    each = seen.select("text", "toxic").mapInArrow(contexts, "word string, before string, after string, uses long")
    met = each.groupBy("word", "before", "after").agg(F.sum("uses").alias("uses"), F.max(F.when(F.col("uses") == 0, 1).otherwise(0)).alias("context"))
    met = met.groupBy("word").agg(F.sum("uses").alias("uses"), F.sum("context").alias("contexts"))
    ratio = F.col("contexts") / n[1] / ((F.col("uses") + 0.5) / n[0])
    marks = met.where((F.col("contexts") >= max(LEAST_CONTEXTS, LEAST_SHARE * n[1])) & (ratio >= LEAST_RATIO))
    marks = [r["word"] for r in marks.orderBy(ratio.desc(), "word").limit(MARK_WORDS).collect()]

    def trained(label: int, most: int) -> bytes:
        pieces = seen.where(F.col("toxic") == label).select("text").mapInArrow(cut, "window binary")
        pieces = [bytes(r["window"]) for r in pieces.orderBy(F.xxhash64("window")).limit(most).collect()]
        try:
            return zstandard.train_dictionary(DICT_BYTES, pieces).as_bytes()
        except zstandard.ZstdError:  # too few samples: they are the dictionary
            return b"".join(pieces)[:DICT_BYTES]

    ordinary, toxic = trained(0, ORDINARY_WINDOWS), trained(1, TOXIC_WINDOWS)
    marked = ordinary + f" {' '.join(reversed(marks))} ".encode()

    def measure(batches):
        packers = packer(ordinary), packer(toxic), packer(marked)
        for b in slices(batches):
            x = features([t or "" for t in b.column(0).to_pylist()], *packers)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["toxic", "x"])

    held = rows.where("part = 3").select("text", "toxic").mapInArrow(measure, "toxic int, x array<double>").collect()
    y = np.array([r["toxic"] for r in held], float)
    if not 0 < y.sum() < len(y):
        return None
    x = np.array([r["x"] for r in held])
    mean, scale, weights = logistic(x, y)
    z = np.c_[(x - mean) / scale, np.ones(len(x))] @ weights
    order = np.argsort(-z, kind="stable")
    hits, told = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    f1 = np.where(told - hits <= FALSE_ALARMS * (len(y) - y.sum()), 2 * hits / (told + y.sum()), 0)
    best = z[order][int(np.argmax(f1))] if f1.any() else z.max() + 1
    weights[-1] += logit(THRESHOLD) + 1e-6 - best
    return Model(ordinary, toxic, marked, mean, scale, weights)


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows with ``score``, in place of a column of this name."""
    kept = [c for c in docs.columns if c != "score"]
    ready, at = with_text(docs, kept, text_col)

    def run(batches) -> Iterator[pa.RecordBatch]:
        packers = (packer(model.ordinary), packer(model.toxic), packer(model.marked)) if model else None
        for b in slices(batches):
            texts = [t or "" for t in b.column(at).to_pylist()]
            s = model.scores(texts, packers) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), pa.array(s)], [*kept, "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return ready.mapInArrow(run, f"{fields}, score double".lstrip(", "))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 3, held: int = 1) -> DataFrame:
    """Per row: id, held_out, score, predicted; trained on labels not held out."""
    model = train(docs, labels.where(fold(F.col(id_col), parts) != held), id_col, text_col)
    told = docs.select(F.col(id_col), (fold(F.col(id_col), parts) == held).alias("held_out"), F.col(text_col).alias("__body"))
    return score(told, model, "__body").select(id_col, "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
