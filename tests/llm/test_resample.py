"""Importance resampling against brute force, CRC matrices against zlib."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lathe.llm import resample
from lathe.session import build_session


@pytest.fixture(scope="module")
def spark():
    return build_session("tests", "local[8]", 8)


def brute(docs, target, percent=25):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    each = [(k, *features(t)) for k, t in docs]
    s, t = Counter(b for *_, f in each for b in f), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for k, n, f in each:
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in f)
        weight = gain // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append([k, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def corpus(n, seed=5):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeé0日") for _ in range(rnd.randint(1, 9))) for _ in range(300)]
    return [(i, rnd.choice([" ", "\n", "-", "A B "]).join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))) for i in range(n)]


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_crc_matrices():
    rnd = random.Random(1)
    features = [rnd.randbytes(rnd.choice([0, 1, 2, 3, 4, 5, 64, 200, 1024, 1025, 1088, 9999])) for _ in range(400)]
    assert resample.crc32s(features).tolist() == [zlib.crc32(f) for f in features]


def test_resample_is_brute_force(spark):
    docs = corpus(300) + [(1000, None), (1001, ""), (1002, "x" * 5000 + " y"), (1003, "the same words " * 20000), (1004, "tie " * 30)]
    target = [t for _, t in corpus(20, 6)] + [None, "", "the same words"]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7).withColumns({c: F.lit(c) for c in ("rank", "score", "key", "n_words", "buckets", "row", "__at")})
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    assert rows(resample.importance_resample(df, aim)) == brute(docs, target)


def test_repeated_and_missing_ids_are_rows_of_their_own(spark):
    docs = [(7, "one two three " * 9)] * 40 + [(None, "one two three " * 9)] * 40
    got = rows(resample.importance_resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("one two",)], "text string")))
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 21))
    assert [r[:4] for r in got] == [r[:4] for r in brute(docs, ["one two"])]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    aim = spark.createDataFrame([], "text string")
    assert rows(resample.importance_resample(none, aim)) == []
    docs = corpus(50)
    assert rows(resample.importance_resample(spark.createDataFrame(docs, "doc_id long, text string"), aim)) == brute(docs, [])
