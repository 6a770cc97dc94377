"""Near copies against brute-force Jaccard of 5-word shingles."""

import itertools
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as cp  # noqa: E402
from lathe.llm import nearcopies  # noqa: E402
from lathe.session import build_session  # noqa: E402


@pytest.fixture(scope="module")
def spark():
    return build_session("tests", "local[8]", 8)


def words_of(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows):
    sets = [words_of(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if not (sets[i] | sets[j]) or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    return {rows[r][0] for r in root}


def corpus(seed, groups, copies):
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 300))]
        for _ in range(copies):
            w = list(base)
            for k in rng.sample(range(len(w)), rng.randrange(0, 7)):
                w[k] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    return rows


def chains(seed):
    """Each text is the one before with one more word changed, of few words that others get too."""
    rng, rows = random.Random(seed), []
    for _ in range(4):
        w = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(40):
            w = list(w)
            w[rng.randrange(len(w))] = f"x{rng.randrange(3)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    return [(i, t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("rows", [corpus(1, 60, 5), corpus(2, 1, 150), chains(3), [(1, None), (2, ""), (3, "a b"), (4, "A B"), (5, "a c")]])
def test_stage_is_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", *[F.lit(None).cast("string").alias(c) for c in ("lang", "source")], F.lit(1).alias("n_chars"))
    assert {r["doc_id"] for r in cp.drop_near_duplicates(spark, df, "").collect()} == brute(rows)
    assert nearcopies.near_copies(df.limit(0)).count() == 0
