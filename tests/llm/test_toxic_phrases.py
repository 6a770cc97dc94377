"""Toxic phrases of ordinary words: no word marks them, the trained dictionary does."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lathe.llm import toxicity  # noqa: E402
from lathe.session import build_session  # noqa: E402


@pytest.fixture(scope="module")
def spark():
    return build_session("tests", "local[8]", 8)


def test_phrases_of_ordinary_words(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randrange(4, 9))) for _ in range(400)]
    phrases = [" ".join(rng.sample(words, 8)) for _ in range(12)]
    rows, labels = [], []
    for i in range(1200):
        w, toxic = rng.choices(words, k=rng.randrange(60, 120)), int(i % 4 == 0)
        for _ in range(2 * toxic):
            w[rng.randrange(len(w)) : 0] = rng.choice(phrases).split()
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    docs, told = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = [(r["predicted"], labels[r["doc_id"]][1]) for r in toxicity.toxicity(docs, told).where("held_out").collect()]
    assert sum(p for p, t in got if t) > 0.5 * sum(t for _, t in got)
    assert sum(p for p, t in got if not t) < 0.05 * sum(1 - t for _, t in got)
