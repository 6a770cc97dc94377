"""The near stage's SimHash step against brute force."""

import itertools
import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lathe.llm import nearcopies, simhash  # noqa: E402
from lathe.session import build_session  # noqa: E402


@pytest.fixture(scope="module")
def spark():
    return build_session("tests", "local[8]", 8)


def grouped(nodes, pairs):
    root = {n: n for n in nodes}
    for a, b in pairs:
        low, high = sorted((root[a], root[b]))
        root = {n: low if r == high else r for n, r in root.items()}
    return root


def test_tries_join_what_lies_within_the_radius(spark):
    rng, texts = random.Random(5), ["", "a b"]
    for _ in range(30):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(100, 400))]
        texts.append(" ".join(base))
        for k in (1, 1, 2):
            w = list(base)
            w[-k] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    prints = {nearcopies.node_of(nearcopies.shingles(t.encode())): simhash.simhash(t.encode(), nearcopies.WIDTH) for t in texts}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= simhash.RADIUS]
    assert len(near) > 20
    rows = [(n, f - (f >> 63 << 64)) for n, f in prints.items()]
    got = nearcopies.within_radius(spark.createDataFrame(rows * 2, "node long, fp long")).collect()
    assert len(got) == len(set(got))
    assert grouped(prints, [(r["a"], r["b"]) for r in got]) == grouped(prints, near)
    assert nearcopies.within_radius(spark.createDataFrame([], "node long, fp long")).count() == 0
