"""Linear-time BPE against the library, and round trips."""

import base64
import hashlib
import random

import pytest
import tiktoken
from public_tokenizers import PATTERN, path
from pyspark.sql import functions as F

from lathe.llm import ahobpe
from lathe.session import build_session

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


@pytest.fixture(scope="module")
def spark():
    return build_session("tests", "local[8]", 8)


def library(name):
    with open(path(name), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rnd = random.Random(3)
    some = [32, 97, 101, 116, 0x4E2D, 0x1F642, 0xE9, 0x301, 10, 13, 9, 0x85, 0xA0, 0x1C, 39, 115, 48, 0xB2, 0x660]
    return [
        "",
        None,
        " ",
        "a" * 5000,
        " " * 3001,
        "ab" * 3000,
        "=-" * 999,
        "é" * 999 + "x",
        "<|endoftext|> x's I'LL we're",
        "".join(chr(rnd.choice(some)) for _ in range(20000)),
        "".join(rnd.choice("aeinrst") for _ in range(30000)),
        "".join(rnd.choice("!-=#_. ") for _ in range(30000)),
    ]


@pytest.mark.parametrize("name", FILES)
def test_encode_is_the_library(spark, name):
    texts, enc = odd_texts(), library(name)
    df = spark.createDataFrame(list(enumerate(texts)) + [(1, "again"), (None, "no id")], "doc_id long, text string")
    df = df.withColumns({c: F.lit(c) for c in ("ids", "n_tokens", "__text")})
    got = ahobpe.encode_texts(df, path(name), with_ids=True)
    for r in got.collect():
        text = "no id" if r.doc_id is None else "again" if r.n_tokens == 1 and r.doc_id == 1 else texts[r.doc_id] or ""
        ids = enc.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = ahobpe.decode_ids(got.where("doc_id <> 1"), path(name)).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in back} == {i: t or "" for i, t in enumerate(texts) if i != 1}


def test_random_pieces_are_the_library():
    v, enc, rnd = ahobpe.coder(path(FILES[0]), PATTERN).vocabulary, library(FILES[0]), random.Random(9)
    for _ in range(3000):
        piece = b"".join(v.token[rnd.randrange(v.size)] for _ in range(rnd.randint(1, 6)))
        assert v.split(piece) == enc._core_bpe.encode_single_piece(piece)


def test_few_remembered_pairs_change_nothing(monkeypatch):
    v = ahobpe.coder(path(FILES[0]), PATTERN).vocabulary
    want = v.split(b"unbelievable" * 50)
    monkeypatch.setattr(ahobpe, "PAIRS", 3)
    v.remembered.clear()
    assert v.split(b"unbelievable" * 50) == want


def test_empty_table_and_null_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ahobpe.encode_texts(none, path(FILES[0])).collect() == []
    ids = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in ahobpe.decode_ids(ids, path(FILES[0])).collect()] == [b"", b""]
