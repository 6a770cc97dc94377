"""Alignment of two tokenizers against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from lathe.llm import align
from lathe.llm.bpe import byte_letters
from lathe.session import build_session

BPE, PIECE = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def spark():
    return build_session("tests", "local[8]", 8)


def spans(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(docs):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    byte = {c: i for i, c in enumerate(byte_letters())}
    each = []
    for key, text in docs:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            each.append((key, [], [], [], []))
            continue
        sa, sb = spans(raw_a), spans(raw_b)
        links = [(ids_a[i], ids_b[j]) for i, (x, y) in enumerate(sa) for j, (u, v) in enumerate(sb) if x < v and u < y]
        cuts = sorted({y for _, y in sa} & {y for _, y in sb})
        groups = [([i for i, (_, y) in zip(ids_a, sa) if p < y <= q], [i for i, (_, y) in zip(ids_b, sb) if p < y <= q]) for p, q in zip([0, *cuts], cuts)]
        each.append((key, ids_a, ids_b, links, groups))
    count = Counter(p for *_, links, _ in each for p in set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for key, ids_a, ids_b, links, groups in each:
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((key, len(ids_a), len(ids_b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), sha, text))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(4)
    words = ["the", "of", "straße", "déjà", "日本", "🙂🙂", "  ", "x\n", "Unbelievable", "co-operate", "<s>", "<|endoftext|>", "12345", "\t", "naïveté", "zq"]
    some = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 40)))) for i in range(120)]
    return some + [(200, None), (201, ""), (202, "▁ rewritten"), (203, " "), (204, "the of " * 400), (None, "the zq"), (5, "the zq"), (205, "\x00 nul"), (206, "q" * 700)]


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


@pytest.mark.parametrize("parts", [1, 7])
def test_alignment_is_brute_force(spark, parts):
    df = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(parts)
    df = df.withColumns({c: F.lit(c) for c in ("key", "block", "pair", "pairs", "groups", "count", "seen", "of")})
    got = align.align_tokenizers(df, BPE, PIECE, with_groups=True)
    assert sorted(map(tuple, got.select(NAMES).collect()), key=str) == brute(corpus())


@pytest.mark.parametrize("chunk", [1, 500])
def test_chunks_change_nothing(spark, chunk, monkeypatch):
    monkeypatch.setattr(align, "CHUNK", chunk)
    monkeypatch.setattr(align.aligned, "__defaults__", ("doc_id", "text", chunk, False))
    df = spark.createDataFrame(corpus(), "doc_id long, text string").coalesce(2)
    got = align.align_tokenizers(df, BPE, PIECE, with_groups=True)
    assert sorted(map(tuple, got.select(NAMES).collect()), key=str) == brute(corpus())


@pytest.mark.parametrize("step", [1, 2, 3, 64, 10000])
def test_pieces_of_the_path_are_the_whole_merge(step):
    rnd = np.random.RandomState(step)
    for _ in range(30):
        total = int(rnd.randint(1, 400))
        a, b = (np.unique(np.r_[rnd.randint(1, total + 1, rnd.randint(0, total + 1)), total]) for _ in range(2))
        at_a, at_b, group_a, group_b = align.merged(a, b, step)
        sa, sb = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if sa[i] < b[j] and sb[j] < a[i]}
        assert set(zip(at_a.tolist(), at_b.tolist())) == want and len(at_a) == len(want)
        both = np.intersect1d(a, b)
        assert group_a.tolist() == np.searchsorted(both, a).tolist() and group_b.tolist() == np.searchsorted(both, b).tolist()


def test_empty_table(spark):
    assert align.align_tokenizers(spark.createDataFrame([], "doc_id long, text string"), BPE, PIECE).collect() == []
