"""Corpus operators against brute force, round trips and odd inputs."""

import gzip
import hashlib
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lathe.llm import bpe, exact, graph, htmltext, langid, packing, quality, simhash, toxicity, urlrules, warc  # noqa: E402
from lathe.llm.queries import QUERIES, tokenizer_path  # noqa: E402
from lathe.session import build_session, fresh_dir  # noqa: E402

SF = "/root/testdata/sf0.001"
LONG = "Thing and other things. " * 6000
DOCS = [
    (1, "Hello World, this is one text with some words in it.", "en", "s"),
    (2, "hello world, this is one text with some words in it.", "en", None),
    (3, None, None, None),
    (4, "", "de", "s"),
    (5, " \n\t ", None, "s"),
    (6, LONG, "en", "s"),
    (7, LONG, "en", "s"),
    (7, LONG, "en", "s"),
    (None, "no id here \U0001f642 é<|endoftext|>x", "fr", "s"),
    (8, "É hello", "fr", "s"),
    (9, "é hello", "fr", "s"),
    (10, "two words", "fr", "s"),
    (11, "日本語のテキスト", "ja", "s"),
]


@pytest.fixture(scope="module")
def spark():
    s = build_session("tests", "local[8]", 8)
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows, with columns named like the operators' own."""
    df = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string")
    for c in ("fp", "bin", "task", "rank", "sha", "id", "mark", "salt", "content", "words", "score", "__text", "key", "half", "node", "toxic"):
        df = df.withColumn(c, F.lit(c))
    return df


@pytest.fixture(scope="module")
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name))


def odd_texts():
    rng, out = random.Random(5), ["", "a" * 3000, "ab" * 2000, "x<|endoftext|> y \n\n z", "İstanbul ΣΑΣ Ⱥb", "don't 'S", "<|startoftext|>"]
    spans = [(32, 127), (0, 0x300), (0x300, 0xD7FF), (0xE000, 0x11000)]
    for _ in range(200):
        out.append("".join(chr(rng.choice([rng.randrange(*rng.choice(spans)), 32, 10, 39])) for _ in range(50)))
    return out + [f"a{chr(c)}b {chr(c)}{chr(c)} 1" for c in range(0x310)]


def test_bpe_is_the_library(spark, docs, none):
    t, c = library("byte_bpe_50k.json"), bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    texts = odd_texts()
    for text, got in zip(texts, c.encode(texts)):
        want = t.encode(text, add_special_tokens=False).ids
        assert got.tolist() == want, repr(text)
        assert bpe.utf8(memoryview(c.decode_bytes(got)[0].tobytes())).decode() == t.decode(want, skip_special_tokens=False)
    rows = bpe.encode_texts(docs, tokenizer_path("byte_bpe_50k.json"), with_ids=True).collect()
    want = []
    for i, text, *_ in DOCS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), sha, hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest(), ids))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    assert bpe.encode_texts(none, tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_small_piece_memory_changes_nothing():
    c = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    texts = odd_texts()[:150]
    want = [e.tolist() for e in c.encode(texts)]
    c.known.limit = 20
    c.known.clear()
    assert [e.tolist() for t in texts for e in c.encode([t])] == want


def test_words_are_the_library():
    t, w = library("word_bpe_49k.json"), packing.Words(tokenizer_path("word_bpe_49k.json"))
    texts = odd_texts()
    for text, got in zip(texts, w.encode(texts)):
        assert got.tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing(spark, docs, none):
    t = library("word_bpe_49k.json")
    rows = packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), with_ids=True).collect()
    want = sorted(repr((i, t.encode(x or "", add_special_tokens=False).ids + [2])) for i, x, *_ in DOCS)
    of: dict = {}
    for r in rows:
        assert r["length"] == len(r["ids"]) <= 4096
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        of.setdefault(r["doc_id"], []).append(r)
    got = []
    for i, pieces in of.items():
        copies = [[], []]
        for k, r in enumerate(sorted(pieces, key=lambda r: r["start"])):
            copies[k % 2 if i == 7 else 0] += r["ids"]
        got += [repr((i, c)) for c in copies if c]
    assert sorted(got) == want
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(by) == list(range(len(by)))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack_documents(none, tokenizer_path("word_bpe_49k.json")).count() == 0


def test_plan_uses_each_tail_once():
    rng = random.Random(2)
    for h in ({}, {1: 1}, {256: 5}, {3: 10**9}, {b: rng.randrange(10**6) for b in range(1, 257)}, {128: 7, 100: 3, 156: 3, 28: 1}):
        used: dict = {}
        for mix, n in (steps := packing.plan(h)):
            assert sum(mix) <= 256 and n > 0
            for b in mix:
                used[b] = used.get(b, 0) + n
        assert used == {b: n for b, n in h.items() if n}
        assert len(steps) < 3000


@pytest.mark.parametrize("words, ideal", [(0, 3), (4, 13)])
def test_short_texts_are_packed_tightly(spark, words, ideal):
    df = spark.range(10_000).select(F.col("id").alias("doc_id"), F.lit(" ".join(["cat"] * words) or None).cast("string").alias("text"))
    rows = packing.pack_documents(df, tokenizer_path("word_bpe_49k.json"))
    assert rows.agg(F.sum("length")).first()[0] == 10_000 * (words + 1)
    assert rows.select("sequence_id").distinct().count() <= ideal + 1


@pytest.mark.parametrize("window", [7, 100, 1000, 4096])
def test_any_window(spark, window):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("cat "), F.col("id").cast("int") * 7).alias("text"))
    rows = packing.pack_documents(df, tokenizer_path("word_bpe_49k.json"), window=window)
    assert rows.agg(F.sum("length")).first()[0] == 7 * 300 * 299 // 2 + 300
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= window


def test_least_squares():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 3, (12, 30)).astype(float)
    b = a @ np.maximum(rng.normal(size=30), 0)
    x = packing.nnls(a, b)
    assert (x >= 0).all() and np.linalg.norm(a @ x - b) < 1e-6 * np.linalg.norm(b)


def fingerprint(text):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(pairs, n):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute_components(rows):
    """(id, fingerprint, smallest id of the component) of (id, text) rows."""
    fps = [fingerprint(t) for _, t in rows]
    root = classes([(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2], len(fps))
    least: dict = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(repr((i, f"{f:016x}", least.get(r))) for (i, _), f, r in zip(rows, fps, root))


def as_rows(near):
    return sorted(repr((r["doc_id"], f"{r['fp'] % 2**64:016x}", r["component_id"])) for r in near.collect())


def test_near_duplicates(spark, docs, none):
    assert as_rows(simhash.near_duplicates(docs)) == brute_components([r[:2] for r in DOCS])
    assert simhash.near_duplicates(none).count() == 0
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert as_rows(simhash.near_duplicates(table)) == brute_components(rows)


@pytest.mark.parametrize("node_rows", [4096, 2100, 300])
def test_trie_loses_no_link(spark, node_rows):
    rng = random.Random(node_rows)
    values = {rng.getrandbits(64) for _ in range(300)} | set(range(500))
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(40):
            x = base
            for b in rng.sample(range(64), rng.randrange(5)):
                x ^= 1 << b
            values.add(x)
    v = np.array(sorted(values), np.uint64)
    pairs = [(i, int(j)) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 2) if j < i]
    assert {(max(p), min(p)) for a, b in simhash.near_pairs(v) for p in zip(a.tolist(), b.tolist())} == set(pairs)
    want: dict = {}
    for x, r in zip(v.view(np.int64).tolist(), classes(pairs, len(v))):
        want.setdefault(r, set()).add(x)
    got: dict = {}
    df = spark.createDataFrame([(x,) for x in v.view(np.int64).tolist()], "fp long")
    for r in graph.components(simhash.links(df, node_rows)).collect():
        got.setdefault(r["root"], set()).add(r["node"])
    assert {frozenset(s) for s in got.values()} == {frozenset(s) for s in want.values() if len(s) > 1}


def test_components_of_a_long_path(spark):
    links = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert {r["root"] for r in graph.components(links).collect()} == {0}


def test_exact(spark, docs, none):
    got = exact.exact_duplicates(docs).collect()
    groups: dict = {}
    for i, t, *_ in DOCS:
        groups.setdefault(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""), []).append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert exact.exact_duplicates(none).count() == 0


def test_rows_without_ids_are_salted(spark):
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Same").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = exact.exact_duplicates(rows).groupBy("group_size", "kept").count().collect()
    assert {tuple(r) for r in got} == {(1, True, 2000), (1000, True, 1000)}


def test_exact_hot_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Same TEXT").otherwise(F.concat(F.lit("same text "), F.col("id"))).alias("text"))
    got = exact.exact_duplicates(df)
    assert got.where("group_size = 1000 and keep_id = 2997").count() == 1000
    assert got.where("kept").count() == 2001


PAGES = [
    (1, "http://A.example.net/en/x?q", "<p>" + "long enough " * 20),
    (2, None, "<p>" + "long enough " * 20),
    (3, "no scheme", "short"),
    (4, "x://net/", "short"),
    (5, "http://x.org/fr/#f", None),
    (6, "http://notexample.com/de/1", ""),
    (7, "https://b.a.Example.com/de/1", "é" * 200),
    (7, "https://b.a.Example.com/de/1", "é" * 200),
    (9, "http://a.net", "é" * 200),
]


def test_warc(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted((tuple(r) for r in warc.archive_pages(pages).collect()), key=repr)
    want = []
    for i, _, h in PAGES:
        b = (h or "").encode()
        lead = min(j for j, _, g in PAGES if (g or "").encode() == b)
        again = len(b) >= 100 and i != lead
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", lead if again else None))
    assert got == sorted(want, key=repr)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_warc_other_files_and_pushdown(spark, tmp_path):
    rows = [{"record_id": f"<urn:page:{k}>", "record_type": "response" if k % 2 else "revisit", "target_uri": f"http://h/{k}", "payload": b"body\r\n\r\nWARC/1.1\r\n" * k} for k in range(40)]
    plain = b"".join(map(warc.encode_record, rows[:10]))
    (tmp_path / "a.warc").write_bytes(plain)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(warc.encode_record(r)) for r in rows[10:20]))
    (tmp_path / "c.warc.gz").write_bytes(b"".join(warc.member(warc.encode_record(r)) for r in rows[20:]))
    df = warc.read_warc(spark, str(tmp_path))
    got = {r["record_id"]: bytes(r["payload"]) for r in df.where("record_type = 'response'").collect()}
    assert got == {r["record_id"]: r["payload"] for r in rows if r["record_type"] == "response"}
    assert df.where("target_uri in ('http://h/3', 'http://h/25')").count() == 2
    assert "PushedFilters: []" not in df.where("record_type = 'response'")._jdf.queryExecution().toString()
    assert warc.read_warc(spark, str(tmp_path), "record_id string").count() == 40
    big = warc.member(warc.encode_record({"record_id": "x", "payload": os.urandom(1 << 20)}))
    reads = []

    class Counting:
        def __init__(self):
            import io

            self.f = io.BytesIO(big * 3)
            self.seek, self.tell = self.f.seek, self.f.tell

        def read(self, n):
            reads.append(n)
            return self.f.read(n)

    assert list(warc.read_member(Counting(), lambda r: False, True)) == [None] * 3
    assert sum(reads) < 100_000


def test_url_rules(spark):
    rng = random.Random(3)
    labels = ["net", "org", "com", "a", "b", "ab", "a-b"]
    host = lambda: ".".join(rng.choices(labels, k=rng.randrange(1, 5)))
    path = lambda: "/" + "".join(rng.choices("ab/", k=rng.randrange(4)))
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(60)] + [("net", "/", "block"), ("net", "/", "allow"), (None, "/zz", "block")]
    urls = [(i, rng.choice(["http://", "x://"]) + host().upper() + path() + rng.choice(["", "?q", "#f"])) for i in range(1500)]
    urls += [(2000 + i, "http://hot.a.net/ab") for i in range(800)] + [(1, None), (None, "nothing"), (3, ""), (4, "://"), (5, "http://x.y.zz/zz")]
    best: dict = {}
    for h, p, v in rules:
        best[h or "", p] = max(v, best.get((h or "", p), ""))
    want = []
    for i, u in urls:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        h, p = (m[1].lower(), m[2]) if m else ("", "")
        fits = [k for k in best if h and (not k[0] or h == k[0] or h.endswith("." + k[0])) and p.startswith(k[1])]
        k = max(fits, key=lambda k: (len(k[0]), len(k[1])), default=None)
        want.append((i, h, p, k and k[0] + k[1], best[k] if k else "allow"))
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("key", F.lit(0)).withColumn("host", F.lit(0)).repartition(5)
    table = spark.createDataFrame(rules, "host string, path string, verdict string").withColumn("part", F.lit(1))
    for ranges in (1, 7, 64):
        got = urlrules.judge_urls(pages, table, ranges=ranges).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert urlrules.judge_urls(pages.limit(0), table).count() == 0
    assert urlrules.judge_urls(pages, table.limit(0)).where("rule is null and verdict = 'allow'").count() == len(urls)


def test_languages(spark, docs, none):
    got = {(r["doc_id"], r["lang_pred"] == "und", r["score"] == 0) for r in langid.languages(docs).collect()}
    assert {(3, True, True), (4, True, True), (5, True, True)} <= got and (1, False, False) in got
    assert langid.languages(none).count() == 0
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.languages(table).where("held_out").join(table.select("doc_id", "lang"), "doc_id")
    n, right = held.count(), held.where("lang = lang_pred").count()
    assert right / n > 0.97
    assert {r["held_out"] for r in langid.languages(table).select("held_out").distinct().collect()} == {True, False}


def test_bundle_is_the_sum_of_bound_trigrams():
    text = "Abc, déf abc"
    c, v = langid.classes_of(text), langid.letter_vectors()
    want = sum(v[0][c[i]].astype(int) * v[1][c[i + 1]] * v[2][c[i + 2]] for i in range(len(c) - 2))
    assert (langid.bundles(["", text, "12"])[1] == want).all()
    assert not langid.bundles(["", text, "12"])[[0, 2]].any()


def test_main_text(spark):
    art = "<p>Caf&eacute; &amp; more,\n  of <b>it</b>all. Long text here, for sure.</p><p>Short.</p><ul><li>one</li><li>two</li></ul>"
    page = f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body><header><h1>Site</h1></header><nav><ul><li><a>x</a></li></ul></nav><div class='cookie-notice'>We use cookies, and more, and more.</div><!-- <p>no</p> --><article><h1>Title</h1>{art}<form><p>Sign up, please.</p></form></article><aside>Side, bar.</aside><div id=comments><p>First, of all: I, for one, disagree.</p></div><footer>&copy; x</footer>"
    want = "Title\nCafé & more, of itall. Long text here, for sure.\nShort.\none\ntwo"
    assert htmltext.main_text(page) == want
    assert htmltext.main_text(page.replace("<article>", "<div class=post>").replace("</article>", "</div>")) == want
    assert [htmltext.main_text(x) for x in ("", "<p>x", "a &amp b", "<nav>x</nav>", "< 3 and <b", "<script>x")] == ["", "x", "a & b", "", "< 3 and <b", ""]
    assert htmltext.main_text("<div>" * 3000 + "<p>deep, text.") == "deep, text."
    assert htmltext.main_text("<p class=a>One, two.<div>Three, four.</div>") == "One, two.\nThree, four."
    assert htmltext.main_text("<p>a, b</p><!-- <p>no</p>") == "a, b"
    rows = [(1, "u", page), (2, None, None), (2, None, ""), (None, "u", "<p>" + LONG)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = sorted(map(repr, map(tuple, htmltext.extract_main_text(df).collect())))
    long = LONG.strip()
    assert got == sorted(map(repr, [(1, "u", want, len(want)), (2, None, "", 0), (2, None, "", 0), (None, "u", long, len(long))]))
    assert htmltext.extract_main_text(df.limit(0)).count() == 0


def test_main_text_costs_the_size_of_a_page():
    """Tens of thousands of open elements, end tags without a start, and tags that never end."""
    nested = htmltext.main_text("<article>" + "".join(f"<div>t{i}, x " for i in range(40_000)))
    assert nested.split("\n") == [f"t{i}, x" for i in range(40_000)]
    assert htmltext.main_text("<div>" * 40_000 + "hi" + "</section>" * 40_000) == "hi"
    assert htmltext.main_text("<a " * 200_000) == ("<a " * 200_000).strip()


def test_main_text_of_driver_pages(spark):
    import html

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        lines = re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:p|h1)>", "\n", body)).split("\n")
        assert htmltext.main_text(r["html"]) == "\n".join(x for x in (" ".join(html.unescape(y).split()) for y in lines) if x)


def base_rules(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    met: dict = {}
    for r in runs:
        met[r] = met.get(r, 0) + 1
    inside = {p for i, r in enumerate(runs) if met[r] > 1 for p in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)


def test_quality(spark, docs, none):
    rows = [r[:2] for r in DOCS] + [(50, "a b c a b c\n x \n x \n\n y\x1cz"), (51, "the # $ <b> " * 30 + "\nx\nx"), (52, " ".join(f"the word{i}" for i in range(60)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit(1)).withColumn("lines", F.lit(1))
    got = quality.quality(df).collect()
    assert sorted(repr((r["doc_id"], *tuple(r)[1:7])) for r in got) == sorted(repr((i, *base_rules(t))) for i, t in rows)
    assert {r["doc_id"]: r["kept"] for r in got}[52] and not {r["doc_id"]: r["kept"] for r in got}[51]
    assert quality.quality(none).count() == 0
    plan = quality.quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(DOCS) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    assert toxicity.toxicity(none, labels).count() == 0
    sf = "/root/testdata/sf0.1"
    told = spark.read.parquet(f"{sf}/labels.parquet")
    held = toxicity.toxicity(spark.read.parquet(f"{sf}/documents.parquet"), told).where("held_out").join(told, "doc_id").toPandas()
    ranks, n = held.score.rank(), (held.toxic == 1).sum()
    assert (ranks[held.toxic == 1].mean() - (n + 1) / 2) / (len(held) - n) > 0.9
    assert (held.predicted[held.toxic == 0].mean()) < 0.05


def test_native_plans(spark, docs):
    plan = exact.exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def smallest_of_near_copies(rows):
    """Ids left by brute force: 5-word Jaccard of 0.8 or more, transitive."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    near = [(i, j) for i in range(len(rows)) for j in range(i) if not (sets[i] | sets[j]) or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    return {rows[r][0] for r in classes(near, len(rows))}


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    kept = {}
    for name, stage in cp.STAGES:
        before, path = {r["doc_id"]: r["text"] for r in docs.collect()}, fresh_dir(spark, "stage")
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == list(cp.COLUMNS)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = ids(docs)
        lower = {i: re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for i, t in before.items()}
        if name in ("toxicity", "language"):
            assert kept[name] <= set(before) and len(kept[name]) > 0.8 * len(before)
        if name == "exact":
            assert kept[name] == {max(i for i in lower if lower[i] == t) for t in set(lower.values())}
        if name == "near":
            assert kept[name] == smallest_of_near_copies(sorted(before.items()))
        if name == "packing":
            assert kept[name] == kept["near"]
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_stages_keep_documents_without_an_id(spark):
    import corpus_pipeline as cp

    texts = ["The small river ran past the old mill.", "Another story about ships and harbours.", "the small river ran past the old mill."]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (6, texts[1] + " It ends here, far away."), (6, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", *[F.lit(None).cast("string").alias(c) for c in ("lang", "source")], F.lit(1).alias("n_chars"), F.lit(0).alias("mark"))
    got = {(r["doc_id"], r["text"]) for r in cp.drop_equal_texts(spark, df, SF).collect()}
    assert got == {rows[1], rows[3], rows[4]}
    again = df.union(df).union(df.where("doc_id is null"))
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in cp.drop_equal_texts(spark, again, SF).collect()))) == sorted(map(str, got))
    assert cp.drop_near_duplicates(spark, again, SF).count() == 3
    near = df.where("doc_id is null or doc_id = 5")
    assert {(r["doc_id"], r["text"]) for r in cp.drop_near_duplicates(spark, near, SF).collect()} == {rows[1], rows[2]}


def test_queries_have_the_contract_columns(spark):
    want = {
        "op1_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op2_simhash": "doc_id fingerprint component_id",
        "op3_exact": "doc_id keep_id group_size kept text_sha256",
        "op4_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op5_warc": "page_id payload_bytes payload_digest record_type refers_to",
        "op6_urlrules": "page_id host path rule verdict",
        "op7_langid": "doc_id held_out lang_pred score",
        "op8_html": "page_id url text n_chars",
        "op9_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op10_toxicity": "doc_id held_out score predicted",
        "op11_resample": "doc_id n_features weight score rank",
        "op12_ahobpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op13_align": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    }
    assert set(want) == set(QUERIES)
    for name, columns in want.items():
        assert set(columns.split()) <= set(QUERIES[name](spark, SF).columns), name
