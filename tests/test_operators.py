"""Operators against plain-Python answers, on data where one key holds a third of all rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lathe.functions import rx
from lathe.functions import text as T
from lathe.operators import dedup as D
from lathe.operators import joins as J
from lathe.operators import ordered as O
from lathe.operators import projection as C
from lathe.operators import reshape as R
from lathe.operators.linkgraph import reachable
from lathe.sources import pages as P
from lathe.spec.packs import extract_dimensions
from lathe.spec.rules import extract_with_rules

N = 3000


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    ords = sorted({rnd.choice([i, 10**6 + i, 10**9 + i * i]) for i in range(N)})
    out = []
    for o in ords:
        key = "hot" if rnd.random() < 0.34 else f"k{rnd.randrange(60)}"
        out.append((o, key, rnd.choice([None, "", "nan", "s1", "s2", "s3"]), rnd.randrange(100)))
    return out


@pytest.fixture(scope="module", params=[1, 7])
def table(spark, rows, request):
    shuffled = rows[:]
    random.Random(request.param).shuffle(shuffled)
    return spark.createDataFrame(shuffled, "ord bigint, key string, sku string, value int").repartition(request.param)


def by_key(rows):
    out = {}
    for r in sorted(rows):
        out.setdefault(r[1], []).append(r)
    return out


def test_keep_first(table, rows):
    got = {r["key"]: r["ord"] for r in D.keep_first(table, "key", "ord").collect()}
    assert got == {k: v[0][0] for k, v in by_key(rows).items()}


def test_keep_first_is_idempotent(table):
    once = D.keep_first(table, "key", "ord")
    assert sorted(D.keep_first(once, "key", "ord").collect()) == sorted(once.collect())


def test_keep_first_sends_one_row_per_task_and_key(table):
    plan = D.keep_first(table.repartition(5), "key", "ord")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_keep_first_present_drops_missing(table):
    assert {r["sku"] for r in D.keep_first_present(table, "sku", "ord").collect()} == {"s1", "s2", "s3"}


def test_keep_first_needs_order(table):
    with pytest.raises(ValueError):
        D.keep_first(table, "key", [])


def test_fallback_kinds_never_collide(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "", "a"), (3, None, None), (4, " ", ""), (5, "a", "z")], "ord int, sku string, handle string")
    got = sorted(r["ord"] for r in D.keep_first_fallback(df, ["sku", "handle"], "ord").collect())
    assert got == [1, 2, 3, 4]


def test_scope_global_and_local(spark):
    df = spark.createDataFrame([(0, "c1", "s", "global"), (1, "c2", "s", "global"), (2, "c3", "s", "local"), (3, "c3", "s", "local")], "ord int, cat string, sku string, scope string")
    got = sorted(r["cat"] for r in D.keep_first_scoped(df, "cat", "sku", "scope", "ord").collect())
    assert got == ["c1", "c3"]


def test_append_old_wins(spark):
    old = spark.createDataFrame([("u1", "a", 9)], "url string, v string, ord int")
    new = spark.createDataFrame([("u1", "b", 1), ("u2", "c", 2)], "url string, v string, ord int")
    once = D.append_old_wins(old, new, "url", "ord")
    assert sorted((r["url"], r["v"]) for r in once.collect()) == [("u1", "a"), ("u2", "c")]
    assert sorted(D.append_old_wins(once, new, "url", "ord").collect()) == sorted(once.collect())


@pytest.mark.parametrize("ranges", [2, 8, 64])
def test_running_index(table, rows, ranges):
    got = {r["ord"]: r["i"] for r in O.running_index(table, "ord", ["key"], "i", ranges).collect()}
    assert got == {r[0]: i for v in by_key(rows).values() for i, r in enumerate(v, 1)}
    got = {r["ord"]: r["i"] for r in O.running_index(table, "ord", (), "i", ranges).collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(rows), 1)}


def test_index_missing(table, rows):
    n, want = 5, {}
    for r in sorted(rows):
        n += r[2] in (None, "", "nan")
        want[r[0]] = n
    got = {r["ord"]: r["serial"] for r in O.index_missing(table, "sku", "ord", start=5).collect()}
    assert got == want


def test_carry_forward_and_next(table, rows):
    head = F.when(F.col("value") > 90, F.col("value"))
    carry = {r["ord"]: r["section"] for r in O.carry_forward(table, head, "ord", ["key"]).collect()}
    nxt = {r["ord"]: r["next"] for r in O.next_value(table, head, "ord", ["key"]).collect()}
    for v in by_key(rows).values():
        last = None
        for r in v:
            last = r[3] if r[3] > 90 else last
            assert carry[r[0]] == last
        later = None
        for r in reversed(v):
            assert nxt[r[0]] == later
            later = r[3] if r[3] > 90 else later


def test_ranges_share_a_hot_key(table):
    sizes = O.laid_out(table, ["ord"], ranges=8).groupBy("__range").count().collect()
    assert max(r["count"] for r in sizes) < N / 3


def test_hot_first_order_column_is_spread(table, rows):
    """One source holds every row: the position behind it still cuts the ranges."""
    t = table.withColumn("source", F.lit("one"))
    sizes = O.laid_out(t, ["source", "ord"], ranges=8).groupBy("__range").count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < N / 4
    got = {r["ord"]: r["i"] for r in O.running_index(t, ["source", "ord"], (), "i", 8).collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(rows), 1)}


def test_text_order(table, rows):
    got = {r["ord"]: r["i"] for r in O.running_index(table, ["sku", "ord"], ["key"], "i", 8).collect()}
    for v in by_key(rows).values():
        for i, r in enumerate(sorted(v, key=lambda r: (r[2] is not None, r[2] or "", r[0])), 1):
            assert got[r[0]] == i


def test_empty_input(table):
    assert O.running_index(table.filter("ord < 0"), "ord", ["key"]).count() == 0


def test_top_n(table, rows):
    got = {}
    for r in O.top_n(table, 3, "ord", ["key"]).collect():
        got.setdefault(r["key"], set()).add(r["ord"])
    assert got == {k: {r[0] for r in v[:3]} for k, v in by_key(rows).items()}


def test_done_and_pending_split_the_input(table):
    done = table.filter("value < 40")
    todo = J.pending(table, done, "ord")
    assert todo.count() + done.count() == table.count()
    assert todo.join(done, "ord").count() == 0


def test_salted_lookup_equals_plain(spark, table):
    side = spark.createDataFrame([(f" {k} ", i) for i, k in enumerate(["hot", "k1", "k2"])], "key string, tag int")
    plain = J.lookup_join(table, side, "key").select("ord", "tag").collect()
    salted = J.lookup_join(table, side, "key", salts=5, spread="ord").select("ord", "tag").collect()
    assert sorted(plain, key=str) == sorted(salted, key=str)


def test_duplicate_results_do_not_fan_out(spark):
    main = spark.createDataFrame([("u ",), ("v",)], "url string")
    res = spark.createDataFrame([("u", 1), (" u", 2)], "URL2 string, n int")
    assert J.merge_results(main, res, "url", "URL2", "n").orderBy("url").select("n").collect() == [(1,), (None,)]


def test_restore_counts_nan_as_missing(spark):
    now = spark.createDataFrame([("a", ""), ("b", "nan"), ("c", None), ("d", "x")], "k string, v string")
    old = spark.createDataFrame([(k, "old") for k in "abcd"], "k string, v string")
    assert {r["k"]: r["v"] for r in J.restore_progress(now, old, "k", ["v"]).collect()} == {"a": "old", "b": "old", "c": "old", "d": "x"}


def test_company_without_people_keeps_a_row(spark):
    c = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    p = spark.createDataFrame([(1, "x"), (1, "y")], "cid int, who string")
    assert sorted((r["id"], r["who"]) for r in J.one_to_many(c, p, "id", "cid").fillna("").collect()) == [(1, "x"), (1, "y"), (2, "")]


def test_columns_by_name_and_place(spark):
    df = spark.createDataFrame([("1", "u", "n")], ["Idx", " Product Url ", "NAME"])
    t = C.trim_headers(df)
    assert C.url_column(t) == "Product Url"
    assert C.resolve_aliases(t).columns == ["Idx", "Product URL", "Product Name"]
    assert C.drop_first_column(t).columns == ["Product Url", "NAME"]
    assert C.positional_names(t, {2: "Product Name"}).columns[2] == "Product Name"
    assert C.standard_first(C.resolve_aliases(t)).columns[:19] == list(C.CATALOG_COLUMNS)
    assert C.grouped_columns(["F"], ["Detail: b", "Detail: a"], ["Pkg: z"], ["F", "other"]) == ["F", "Detail: a", "Detail: b", "Pkg: z", "other"]
    with pytest.raises(ValueError):
        C.require_columns(t, ["missing"])
    with pytest.raises(ValueError):
        C.url_column(spark.createDataFrame([(1,)], ["x"]))


def test_variants_with_and_without_base(spark):
    df = spark.createDataFrame([(1, [("a",), ("b",)]), (2, None)], "id int, v array<struct<sku:string>>")
    plain = [(r["id"], r["variant_pos"]) for r in R.explode_variants(df, "v").collect()]
    based = [(r["id"], r["variant_pos"]) for r in R.explode_variants(df, "v", keep_base=True).collect()]
    assert plain == [(1, 0), (1, 1), (2, None)]
    assert based == [(1, -1), (1, 0), (1, 1), (2, -1)]


def test_rule_table_agrees_with_compiled_grammar(spark):
    texts = ["W. 31.5″ | D. 20″ | H. 9″", "Ø 12 | H. 4", "SD. 9 | W. 2", "nothing"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, spec string")
    rules = spark.createDataFrame([(f, 1, rf"(?<![A-Za-z]){a}\.\s*([\d.]+)", 1) for f, a in (("width", "W"), ("depth", "D"), ("height", "H"))], "field string, prio int, pattern string, grp int")
    fields = ["width", "depth", "height"]
    compiled = extract_dimensions(df, "spec", "EI").select("id", *[f"dims.{f}" for f in fields])
    assert sorted(extract_with_rules(df, "id", "spec", rules, fields).collect(), key=str) == sorted(compiled.collect(), key=str)


def test_measures_round_trip(spark):
    rnd = random.Random(3)
    want = {i: tuple(str(rnd.randrange(4, 4000) / 4).rstrip("0").rstrip(".") for _ in range(3)) for i in range(200)}
    df = spark.createDataFrame([(i, '{}" W x {}" D x {}" H'.format(*v)) for i, v in want.items()], "id int, spec string")
    for code in ("ZUO", "DSH", "SB", "QUA"):
        got = {r["id"]: (r["dims"]["width"], r["dims"]["depth"], r["dims"]["height"]) for r in extract_dimensions(df, "spec", code).collect()}
        assert got == want, code


def test_reachable_is_breadth_first(spark):
    links = {"http://a": ["http://a/1", "http://a/2", "http://b"], "http://a/1": ["http://a/3", "http://a"], "http://a/2": ["http://a/3", "http://a/4"], "http://a/3": ["http://a/5"]}
    edges = spark.createDataFrame([(s, i, d) for s, ds in links.items() for i, d in enumerate(ds)], "src string, pos int, dst string")
    seeds = spark.createDataFrame([("http://a/",)], "url string")
    got = [(r["rank"], r["url"], r["depth"]) for r in reachable(seeds, edges).orderBy("rank").collect()]
    assert got == [(1, "http://a", 0), (2, "http://a/1", 1), (3, "http://a/2", 1), (4, "http://a/3", 2), (5, "http://a/4", 2), (6, "http://a/5", 3)]
    assert [r["url"] for r in reachable(seeds, edges, max_pages=3).orderBy("rank").collect()] == ["http://a", "http://a/1", "http://a/2"]


def test_item_cards(spark):
    html = '<ul><li class="product-item"><a href="/x">L</a><h2 class="product-title">Lamp</h2><img src="//i/a.jpg"><span class="price">$5</span></li><li class="product-item"><h2>no link</h2></li></ul>'
    df = spark.createDataFrame([(1, "https://s.example/list", html)], "page_id int, url string, html string")
    got = P.listing_cards(df, form=P.ITEM, need_sku=False).collect()
    assert [(r["card_name"], r["card_url"], r["card_image"], r["card_price"]) for r in got] == [("Lamp", "https://s.example/x", "https://i/a.jpg", "$5")]


def test_paragraph_and_line_descriptions(spark):
    df = spark.createDataFrame([(["Finish: oak", "A fine lamp."], "A chair.<br>Height: 9<br/><b>Very</b> soft</p>")], "paras array<string>, html string")
    r = df.select(T.first_paragraph("paras").alias("p"), T.description_lines("html").alias("d")).collect()[0]
    assert (r["p"], r["d"]) == ("A fine lamp.", "A chair. Very soft")


def test_null_rule(spark):
    df = spark.createDataFrame([("",), ("nan",), (" None ",), ("NULL",), ("0",), (None,)], "v string")
    assert [r[0] for r in df.select(rx.present("v")).collect()] == [None, None, None, None, "0", None]
    assert [r["v"] for r in C.to_export(C.to_raw(df)).collect()] == ["", "", "", "", "0", ""]


def test_full_entity_decoding(evaluate):
    assert evaluate(T.decode_entities_full, "caf&eacute; &amp; &#8243;") == "café & ″"


def test_right_sides_do_not_fan_out(spark):
    left = spark.createDataFrame([("a", None), ("b", "x")], "k string, v string")
    right = spark.createDataFrame([("a", "2", 2), (" a", "1", 1), ("a", "3", 3)], "k string, v string, ord int")
    assert {(r["k"], r["v"]) for r in J.restore_progress(left, right, "k", ["v"], "ord").collect()} == {("a", "1"), ("b", "x")}
    assert J.fill_from_lookup(left, right, "k", ["v"], "ord").count() == 2
    assert J.enrich(left, right.drop("ord"), "k", ["v"]).count() == 2
    assert J.join_on_url(left, right, "k", "k").count() == 2


def test_running_sum_of_missing_values(spark):
    df = spark.createDataFrame([(i, None if i < 3 or i % 2 else i) for i in range(60)], "i int, v int")
    got = [r["running"] for r in O.running_sum(df, "v", "i", ranges=9).orderBy("i").collect()]
    total, want = None, []
    for i in range(60):
        total = total if i < 3 or i % 2 else (total or 0) + i
        want.append(total)
    assert got == want


def test_vendor_rows_without_a_grammar_stay(spark):
    from lathe.spec.packs import extract_by_vendor

    df = spark.createDataFrame([(1, "EI", '10"W'), (2, "??", '10"W'), (3, None, '10"W')], "k int, pack string, spec string")
    assert sorted((r["k"], r["dims"] is None) for r in extract_by_vendor(df, "spec", "pack", ["EI", "ZUO"]).collect()) == [(1, False), (2, True), (3, True)]


def test_references(evaluate):
    assert evaluate(T.decode_entities, "Caf&eacute; 5&#8243; &deg; &#x1F642; &amp;lt; &#0; &bogus; a&b &nbsp;x") == "Café 5″ ° \U0001f642 &lt; \ufffd &bogus; a&b  x"


def test_balanced_json_is_a_slice(spark):
    from lathe.sources.pages import balanced_json

    deep = '{"a":' * 300 + "1" + "}" * 300
    cases = [
        ('x shop = {"p": 1.10, "n": 1234567890123456789012, "s": "}\\"{", "e": "\\\\"} {', '{"p": 1.10, "n": 1234567890123456789012, "s": "}\\"{", "e": "\\\\"}'),
        ('shop = {"open": [1, {"b": 2}', None),
        ("shop = nothing", None),
        ('{"before": 1}', None),
        (f"shop {deep} tail", deep),
        ('shop {"long": "' + "a\\n" * 20000 + '"};', '{"long": "' + "a\\n" * 20000 + '"}'),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["j"] for r in df.select("i", balanced_json("t", "shop").alias("j")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_numbered_counts_every_row(spark):
    from lathe.operators.ordered import numbered

    rows = spark.createDataFrame([(i % 7, -i) for i in range(1000)], "a int, b int").repartition(5)
    got = sorted((r["a"], r["b"], r["n"]) for r in numbered(rows, ["a", "b"], "n").collect())
    assert [n for *_, n in got] == list(range(1, 1001))
    assert numbered(rows.limit(0), ["a"], "n").count() == 0


def test_routed_keeps_first_of_fixed_and_last_of_extras(spark):
    from lathe.operators.projection import routed

    rows = [(1, " width ", "10", 1), (1, "WIDTH", "11", 2), (1, "Finish", "a", 3), (1, "finish", " b ", 4), (1, "seat", " ", 5), (1, None, "z", 6), (2, "Arm", "q", 1), (2, "Arm height", "r", 0)]
    got = routed(spark.createDataFrame(rows, "id int, key string, value string, at int"), "id", ["Width", "Depth"], "at").collect()
    assert {r["id"]: (r["Width"], r["Depth"], r["extras"]) for r in got} == {1: ("10", None, {"Finish": "b"}), 2: (None, None, {"Arm Height": "r", "Arm": "q"})}


def brute_elements(html, name):
    """(place, depth, content) by a stack; an element that is never closed runs to the end."""
    found, stack, depth = [], {}, 0
    tags = list(re.finditer(rf"(?i)<(/?){name}(?=[\s/>])[^>]*>", html))
    for place, tag in enumerate(tags, 1):
        if tag[1]:
            at = stack.pop(depth, None)
            if at is not None:
                found[at][2] = html[found[at][3] : tag.start()]
            depth -= 1
        else:
            depth += 1
            stack[depth] = len(found)
            found.append([place, depth, html[tag.end() :], tag.end()])
    return [tuple(f[:3]) for f in found]


def test_nested_elements_equal_a_stack(spark):
    from lathe.functions.html import contents, elements

    rng = random.Random(5)
    parts = ["<div>", "<DIV class='a b'>", "</div>", "</div >", "<div\n>", "text ", "<p>x</p>", "<divider>", "<li>", "é"]
    pages = ["", "plain", "<div>", "</div>", "<div><div>" * 50 + "x" + "</div></div>" * 50, "<div>y</div>" * 3000]
    pages += ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(150)]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)] + [(-1, None)], "i int, h string")
    got = {r["i"]: r for r in df.select("i", elements("h", "div").alias("e"), contents("h", "div", "class").alias("c")).collect()}
    assert got[-1]["e"] is None
    for i, h in enumerate(pages):
        assert [tuple(e) for e in got[i]["e"]] == brute_elements(h, "div"), h
        assert got[i]["c"] == [c for (_, _, c), t in zip(brute_elements(h, "div"), re.findall(r"(?i)<div(?=[\s/>])[^>]*>", h)) if "class" in t]


def test_what_nests_is_found_whole(spark):
    from lathe.functions.html import links
    from lathe.operators.audit import address_candidates
    from lathe.sources.pages import bullet_facts

    html = (
        "<div>Visit <div>us</div> at 4 Elm Street</div><noscript><a href='/n'>n</a></noscript><template><a href='/t'>t</a></template>"
        "<script>'<a href=\"/s\">'</script><ul><li>Wood<ul><li>Finish: matte</li></ul></li></ul>" + "<div>" + "Avenue " * 40 + "</div>"
    )
    df = spark.createDataFrame([(html,)], "h string")
    row = df.select(address_candidates("h").alias("all"), address_candidates("h", 200).alias("short"), links("h").alias("l"), bullet_facts("h")["extras"].alias("x"), bullet_facts("h")["materials"].alias("m")).first()
    assert row["short"] == ["Visit us at 4 Elm Street"] and len(row["all"]) == 2
    assert row["l"] == ["/n", "/t"]
    assert row["x"] == {"Finish": "matte", "Wood Finish": "matte"} and row["m"] is None


def test_site_keywords_take_the_first_page(spark):
    from lathe.operators.audit import SITE_KEYWORDS, site_keywords

    rows = [
        ("a", 2, "u2", "<title>roofing</title><p>Pest <b>control</b>, HVAC!</p>"),
        ("a", 1, "u1", "<p>Plumbers' services</p><script>hvac</script>"),
        ("a", 3, "u3", "<li>hvac and carpet-cleaning</li>"),
        ("b", 1, "v1", None),
        (None, 1, "w1", "<p>Home service</p>"),
    ]
    out = {r["site"]: r for r in site_keywords(spark.createDataFrame(rows, "site string, page int, url string, html string"), "site", "page").collect()}
    assert set(out) == {"a", "b", None} and len(out["a"]) == 1 + 2 * len(SITE_KEYWORDS)
    told = {k: out["a"][f"{k} Source"] for k in SITE_KEYWORDS if out["a"][k] == "Yes"}
    # Without its hyphen "carpet-cleaning" is one word, and "pet" is in it.
    assert told == {"pest control": "u2", "HVAC": "u2", "plumbers": "u1", "PET": "u3"}
    assert all(out["b"][k] == "No" and out["b"][f"{k} Source"] == "" for k in SITE_KEYWORDS)
    assert out[None]["Home Services Source"] == "w1"


def test_grammars_read_their_own_rows_and_keep_what_they_do_not_know(spark):
    from lathe.spec.router import route_grammars

    bd = "Overall | W: 10 | Q: 4\nCanopy | H: 5\nCanopy | H: 6\nCord | 72"
    dwr = "Height (max): 30\nCord Length: 12\nCord Length: 13½\nBulb: none\nWidth: 9"
    rows = [(i, "EI", f'{i}"W', "x") for i in range(40)] + [(100, "BD", bd, "x"), (101, "DWR", dwr, "x"), (102, "?", "W: 1", "x"), (103, None, "W: 1", "x"), (104, "BD", None, "x"), (105, "DWR", "", "x"), (106, "", "W: 1", "x")]
    df = spark.createDataFrame(rows, "k int, pack string, spec string, extras string")
    out = {r["k"]: r for r in route_grammars(df, "spec", "pack").collect()}
    assert len(out) == len(rows) and out[0].__fields__ == ["k", "pack", "spec", "dims", "extras"]
    alone = {r["k"]: r["dims"] for r in extract_dimensions(df.where("pack = 'EI'"), "spec", "EI").collect()}
    assert all(out[k]["dims"] == alone[k] and out[k]["extras"] is None for k in range(40))
    assert out[100]["dims"]["width"] == "10" and out[100]["extras"] == {"Overall Q": "4", "Canopy H": "5", "Cord": "72"}
    assert out[101]["dims"]["height"] == "30" and out[101]["dims"]["width"] == "9"
    assert out[101]["extras"] == {"Cord Length": "13.5", "Bulb": "none"}
    assert all(out[k]["dims"] is None and out[k]["extras"] is None for k in (102, 103, 106))
    assert out[104]["extras"] is None and out[105]["extras"] == {}
    assert route_grammars(df.limit(0), "spec", "pack", ["EI"]).count() == 0


def test_card_layouts(spark):
    """Cards inside cards, classes that only begin alike, missing parts, NULL and empty pages; columns with clashing names."""
    from lathe.sources import cards as K

    wide = K.CardLayout((K.Step("div", "card"), K.Step("li")), (K.Pick((K.Step("a"),), ("data-to", "href")),), (K.Pick((K.Step("img", "pic"),), ("src",)),), (K.Pick((K.Step("div", "t"), K.Step("b"))),))
    pages = [
        (1, '<div class="card-deck"><div class="a card"><div class=t>x<b>One</b></div><a href="/1">a</a><div class="card"><a href="/2" data-to="/3">b</a></div></div></div>'),
        (2, "<ul><li><a href='/4'>c</a><li>no link</li></ul>"),
        (3, ""),
        (4, None),
    ]
    df = spark.createDataFrame([(i, "https://s.example/", "kept", h) for i, h in pages], "page_id int, url string, pos_of string, html string")
    got = sorted(tuple(r) for r in K.laid_out_cards(df, wide).select("page_id", "pos", "card_url", "card_name", "card_sku", "card_image", "pos_of").collect())
    s = "https://s.example"
    assert got == [(1, 0, f"{s}/1", "One", None, None, "kept"), (1, 1, f"{s}/3", None, None, None, "kept"), (2, 0, f"{s}/4", None, None, None, "kept")]


def test_no_round_shuffles_the_edges(spark):
    from lathe.operators.linkgraph import steps
    from lathe.session import bucketed

    edges = spark.range(1000).selectExpr("concat('http://a/', id % 50) src", "cast(id as int) pos", "concat('http://a/', id) dst")
    frontier = spark.createDataFrame([("http://a", "http://a/7", 1)], "site string, url string, rank bigint")
    before, tables = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), len(spark.catalog.listTables())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed(edges, "src") as stored_edges:
            found = steps(frontier, stored_edges)
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(url" in plan and "hashpartitioning(src" not in plan
            assert found.count() == 20
        assert len(spark.catalog.listTables()) == tables
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["running_index", "running_sum", "carry_forward", "next_value", "index_across", "numbered"])
def test_ordered_operators_read_their_input_twice(spark, name):
    """A hot key with half of all rows and a NULL key, against a plain Python loop."""
    import lathe.operators.ordered as O

    rows = [(None if i % 10 == 0 else "hot" if i % 2 else f"k{i % 7}", (i * 37) % 401, i % 3 if i % 5 else None) for i in range(401)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "k string, o int, v int").mapInArrow(count, "k string, o int, v int")
    made = {
        "running_index": lambda: O.running_index(df, "o", ["k"], "out", ranges=5),
        "running_sum": lambda: O.running_sum(df, "v", "o", ["k"], "out", ranges=5),
        "carry_forward": lambda: O.carry_forward(df, "v", "o", ["k"], "out", ranges=5),
        "next_value": lambda: O.next_value(df, "v", "o", ["k"], "out", ranges=5),
        "index_across": lambda: O.index_across(df.withColumn("c", F.lit(1)), "k", "c", "o", "out", ranges=5),
        "numbered": lambda: O.numbered(df, "o", "out"),
    }[name]()
    got = {r["o"]: r["out"] for r in made.collect()}
    assert seen.value <= 2 * len(rows)
    want, first = {}, lambda r: (r[0] is not None, r[0] or "", r[1])
    if name == "numbered":
        want = {o: i + 1 for i, (_, o, _) in enumerate(sorted(rows, key=lambda r: r[1]))}
    elif name == "index_across":
        want = {o: i + 1 for i, (_, o, _) in enumerate(sorted(rows, key=first))}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=first)
        for i, (_, o, _) in enumerate(own):
            past = [v for _, _, v in own[: i + 1] if v is not None]
            later = [v for _, _, v in own[i + 1 :] if v is not None]
            value = {"running_index": i + 1, "running_sum": sum(past) if past else None, "carry_forward": past[-1] if past else None, "next_value": later[0] if later else None}
            want.setdefault(o, value.get(name))
    assert got == want
