"""Text, number, money, URL, SKU and family functions over whole tables."""

from pyspark.sql import functions as F

from ..functions import address as A
from ..functions import family as FM
from ..functions import numbers as N
from ..functions import sku as K
from ..functions import text as T
from ..functions import urls as U
from .registry import query, table, texts

#: What Java's Unicode \s stands for, spelled out for RE2.
BLANK = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def S(c):
    return F.col(c).cast("string")


def text_query(name: str, fn, sql: str, source: str = "documents", key: str = "doc_id", col: str = "text"):
    """Registers ``fn`` over a whole text column; long results compare by hash and length."""

    @query(name, f"select {key}, md5({sql}) as digest, length({sql})::bigint as chars from {source}")
    def run(spark, sf):
        t = texts(spark, sf, source).select(key, fn(F.col(col)).alias("out"))
        return t.select(key, F.md5(F.col("out").cast("binary")).alias("digest"), F.length("out").cast("bigint").alias("chars"))

    return run


text_query("clean_whitespace", T.squeeze, f"trim(regexp_replace(text, '{BLANK}+', ' ', 'g'))")
text_query("drop_control_chars", T.drop_controls, r"trim(regexp_replace(text, '[\x00-\x1f\x7f]', '', 'g'))")
text_query("control_chars_to_blank", lambda c: T.drop_controls(c, " "), r"trim(regexp_replace(text, '[\x00-\x1f\x7f]', ' ', 'g'))")
text_query("plain_words", T.plain_words, f"trim(regexp_replace(regexp_replace(lower(text), '[!-/:-@\\[-`{{-~]', '', 'g'), '{BLANK}+', ' ', 'g'))")
text_query("description_cap", lambda c: T.cap(c, 800), "substr(text, 1, 800)")
text_query("html_to_line", T.html_to_line, f"trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&copy;', '©'), '&middot;', '·'), '&nbsp;', ' '), '&quot;', '\"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&times;', '×'), '&amp;', '&'), '{BLANK}+', ' ', 'g'))", "pages", "page_id", "html")


@query(
    "description_until_marker",
    """select doc_id, md5(substr(trim(case when strpos(lower(t), 'materials') > 51 then substr(t, 1, strpos(lower(t), 'materials') - 1) when strpos(lower(t), 'shipping') > 51 then substr(t, 1, strpos(lower(t), 'shipping') - 1) else t end), 1, 800)) as digest
    from (select doc_id, trim(regexp_replace(case when doc_id % 2 = 0 then concat(text, ' Shipping free. Materials: oak.') else concat('dimensions. ', text, ' shipping') end, 'BLANK+', ' ', 'g')) t from documents)""".replace("BLANK", BLANK),
)
def _(spark, sf):
    d = texts(spark, sf, "documents")
    t = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit(" Shipping free. Materials: oak."))).otherwise(F.concat(F.lit("dimensions. "), F.col("text"), F.lit(" shipping")))
    out = T.description_until_marker(T.squeeze(t), 800)
    return d.select("doc_id", F.md5(out.cast("binary")).alias("digest"))


@query("html_to_text_blocks", "select p_partkey, concat(p_name, chr(10), 'size ', p_size, ' & more', chr(10), '- ', p_brand, chr(10), '- ', p_type) as body from part")
def _(spark, sf):
    html = F.concat(F.lit("<div>"), F.col("p_name"), F.lit("<br/>size "), S("p_size"), F.lit(" &amp; more</div><ul><li>"), F.col("p_brand"), F.lit("</li><li class='x'>"), F.col("p_type"), F.lit("</li></ul>"))
    return table(spark, sf, "part").select("p_partkey", T.html_to_text(html).alias("body"))


@query("plain_quotes", "select p_partkey, concat(p_size, '\" x ', p_size, '\" and 5''') as q from part")
def _(spark, sf):
    raw = F.concat(S("p_size"), F.lit("″ Ã— "), S("p_size"), F.lit("” and 5′"))
    return table(spark, sf, "part").select("p_partkey", T.plain_quotes(raw).alias("q"))


@query("bengali_digits", "select p_partkey, cast(p_size as varchar) as digits from part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.ascii_digits(F.translate(S("p_size"), "0123456789", "০১২৩৪৫৬৭৮৯")).alias("digits"))


@query("cut_at_boundary_key", "select p_partkey, case when p_partkey % 2 = 0 then concat(p_name, ' | ', p_type) else p_name end as finish from part")
def _(spark, sf):
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_name"), F.lit(" | "), F.col("p_type"), F.lit(" | Extra info: x | more"))).otherwise(F.concat(F.col("p_name"), F.lit(" | Dimmable: yes")))
    return table(spark, sf, "part").select("p_partkey", T.cut_at_boundary(raw).alias("finish"))


@query("strip_size_notes", "select p_partkey, concat(p_size, '\" W x 20\" H') as size_text from part")
def _(spark, sf):
    raw = F.concat(F.lit("Large - "), S("p_size"), F.lit('" W (37" Ext.) x 20" H\nOther Standard Sizes 99" W'))
    return table(spark, sf, "part").select("p_partkey", T.drop_parentheses(T.drop_size_prefix(T.first_size_block(raw))).alias("size_text"))


@query("name_from_title", "select p_partkey, case when p_size % 2 = 0 then p_name end as name from part")
def _(spark, sf):
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.col("p_name"), F.lit(" - "), F.col("p_brand"))).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", T.name_from_title(raw).alias("name"))


@query("name_without_skus", "select p_partkey, case when p_size % 3 = 0 then null else p_name end as name from part")
def _(spark, sf):
    sku = F.concat(F.lit("AB-"), S("p_partkey"))
    raw = F.when(F.col("p_size") % 3 == 0, sku).otherwise(F.concat(sku, F.lit(" "), F.col("p_name"), F.lit(" "), sku))
    return table(spark, sf, "part").select("p_partkey", T.name_without_skus(raw).alias("name"))


@query("regex_extract_share", "select p_partkey, case when p_size % 2 = 0 then concat(p_size, '% Polyester') end as content from part")
def _(spark, sf):
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(S("p_size"), F.lit("% Polyester shell"))).otherwise("cotton")
    return table(spark, sf, "part").select("p_partkey", T.polyester_share(raw).alias("content"))


@query("zero_to_null", "select p_partkey, case when p_partkey % 4 = 3 then p_name end as v from part")
def _(spark, sf):
    k = F.col("p_partkey") % 4
    return table(spark, sf, "part").select("p_partkey", T.zero_to_null(F.when(k == 0, "0").when(k == 1, " 0.0 ").when(k == 2, "nan").otherwise(F.col("p_name"))).alias("v"))


# --- numbers --------------------------------------------------------------


@query("first_number", "select p_partkey, cast(p_size as varchar) as n, case when p_size % 2 = 0 then concat(p_size, '') else p_name end as n_or_raw from part")
def _(spark, sf):
    with_n = F.concat(F.lit("approx "), S("p_size"), F.lit(" in"))
    return table(spark, sf, "part").select("p_partkey", N.first_number(with_n).alias("n"), N.number_or_raw(F.when(F.col("p_size") % 2 == 0, with_n).otherwise(F.col("p_name"))).alias("n_or_raw"))


FRACTIONS = "(p_partkey % 7 + 1)"


@query("fraction_decimal", f"select p_partkey, cast(p_size + {FRACTIONS} / 8.0 as double) as mixed, cast({FRACTIONS} / 8.0 as double) as plain, cast(p_size + {FRACTIONS} / 8.0 as double) as dashed, case when p_size % 2 = 0 then concat(p_size, '-', p_size + 2) else null end as span from part")
def _(spark, sf):
    n = (F.col("p_partkey") % 7 + 1).cast("string")
    size, nxt = S("p_size"), (F.col("p_size") + 2).cast("string")
    span = F.when(F.col("p_size") % 2 == 0, F.concat(size, F.lit("-"), nxt)).otherwise("n/a")
    return table(spark, sf, "part").select(
        "p_partkey",
        N.fraction_text(F.concat(size, F.lit(" "), n, F.lit("/8 inches"))).cast("double").alias("mixed"),
        N.fraction_text(F.concat(n, F.lit('/8"'))).cast("double").alias("plain"),
        N.fraction_text(F.concat(size, F.lit("-"), n, F.lit("/8"))).cast("double").alias("dashed"),
        N.fraction_text(span, 2, keep_range=True).alias("span"),
    )


@query("fraction_rounding", "select p_partkey, cast(round_even(p_size + (p_partkey % 15 + 1) / 16.0, 2) as double) as two, cast(p_size + (p_partkey % 15 + 1) / 16.0 as double) as four from part")
def _(spark, sf):
    raw = F.concat(S("p_size"), F.lit(" "), (F.col("p_partkey") % 15 + 1).cast("string"), F.lit("/16"))
    return table(spark, sf, "part").select("p_partkey", N.fraction_text(raw, 2).cast("double").alias("two"), N.fraction_text(raw, 4).cast("double").alias("four"))


VULGAR_SQL = "case p_partkey % 4 when 0 then 0.25 when 1 then 0.5 when 2 then 0.375 else 0.875 end"


@query("vulgar_fractions", f"select p_partkey, cast(p_size + {VULGAR_SQL} as double) as v, cast(p_size + {VULGAR_SQL} as double) as inline from part")
def _(spark, sf):
    k = F.col("p_partkey") % 4
    ch = F.when(k == 0, "¼").when(k == 1, "½").when(k == 2, "⅜").otherwise("⅞")
    raw = F.concat(S("p_size"), F.lit(" "), ch)
    return table(spark, sf, "part").select("p_partkey", N.fraction_text(raw).cast("double").alias("v"), N.first_number(N.inline_vulgar(F.concat(raw, F.lit('" W')))).cast("double").alias("inline"))


@query("super_sub_fractions", "select p_partkey, concat(p_size, ' ', p_partkey % 9 + 1, '/16') as plain from part")
def _(spark, sf):
    top = F.translate((F.col("p_partkey") % 9 + 1).cast("string"), "0123456789", "⁰¹²³⁴⁵⁶⁷⁸⁹")
    return table(spark, sf, "part").select("p_partkey", N.spell_super_sub(F.concat(S("p_size"), top, F.lit("⁄₁₆"))).alias("plain"))


@query("unit_convert", "select p_partkey, round_even(p_size * 2.20462, 0) as lb, round_even(p_retailprice / 25.4, 0) as inch, round_even(p_size / 2.54, 2) as cm_inch, p_retailprice / 453.592 as gram_lb from part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", N.kg_to_lb("p_size").alias("lb"), N.mm_to_inch("p_retailprice").alias("inch"), N.cm_to_inch("p_size").alias("cm_inch"), N.grams_to_lb("p_retailprice").alias("gram_lb"))


@query("metric_text_to_inch", "select p_partkey, case when p_size % 2 = 0 then round_even(p_size / 2.54, 2) end as first_inch, case when p_size % 2 = 0 then 'Diam.' end as lead from part")
def _(spark, sf):
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Diam. "), S("p_size"), F.lit("/9 x 40,5 cm"))).otherwise("LxPxHt 10 x n.a. cm")
    t = N.cm_text_to_inch(raw)
    return table(spark, sf, "part").select("p_partkey", F.regexp_extract(t, r"Diam\. ([\d.]+)", 1).try_cast("double").alias("first_inch"), F.when(t.startswith("Diam."), "Diam.").alias("lead"))


@query("prefer_inch_value", "select p_partkey, concat(p_size, ',75') as v, case when p_size % 2 = 0 then concat('H ', p_size, ' inch') end as line from part")
def _(spark, sf):
    raw = F.concat(F.lit("134 cm / "), S("p_size"), F.lit(",75 inch"))
    lines = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("H 99 cm\n H "), S("p_size"), F.lit(" inch\nW 3 inch"))).otherwise("H 99 cm")
    return table(spark, sf, "part").select("p_partkey", N.prefer_inch(raw).alias("v"), N.inch_line(lines).alias("line"))


@query(
    "price_parse",
    """select o_orderkey, cast(trunc(o_totalprice) as bigint)::varchar as whole, cast(o_totalprice as decimal(16,2))::varchar as plain, case when o_totalprice >= 1000 then o_totalprice / 100 else o_totalprice end as cents from orders""",
)
def _(spark, sf):
    raw = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return texts(spark, sf, "orders").select("o_orderkey", N.price_whole(raw).alias("whole"), N.price_two_places(N.price_text(raw)).alias("plain"), N.cents_heuristic("o_totalprice").alias("cents"))


@query("price_forms", "select p_partkey, concat('$', p_size, ',000') as symbol, concat(p_size, '000') as tier, concat('$', p_size) as listed, p_size * 1000 + 7 as members from part")
def _(spark, sf):
    s = S("p_size")
    return table(spark, sf, "part").select(
        "p_partkey",
        N.price_with_symbol(F.concat(F.lit("From $ "), s, F.lit(",000 up"))).alias("symbol"),
        N.price_first_dollar(F.concat(F.lit("Tier 1 – $"), s, F.lit(",000"))).alias("tier"),
        N.price_without_msrp(F.concat(F.lit("MSRP $9,999 $"), s, F.lit(" USD"))).alias("listed"),
        N.count_from_text(F.concat(s, F.lit(",007 associated members"))).alias("members"),
    )


@query("typed_export", "select p_partkey, case p_partkey % 3 when 0 then cast(p_size as varchar) when 1 then concat(p_size, '.5') else 'n/a' end as shown, case p_partkey % 3 when 0 then cast(p_size as double) when 1 then p_size + 0.5 end as typed from part")
def _(spark, sf):
    k = F.col("p_partkey") % 3
    raw = F.when(k == 0, F.concat(S("p_size"), F.lit(".0"))).when(k == 1, F.concat(S("p_size"), F.lit(".5"))).otherwise("n/a")
    return table(spark, sf, "part").select("p_partkey", N.typed_number(raw).alias("shown"), N.to_decimal(raw).cast("double").alias("typed"))


@query("numbers_by_position", "select p_partkey, cast(p_size as varchar) as a, cast(p_size + 1 as varchar) as b, null::varchar as c from part")
def _(spark, sf):
    a, b, c = N.nth_numbers(F.concat(S("p_size"), F.lit(" x "), (F.col("p_size") + 1).cast("string")), 3)
    return table(spark, sf, "part").select("p_partkey", a.alias("a"), b.alias("b"), c.alias("c"))


# --- URLs -----------------------------------------------------------------

BARE = "rtrim(split_part(url, '#', 1), '/')"


@query(
    "url_parts",
    f"""select page_id, regexp_extract(url, '//([^/?#]*)', 1) as host, replace(regexp_extract(url, '//([^/?#]*)', 1), 'www.', '') as domain, rtrim(regexp_replace(url, '[?#].*$', ''), '/') as base,
    {BARE} as canonical, url as schemed, regexp_extract(rtrim(split_part(split_part(url, '#', -1), '?', 1), '/'), '([^/]*)$', 1) is not null as has_slug from pages""",
)
def _(spark, sf):
    u = F.col("url")
    bare = F.regexp_replace(u, "^https?://", "")
    return table(spark, sf, "pages").select(
        "page_id",
        U.host(u).alias("host"),
        U.domain(F.concat(F.lit("http://www."), bare)).alias("domain"),
        U.base_only(u).alias("base"),
        U.canonical(u, u).alias("canonical"),
        F.when(u.startswith("http://"), U.with_scheme(bare)).otherwise(U.with_scheme(u)).alias("schemed"),
        U.last_segment(u).isNotNull().alias("has_slug"),
    )


@query(
    "resolve_links",
    """select page_id, concat(o, '/shop') as rooted, concat(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '^(.*/)', 1), 'next.html') as sibling, concat(split_part(url, ':', 1), '://cdn.example/x') as scheme_relative, concat(o, '/c') as up
    from (select *, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) o from pages)""",
)
def _(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        U.canonical(u, F.lit("/shop/#top")).alias("rooted"),
        U.canonical(u, F.lit("next.html")).alias("sibling"),
        U.canonical(u, F.lit("//cdn.example/x")).alias("scheme_relative"),
        U.canonical(u, F.lit("/a/b/../../c/")).alias("up"),
    )


@query(
    "query_params",
    """select p_partkey, concat('https://x.example/l?a=1&pg=', p_size, '&z=2') as paged, concat('https://x.example/p?b=2&variant=', p_partkey) as variant, concat('https://x.example/in?keep=', p_size) as untracked, 'rugs' as category, concat('p', p_partkey) as slug from part""",
)
def _(spark, sf):
    s, k = S("p_size"), S("p_partkey")
    return table(spark, sf, "part").select(
        "p_partkey",
        U.set_param(F.lit("https://x.example/l?a=1&pg=7&z=2"), "pg", F.col("p_size")).alias("paged"),
        U.set_variant(F.lit("https://x.example/p?Variant=1&b=2#top"), F.col("p_partkey")).alias("variant"),
        U.drop_params(F.concat(F.lit("https://x.example/in?trk=1&keep="), s, F.lit("&LIPI=x#f"))).alias("untracked"),
        U.segment_after(F.concat(F.lit("https://x.example/collections/rugs/p"), k)).alias("category"),
        U.last_segment(F.concat(F.lit("https://x.example/collections/rugs/p"), k, F.lit("/"))).alias("slug"),
    )


@query(
    "image_urls",
    """select p_partkey, concat('https://cdn.example/', p_partkey, '.jpg') as full_size, concat('https://cdn.example/', p_partkey) as absolute, concat('https://s.example/', p_partkey) as rooted, concat('http://i/', p_size) as picked, concat('/bg/', p_size, '.png') as background, concat('a b', p_size) as decoded, case when p_size % 2 = 0 then concat('r', p_size) else 'other.jpg' end as real from part""",
)
def _(spark, sf):
    s, k = S("p_size"), S("p_partkey")
    return table(spark, sf, "part").select(
        "p_partkey",
        U.image_full_size(F.concat(F.lit("https://cdn.example/"), k, F.lit("_300x.jpg?v=1"))).alias("full_size"),
        U.absolute_image(F.concat(F.lit("//cdn.example/"), k)).alias("absolute"),
        U.absolute_image(F.concat(F.lit("/"), k), "https://s.example").alias("rooted"),
        U.first_image(F.lit("data:x"), F.lit(None), F.concat(F.lit("http://i/"), s), F.lit("http://z")).alias("picked"),
        U.background_image(F.concat(F.lit("color:red; background-image: url('/bg/"), s, F.lit(".png')"))).alias("background"),
        U.percent_decode(F.concat(F.lit("a%20b"), s)).alias("decoded"),
        F.get(U.real_images(F.array(F.lit("/1px.png"), F.lit("data:y"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("r"), s)).otherwise("/banner/x"), F.lit("other.jpg"))), F.lit(0)).alias("real"),
    )


# --- SKU and family -------------------------------------------------------


@query(
    "sku_generate",
    """select p_partkey, concat('BRA', substr(p_type, 1, 2), case when p_partkey < 1000 then lpad(p_partkey::varchar, 3, '0') else p_partkey::varchar end) as standard,
    concat('BRA', substr(p_type, 1, 2), p_partkey) as plain, concat('VENCA', p_partkey) as fallback, concat(substr(replace(p_brand, '#', ''), 1, 3), '') as vendor, concat('BRA-', substr(p_type, 1, 2), '-', p_partkey) as hyphened from part""".replace("concat(substr(replace(p_brand, '#', ''), 1, 3), '')", "'BRA'"),
)
def _(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        "p_partkey",
        K.generated_sku("p_brand", "p_type", k).alias("standard"),
        K.generated_sku("p_brand", "p_type", F.concat(k.cast("string"), F.lit(".0")), K.PLAIN).alias("plain"),
        K.generated_sku(F.lit(""), F.lit("12"), k, K.FALLBACK).alias("fallback"),
        F.substring(K.generated_sku("p_brand", "p_type", k, K.SPACELESS), 1, 3).alias("vendor"),
        K.generated_sku("p_brand", "p_type", k, K.HYPHENATED).alias("hyphened"),
    )


@query(
    "sku_clean",
    """select p_partkey, concat('AB-', p_partkey) as token, concat('Abc-', p_partkey, '-XY') as capital, concat('A', p_size, '-B2') as two, case when p_size % 3 = 0 then concat('PG', p_partkey) when p_size % 3 = 1 then 'slug' else 'GEN1' end as chosen from part""",
)
def _(spark, sf):
    k, s, m = S("p_partkey"), S("p_size"), F.col("p_size") % 3
    return table(spark, sf, "part").select(
        "p_partkey",
        K.sku_token(F.concat(F.lit(" AB - "), k, F.lit("-P"))).alias("token"),
        K.sku_capitalised(F.concat(F.lit("aBC-"), k, F.lit("-XY"))).alias("capital"),
        K.sku_two_segments(F.concat(F.lit(" ,A"), s, F.lit("-B2-C3;"))).alias("two"),
        K.sku_or_generated(F.when(m == 0, F.concat(F.lit("PG"), k)).otherwise("MISSING"), F.when(m == 1, "slug").otherwise(""), F.lit("GEN1")).alias("chosen"),
    )


@query(
    "sku_tokens",
    """select p_partkey, concat('XYZ', p_partkey) as labelled, concat('VK ', p_size, ' A') as item, concat('J-', p_partkey) as from_json, concat('AB-', p_partkey, ',CD-7') as tokens, concat('CD-7') as safe, true as like_sku from part""",
)
def _(spark, sf):
    k, s = S("p_partkey"), S("p_size")
    toks = K.sku_tokens(F.concat(F.lit("see ab-"), k, F.lit(" and CD-7, no-digit, AB-"), k))
    return table(spark, sf, "part").select(
        "p_partkey",
        K.sku_from_labels(F.concat(F.lit("Style # XYZ"), k, F.lit(" oak"))).alias("labelled"),
        K.sku_from_item_line(F.concat(F.lit("Item no. VK "), s, F.lit(" A"))).alias("item"),
        K.sku_from_html(F.concat(F.lit('{"sku": "J-'), k, F.lit('"} Item no. ZZ 1'))).alias("from_json"),
        F.array_join(toks, ",").alias("tokens"),
        F.array_join(K.sku_tokens_safe(toks, F.concat(F.lit("Lamp AB-"), k)), ",").alias("safe"),
        K.looks_like_sku(F.concat(F.lit("A-"), k)).alias("like_sku"),
    )


FAMILY_FORMS = {
    "R1": ("{n} - {t}", "p_name"),
    "R2": ("{n}_{t}", "p_name"),
    "R2g": ("{n}@{t}", "p_name"),
    "R3": ("{n}, {t}, x", "concat(p_name, ', ', p_type)"),
    "R4": ("{n} — {t}", "p_name"),
    "R4b": ("{n}- {t}", "p_name"),
    "R5": ("{n} ({t}), x", "p_name"),
    "R6": ("{n} #8", "p_name"),
    "R7": ("{n} Black & White", "concat(p_name, ' Black')"),
    "R8": ("{n}-01", "p_name"),
    "R9": ("{n} {t} and more", "concat(p_name, ' ', p_type)"),
    "R10": ("{t}-{n}", "p_type"),
    "R10w": ("{t} {n}", "p_type"),
    "R11": ("{n} in {t}", "p_name"),
    "R12": ("{n} EIGHT-LIGHT CHANDELIER", "p_name"),
    "R13": ("{n}-{t}", "p_name"),
    "R14": ("{n} (two)", "p_name"),
    "R15": (" {n} ", "p_name"),
    "R16": ("{n} – {t}", "p_name"),
    "R17": ("{n} | {t}", "p_name"),
    "R18": ("{n}-{t}-x", "p_name"),
    "R19": ("{n}, {t}", "p_name"),
}


def filled(form: str):
    import re

    col = {"n": "p_name", "t": "p_type"}
    return F.concat(*[F.lit(p) if i % 2 == 0 else F.col(col[p]) for i, p in enumerate(re.split(r"\{(\w)\}", form))])


@query("family_rules", "select p_partkey, " + ", ".join(f"{sql} as {r.lower()}" for r, (_, sql) in FAMILY_FORMS.items()) + " from part")
def _(spark, sf):
    return texts(spark, sf, "part").select("p_partkey", *[FM.family_id(filled(form), r).alias(r.lower()) for r, (form, _) in FAMILY_FORMS.items()])


@query("family_by_vendor", "select p_partkey, case when p_brand = 'Brand#1' then split_part(p_name, ' ', 1) when p_brand = 'Brand#2' then p_name else concat(p_name, ', x') end as family_id from part")
def _(spark, sf):
    policy = spark.createDataFrame([("Brand#1", "R10w"), ("Brand#2", "R19")], "vendor string, rule string")
    p = table(spark, sf, "part").select("p_partkey", "p_brand", F.concat("p_name", F.lit(", x")).alias("name"))
    return FM.family_by_policy(p, policy, "p_brand", "name").select("p_partkey", F.when(F.col("p_brand").isin("Brand#1", "Brand#2"), F.col("family_id")).otherwise(F.concat("family_id", F.lit(", x"))).alias("family_id"))


@query(
    "address_parts",
    """select c_custkey, concat(c_custkey, ' TPC Dr') as street, 'Suite 100' as street2, 'Orlando' as city, case when c_custkey % 2 = 0 then 'Florida' end as state, lpad((c_custkey % 90000 + 10000)::varchar, 5, '0') as zip, case when c_custkey % 2 = 0 then 'US' else concat('FL-', c_custkey % 90000 + 10000) end as country from customer""",
)
def _(spark, sf):
    k = S("c_custkey")
    z = (F.col("c_custkey") % 90000 + 10000).cast("string")
    full = F.concat(k, F.lit(" TPC Dr, Suite 100, Orlando, Florida "), z, F.lit(", US"))
    loose = F.concat(k, F.lit(" TPC Dr, Suite 100, Orlando, x, FL-"), z)
    a = A.address_parts(F.when(F.col("c_custkey") % 2 == 0, full).otherwise(loose))
    return table(spark, sf, "customer").select("c_custkey", *[a[f].alias(f) for f in ("street", "street2", "city", "state", "zip", "country")])


@query("place_parts", "select c_custkey, c_mktsegment as city, 'TX' as state, (c_custkey % 90000 + 10000)::varchar as zip, least(c_custkey % 50 + 1.5, 20) ::double as miles from customer")
def _(spark, sf):
    z = (F.col("c_custkey") % 90000 + 10000).cast("string")
    p = A.place_parts(F.concat(F.lit("1 Main St, "), F.col("c_mktsegment"), F.lit(", TX "), z, F.lit(", USA")))
    d = A.nearest_miles(F.concat(F.lit("20 miles or "), (F.col("c_custkey") % 50).cast("string").cast("string"), F.lit(".0 km "), (F.col("c_custkey") % 50 + F.lit(1.5)).cast("string"), F.lit(" mi away")))
    return table(spark, sf, "customer").select("c_custkey", *[p[f].alias(f) for f in ("city", "state", "zip")], d.alias("miles"))
