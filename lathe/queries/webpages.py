"""Landed pages: metadata, links, trackers, scores, cards, embedded JSON, crawl."""

from pyspark.sql import functions as F

from ..functions.html import elements, links, page_text
from ..operators import audit as N
from ..operators.linkgraph import link_table, reachable
from ..operators.report import sorted_set
from ..plans.catalog import site_audit
from ..sources import pages as P
from .registry import query, table, texts
from .scalars import BLANK


def pages(spark, sf):
    return texts(spark, sf, "pages").select("page_id", "url", "html")


def S(c):
    return F.col(c).cast("string")


DECODE = "replace(replace(replace(replace(replace(replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), '&nbsp;', ' '), '&quot;', '\"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
TITLE = "coalesce(trim(" + DECODE.format("nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '')") + "), '')"
HOST = "lower(regexp_extract(url, '//([^/?#]*)', 1))"
CODE = "regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<!--.*?-->', ' ', 'g')"
HREFS = f"select page_id, url, html, unnest(regexp_extract_all({CODE}, '(?is)<a\\b[^>]*\\shref\\s*=\\s*\"([^\"]*)\"', 1)) as href from pages"
INTERNAL = f"(select page_id pid, count(*) as internal from ({HREFS}) where trim(href) <> '' and (href not like '%:%' and href not like '//%' or lower(regexp_extract(href, '//([^/?#]*)', 1)) = {HOST}) group by 1)"

TRACKED = {
    "Google Tag Manager": r"GTM-[A-Z0-9]+|googletagmanager\.com/gtm\.js",
    "Google Analytics 4": r"G-[A-Z0-9]{6,}|googletagmanager\.com/gtag/js\?id=G-|gtag\(\s*''config''\s*,\s*''G-[A-Z0-9]+",
    "Google Analytics (UA)": r"UA-\d{4,}-\d+|analytics\.js",
    "Google Ads (AW)": r"AW-\d{6,}|googletagmanager\.com/gtag/js\?id=AW-",
    "Meta Pixel": r"connect\.facebook\.net/.*/fbevents\.js|fbq\(''init''|fbq\(''track''",
    "TikTok Pixel": r"analytics\.tiktok\.com/i18n/pixel/events\.js|ttq\s*=\s*window\.ttq|ttq\.track\(",
    "LinkedIn Insight": r"snap\.licdn\.com/li\.lms-analytics/insight\.min\.js|linkedin_partner_id",
    "Hotjar": r"hotjar\.com|hj\(''trigger''",
    "Microsoft Clarity": r"clarity/ms\.js|clarity\(",
    "HubSpot": r"js\.hs-analytics\.net|hs-scripts\.com",
    "Segment": r"cdn\.segment\.com/analytics|analytics\.load\(",
}
TRACK_SQL = "concat_ws(', ', " + ", ".join(f"case when regexp_matches(html, '(?i){p}') then '{k}' end" for k, p in TRACKED.items()) + ")"


@query("page_title_meta", f"select page_id, {TITLE} as title, '' as description from pages")
def _(spark, sf):
    return pages(spark, sf).select("page_id", N.title("html").alias("title"), N.meta_description("html").alias("description"))


@query("internal_links", f"select page_id, coalesce(internal, 0)::int as internal from pages left join {INTERNAL} on page_id = pid")
def _(spark, sf):
    return pages(spark, sf).select("page_id", N.internal_link_count("html", "url").alias("internal"))


@query("link_edges", f"select page_id, count(*) as links from ({HREFS}) where trim(href) <> '' group by 1")
def _(spark, sf):
    return pages(spark, sf).select("page_id", F.explode(links("html")).alias("l")).groupBy("page_id").agg(F.count(F.lit(1)).alias("links"))


WITH_TRACKERS = "(select page_id, case page_id % 4 when 0 then concat(html, 'GTM-AB12') when 1 then concat(html, 'fbq(''track'') hotjar.com') when 2 then concat(html, 'analytics.load( UA-12345-1') else html end as html from pages)"


@query("tracker_detect", f"select page_id, {TRACK_SQL} as trackers from {WITH_TRACKERS}")
def _(spark, sf):
    k = F.col("page_id") % 4
    more = F.when(k == 0, "GTM-AB12").when(k == 1, "fbq('track') hotjar.com").when(k == 2, "analytics.load( UA-12345-1").otherwise("")
    p = pages(spark, sf).withColumn("html", F.concat("html", more))
    return p.select("page_id", F.array_join(N.trackers("html"), ", ").alias("trackers"))


@query(
    "image_alt_coverage",
    """select page_id, n as total, (n + 1) // 2 as missing, case when n = 0 then 'No images found' else concat('Poor (', case n when 1 then 0 when 2 then 50 else 33 end, '%)') end as label,
    case when n = 0 then 'No images' when n = 2 then 'Needs improvement' else 'Poor' end as grade from (select page_id, (page_id % 4)::int n from pages)""",
)
def _(spark, sf):
    n = (F.col("page_id") % 4).cast("int")
    tags = F.array(F.lit('<img src="a.jpg">'), F.lit("<IMG class='x' alt='lamp' src=b.jpg>"), F.lit('<img alt=" " src="c.jpg"/>'))
    imgs = F.array_join(F.slice(tags, F.lit(1), n), " ")
    p = pages(spark, sf).withColumn("html", F.concat(F.lit("<body>"), imgs, F.col("html")))
    total, missing = N.image_counts("html")
    return p.select("page_id", total.alias("total"), missing.alias("missing")).withColumns({"label": N.coverage_label("total", "missing"), "grade": N.image_grade("total", "missing")})


@query(
    "seo_score",
    f"""select page_id, title_length, internal, meta, case when m + 2 + l >= 7 then 'Excellent' when m + 2 + l >= 5 then 'Good' when m + 2 + l >= 3 then 'Fair' else 'Poor' end as status,
    case when m + 2 + l >= 7 then 'Digital Marketing & Growth' when m + 2 + l >= 5 then 'Digital Marketing Setup' else 'SEO Optimization Package' end as offer from
    (select page_id, length({TITLE})::int as title_length, coalesce(internal, 0)::int internal, case when length({TITLE}) between 30 and 65 then 'Good' else 'Weak (length issues or missing)' end as meta,
     case when length({TITLE}) between 30 and 65 then 3 else 1 end m, case when coalesce(internal, 0) >= 20 then 3 when coalesce(internal, 0) >= 10 then 2 else 1 end l from pages left join {INTERNAL} on page_id = pid)""",
)
def _(spark, sf):
    described = "<meta property='x'><meta content=\"" + "d" * 100 + '" name="description">'
    p = pages(spark, sf).withColumn("html", F.regexp_replace("html", "(?i)</head>", described + "</head>"))
    m = p.select("page_id", N.title("html").alias("t"), N.meta_description("html").alias("d"), N.internal_link_count("html", "url").alias("internal"))
    m = m.select("page_id", F.length("t").alias("title_length"), "internal", N.meta_quality("t", "d").alias("meta"))
    m = m.withColumn("status", N.overall_status("meta", F.lit("No images"), "internal"))
    return m.withColumn("offer", N.suggestion("status", F.lit(False)))


@query("page_visible_text", f"select page_id, md5(trim(regexp_replace({DECODE.format('regexp_replace(' + CODE + ", '<[^>]+>', ' ', 'g')")}, '{BLANK}+', ' ', 'g'))) as digest from pages")
def _(spark, sf):
    return pages(spark, sf).select("page_id", F.md5(page_text("html").cast("binary")).alias("digest"))


@query("keyword_groups", "select doc_id, doc_id % 3 = 0 as residential, doc_id % 3 = 1 as commercial, doc_id % 5 = 0 as industrial from documents")
def _(spark, sf):
    k = F.col("doc_id")
    extra = F.concat(F.when(k % 3 == 0, " our RESIDENTIAL work ").when(k % 3 == 1, " Comm A/C, ").otherwise(" nonresidentialx "), F.when(k % 5 == 0, "(industrial)").otherwise(""))
    flags = N.keyword_groups(F.concat(F.col("text"), extra))
    return texts(spark, sf, "documents").select("doc_id", *[c.alias(n) for n, c in flags.items()])


CLEAN = f"trim(regexp_replace(regexp_replace(lower(text), '[!-/:-@\\[-`{{-~]', '', 'g'), '{BLANK}+', ' ', 'g'))"


@query("keyword_substrings", f"select doc_id, contains(c, 'cat') as cat, contains(c, 'heating') as heating, contains(c, 'home service') as home, contains(c, 'plumber') as plumbers from (select doc_id, {CLEAN} c from documents)")
def _(spark, sf):
    d = texts(spark, sf, "documents")
    return d.select("doc_id", N.keyword_found("text", "CAT").alias("cat"), N.keyword_found("text", "Heating").alias("heating"), N.keyword_found("text", "Home Services").alias("home"), N.keyword_found("text", "plumbers").alias("plumbers"))


@query("address_candidates", "select page_id, concat_ws(';', concat(page_id, ' Elm Street'), case when page_id % 2 = 0 then concat('Suite ', page_id) end) as spots from pages")
def _(spark, sf):
    k = S("page_id")
    html = F.concat(F.lit("<address>"), k, F.lit(" Elm <b>Street</b></address><p>"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("Suite "), k)).otherwise("nothing here"), F.lit("</p><div>"), F.repeat(F.lit("Avenue "), 40), F.lit("</div>"))
    return pages(spark, sf).select("page_id", F.array_join(N.address_candidates(html, shorter_than=200), ";").alias("spots"))


def element_sql(name, source="pages"):
    """(page_id, place, depth, content) of all elements of a name: depths are sums over tags, partners the next tag of a level."""
    cut = rf"select page_id, string_split(regexp_replace(html, '(?i)(</?{name}[\s/>])', chr(1) || '\1', 'g'), chr(1)) as l from {source}"
    each = f"select page_id, l, unnest(l) as piece, unnest(range(len(l))) as i from ({cut})"
    steps = rf"select *, case when regexp_matches(piece, '^(?i)<{name}[\s/>]') then 1 when regexp_matches(piece, '^(?i)</{name}[\s/>]') then -1 else 0 end as step from ({each})"
    depths = f"select *, sum(step) over (partition by page_id order by i) + case when step < 0 then 1 else 0 end as depth from ({steps})"
    pairs = f"select *, lead(i) over (partition by page_id, depth order by i) as until, row_number() over (partition by page_id order by i) as place from ({depths}) where step <> 0"
    return f"(select page_id, place::int as place, depth::int as depth, regexp_replace(array_to_string(l[i + 1:coalesce(until, len(l))], ''), '^<[^>]*>?', '') as content from ({pairs}) where step = 1)"


def line_sql(source):
    tagless = f"regexp_replace({source}, '<[^>]+>', ' ', 'g')"
    return f"trim(regexp_replace({DECODE.format(tagless)}, '{BLANK}+', ' ', 'g'))"


#: The page, its article in two more containers with an address in nested ones, and one container that is never closed.
WRAPPED = """(select page_id, replace(replace(html, '<article>', '<div class="outer"><div><article>'), '</article>', '</article><div>12 Elm <div>Street</div> Suite 4</div></div></div><div>') as html from pages)"""


def wrapped(spark, sf):
    html = F.replace(F.col("html"), F.lit("<article>"), F.lit('<div class="outer"><div><article>'))
    html = F.replace(html, F.lit("</article>"), F.lit("</article><div>12 Elm <div>Street</div> Suite 4</div></div></div><div>"))
    return pages(spark, sf).select("page_id", html.alias("html"))


@query("nested_elements", f"select page_id, 'div' as name, place, depth, md5(content) as digest from {element_sql('div', WRAPPED)} union all select page_id, 'li', place, depth, md5(content) from {element_sql('li', WRAPPED)}")
def _(spark, sf):
    def of(name):
        each = wrapped(spark, sf).select("page_id", F.explode(elements("html", name)).alias("e"))
        return each.select("page_id", F.lit(name).alias("name"), "e.place", "e.depth", F.md5(F.col("e.content").cast("binary")).alias("digest"))

    return of("div").union(of("li"))


STREET = "(" + " or ".join(f"contains(t, '{w}')" for w in N.STREET_WORDS) + ")"


@query(
    "page_addresses",
    rf"""select page_id, string_agg(distinct t, ' ; ' order by t) as spots from (
    select page_id, {line_sql("content")} as t from (select page_id, content from {element_sql('div', WRAPPED)} union all select page_id, content from {element_sql('span', WRAPPED)}
    union all select page_id, unnest(regexp_extract_all(html, '(?is)<p\b[^>]*>(.*?)</p\s*>', 1)) from {WRAPPED})) where {STREET} and length(t) < 200 group by 1""",
)
def _(spark, sf):
    spots = wrapped(spark, sf).select("page_id", F.explode(N.address_candidates("html", shorter_than=200)).alias("t"))
    return sorted_set(spots, "page_id", "t", "spots", " ; ")


@query("page_bullets", rf"select page_id, string_agg(t, ' | ' order by place) as bullets from (select page_id, place, {line_sql('content')} as t from {element_sql('li')}) where t <> '' and not regexp_matches(t, '^[^:]{{2,40}}:\s*.+$') group by 1")
def _(spark, sf):
    return pages(spark, sf).select("page_id", P.bullet_facts("html")["materials"].alias("bullets")).where("bullets is not null")


SHOWN_TEXT = line_sql(CODE.replace("(html,", "(regexp_replace(html, '(?is)<title[^>]*>.*?</title>', ' ', 'g'),"))


def finder_sql(text):
    hits, columns = [], []
    for i, (keyword, words) in enumerate(N.SITE_KEYWORDS.items()):
        hits.append("(" + " or ".join(f"contains(c, '{w}')" for w in words) + f") as k{i}")
        columns.append(f"case when bool_or(k{i}) then 'Yes' else 'No' end as \"{keyword}\", coalesce(arg_min(url, page_id) filter (k{i}), '') as \"{keyword} Source\"")
    return f"select site, {', '.join(columns)} from (select site, url, page_id, {', '.join(hits)} from (select {HOST} as site, url, page_id, {CLEAN} as c from (select url, page_id, {text} as text from pages))) group by 1"


@query("site_keyword_finder", finder_sql(SHOWN_TEXT))
def _(spark, sf):
    from ..functions.urls import host

    return N.site_keywords(pages(spark, sf).withColumn("site", host("url")), "site", "page_id")


@query(
    "site_keyword_search",
    f"""select site, case when bool_or(c) then 'Yes' else 'No' end as residential_found, coalesce(arg_max(case when c then url end, case when c then page_id end), '') as residential_source from
    (select {HOST} as site, page_id, url, page_id % 3 = 0 as c from pages) group by 1""",
)
def _(spark, sf):
    from ..functions.urls import host

    p = pages(spark, sf).withColumn("site", host("url"))
    p = p.withColumn("html", F.concat(F.col("html"), F.when(F.col("page_id") % 3 == 0, "<p>Residential AC</p>").otherwise("")))
    return N.site_findings(p, "site", "page_id").select("site", "residential_found", "residential_source")


def asked(spark, sf):
    k = F.col("page_id") % 10
    return table(spark, sf, "pages").select("page_id", F.when(k == 0, " ").when(k == 1, F.concat(F.col("url"), F.lit("/gone"))).otherwise(F.col("url")).alias("ask"))


AUDIT = f"""select case page_id % 10 when 0 then ' ' when 1 then concat(url, '/gone') else url end as url, case when page_id % 10 > 1 then 200 end as http_status,
 case when page_id % 10 > 1 then {TITLE} else '' end as meta_title, case when page_id % 10 > 1 then coalesce(internal, 0) else 0 end::int as internal_links_count,
 case when page_id % 10 > 1 then 'No images found' when page_id % 10 = 1 then 'Unreachable' else 'Invalid URL' end as alt_tag_coverage,
 case when page_id % 10 > 1 then {TRACK_SQL} else '' end as trackers_found, case when page_id % 10 > 1 then '' when page_id % 10 = 1 then 'Request failed' else 'Empty or invalid URL' end as notes,
 case when page_id % 10 > 1 then 'No images' else 'N/A' end as image_seo_status from pages left join {INTERNAL} on page_id = pid"""
AUDIT_SHOWN = ["url", "http_status", "meta_title", "internal_links_count", "alt_tag_coverage", "trackers_found", "notes", "image_seo_status"]


def audited(spark, sf):
    from ..functions.urls import host

    return site_audit(asked(spark, sf), pages(spark, sf).withColumn("site", host("url")), "ask", "site", "page_id")


@query("full_page_audit", AUDIT)
def _(spark, sf):
    return audited(spark, sf).select(*AUDIT_SHOWN)


@query(
    "audit_summary",
    f"""select unnest(['Total Websites Audited','Successfully Crawled','Failed to Crawl','Excellent SEO Status','Good SEO Status','Fair SEO Status','Poor SEO Status','Sites with Perfect Alt Tags','Sites Missing Alt Tags','Average Internal Links']) as metric,
    unnest([t, r, t - r, 0, g, r - g, 0, t, 0, m]) as amount from (select count(*)::double t, count(http_status)::double r, sum(case when http_status = 200 and internal_links_count >= 10 then 1 else 0 end)::double g, round_even(avg(internal_links_count), 1)::double m from ({AUDIT}))""",
)
def _(spark, sf):
    from ..operators.report import audit_summary

    return audit_summary(audited(spark, sf))


@query("listing_cards", "select page_id, i as pos, concat('SKU', page_id, '-', i) as sku, case when i = 0 then concat('Lamp ', page_id) else 'Plain name' end as name, concat('https://shop.example/p/', page_id, '/', i) as url, case when i = 0 then 'https://cdn.example/a.jpg' else 'https://cdn.example/b.jpg' end as image, concat(page_id, '.50') as price from pages, (select unnest([0, 1]) i) t")
def _(spark, sf):
    k = S("page_id")
    card0 = F.concat(F.lit('<div class="tile" data-pid="SKU'), k, F.lit('-0" aria-label="Lamp '), k, F.lit('"><a href="/p/'), k, F.lit('/0">x</a><img class="tile-image" src="//cdn.example/a.jpg"><span class="sales"><span class="value" content="'), k, F.lit('.50">$</span></span></div>'))
    card1 = F.concat(F.lit("<div data-pid='SKU"), k, F.lit("-1' aria-label='Compare'><h3 class='product-name big'>Plain <b>name</b></h3><a href='https://shop.example/p/"), k, F.lit("/1'>y</a><img class='tile-image' data-src='https://cdn.example/b.jpg'><span class='value'>"), k, F.lit(".50</span></div>"))
    bad = F.lit('<div data-pid="" aria-label="no sku"><a href="/x">z</a></div>')
    p = pages(spark, sf).select("page_id", F.lit("https://shop.example/list").alias("base"), F.concat(F.col("html"), card0, card1, bad).alias("html"))
    rows = P.listing_cards(p, "base")
    return rows.select("page_id", "pos", *[F.col(f"card_{f}").alias(f) for f in ("sku", "name", "url", "image", "price")])


@query("embedded_product_json", "select page_id, case page_id % 4 when 0 then concat('meta ', page_id) when 1 then concat('ld ', page_id) when 2 then concat('graph ', page_id) end as name, page_id as balanced from pages")
def _(spark, sf):
    k = F.col("page_id") % 4
    s = S("page_id")
    block = (
        F.when(k == 0, F.concat(F.lit('<script>var meta = {"name":"meta '), s, F.lit('"};</script>')))
        .when(k == 1, F.concat(F.lit('<script type="application/ld+json">{"@type":"Product","name":"ld '), s, F.lit('"}</script>')))
        .when(k == 2, F.concat(F.lit('<script type="application/ld+json">{"@graph":[{"@type":"WebPage","name":"w"},{"@type":"Product","name":"graph '), s, F.lit('"}]}</script>')))
        .otherwise('<script type="application/ld+json">{"@type":"WebPage","name":"w"}</script>')
    )
    tail = F.concat(F.lit('<script>window.shop = {"a":{"b":"}{\\"","n":'), s, F.lit("}}; more {</script>"))
    p = pages(spark, sf).select("page_id", F.concat(F.col("html"), block, tail).alias("html"))
    return p.select("page_id", F.get_json_object(P.embedded_product("html"), "$.name").alias("name"), F.get_json_object(P.balanced_json("html", "window.shop"), "$.a.n").cast("bigint").alias("balanced"))


@query("page_source_facts", "select page_id, concat('F', page_id) as family_id, concat('A long enough description ', page_id) as description, concat('W=', page_id, ';H=40') as sizes_cm from pages")
def _(spark, sf):
    s = S("page_id")
    p = pages(spark, sf).select("page_id", F.concat(F.col("html"), F.lit('{"familyId":"F'), s, F.lit('","description":"<b>A long<\\/b> enough description '), s, F.lit('","width_cm": '), s, F.lit(', "hoogte": 40}')).alias("html"))
    facts = P.source_facts("html")
    return p.select("page_id", facts["family_id"].alias("family_id"), F.regexp_replace(facts["description"], " +", " ").alias("description"), facts["sizes_cm"].alias("sizes_cm"))


@query("label_value_rows", "select page_id, i as pos, case i when 0 then 'Width' when 1 then 'Origin' else 'Finish' end as label, case i when 0 then concat(page_id, ' in') when 1 then 'Italy & co' else concat('F', page_id) end as value from pages, (select unnest([0, 1, 2]) i) t")
def _(spark, sf):
    s = S("page_id")
    p = pages(spark, sf).select("page_id", F.concat(F.col("html"), F.lit("<table><tr><th>Width</th><td>"), s, F.lit(" in</td></tr></table><dl><dt>Origin</dt> <dd>Italy &amp; co</dd></dl><div class='col label'>Finish</div><div class='col data'>F"), s, F.lit("</div>")).alias("html"))
    return P.pair_table(p, "page_id")


@query("page_sections", "select page_id, concat('Oak ', page_id) as materials, concat('12 in ', page_id) as size_text, concat('Made of ', page_id) as strong, concat('Care: soft', '') as care, concat('plain ', page_id) as rest from pages")
def _(spark, sf):
    s = S("page_id")
    html = F.concat(F.lit("<h2>Materials</h2><p>Oak <i>"), s, F.lit("</i></p><summary>Size</summary><div>12 in "), s, F.lit("</div><p><strong>Make:</strong> : Made of "), s, F.lit("</p>"))
    bullets = P.bullet_facts(F.concat(F.lit("<ul><li>care notes: x</li><li>Care Notes: soft</li><li>plain "), s, F.lit("</li></ul>")))
    m = P.section_map(html)
    return pages(spark, sf).select(
        "page_id",
        F.try_element_at(m, F.lit("MATERIALS")).alias("materials"),
        F.regexp_extract(F.try_element_at(m, F.lit("SIZE")), r"^(12 in \d+)", 1).alias("size_text"),
        P.strong_value(html, "make").alias("strong"),
        F.concat(F.lit("Care: "), F.try_element_at(bullets["extras"], F.lit("Care Notes"))).alias("care"),
        bullets["materials"].alias("rest"),
    )


@query("bold_label_facts", "select page_id, concat('E', page_id) as base, 'Yes' as dimmable, concat('Nice ', page_id) as description from pages")
def _(spark, sf):
    s = S("page_id")
    b = P.bold_facts(F.concat(F.lit("<p><strong>BASE:</strong> E"), s, F.lit("</p><p>Nice "), s, F.lit("</p><p><strong>dimmable</strong>Yes</p>")))
    return pages(spark, sf).select("page_id", F.try_element_at(b["facts"], F.lit("Base")).alias("base"), F.try_element_at(b["facts"], F.lit("Dimmable")).alias("dimmable"), b["description"].alias("description"))


@query("technical_spec_page", "select page_id, page_id::varchar as weight, concat(page_id, 'W') as wattage, 'Brass' as material, '40' as oah_max, 'E26' as socket, 'sheet.pdf' as download from pages")
def _(spark, sf):
    s = S("page_id")
    html = F.concat(F.lit("<h2>Technical Specs</h2><p>WEIGHT</p><p>"), s, F.lit(" lbs</p><p>WATTAGE</p><p>"), s, F.lit("W max</p><p>MATERIAL</p><p>Brass</p><p>OVERALL HEIGHT</p><p>OAH max: 40</p><p>SOCKET TYPE</p><p>E26</p><h3>Downloads</h3><a href='sheet.pdf'>Spec sheet</a>"))
    t = P.technical_specs(html)
    return pages(spark, sf).select("page_id", *[t[k].alias(k) for k in ("weight", "wattage", "material", "oah_max", "socket")], F.try_element_at(P.download_links(html), F.lit("Spec sheet")).alias("download"))


REACHABLE = """with recursive
 p as (select page_id, rtrim(split_part(url, '#', 1), '/') as u, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as o, html from pages),
 hrefs as (select u, o, unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) as h from p),
 edges as (select u as src, o || rtrim(h, '/') as dst from hrefs where starts_with(h, '/') union select o, u from p),
 reach(site, url, depth) as (
   select distinct o, o, 0 from p
   union select site, dst, depth + 1 from reach join edges on src = url and starts_with(dst, site) where depth < 4)
 select site, url, min(depth) as depth from reach group by 1, 2"""


def site_links(spark, sf):
    """Seeds and edges of the landed pages; a site's root also leads to its pages, by id."""
    p = pages(spark, sf)
    edges = link_table(p)
    seeds = p.select(F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1).alias("url")).distinct()
    home = seeds.select(F.col("url").alias("src"), F.lit(0).alias("pos"))
    inside = p.select(F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1).alias("src"), F.col("page_id").cast("int").alias("pos"), F.rtrim(F.substring_index("url", "#", 1), F.lit("/")).alias("dst"))
    return seeds, edges.unionByName(inside.join(home.select("src"), "src", "left_semi"))


@query("link_reachability", REACHABLE)
def _(spark, sf):
    seeds, edges = site_links(spark, sf)
    return reachable(seeds, edges, max_depth=4).select("site", "url", "depth")


def ranked_levels(depth: int, most: int) -> str:
    """Each level from the ones before it; a row has its rank in its site, by its parent's rank and the link's place."""
    parts = [
        """with p as (select page_id, rtrim(split_part(url, '#', 1), '/') as u, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as o, html from pages),
 found as (select u, o, regexp_extract_all(html, '<a href="([^"]+)"', 1) as hs from p),
 hrefs as (select u, o, unnest(hs) as h, generate_subscripts(hs, 1) - 1 as pos from found),
 edges as (select u as src, pos, o || rtrim(h, '/') as dst from hrefs where starts_with(h, '/') union all select o, page_id, u from p),
 l0 as (select distinct o as site, o as url, 0 as depth, 1::bigint as rank from p)"""
    ]
    for d in range(1, depth + 1):
        known = " union all ".join(f"select * from l{k}" for k in range(d))
        parts.append(f"""known{d} as ({known}),
 step{d} as (select site, dst as url, min((l.rank * 1000000 + pos)) as place from l{d - 1} l join edges on src = url and starts_with(dst, site) group by 1, 2),
 new{d} as (select s.* from step{d} s where not exists (select 1 from known{d} k where k.site = s.site and k.url = s.url)),
 l{d} as (select * from (select n.site, n.url, {d} as depth, (m.top + row_number() over (partition by n.site order by n.place, n.url))::bigint as rank
   from new{d} n join (select site, max(rank) as top from known{d} group by 1) m on n.site = m.site) where rank <= {most})""")
    return ",\n ".join(parts) + " " + " union all ".join(f"select * from l{k}" for k in range(depth + 1))


@query("link_reachability_ranked", ranked_levels(3, 8))
def _(spark, sf):
    seeds, edges = site_links(spark, sf)
    return reachable(seeds, edges, max_pages=8, max_depth=3)


REACH = f"""select p.o as site, count(*) as within_two from (select distinct regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) o from pages) p join
 (select regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) o, rtrim(split_part(url, '#', 1), '/') dst from pages) q on p.o = q.o group by 1"""


@query("link_targets_per_site", REACH)
def _(spark, sf):
    p = pages(spark, sf)
    site = F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1)
    return p.select(site.alias("site"), F.rtrim(F.substring_index("url", "#", 1), F.lit("/")).alias("dst")).groupBy("site").agg(F.count(F.lit(1)).alias("within_two"))
