"""Card layouts, header rules, files written and read again, text rules."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ordered as O
from ..operators import projection as C
from ..session import fresh_dir
from ..sinks import tables as B
from ..sources import cards as K
from ..sources import pages as P
from ..sources import tables as A
from .registry import query, table, texts


def S(c):
    return F.col(c).cast("string")


def filled(template: str, **values):
    """The template with columns in place of {name}."""
    import re

    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.lit(p) if i % 2 == 0 else values[p] for i, p in enumerate(pieces)])


# --- A7: each page's own html with the cards of a listing behind it ----------


def listing(spark, sf, layout, template: str):
    p = texts(spark, sf, "pages")
    shown = F.get(F.split("url", "/"), F.lit(2))
    html = F.concat("html", filled(template, id=S("page_id"), host=shown))
    rows = K.laid_out_cards(p.select("page_id", F.lit("https://shop.example/list/").alias("base"), html.alias("html")), layout, "base")
    return rows.select("page_id", "pos", *[F.col(f"card_{c}").alias(c) for c in ("sku", "name", "url", "image")])


HOST = "split_part(url, '/', 3)"


@query(
    "listing_cards_thumbnails",
    f"""select page_id, i as pos, case when i = 0 then concat('T-', page_id) else concat('H ', page_id) end as sku, case when i = 0 then concat('Chair ', {HOST}) else 'Stool' end as name,
    concat('https://shop.example/', case when i = 0 then 'iteminformation.aspx?id=' else 'shop/ItemInformation.aspx?no=' end, page_id) as url,
    case when i = 0 then concat('https://cdn.example/', page_id, '.jpg') else 'https://shop.example/list/b.jpg' end as image from pages, (select unnest([0, 1]) i) t""",
)
def _(spark, sf):
    template = (
        '<div class="grid ProductThumbnail"><div><a href="/about">no</a></div><a href="/iteminformation.aspx?id={id}"><img class="ProductThumbnailImg big" src="blank.gif" data-src="https://cdn.example/{id}.jpg"></a>'
        '<div class="ProductThumbnailDetails"><h3>H</h3><p class="ProductThumbnailParagraphDescription"><a>Chair <b>{host}</b></a></p><p class="ProductThumbnailParagraphSkuName"><a href="#">T-{id}</a></p></div></div>'
        "<div class='ProductThumbnail'><img src='other.jpg'><img class='ProductThumbnailImg' src='b.jpg'><a href='/shop/ItemInformation.aspx?no={id}'>x</a>"
        "<div class='ProductThumbnailDetails'><p class='ProductThumbnailParagraphDescription'><a>Stool</a></p><p class='ProductThumbnailParagraphSkuName'><a> </a></p><h3>H {id}</h3></div></div>"
        '<div class="ProductThumbnail"><p>no link</p></div><div class="ProductThumbnail-row"><a href="/iteminformation.aspx?id=0">not a card</a></div>'
    )
    return listing(spark, sf, K.THUMBNAILS, template)


@query(
    "listing_cards_styles",
    f"""select page_id, i as pos, case when i = 0 then concat('L', page_id, '-05') else 'Sofas of all kinds' end as sku, case when i = 0 then concat('Bed ', {HOST}, ' Queen Bed (65W)') else 'Sofas of all kinds' end as name,
    concat('https://shop.example/list/p/', page_id) as url, case when i = 0 then 'https://shop.example/a.jpg' else concat('https://shop.example/z/', page_id, '.jpg') end as image
    from pages, (select unnest([0, 1]) i) t""",
)
def _(spark, sf):
    template = (
        '<div class="x style_thumbs_wide"><a class="pageLoc" href="p/{id}"><img src="/a.jpg" data-src="/b.jpg"></a><div class="stylename">Bed {host}</div>'
        '<div class="stylenumber">Collection of the year</div><div class="stylenumber">L{id}-05</div><div><div class="stylenumber">Queen Bed (65W)</div></div></div>'
        '<div class="style_thumbs"><a href="q">other</a><a class="more pageLoc" href=" p/{id} "><img lazyload="/z/{id}.jpg" alt="src="></a><div class="stylename">Sofas of all kinds</div><div class="stylenumber">Sofas of all kinds</div></div>'
        '<div stylename="not used"><a class="pageLoc" href="p/0">only where no card has the class</a></div>'
    )
    return listing(spark, sf, K.STYLES, template)


@query(
    "listing_cards_items",
    f"""select page_id, i as pos, null::varchar as sku, case when i = 0 then concat('Rug ', {HOST}) else 'Runner' end as name, concat('https://shop.example/rugs/', page_id, '/', i) as url,
    case when i = 0 then concat('https://shop.example/i/', page_id, '.jpg') else 'https://cdn.example/main.jpg' end as image from pages, (select unnest([0, 1]) i) t""",
)
def _(spark, sf):
    template = (
        '<ol class="products list items product-items"><li class="item product product-item"><ul><li>inner</li></ul><a class="product-item-link" href="/rugs/{id}/0">short</a>'
        '<strong class="product name product-item-name"><a class="product-item-link" href="/rugs/{id}/0">Rug {host}</a></strong><img class="product-image-photo" src="/i/{id}.jpg"></li>'
        "<li class='item product product-item'><a class='product-item-link mainImage' href='/rugs/{id}/1'>Runner <img data-src='https://cdn.example/main.jpg'></a></li>"
        '<li class="product-item-note"><a class="product-item-link" href="/no">no card</a></li></ol>'
    )
    return listing(spark, sf, K.ITEMS, template)


@query("landed_pages", "select page_id, url, length(html) as chars from pages")
def _(spark, sf):
    return P.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.length("html").cast("bigint").alias("chars"))


# --- B1, B8, B10, B12: written, then read again -------------------------------


@query("flat_csv_round_trip", """select s_suppkey::varchar as "Key", concat(s_name, chr(10), '"', s_nationkey, '",') as "Note", case when s_suppkey % 4 <> 0 then s_name end as "Name" from supplier""")
def _(spark, sf):
    """The null rule of the ingest: blanks around a cell go, "nan" is NULL."""
    s = table(spark, sf, "supplier")
    note = F.concat("s_name", F.lit('\n"'), S("s_nationkey"), F.lit('", '))
    name = F.when(F.col("s_suppkey") % 4 == 0, " nan ").otherwise(F.col("s_name"))
    rows = s.select(S("s_suppkey").alias("Key"), note.alias("Note"), name.alias("Name"))
    path = fresh_dir(spark, "flat")
    B.write_flat(rows.limit(5), path, "csv")
    B.write_flat(rows, path, "csv")
    return A.read_flat(spark, path, "csv")


@query(
    "report_detail_summary",
    """with d as (select p_partkey, case when k is null then 'failed' else 'success' end as status, flags from part left join
    (select l_partkey as k, max(l_returnflag) as flags from lineitem where l_quantity > 49 group by 1) on p_partkey = k)
    select d.p_partkey, d.status, d.flags, n.rows from d join (select status, count(*) as rows from d group by 1) n on d.status = n.status""",
)
def _(spark, sf):
    from ..operators.report import status_report

    listed = table(spark, sf, "part").select("p_partkey")
    found = table(spark, sf, "lineitem").filter("l_quantity > 49").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_returnflag").alias("flags"))
    path = fresh_dir(spark, "report")
    rows = B.with_status(listed, found, "p_partkey")
    B.write_report(rows, status_report(rows), path)
    detail, summary = (spark.read.parquet(f"{path}/{t}") for t in ("detail", "summary"))
    return detail.join(summary, "status").select("p_partkey", "status", "flags", "rows")


@query("master_and_categories", "select p_partkey, p_type, p_name, row_number() over (partition by p_type order by p_partkey) as idx from part")
def _(spark, sf):
    path = fresh_dir(spark, "master")
    B.write_master_and_categories(table(spark, sf, "part").select("p_partkey", "p_type", "p_name"), path, "p_type", "p_partkey")
    master = spark.read.parquet(f"{path}/master").select("p_partkey", "p_name")
    each = spark.read.parquet(f"{path}/by_category").select("p_partkey", S("p_type").alias("p_type"), F.col("Index").alias("idx"))
    return master.join(each, "p_partkey").select("p_partkey", "p_type", "p_name", "idx")


# --- C7, C8, C12, C14, I2 -----------------------------------------------------


@query("headers_by_position", """select s_name as "Product Name", concat('https://x.example/', s_suppkey) as "Product URL", 'u' as "Other Url", s_acctbal as "Price" from supplier""")
def _(spark, sf):
    s = table(spark, sf, "supplier").select(F.lit(0).alias("Unnamed: 0"), F.col("s_name").alias("Item"), F.concat(F.lit("https://x.example/"), S("s_suppkey")).alias("Shop URL"), F.lit("u").alias("Other Url"), F.col("s_acctbal").alias("x"))
    body = C.drop_first_column(s)
    body = body.withColumnRenamed(C.url_column(body), "Product URL")
    return C.positional_names(body, {0: "Product Name", 3: "Price"})


@query(
    "grouped_dynamic_columns",
    """select l_orderkey, max(case when l_returnflag = 'A' then 'A' end) as "A", max(case when l_returnflag = 'N' then 'N' end) as "N", max(case when l_returnflag = 'R' then 'R' end) as "R",
    max(case when l_linestatus = 'F' then 'box' end) as "pkg F", max(case when l_linestatus = 'O' then 'box' end) as "pkg O", 'l_orderkey,A,N,R,pkg F,pkg O' as shown from lineitem group by 1""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    long = items.select("l_orderkey", "l_linenumber", F.explode(F.create_map(F.col("l_returnflag"), F.col("l_returnflag"), F.concat(F.lit("pkg "), "l_linestatus"), F.lit("box"))).alias("key", "value"))
    # As many keys as columns of the result.
    keys = [r["key"] for r in long.select("key").distinct().collect()]
    columns = C.grouped_columns(["l_orderkey"], [k for k in keys if not k.startswith("pkg")], [k for k in keys if k.startswith("pkg")], keys)
    wide = C.widen(long, "l_orderkey", "key", "value", columns[1:], "l_linenumber").select(*[C.q(c) for c in columns])
    return wide.withColumn("shown", F.lit(",".join(wide.columns)))


@query(
    "category_serial_order",
    "select n_name, s_suppkey, row_number() over (order by case n_name when 'NATION_7' then 0 when 'NATION_2' then 1 else 99 end, s_suppkey) as serial from supplier join nation on s_nationkey = n_nationkey",
)
def _(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "s_suppkey")
    dim = A.category_dim(spark, {"NATION_7": {}, "NATION_2": {}, "not there": {}})
    return O.sort_by_category(s, dim, "n_name", "s_suppkey", serial="serial")


# --- D16, D17, K2, K78 ----------------------------------------------------------


@query(
    "paragraph_rules",
    """select p_partkey, case when p_size % 2 = 0 then p_name else p_type end as first_paragraph, concat(p_name, ' made of ', p_brand) as lines, case when p_size % 3 = 0 then null else p_type end as only_measures,
    concat('a ', p_name, chr(10), p_brand, chr(10), 'c') as squeezed, concat(lower(p_brand), ' seat height') as label from part""",
)
def _(spark, sf):
    p = texts(spark, sf, "part")
    even = F.col("p_size") % 2 == 0
    paragraphs = F.array(F.lit("Overall: 3 in"), F.concat(F.lit("FINISHED in "), "p_brand"), F.when(even, F.col("p_name")).otherwise("Dimensions"), F.col("p_type"))
    html = filled("<p>{name}</p><p>Weight: {size}</p>made&nbsp;of <b>{brand}</b><BR/>Seat HEIGHT {size}<br>", name=F.col("p_name"), size=S("p_size"), brand=F.col("p_brand"))
    measures = F.concat(F.lit("Width 3<br>"), F.when(F.col("p_size") % 3 == 0, "Depth").otherwise(F.col("p_type")), F.lit("</p>diameter"))
    lines = filled("\r\n  a \t {name} \r\n\n  \r{brand}\n c\n\n", name=F.col("p_name"), brand=F.col("p_brand"))
    label = filled("  {brand}:\tSeat  Height: ", brand=F.col("p_brand"))
    return p.select("p_partkey", T.first_paragraph(paragraphs).alias("first_paragraph"), T.description_lines(html).alias("lines"), T.description_lines(measures).alias("only_measures"), T.squeeze_keep_lines(lines).alias("squeezed"), T.clean_label(label).alias("label"))
