"""End-to-end flows, sources, sinks and streams."""

from pyspark.sql import functions as F

from ..functions.numbers import fraction_value
from ..operators.projection import q
from ..plans.catalog import collection_flow, standard_catalogue, two_stage
from ..session import fresh_dir
from ..sinks import tables as B
from ..sources import tables as A
from ..spec.packs import extract_by_vendor
from ..streaming import incremental as M
from .copies import ORDER, ORDER_SQL
from .measures import FORMS, text_column, value
from .registry import query, table, texts


def S(c):
    return F.col(c).cast("string")


# --- the flagship: spec text to the standard table ------------------------


def product_listing(spark, sf):
    """Each part as listed twice; the second copy carries other text and must lose."""
    p = texts(spark, sf, "part").select("p_partkey", "p_size", "p_name", "p_type", "p_brand")
    spec = F.when(F.col("p_partkey") % 2 == 0, text_column(FORMS["EI"][0][0])).otherwise(text_column(FORMS["EI"][1][0]))
    base = p.select(
        (F.col("p_partkey") * 2).alias("ord"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Manufacturer"),
        F.concat(F.lit("https://shop.example/p/"), S("p_partkey")).alias("Product URL"),
        F.concat("p_name", F.lit(" - "), F.col("p_type")).alias("Product Name"),
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("SKU"), S("p_partkey"))).otherwise(" ").alias("SKU"),
        spec.alias("Specifications"),
    )
    return base.unionByName(base.withColumns({"ord": F.col("ord") + 1, "Specifications": F.lit("W. 1″")}))


EI_EVEN, EI_ODD = FORMS["EI"][0][1], FORMS["EI"][1][1]


def ei(field: str) -> str:
    sides = [value(says[field]) if field in says else "null" for says in (EI_EVEN, EI_ODD)]
    return f"cast(case when p_partkey % 2 = 0 then {sides[0]} else {sides[1]} end as double)"


CATALOG_SQL = f"""select p_type as "Category", row_number() over (partition by p_type order by p_partkey) as "Index", p_brand as "Manufacturer",
 concat('https://shop.example/p/', p_partkey) as "Source", concat(p_name, ' - ', p_type) as "Product Name", p_name as "Product Family Id",
 {ei('width')} as "Width", {ei('depth')} as "Depth", {ei('height')} as "Height", {ei('diameter')} as "Diameter", {ei('seat_height')} as "Seat Height", p_partkey from part"""


@query(
    "catalog_standard_table",
    f"""select * exclude (p_partkey), case when p_partkey % 3 = 0 then concat('SKU', p_partkey) else concat('BRA', substr("Category", 1, 2), case when "Index" < 1000 then lpad("Index"::varchar, 3, '0') else "Index"::varchar end) end as "SKU" from ({CATALOG_SQL})""",
)
def _(spark, sf):
    c = standard_catalogue(product_listing(spark, sf), "EI")
    numeric = ("Width", "Depth", "Height", "Diameter", "Seat Height")
    return c.select("Category", "Index", "Manufacturer", "Source", q("Product Name"), q("Product Family Id"), *[fraction_value(q(n)).alias(n) for n in numeric], "SKU")


@query(
    "two_stage_enrichment",
    f"""select l_returnflag, l_partkey, case when p_size % 2 = 0 then p_name else 'listed' end as name from
    (select * from (select *, row_number() over (partition by l_returnflag, l_partkey order by {ORDER_SQL}) rn from lineitem) where rn = 1) join part on l_partkey = p_partkey where p_size % 7 <> 0""",
)
def _(spark, sf):
    listing = table(spark, sf, "lineitem").select("l_returnflag", "l_partkey", *[c for c in ORDER if c != "l_partkey"], S("l_partkey").alias("url"), F.lit("listed").alias("name"))
    part = table(spark, sf, "part")
    done = part.filter("p_size % 7 = 0").select(S("p_partkey").alias("url"))
    detail = part.select(S("p_partkey").alias("url"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise("").alias("name"))
    return two_stage(listing, done, detail, "url", "l_returnflag", ORDER, ["name"]).select("l_returnflag", "l_partkey", "name")


CONFIG = {
    "N": {"links": ["n1", "n2"], "scope": "global"},
    "A": {"links": ["a1"], "scope": "global", "type_filter": "ring"},
    "R": {"links": ["r1"], "scope": "local"},
}
COLLECT = "select l_returnflag as category, case l_returnflag when 'N' then 0 when 'A' then 1 else 2 end co, l_partkey, p_name, row_number() over (partition by l_returnflag, l_partkey order by {o}) rn, {o} from lineitem join part on l_partkey = p_partkey where l_returnflag <> 'A' or contains(p_name, 'ring')".replace("{o}", ORDER_SQL)


@query(
    "collection_flow",
    f"""select category, l_partkey from (select *, row_number() over (partition by l_partkey order by co, {ORDER_SQL}) g from ({COLLECT}) where rn = 1 and category <> 'R') where g = 1
    union all select category, l_partkey from ({COLLECT}) where rn = 1 and category = 'R'""",
)
def _(spark, sf):
    li = texts(spark, sf, "lineitem").join(table(spark, sf, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    rows = li.select(F.col("l_returnflag").alias("category"), "l_partkey", S("l_partkey").alias("handle"), F.lit(" ").alias("sku"), F.col("p_name").alias("product_type"), F.struct(*ORDER).alias("ord"))
    return collection_flow(rows, A.category_dim(spark, CONFIG)).select("category", "l_partkey")


@query("dims_by_vendor", f"select p_partkey, {value('w')} as width, {value('h')} as height from part where p_size % 7 <> 0 union all select p_partkey, null, null from part where p_size % 7 = 0")
def _(spark, sf):
    p = table(spark, sf, "part")
    code = F.when(F.col("p_size") % 14 == 0, "?").when(F.col("p_size") % 7 == 0, F.lit(None)).when(F.col("p_size") % 2 == 0, "EI").otherwise("ZUO")
    spec = F.when(F.col("p_size") % 2 == 0, text_column(FORMS["EI"][0][0])).otherwise(text_column(FORMS["ZUO"][0][0]))
    df = p.select("p_partkey", code.alias("pack"), spec.alias("spec"))
    d = extract_by_vendor(df, "spec", "pack", ["EI", "ZUO"])
    return d.select("p_partkey", fraction_value("dims.width").alias("width"), fraction_value("dims.height").alias("height"))


# --- sources --------------------------------------------------------------


def collection_json(spark, sf):
    """Each part as one collection page with two products."""
    k, s = S("p_partkey"), F.col("p_size")

    def product(i: int):
        vid = F.col("p_partkey") * 10 + i
        variant = lambda n: F.struct((vid + n).alias("id"), F.concat(F.lit("V"), k, F.lit(f"-{i}{n}")).alias("sku"), F.when(F.lit(n == 1), F.lit(None)).otherwise((s + n).cast("string")).alias("price"), F.lit("Oak" if n % 2 else "Ash").alias("option1"), F.when(F.lit(n == 0), F.lit("")).otherwise(F.col("p_type")).alias("option2"), F.lit(None).cast("string").alias("option3"))
        return F.struct(
            F.concat(F.lit("h"), k, F.lit(f"-{i}")).alias("handle"),
            F.col("p_name").alias("title"),
            F.concat(F.lit("<p>Nice "), F.col("p_name"), F.lit("</p>")).alias("body_html"),
            F.col("p_type").alias("product_type"),
            F.array(F.lit("a"), F.col("p_brand")).alias("tags"),
            F.array(F.struct(F.lit("first.jpg").alias("src"), F.array().cast("array<bigint>").alias("variant_ids")), F.struct(F.lit("second.jpg").alias("src"), F.array(vid + 1).alias("variant_ids"))).alias("images"),
            F.array(F.struct(F.lit("Finish").alias("name"))).alias("options"),
            F.array(variant(0), variant(1), variant(2)).alias("variants"),
        )

    return texts(spark, sf, "part").select("p_partkey", F.to_json(F.struct(F.array(product(0), product(1)).alias("products"))).alias("body"))


@query(
    "collection_products",
    """select p_partkey, i as pos, concat('https://shop.example/products/h', p_partkey, '-', i) as source, p_name as product_name, concat('V', p_partkey, '-', i, '0') as sku, concat(p_size, '.00') as price, 'first.jpg' as image_url, concat('Nice ', p_name) as description, 'Ash, Oak' as finish, concat('a, ', p_brand) as tags
    from part, (select unnest([0, 1]) i) t""",
)
def _(spark, sf):
    rows = A.product_columns(A.collection_products(collection_json(spark, sf), "body"), "https://shop.example")
    return rows.drop("handle", "product_type")


@query(
    "collection_variants",
    """select p_partkey, i as pos, n as variant_pos, concat('V', p_partkey, '-', i, n) as sku, case when n = 1 then p_size else p_size + n end::varchar as price, case n when 0 then 'Ash' when 1 then concat('Oak / ', p_type) else concat('Ash / ', p_type) end as variant_label,
    case when n = 1 then 'second.jpg' else 'first.jpg' end as image_url from part, (select unnest([0, 1]) i) t, (select unnest([0, 1, 2]) n) u""",
)
def _(spark, sf):
    return A.variant_rows(A.collection_products(collection_json(spark, sf), "body")).drop("handle")


@query("category_links", "select c as category, i as link_pos, concat(lower(c), i + 1) as link from (select distinct l_returnflag c from lineitem), (select unnest([0, 1]) i) t where c = 'N' or i = 0")
def _(spark, sf):
    links = A.category_links(A.category_dim(spark, CONFIG))
    seen = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("category")).distinct()
    return links.join(seen, "category").select("category", "link_pos", "link")


@query("banner_sheets", "select s_suppkey, n_name as sheet_name, s_name as name from supplier join nation on s_nationkey = n_nationkey where s_suppkey % 5 <> 0")
def _(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    url = F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("https://x.example/"), S("s_suppkey"))).otherwise("n/a")
    rows = s.select(F.col("n_name").alias("sheet"), (F.col("s_suppkey") + 5).alias("line_no"), F.concat_ws(",", S("s_suppkey"), url, F.concat(F.lit('"'), F.col("s_name"), F.lit('"'))).alias("line"))
    heads = table(spark, sf, "nation").select(F.col("n_name").alias("sheet"), F.posexplode(F.array(F.lit("Brand,Acme"), F.lit("Link,https://x.example"), F.lit(""), F.lit("Index,Product URL,Product Name"), F.lit(",,")))).select("sheet", (F.col("pos") + 1).cast("bigint").alias("line_no"), F.col("col").alias("line"))
    lines = rows.unionByName(heads.filter("line_no < 5"))
    data = A.banner_rows(lines, 4, ["Index", "Product URL", "Product Name"])
    meta = A.banner_meta(lines).filter(F.col("brand") == "Acme")
    return data.join(meta, F.col("Category") == F.col("sheet")).select(F.col("Index").cast("bigint").alias("s_suppkey"), F.col("Category").alias("sheet_name"), q("Product Name").alias("name"))


NOTE_SQL = "concat(o_custkey, chr(10), 'said \"', o_orderstatus, '\", ', chr(10), chr(10), o_orderkey)"


@query("sheet_files", f"select o_orderpriority as sheet, o_orderkey, {NOTE_SQL} as note, case when o_orderkey % 3 = 0 then null else 'c' || o_custkey end as clerk from orders")
def _(spark, sf):
    """Every order through CSV sheets, one folder a priority, whose cells hold line breaks, quotes and commas."""
    o = table(spark, sf, "orders")
    note = F.concat(S("o_custkey"), F.lit('\nsaid "'), "o_orderstatus", F.lit('", \n\n'), S("o_orderkey"))
    sheets = o.select("o_orderpriority", S("o_orderkey").alias("Order Key"), note.alias("Note"), F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("c"), S("o_custkey"))).alias("Clerk"))
    path = fresh_dir(spark, "sheets")
    sheets.write.partitionBy("o_orderpriority").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    back = A.read_sheets(spark, path, ["Clerk", "Order Key", "Note"], key="o_orderpriority")
    return back.select(F.col("Category").alias("sheet"), q("Order Key").cast("bigint").alias("o_orderkey"), F.col("Note").alias("note"), F.nullif("Clerk", F.lit("")).alias("clerk"))


@query(
    "banner_sheet_files",
    """select n_name as sheet, s_suppkey, s_name || chr(10) || n_name as name, 'Acme' as brand,
    'https://x.example/' || n_nationkey || chr(10) || 'https://y.example/' || n_nationkey as link, 4 + row_number() over (partition by n_name order by s_suppkey) as line_no
    from supplier join nation on s_nationkey = n_nationkey""",
)
def _(spark, sf):
    """One file a nation with brand and links above the header; links and names go over two lines."""
    n = table(spark, sf, "nation")
    key = S("n_nationkey")
    links = F.concat(F.lit('Link,"https://x.example/'), key, F.lit("\nhttps://y.example/"), key, F.lit('"'))
    top = n.select("n_name", F.posexplode(F.array(F.lit("Brand,Acme"), links, F.lit(""), F.lit("Index,Product URL,Product Name"))).alias("ord", "line"))
    s = table(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    row = F.concat(S("s_suppkey"), F.lit(",https://x.example/p/"), S("s_suppkey"), F.lit(',"'), "s_name", F.lit("\n"), "n_name", F.lit('"'))
    body = s.select("n_name", (F.col("s_suppkey") + 4).alias("ord"), row.alias("line"))
    path = fresh_dir(spark, "banners")
    top.unionByName(body).repartition("n_name").sortWithinPartitions("n_name", "ord").select("n_name", "line").write.partitionBy("n_name").text(path)
    lines = A.number_lines(spark, path, "n_name")
    data = A.banner_rows(lines, 4, ["Index", "Product URL", "Product Name"])
    return data.join(A.banner_meta(lines), F.col("Category") == F.col("sheet")).select("sheet", F.col("Index").cast("bigint").alias("s_suppkey"), q("Product Name").alias("name"), "brand", "link", "line_no")


# --- sinks ----------------------------------------------------------------


@query("write_by_category", "select p_type, p_partkey, row_number() over (partition by p_type order by p_partkey) as idx from part")
def _(spark, sf):
    path = fresh_dir(spark, "by-category")
    B.write_by_category(table(spark, sf, "part").select("p_type", "p_partkey"), path, "p_type", "p_partkey")
    return spark.read.parquet(path).select(S("p_type").alias("p_type"), "p_partkey", F.col("Index").alias("idx"))


FIRST_PER_USER = "select event_type, user_id, event_id from (select *, row_number() over (partition by event_type, user_id order by {o}) rn from events) where rn = 1"


@query("upsert_by_category", FIRST_PER_USER.format(o="case when event_id % 3 = 0 then 0 else 1 end, event_id"))
def _(spark, sf):
    path = fresh_dir(spark, "upsert")
    e = table(spark, sf, "events").select("event_type", "user_id", "event_id", F.concat_ws("/", "event_type", S("user_id")).alias("key"))
    old, new = e.filter("event_id % 3 = 0"), e.filter("event_id % 3 <> 0")
    for batch in (old, new, new):
        B.upsert_by_category(batch, path, "event_type", "key", "event_id")
    return spark.read.parquet(path).select(S("event_type").alias("event_type"), "user_id", "event_id")


@query("batch_files", "select count(*) as rows, sum(o_orderkey)::bigint as keys from orders")
def _(spark, sf):
    path = fresh_dir(spark, "batches")
    B.write_batches(table(spark, sf, "orders").select("o_orderkey"), path, 5000)
    return A.read_batches(spark, path, "*.parquet").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))


# --- streams --------------------------------------------------------------


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return M.landing_stream(spark, sf, schema, "events.parquet")


@query("stream_first_sightings", "select distinct user_id from events")
def _(spark, sf):
    out = fresh_dir(spark, "stream")
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    middle = e.agg(F.avg("user_id")).collect()[0][0]
    # Two landings; what lands second is older by its name only, and has keys that the first has not.
    e.filter(F.col("user_id") > middle).write.parquet(f"{out}/in/a")
    s = M.landing_stream(spark, f"{out}/in/*", e.schema)
    M.sightings_stream(s, f"{out}/rows", f"{out}/state", "user_id", ["ts", "event_id"]).awaitTermination()
    e.withColumn("ts", F.expr("ts - interval 900 days")).write.parquet(f"{out}/in/b")
    # The second run starts anew: it reads both landings and adds only what the table does not have.
    M.sightings_stream(s, f"{out}/rows", f"{out}/state2", "user_id", ["ts", "event_id"]).awaitTermination()
    return spark.read.schema(e.schema).parquet(f"{out}/rows").select("user_id")


@query("stream_upsert", FIRST_PER_USER.format(o="event_id"))
def _(spark, sf):
    out = fresh_dir(spark, "stream")
    s = event_stream(spark, sf).select("event_type", "user_id", "event_id", F.concat_ws("/", "event_type", S("user_id")).alias("key"))
    M.upsert_stream(s, f"{out}/rows", f"{out}/state", "event_type", "key", "event_id").awaitTermination()
    return spark.read.parquet(f"{out}/rows").select(S("event_type").alias("event_type"), "user_id", "event_id")


@query("stream_discovered_urls", "select distinct lower(event_type) as url from events")
def _(spark, sf):
    out = fresh_dir(spark, "stream")
    seeds = event_stream(spark, sf).select(F.upper("event_type").alias("url"))
    found = event_stream(spark, sf).select(F.col("event_type").alias("url"))
    M.append_stream(M.discovered_urls(seeds, found, "url"), f"{out}/rows", f"{out}/state").awaitTermination()
    return spark.read.schema("url string").parquet(f"{out}/rows")


@query("stream_discovered_table", "select distinct lower(event_type) || '/' || user_id as url from events union select distinct 'seed/' || lower(event_type) from events")
def _(spark, sf):
    """Two runs with checkpoints of their own over one table; the second sees all of it again in another case."""
    out = fresh_dir(spark, "stream")
    e = event_stream(spark, sf).withColumn("url", F.concat_ws("/", "event_type", S("user_id")))
    seeds = e.select(F.concat(F.lit("Seed/"), "event_type").alias("url"))
    for run, found in enumerate((e.filter("event_id % 3 > 0").select("url"), e.select(F.upper("url").alias("url")))):
        M.discovered_stream(seeds, found, "url", f"{out}/rows", f"{out}/state{run}").awaitTermination()
    return spark.read.schema("url string").parquet(f"{out}/rows")


RETRY = "select user_id, count(*) as attempts from events group by 1 having max(case when event_type = 'purchase' and value > 95 then 1 else 0 end) = 0 and count(*) < 80"


@query("retry_round", RETRY)
def _(spark, sf):
    e = table(spark, sf, "events").select("user_id", ((F.col("event_type") == "purchase") & (F.col("value") > 95)).alias("ok"))
    return M.retry_round(M.attempt_counts(e, "user_id", "ok"), 80).select("user_id", "attempts")


@query("enrich_only_new", "select p_partkey, case when p_partkey % 4 = 0 then 'old' else p_name end as note from part")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    done = p.filter("p_partkey % 4 = 0").select("p_partkey", F.lit("old").alias("note"))
    return M.enrich_new(p, done, "p_partkey", "p_partkey", lambda df: df.select("p_partkey", F.col("p_name").alias("note")))
