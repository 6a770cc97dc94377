"""Joins, lookups and precedence on the driver tables."""

from pyspark.sql import functions as F

from ..operators import filters as P
from ..operators import joins as J
from .registry import query, table, texts


def S(c):
    return F.col(c).cast("string")


@query(
    "merge_results_trimmed",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_name, p_retailprice
    from lineitem left join (select p_partkey, p_name, p_retailprice from part where p_partkey % 5 <> 0) on l_partkey = p_partkey""",
)
def _(spark, sf):
    main = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.concat(F.lit(" /p/"), S("l_partkey")).alias("link"))
    part = table(spark, sf, "part").filter(F.col("p_partkey") % 5 != 0).select(F.concat(F.lit("/p/"), S("p_partkey"), F.lit(" ")).alias("url"), "p_name", "p_retailprice", F.lit(1).alias("ord"))
    twice = part.unionByName(part.select(F.trim("url").alias("url"), F.lit("late copy").alias("p_name"), "p_retailprice", F.lit(2).alias("ord")))
    return J.merge_results(main, twice, "link", "url", "ord").drop("link", "ord")


@query(
    "merge_results_salted",
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_name from lineitem left join part on l_partkey = p_partkey",
)
def _(spark, sf):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    main = table(spark, sf, "lineitem").select(*cols, S("l_partkey").alias("link"))
    part = texts(spark, sf, "part").select(S("p_partkey").alias("url"), "p_name", F.lit(1).alias("ord"))
    return J.merge_results(main, part, "link", "url", "ord", salts=4, spread=cols).drop("link", "ord")


@query(
    "master_left_join",
    """select concat('/p/', cast(p_partkey as varchar)) as "Product URL", p_name as "Product Name", concat('img', cast(p_partkey as varchar)) as "Image URL",
       d.flag as "Finish", cast(null as varchar) as "Socket"
    from part left join (select l_partkey, min(l_returnflag) flag from lineitem group by 1) d on l_partkey = p_partkey""",
)
def _(spark, sf):
    listing = table(spark, sf, "part").select(F.concat(F.lit("/p/"), S("p_partkey")).alias("Product URL"), F.col("p_name").alias("Product Name"), F.concat(F.lit("img"), S("p_partkey")).alias("Image URL"))
    detail = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.min("l_returnflag").alias("Finish"))
    detail = detail.select(F.concat(F.lit("/p/"), S("l_partkey")).alias("Product URL"), "Finish", F.lit("other.png").alias("Image URL"))
    return J.master_assembly(listing, detail, "Product URL", ["Product URL", "Product Name", "Image URL", "Finish", "Socket"])


@query(
    "progress_restore",
    """select o_orderkey, case when o_orderkey % 4 = 0 then case when o_orderkey % 3 = 0 then o_orderpriority end
       when o_orderkey % 4 = 1 then case when o_orderkey % 3 = 0 then o_orderpriority end else o_orderstatus end as note from orders""",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    now = o.select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, "").when(F.col("o_orderkey") % 4 == 1, "nan").otherwise(F.col("o_orderstatus")).alias("note"))
    old = o.filter(F.col("o_orderkey") % 3 == 0).select("o_orderkey", F.col("o_orderpriority").alias("note"))
    return J.restore_progress(now, old, "o_orderkey", ["note"])


@query("todo_anti", "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders)")
def _(spark, sf):
    return J.pending(table(spark, sf, "customer").select("c_custkey", "c_name"), table(spark, sf, "orders"), "c_custkey", "o_custkey")


@query("resume_unmarked", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def _(spark, sf):
    done = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("first_keyword"))
    return J.resume_unmarked(table(spark, sf, "customer").select("c_custkey"), done, "c_custkey", "first_keyword")


@query("join_on_schemed_url", "select page_id, length(url) as url_chars from pages")
def _(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    asked = p.select("page_id", F.when(F.col("url").startswith("http://"), F.substring("url", F.lit(8), F.length("url"))).otherwise(F.col("url")).alias("ask"))
    result = p.select(F.col("url").alias("result_url"), F.length("url").cast("bigint").alias("url_chars"))
    return J.join_on_url(asked, result, "ask", "result_url").select("page_id", "url_chars")


@query(
    "enrich_listing",
    """select p_partkey, case when f is null then p_type else f end as finish, case when f is null then 'size=' || p_size else 'flag=' || f || ';size=' || p_size end as extras
    from part left join (select l_partkey, max(l_returnflag) f from lineitem group by 1) on l_partkey = p_partkey""",
)
def _(spark, sf):
    listing = table(spark, sf, "part").select(S("p_partkey").alias("url"), "p_partkey", F.col("p_type").alias("finish"), F.create_map(F.lit("size"), S("p_size"), F.lit("flag"), F.lit("old")).alias("extras"))
    listing = listing.withColumn("extras", F.map_filter("extras", lambda k, v: k == "size"))
    detail = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max("l_returnflag").alias("finish"))
    detail = detail.select(S("l_partkey").alias("url"), "finish", F.create_map(F.lit("flag"), F.col("finish")).alias("extras"))
    rich = J.enrich(listing, detail, "url", ["finish"], "extras")
    shown = F.array_join(F.array_sort(F.transform(F.map_entries("extras"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return rich.select("p_partkey", "finish", shown.alias("extras"))


@query(
    "field_precedence",
    "select o_orderkey, coalesce(case when o_orderkey % 2 = 0 then o_orderstatus end, case when o_orderkey % 3 = 0 then o_orderpriority end, 'none given') as chosen from orders",
)
def _(spark, sf):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey", F.when(k % 2 == 0, F.col("o_orderstatus")).otherwise("  ").alias("a"), F.when(k % 3 == 0, F.col("o_orderpriority")).otherwise("NaN").alias("b"))
    return o.select("o_orderkey", J.precedence("a", "b", F.lit("none given")).alias("chosen"))


@query(
    "lookup_list_join",
    """with ids as (select c_custkey, unnest([c_nationkey, 99, c_nationkey % 3]) as id, unnest([0, 1, 2]) as pos from customer)
    select c_custkey, string_agg(n_name, ' | ' order by pos) as names from ids join nation on id = n_nationkey group by c_custkey""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.concat_ws(",", S("c_nationkey"), F.lit(" 99"), (F.col("c_nationkey") % 3).cast("string")).alias("ids"))
    return J.resolve_list(c, "ids", table(spark, sf, "nation"), "n_nationkey", "n_name", "c_custkey", "names").select("c_custkey", "names")


FINISHES = {"1": "Brass", "3": "Bronze", "5": "Nickel"}


@query(
    "lookup_list_fixed_map",
    "select p_partkey, concat_ws(' | ', case p_size % 6 when 1 then 'Brass' when 3 then 'Bronze' when 5 then 'Nickel' end, case p_partkey % 6 when 1 then 'Brass' when 3 then 'Bronze' when 5 then 'Nickel' end) as finish from part",
)
def _(spark, sf):
    ids = F.concat_ws(", ", (F.col("p_size") % 6).cast("string"), F.lit("9"), (F.col("p_partkey") % 6).cast("string"))
    return table(spark, sf, "part").select("p_partkey", J.resolve_list_literal(ids, FINISHES).alias("finish"))


@query("zip_or_default", "select p_partkey, case when p_partkey % 2 = 0 then p_type else 'default' end as finish from part")
def _(spark, sf):
    keys = F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("1"), F.lit("2"))).otherwise(F.array(F.lit("1"), F.lit("2"), F.lit("3")))
    m = J.zip_or_default(keys, F.array("p_type", "p_brand"), F.create_map(F.lit("1"), F.lit("default")))
    return table(spark, sf, "part").select("p_partkey", F.try_element_at(m, F.lit("1")).alias("finish"))


@query(
    "fill_from_lookup",
    "select p_partkey, coalesce(q, p_type) as finish from part left join (select l_partkey, max(l_returnflag) q from lineitem where l_returnflag <> 'N' group by 1) on l_partkey = p_partkey",
)
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", S("p_partkey").alias("sku"), F.col("p_type").alias("finish"))
    meta = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max(F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))).alias("finish"))
    return J.fill_from_lookup(part, meta.select(S("l_partkey").alias("sku"), "finish"), "sku", ["finish"]).select("p_partkey", "finish")


@query(
    "company_people_outer",
    "select c_custkey, c_name, o_orderkey, o_orderstatus from customer left join orders on o_custkey = c_custkey",
)
def _(spark, sf):
    people = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return J.one_to_many(table(spark, sf, "customer").select("c_custkey", "c_name"), people, "c_custkey", "o_custkey")


@query(
    "theta_contains",
    """select p_partkey, case when contains(n, 'red') then 'hard' when contains(n, 'ring') then 'medium' when contains(n, 'old rusty bolt') or contains('old rusty bolt', n) then 'easy' else 'unknown' end as difficulty
    from (select p_partkey, lower(trim(p_name)) n from part)""",
)
def _(spark, sf):
    rules = [("red", "hard"), ("ring", "medium"), ("old rusty bolt", "easy")]
    return J.contains_either_way(table(spark, sf, "part"), "p_name", rules, "difficulty", "unknown").select("p_partkey", "difficulty")


@query(
    "label_to_column",
    "select c_custkey, case c_mktsegment when 'AUTOMOBILE' then 'Weight' when 'BUILDING' then 'Width' else case when contains(lower(c_mktsegment), 'house') then 'Pile Height' end end as target from customer",
)
def _(spark, sf):
    target = J.label_column(F.concat(F.lit(" "), F.initcap("c_mktsegment"), F.lit(" ")), {"automobile": "Weight", "building": "Width"}, {"house": "Pile Height", "hold": "Backing"})
    return table(spark, sf, "customer").select("c_custkey", target.alias("target"))


@query(
    "override_by_url_text",
    "select p_partkey, case when contains(p_brand, '#1') and contains(p_name, 'ring') then 'RING-1' when contains(p_brand, '#2') then 'TWO' else p_name end as sku from part",
)
def _(spark, sf):
    rules = [("brand#1", "ring", "RING-1"), ("brand#2", "", "TWO")]
    return table(spark, sf, "part").select("p_partkey", J.override_by_text("p_name", "p_brand", "p_name", rules).alias("sku"))


@query("retry_rows", "select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_acctbal < 0)")
def _(spark, sf):
    retry = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return J.retry_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), retry, "o_custkey")


@query("retry_predicate", "select o_orderkey from orders where o_orderkey % 7 = 0 or o_orderkey % 11 = 0")
def _(spark, sf):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey", F.when(k % 7 != 0, F.col("o_orderstatus")).alias("name"), F.when(k % 11 != 0, F.col("o_orderpriority")).otherwise("none").alias("sku"))
    return J.unresolved(o, ["name", "sku"]).select("o_orderkey")


@query("fill_missing_from_overall", "select p_partkey, case when p_partkey % 2 = 0 then cast(p_size as varchar) else cast(p_size + 1 as varchar) end as width from part")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, S("p_size")).otherwise("").alias("width"), F.struct((F.col("p_size") + 1).cast("string").alias("width")).alias("overall"))
    return J.fill_missing(part, "overall", ["width"]).select("p_partkey", "width")


@query("pending_rows", "select o_orderkey from orders where o_orderkey % 5 in (0, 1)")
def _(spark, sf):
    k = F.col("o_orderkey") % 5
    o = table(spark, sf, "orders").select("o_orderkey", F.when(k == 0, "").when(k == 1, None).otherwise("done").alias("detail"))
    return P.unfilled(o, "detail").select("o_orderkey")


@query("valid_url_rows", "select page_id from pages where page_id % 3 <> 0")
def _(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("x"), F.col("url"))).otherwise(F.col("url")).alias("link"))
    return P.with_url(p, "link").select("page_id")


@query("category_type_filter", "select p_partkey, p_type from part where p_type <> 'PROMO' and (p_type <> 'SMALL' or contains(p_name, 'ring'))")
def _(spark, sf):
    from ..sources.tables import category_dim

    types = ("ECONOMY", "SMALL", "MEDIUM", "LARGE", "STANDARD", "PROMO")
    dim = category_dim(spark, {t: {"links": [t.lower()], "type_filter": {"SMALL": "RING", "PROMO": "nothing"}.get(t)} for t in types})
    return P.by_category_type(table(spark, sf, "part"), dim, "p_type", "p_name").select("p_partkey", "p_type")


@query("row_completeness", "select o_orderkey from orders where o_orderkey % 6 <> 0 and o_orderkey % 5 <> 0")
def _(spark, sf):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey", F.when(k % 6 != 0, "sku").alias("sku"), F.when(k % 5 != 0, "url").otherwise(" ").alias("url"))
    return P.complete(o, "sku", "url").select("o_orderkey")


@query("blocked_pages", "select page_id, regexp_matches(lower(html), 'captcha|cloudflare|access denied|are you human|unusual traffic|403 forbidden|bot detection|please enable javascript|checking your browser|ddos protection|ray id') as blocked from pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", P.is_blocked("html").alias("blocked"))


@query(
    "valid_finishes",
    "select p_partkey, p_name in (select distinct p_name from part) and p_partkey % 4 = 0 as ok from part",
)
def _(spark, sf):
    k = F.col("p_partkey") % 4
    v = F.when(k == 0, F.col("p_name")).when(k == 1, F.concat(F.col("p_name"), F.lit(" 12"))).when(k == 2, F.concat(F.lit("Select "), F.col("p_name"))).otherwise(F.concat(F.col("p_name"), F.lit(" and two more words")))
    return table(spark, sf, "part").select("p_partkey", P.valid_finish(v).alias("ok"))


@query("dimension_lines", "select p_partkey, p_partkey % 3 <> 2 as is_dim, p_partkey % 3 = 0 as like_dim from part")
def _(spark, sf):
    k = F.col("p_partkey") % 3
    v = F.when(k == 0, F.concat(S("p_size"), F.lit('" W x 20" D'))).when(k == 1, F.concat(F.lit("Queen: "), F.col("p_name"))).otherwise(F.concat(F.col("p_name"), F.lit(" only")))
    return table(spark, sf, "part").select("p_partkey", P.dimension_line(v).alias("is_dim"), P.dimension_like(v).alias("like_dim"))


@query("size_line_candidates", "select p_partkey, concat('W ', p_size, '|', 'D ', p_size + 1, '|', 'H ', p_size + 2) as size_lines from part")
def _(spark, sf):
    text = F.concat(F.lit("finest oak\n W "), S("p_size"), F.lit("\nno size\nD "), (F.col("p_size") + 1).cast("string"), F.lit("\nH "), (F.col("p_size") + 2).cast("string"), F.lit("\nDia 9"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(P.size_lines(text, 3), "|").alias("size_lines"))


@query("detail_noise_filter", "select p_partkey, case when p_partkey % 2 = 0 then p_name else concat(p_name, ',', p_type) end as details from part")
def _(spark, sf):
    parts = F.array(F.col("p_name"), F.lit("Free Shipping"), F.when(F.col("p_partkey") % 2 == 0, F.lit("visa card")).otherwise(F.col("p_type")))
    return table(spark, sf, "part").select("p_partkey", F.array_join(P.product_details(parts), ",").alias("details"))


@query("plausible_distance", "select o_orderkey, case when o_totalprice / 1000 <= 500 then o_totalprice / 1000 end as miles from orders")
def _(spark, sf):
    from ..functions.address import plausible_miles

    return table(spark, sf, "orders").select("o_orderkey", plausible_miles(F.col("o_totalprice") / 1000).alias("miles"))
