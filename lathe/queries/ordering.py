"""Numbering, carry-forward, top-n and sorting."""

from pyspark.sql import functions as F

from ..operators import ordered as O
from ..session import fresh_dir
from ..sinks.tables import brand_category_links, sheet_list, sheet_name, sheet_name_clashes, write_numbered_batches
from ..sources.tables import read_numbered_batches
from .copies import ORDER, ORDER_SQL
from .registry import query, table


def items(spark, sf, *more):
    return table(spark, sf, "lineitem").select(*ORDER, *more)


@query("category_index", f"select l_returnflag, {ORDER_SQL}, row_number() over (partition by l_returnflag order by {ORDER_SQL}) as idx from lineitem")
def _(spark, sf):
    return O.running_index(items(spark, sf, "l_returnflag"), ORDER, ["l_returnflag"], "idx")


@query("running_index", f"select {ORDER_SQL}, row_number() over (order by {ORDER_SQL}) as idx from lineitem")
def _(spark, sf):
    return O.running_index(items(spark, sf), ORDER, (), "idx")


CAT_ORD = "case l_returnflag when 'R' then 0 when 'A' then 1 else 2 end"


@query("index_across_categories", f"select {ORDER_SQL}, row_number() over (order by {CAT_ORD}, {ORDER_SQL}) as idx from lineitem")
def _(spark, sf):
    rows = items(spark, sf, "l_returnflag").withColumn("category_ord", F.expr(CAT_ORD))
    return O.index_across(rows, "l_returnflag", "category_ord", ORDER, "idx").select(*ORDER, "idx")


@query("index_missing_only", f"select {ORDER_SQL}, 100 + sum(case when l_partkey % 4 = 0 then 1 else 0 end) over (order by {ORDER_SQL} rows unbounded preceding) as serial from lineitem")
def _(spark, sf):
    rows = items(spark, sf).withColumn("sku", F.when(F.col("l_partkey") % 4 != 0, "have").otherwise(" "))
    return O.index_missing(rows, "sku", ORDER, start=100).drop("sku")


@query("batch_number", f"select {ORDER_SQL}, cast(ceil(row_number() over (order by {ORDER_SQL}) / 50.0) as bigint) as batch from lineitem")
def _(spark, sf):
    return O.batch_number(items(spark, sf), ORDER)


@query(
    "numbered_batch_files",
    "select cast((k + 49) // 50 as bigint) as batch, 1::bigint as files, count(*) as n, min(o_orderkey) as first_key, max(o_orderkey) as last_key from (select o_orderkey, row_number() over (order by o_orderkey) as k from orders) group by 1",
)
def _(spark, sf):
    path = fresh_dir(spark, "batches")
    write_numbered_batches(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path, "o_orderkey")
    back = read_numbered_batches(spark, path, ["o_orderkey"])
    return back.groupBy("batch").agg(F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("sorted_by_category_serial", f"select o_orderkey, row_number() over (order by case o_orderstatus when 'P' then 0 when 'F' then 1 end nulls last, o_orderkey) as serial from orders")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    dim = spark.createDataFrame([("P", 0), ("F", 1)], "category string, ord int")
    rows = O.sort_by_category(o, dim, "o_orderstatus", "o_orderkey")
    ranked = rows.join(F.broadcast(dim), F.col("o_orderstatus") == F.col("category"), "left")
    return O.numbered(ranked, [F.asc_nulls_last("ord"), "o_orderkey"], "serial").select("o_orderkey", "serial")


@query("sheet_order_first_seen", "select p_brand, dense_rank() over (order by f) as sheet_ord from (select p_brand, min(p_partkey) f from part group by 1)")
def _(spark, sf):
    return O.sheet_order(table(spark, sf, "part"), "p_brand", "p_partkey").select("p_brand", "sheet_ord")


@query("sheet_list_present", "select p_type, dense_rank() over (order by f) as sheet_ord from (select p_type, min(p_partkey) f from part group by 1)")
def _(spark, sf):
    return sheet_list(table(spark, sf, "part"), "p_type", "p_partkey")


@query("sheet_name_sanitise", "select p_partkey, substr(concat(p_name, ' a b c d e f g h ', p_brand, ' ', p_type), 1, 31) as sheet from part")
def _(spark, sf):
    raw = F.concat(F.col("p_name"), F.lit(" a:b/c*d?e[f]g\\h "), F.col("p_brand"), F.lit(" "), F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", sheet_name(raw).alias("sheet"))


@query("sheet_name_clashes", "select sheet, count(*) as categories from (select distinct concat('A rather long category name ', p_brand) c, substr(concat('A rather long category name ', p_brand), 1, 31) sheet from part) group by 1 having count(*) > 1")
def _(spark, sf):
    c = table(spark, sf, "part").select(F.concat(F.lit("A rather long category name "), F.col("p_brand")).alias("category"))
    return sheet_name_clashes(c, "category")


@query("brand_category_links", "select p_brand, p_type, arg_min(p_name, p_partkey) as link from part where p_type <> 'PROMO' group by 1, 2")
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_brand", F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("p_type"), F.col("p_name").alias("link"), "p_partkey")
    return brand_category_links(rows, "p_brand", "p_type", "link", "p_partkey")


@query(
    "carry_forward_section",
    "select event_id, user_id, last_value(case when event_type = 'purchase' or value > 90 then event_id end ignore nulls) over (partition by user_id order by event_id rows unbounded preceding) as section from events",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    head = F.when((F.col("event_type") == "purchase") | (F.col("value") > 90), F.col("event_id"))
    return O.carry_forward(e, head, "event_id", ["user_id"]).select("event_id", "user_id", "section")


@query(
    "next_line_value",
    "select event_id, event_type, first_value(case when value > 50 then value end ignore nulls) over (partition by event_type order by event_id rows between 1 following and unbounded following) as next_value from events",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    return O.next_value(e, F.when(F.col("value") > 50, F.col("value")), "event_id", ["event_type"], "next_value").select("event_id", "event_type", "next_value")


@query("turn_carry_forward", "select conv_id, turn, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows unbounded preceding) as asked_at from conversations")
def _(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return O.carry_forward(c, F.when(F.col("role") == "user", F.col("turn")), "turn", ["conv_id"], "asked_at").drop("role")


@query("top_n_per_category", "select p_type, p_partkey, p_retailprice from (select *, row_number() over (partition by p_type order by p_retailprice desc, p_partkey) rn from part) where rn <= 5")
def _(spark, sf):
    return O.top_n(table(spark, sf, "part"), 5, [F.desc("p_retailprice"), "p_partkey"], ["p_type"]).select("p_type", "p_partkey", "p_retailprice")


@query("sort_nulls_last", "select o_orderkey, case when o_orderkey % 9 <> 0 then o_totalprice end as distance from orders")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("distance"))
    return O.sort_nulls_last(o, "distance", "o_orderkey")


@query("vendor_lookup", "select s_suppkey, s_name from supplier where contains(lower(s_name), 'plier#00000001') order by s_suppkey limit 1")
def _(spark, sf):
    from ..sources.tables import find_vendor

    return find_vendor(table(spark, sf, "supplier"), "PLIER#00000001", "s_suppkey", vendor="s_name").select("s_suppkey", "s_name")


@query("widest_image_source", "select p_partkey, case when p_size >= 25 then concat('/img/', p_partkey, '-a.jpg') else concat('/img/', p_partkey, '-b.jpg') end as image from part")
def _(spark, sf):
    from ..functions.urls import widest_srcset

    k = F.col("p_partkey").cast("string")
    srcset = F.concat(F.lit("/img/"), k, F.lit("-a.jpg "), (F.col("p_size") + 100).cast("string"), F.lit("w, /img/"), k, F.lit("-b.jpg 125w"))
    return table(spark, sf, "part").select("p_partkey", widest_srcset(srcset).alias("image"))
