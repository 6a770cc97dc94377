"""De-duplication: line items read as repeated listings of a product page."""

from pyspark.sql import functions as F

from ..functions.rx import present
from ..operators import dedup as D
from .registry import query, table

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
ORDER_SQL = ", ".join(ORDER)
URL_SQL = "concat('https://shop.example/p/', cast(l_partkey as varchar))"
RAW_SQL = f"select *, {URL_SQL} as url from lineitem"


def listings(spark, sf):
    li = table(spark, sf, "lineitem").select(*ORDER, "l_returnflag", "l_linestatus", "l_quantity")
    return li.withColumn("url", F.concat(F.lit("https://shop.example/p/"), F.col("l_partkey").cast("string")))


def first_sql(keys: str, cols: str, source: str = RAW_SQL, order: str = ORDER_SQL) -> str:
    return f"select {cols} from (select *, row_number() over (partition by {keys} order by {order}) rn from ({source})) where rn = 1"


SHOWN = ["url", *ORDER]
SHOWN_SQL = ", ".join(SHOWN)


@query("dedup_keep_first_url", first_sql("url", SHOWN_SQL))
def _(spark, sf):
    return D.keep_first(listings(spark, sf), "url", ORDER).select(*SHOWN)


SKU_SQL = f"select *, case when l_partkey % 10 = 0 then ' ' when l_partkey % 10 = 1 then 'nan' else concat('SKU-', cast(l_partkey % 97 as varchar)) end as sku, {URL_SQL} as url from lineitem"


def with_sku(spark, sf):
    k = F.col("l_partkey")
    sku = F.when(k % 10 == 0, " ").when(k % 10 == 1, "nan").otherwise(F.concat(F.lit("SKU-"), (k % 97).cast("string")))
    return listings(spark, sf).withColumn("sku", sku)


@query("dedup_key_present", first_sql("sku", "sku, " + ORDER_SQL, f"select * from ({SKU_SQL}) where trim(sku) not in ('', 'nan')"))
def _(spark, sf):
    return D.keep_first_present(with_sku(spark, sf), "sku", ORDER).select("sku", *ORDER)


@query("dedup_composite_key", first_sql("l_partkey, l_returnflag, l_suppkey", "l_returnflag, " + ORDER_SQL))
def _(spark, sf):
    return D.keep_first(listings(spark, sf), ["l_partkey", "l_returnflag", "l_suppkey"], ORDER).select("l_returnflag", *ORDER)


@query("dedup_fallback_key", first_sql("case when trim(sku) in ('', 'nan') then concat('u:', url) else concat('s:', sku) end", "sku, url, " + ORDER_SQL, SKU_SQL))
def _(spark, sf):
    return D.keep_first_fallback(with_sku(spark, sf), ["sku", "url"], ORDER).select("sku", "url", *ORDER)


@query("dedup_scope_category", first_sql("l_returnflag, url", "l_returnflag, " + SHOWN_SQL))
def _(spark, sf):
    return D.keep_first_in_category(listings(spark, sf), "l_returnflag", "url", ORDER).select("l_returnflag", *SHOWN)


SCOPED = f"select *, case l_returnflag when 'R' then 'local' else 'global' end as scope, case l_returnflag when 'N' then 0 when 'A' then 1 else 2 end as category_ord, {URL_SQL} as url from lineitem"
SCOPED_ORDER = f"category_ord, {ORDER_SQL}"


def scoped(spark, sf):
    flag = F.col("l_returnflag")
    return listings(spark, sf).withColumns({"scope": F.when(flag == "R", "local").otherwise("global"), "category_ord": F.when(flag == "N", 0).when(flag == "A", 1).otherwise(2)})


def scope_sql(source: str) -> str:
    g = first_sql("url", "l_returnflag, " + SHOWN_SQL, f"select * from ({source}) where scope = 'global'", SCOPED_ORDER)
    loc = first_sql("l_returnflag, url", "l_returnflag, " + SHOWN_SQL, f"select * from ({source}) where scope <> 'global'", SCOPED_ORDER)
    return f"{g} union all {loc}"


@query("dedup_scope_global", scope_sql(SCOPED))
def _(spark, sf):
    return D.keep_first_scoped(scoped(spark, sf), "l_returnflag", "url", "scope", ["category_ord", *ORDER]).select("l_returnflag", *SHOWN)


IN_CATEGORY = first_sql("l_returnflag, url", "* exclude (rn)", SCOPED, SCOPED_ORDER)
LIMITED = f"select * exclude (rn2) from (select *, row_number() over (partition by l_returnflag order by {SCOPED_ORDER}) rn2 from ({IN_CATEGORY})) where rn2 <= 25"


@query("demo_limit_then_global", scope_sql(LIMITED))
def _(spark, sf):
    return D.demo_then_scope(scoped(spark, sf), "l_returnflag", "url", "scope", ["category_ord", *ORDER], 25).select("l_returnflag", *SHOWN)


@query("demo_mode_no_global_check", f"select l_returnflag, {SHOWN_SQL} from ({LIMITED})")
def _(spark, sf):
    return D.demo_then_scope(scoped(spark, sf), "l_returnflag", "url", "scope", ["category_ord", *ORDER], 25, demo=True).select("l_returnflag", *SHOWN)


MIXED = "select *, case when l_linenumber % 2 = 0 then concat('HTTPS://Shop.example/P/', cast(l_partkey as varchar), ' ') else concat('https://shop.example/p/', cast(l_partkey as varchar)) end as link from lineitem"


@query("dedup_nocase_url", first_sql("lower(trim(link))", "link, " + ORDER_SQL, MIXED))
def _(spark, sf):
    k = F.col("l_partkey").cast("string")
    link = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("HTTPS://Shop.example/P/"), k, F.lit(" "))).otherwise(F.concat(F.lit("https://shop.example/p/"), k))
    return D.keep_first_nocase(listings(spark, sf).withColumn("link", link), "link", ORDER).select("link", *ORDER)


@query("append_old_wins", first_sql("url", SHOWN_SQL, f"select *, case when l_orderkey % 3 = 0 then 0 else 1 end as src from ({RAW_SQL})", f"src, {ORDER_SQL}"))
def _(spark, sf):
    rows = listings(spark, sf)
    old, new = rows.filter(F.col("l_orderkey") % 3 == 0), rows.filter(F.col("l_orderkey") % 3 != 0)
    return D.append_old_wins(old, new, "url", ORDER).select(*SHOWN)


COMPLETE = "trim(sku) not in ('', 'nan') and l_returnflag <> 'N'"


@query(
    "dedup_complete_keys_only",
    first_sql("sku, l_returnflag", "sku, l_returnflag, " + ORDER_SQL, f"select * from ({SKU_SQL}) where {COMPLETE}") + f" union all select sku, case when l_returnflag = 'N' then null else l_returnflag end, {ORDER_SQL} from ({SKU_SQL}) where not ({COMPLETE})",
)
def _(spark, sf):
    rows = with_sku(spark, sf).withColumn("l_returnflag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    return D.keep_first_complete(rows, ["sku", "l_returnflag"], ORDER).select("sku", "l_returnflag", *ORDER)


@query("dedup_two_level", first_sql("url", "l_returnflag, " + SHOWN_SQL, first_sql("l_returnflag, url, l_linestatus", "* exclude (rn)")))
def _(spark, sf):
    return D.keep_first_two_level(listings(spark, sf), "l_returnflag", "url", "l_linestatus", ORDER).select("l_returnflag", *SHOWN)


@query("distinct_values", "select distinct l_suppkey from lineitem")
def _(spark, sf):
    return D.distinct_values(table(spark, sf, "lineitem"), "l_suppkey")


@query(
    "unique_in_order",
    "select p_partkey, case when a = b then a else concat(a, ' ', b) end as words from (select p_partkey, split_part(p_name, ' ', 1) a, split_part(p_name, ' ', 2) b from part)",
)
def _(spark, sf):
    w = F.split("p_name", " ")
    doubled = F.concat(w, F.reverse(w), w)
    return table(spark, sf, "part").select("p_partkey", F.array_join(D.unique_in_order(doubled), " ").alias("words"))


@query("null_rule_on_ingest", f"select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when trim(sku) in ('', 'nan') then null else sku end as sku from ({SKU_SQL})")
def _(spark, sf):
    return with_sku(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", present("sku").alias("sku"))
