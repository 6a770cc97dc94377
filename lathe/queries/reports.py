"""Counts, fill reports, concatenation, variants and dynamic columns."""

from pyspark.sql import functions as F

from ..operators import projection as C
from ..operators import report as G
from ..operators import reshape as R
from .copies import ORDER
from .registry import query, table


def S(c):
    return F.col(c).cast("string")


FILL = "select '{c}' as column_name, count(*) as row_count, count({e}) as non_null, sum(case when trim({e}) not in ('', 'nan') then 1 else 0 end)::bigint as filled, coalesce(sum(case when trim({e}) not in ('', 'nan') then 1 else 0 end), 0) = 0 as all_blank from part"


@query(
    "fill_report",
    " union all ".join(
        FILL.format(c=c, e=e)
        for c, e in (
            ("name", "p_name"),
            ("type", "case when p_partkey % 3 = 0 then null when p_partkey % 3 = 1 then ' ' else p_type end"),
            ("blank", "''"),
        )
    ),
)
def _(spark, sf):
    k = F.col("p_partkey") % 3
    p = table(spark, sf, "part").select(F.col("p_name").alias("name"), F.when(k == 1, " ").when(k == 2, F.col("p_type")).alias("type"), F.lit("").alias("blank"))
    return G.fill_report(p, ["name", "type", "blank"])


@query("filled_counts", "select sum(case when p_size % 2 = 0 then 1 else 0 end)::bigint as name_filled, count(*) as image_filled from part")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise("").alias("name"), F.col("p_brand").alias("image"))
    return G.filled_counts(p, "name", "image")


@query("category_counts", "select p_type, count(*) as products from part group by 1")
def _(spark, sf):
    return G.category_counts(table(spark, sf, "part"), "p_type")


@query("first_value_per_group", "select l_partkey, arg_min(l_suppkey, (l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) as first_supplier from lineitem group by 1")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("ord"))
    return G.first_value(li, "l_partkey", "l_suppkey", "ord", "first_supplier")


@query(
    "distinct_option_concat",
    """select l_partkey, string_agg(l_returnflag, ', ' order by o) as options from
    (select l_partkey, l_returnflag, min((l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) as o from lineitem group by 1, 2) group by 1""",
)
def _(spark, sf):
    return G.distinct_concat(table(spark, sf, "lineitem"), "l_partkey", "l_returnflag", ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"], "options")


@query("sorted_set_concat", "select l_suppkey, string_agg(s, ', ' order by s) as statuses from (select distinct l_suppkey, concat(l_returnflag, l_linestatus) s from lineitem) group by 1")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("s"))
    return G.sorted_set(li, "l_suppkey", "s", "statuses")


@query("variant_label", "select p_partkey, concat_ws(' / ', case when p_size % 2 = 0 then p_type end, p_brand, case when p_size % 3 = 0 then p_name end) as label from part")
def _(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", G.variant_label(F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(""), "p_brand", F.when(F.col("p_size") % 3 == 0, F.col("p_name"))).alias("label"))


KEYWORD = """select user_id, case when bool_or(value > 80) then 'Yes' else 'No' end as high_found, coalesce({f}(case when value > 80 then event_type end, case when value > 80 then event_id end), '') as high_source,
 case when bool_or(event_type = 'error') then 'Yes' else 'No' end as fault_found, coalesce({f}(case when event_type = 'error' then event_type end, case when event_type = 'error' then event_id end), '') as fault_source from events group by 1"""


def keyword_hits(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_id", "event_type", (F.col("value") > 80).alias("high"), (F.col("event_type") == "error").alias("fault"))


@query("keyword_last_page", KEYWORD.format(f="arg_max"))
def _(spark, sf):
    return G.keyword_pages(keyword_hits(spark, sf), "user_id", "event_id", "event_type", ["high", "fault"], last=True)


@query("keyword_first_page", KEYWORD.format(f="arg_min"))
def _(spark, sf):
    return G.keyword_pages(keyword_hits(spark, sf), "user_id", "event_id", "event_type", ["high", "fault"], last=False)


@query("nearest_distance", "select l_partkey, min(l_extendedprice) as nearest from lineitem group by 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.min("l_extendedprice").alias("nearest"))


@query("change_count", "select sum(case when p_partkey % 5 = 0 then 1 else 0 end)::bigint as name_changed, 0::bigint as type_changed from part")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 5 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name2"), F.col("p_type").alias("type"), F.col("p_type").alias("type2"))
    return G.change_count(p, {"name": "name2", "type": "type2"})


STATUS = "select c_custkey, case when c_custkey in (select o_custkey from orders) then 'success' else 'failed' end as status from customer"


def status_rows(spark, sf):
    from ..sinks.tables import with_status

    detail = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return with_status(table(spark, sf, "customer").select("c_custkey"), detail, "c_custkey").drop("n")


@query("dead_letter_status", STATUS)
def _(spark, sf):
    return status_rows(spark, sf)


@query("status_report", f"select status, count(*) as rows from ({STATUS}) group by 1")
def _(spark, sf):
    return G.status_report(status_rows(spark, sf))


@query("failed_keys", f"select c_custkey from ({STATUS}) where status = 'failed'")
def _(spark, sf):
    return G.failed_keys(status_rows(spark, sf), "c_custkey")


@query("done_keys", "select distinct o_orderpriority from orders")
def _(spark, sf):
    return G.done_keys(table(spark, sf, "orders"), "o_orderpriority")


@query("union_by_name", "select p_partkey as id, p_name as name, p_size as size, null::varchar as segment from part union all select c_custkey, c_name, null, c_mktsegment from customer")
def _(spark, sf):
    a = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    b = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))
    return G.union_all([a, b])


# --- variants -------------------------------------------------------------


def variant_parts(spark, sf):
    n = F.col("p_size") % 4
    variants = F.transform(F.filter(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda i: i < n), lambda i: F.struct(F.concat(S("p_partkey"), F.lit("-"), i.cast("string")).alias("sku"), F.when(i != 1, F.col("p_retailprice") + i).alias("price")))
    return table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", variants.alias("variants"))


NUMBERED = "(select unnest([0, 1, 2]) as i) t"
VARIANTS = f"select p_partkey, i as variant_pos, concat(p_partkey, '-', i) as sku, case when i = 1 then p_retailprice else p_retailprice + i end as price from part, {NUMBERED} where i < p_size % 4"


@query("variant_explode", f"{VARIANTS} union all select p_partkey, null, null, p_retailprice from part where p_size % 4 = 0")
def _(spark, sf):
    v = R.explode_variants(variant_parts(spark, sf), "variants")
    return v.select("p_partkey", "variant_pos", "variant.sku", F.coalesce("variant.price", "p_retailprice").alias("price"))


@query("variant_explode_with_base", f"{VARIANTS} union all select p_partkey, -1, null, p_retailprice from part")
def _(spark, sf):
    v = R.explode_variants(variant_parts(spark, sf), "variants", keep_base=True)
    return v.select("p_partkey", "variant_pos", "variant.sku", F.coalesce("variant.price", "p_retailprice").alias("price"))


@query(
    "option_cross",
    "select p_partkey, c as color_pos, s as size_pos, case c when 0 then p_brand else p_type end as color, case s when 0 then '2x3' else '5x8' end as size from part, (select unnest([0, 1]) c) a, (select unnest([0, 1]) s) b",
)
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.array("p_brand", "p_type").alias("colors"), F.array(F.lit("2x3"), F.lit("Custom size"), F.lit("5x8")).alias("sizes"))
    return R.option_product(p, "colors", "sizes")


@query(
    "changed_variants",
    """select l_partkey as id, concat(p_name, ' - ', l_returnflag) as name, l_returnflag as finish from (select distinct l_partkey, l_returnflag from lineitem) join part on l_partkey = p_partkey where l_returnflag <> base(p_size)
    union all select p_partkey, p_name, base(p_size) from part where p_partkey not in (select l_partkey from lineitem where l_returnflag <> base((select p_size from part q where q.p_partkey = l_partkey)))""".replace("base(p_size)", "(case p_size % 3 when 0 then 'A' when 1 then 'N' else 'R' end)").replace(
        "base((select p_size from part q where q.p_partkey = l_partkey))", "(select case q.p_size % 3 when 0 then 'A' when 1 then 'N' else 'R' end from part q where q.p_partkey = l_partkey)"
    ),
)
def _(spark, sf):
    k = F.col("p_size") % 3
    base = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.when(k == 0, "A").when(k == 1, "N").otherwise("R").alias("finish"))
    seen = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("finish")).distinct()
    variants = seen.join(base.select("id", "name"), "id").select("id", "name", "finish")
    return R.changed_variants(base, variants, "id", ["finish"], "name", "finish")


@query("group_columns_and_extras", "select p_partkey, cast(p_size as varchar) as width, case when p_partkey % 2 = 0 then concat('depth: ', p_size + 1, ' | width: ', p_size + 2) end as large from part")
def _(spark, sf):
    g0 = F.struct(F.lit("Small").alias("name"), F.create_map(F.lit("width"), S("p_size")).alias("dims"))
    g1 = F.struct(F.lit("Large").alias("name"), F.create_map(F.lit("depth"), (F.col("p_size") + 1).cast("string"), F.lit("width"), (F.col("p_size") + 2).cast("string")).alias("dims"))
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.array(g0, g1)).otherwise(F.array(g0)).alias("groups"))
    return p.select("p_partkey", *R.first_group_to_columns("groups", ["width"]), F.try_element_at(R.later_groups_to_extras("groups"), F.lit("Large")).alias("large"))


@query("split_to_rows", "select p_partkey, i as pos, case i when 0 then split_part(p_name, ' ', 1) else split_part(p_name, ' ', 2) end as part from part, (select unnest([0, 1]) i) t")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(" | ")).alias("names"))
    return R.split_to_rows(p, "names", r"\|").select("p_partkey", "pos", "part")


@query("pairs_from_list", "select p_partkey, concat('brand=', p_brand, ';type=', p_type) as pairs from part")
def _(spark, sf):
    flat = F.array(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"), F.lit("odd"))
    shown = F.array_join(F.transform(R.pairs_from_list(flat), lambda p: F.concat(p["key"], F.lit("="), p["value"])), ";")
    return table(spark, sf, "part").select("p_partkey", shown.alias("pairs"))


@query("header_row_map", "select p_partkey, cast(p_size as varchar) as w, cast(p_size + 1 as varchar) as h from part")
def _(spark, sf):
    m = R.header_row_map(F.array(F.lit("W"), F.lit("H"), F.lit(None)), F.array(S("p_size"), (F.col("p_size") + 1).cast("string"), F.lit("x")))
    return table(spark, sf, "part").select("p_partkey", F.try_element_at(m, F.lit("W")).alias("w"), F.try_element_at(m, F.lit("H")).alias("h"))


@query("attribute_summary", "select p_partkey, concat_ws(' | ', concat('Width: ', p_size), case when p_size % 2 = 0 then concat('Type: ', p_type) end) as summary from part")
def _(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", R.summary_text({"Width": S("p_size"), "Depth": F.lit(""), "Type": F.when(F.col("p_size") % 2 == 0, F.col("p_type"))}).alias("summary"))


# --- dynamic columns ------------------------------------------------------


def long_props(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return e.select("user_id", "event_id", F.col("event_type").alias("key"), F.col("value").cast("string").alias("value"))


def pivot_sql(last: bool) -> str:
    f = "arg_max" if last else "arg_min"
    kinds = ("click", "error", "purchase", "signup", "view")
    cols = ", ".join(f"{f}(case when event_type = '{k}' then value end, case when event_type = '{k}' then event_id end) as \"{k}\"" for k in kinds)
    return f"select user_id, {cols} from events group by 1"


def as_double(df):
    return df.select("user_id", *[F.col(f"`{c}`").cast("double").alias(c) for c in df.columns if c != "user_id"])


@query("dynamic_pivot_sorted", pivot_sql(False))
def _(spark, sf):
    long = long_props(spark, sf)
    return as_double(C.widen(long, "user_id", "key", "value", C.key_list(long, "key"), "event_id"))


@query("dynamic_pivot_last_wins", pivot_sql(True))
def _(spark, sf):
    long = long_props(spark, sf)
    return as_double(C.widen(long, "user_id", "key", "value", C.key_list(long, "key", "event_id"), "event_id", last=True))


@query(
    "spread_specs_clash",
    """select l_suppkey, count(*) as "A", max(case when l_returnflag = 'A' then f end) as "A (2)", max(case when l_returnflag = 'N' then f end) as "N", max(case when l_returnflag = 'R' then f end) as "R"
    from (select l_suppkey, l_returnflag, first_value(l_linestatus) over (partition by l_suppkey, l_returnflag order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) f from lineitem) group by 1""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    base = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("A"))
    long = li.select("l_suppkey", F.col("l_returnflag").alias("key"), F.col("l_linestatus").alias("value"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("ord"))
    return C.spread_specs(base, long, "l_suppkey", "key", "value", "ord")


@query(
    "per_category_columns",
    "select p_type, string_agg(b, ',' order by o, b) as columns from (select p_type, p_brand b, min(p_partkey) o from part where p_size % 5 <> 0 group by 1, 2) group by 1",
)
def _(spark, sf):
    long = table(spark, sf, "part").select("p_type", "p_partkey", F.col("p_brand").alias("key"), F.when(F.col("p_size") % 5 != 0, F.col("p_name")).otherwise(" ").alias("value"))
    return C.category_columns(long, "p_type", "p_partkey").select("p_type", F.array_join("columns", ",").alias("columns"))


@query("live_category_keys", "select distinct p_type, p_brand as key from part where p_size > 45")
def _(spark, sf):
    long = table(spark, sf, "part").select("p_type", F.col("p_brand").alias("key"), F.when(F.col("p_size") > 45, F.col("p_name")).alias("value"))
    return C.live_keys(long, "p_type")


@query(
    "routed_columns",
    """with p as (select user_id, upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) as k, event_id from events),
       e as (select user_id, k, min(event_id) as a, max(event_id) as z from p group by all)
       select user_id, max(case when k = 'Click' then a end)::varchar as "Click", max(case when k = 'View' then a end)::varchar as "View",
              coalesce(string_agg(k || '=' || z, '|' order by a) filter (k not in ('Click', 'View')), '') as extras from e group by 1""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", F.concat(F.lit(" "), F.upper("event_type")).alias("key"), S("event_id").alias("value"))
    blank = e.withColumn("value", F.lit(" ")).withColumn("event_id", -F.col("event_id") - 1)
    wide = C.routed(e.union(blank), "user_id", ["Click", "View"], "event_id")
    return wide.withColumn("extras", F.array_join(F.transform(F.map_entries("extras"), lambda x: F.concat_ws("=", x["key"], x["value"])), "|"))


@query("route_keys", "select event_id, event_type as key, case when event_type in ('click', 'view') then 'fixed' else 'extra' end as target from events")
def _(spark, sf):
    return C.route_keys(long_props(spark, sf), ["click", "view"]).select("event_id", "key", "target")


@query("json_extras_long", "select event_id, 'k' as key, regexp_extract(props, '[0-9]+') as value from events")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("extras"))
    return C.explode_extras(e, "event_id", "extras")


@query(
    "standard_columns_first",
    """select 'Acme' as "Manufacturer", concat('/p/', p_partkey) as "Source", null::varchar as "Image URL", p_name as "Product Name", null::varchar as "SKU", null::varchar as "Product Family Id", null::varchar as "Description", null::varchar as "Weight",
    cast(p_size as varchar) as "Width", null::varchar as "Depth", null::varchar as "Diameter", null::varchar as "Length", null::varchar as "Height", null::varchar as "Seat Width", null::varchar as "Seat Depth", null::varchar as "Seat Height", null::varchar as "Arm Height", null::varchar as "Arm Width", null::varchar as "List Price",
    concat('/p/', p_partkey) as "Product URL", p_type as "Category" from part""",
)
def _(spark, sf):
    p = table(spark, sf, "part").select(F.concat(F.lit("/p/"), S("p_partkey")).alias("url"), F.col("p_name").alias("NAME"), S("p_size").alias(" Width "), F.col("p_type").alias("Category"))
    named = C.resolve_aliases(C.trim_headers(p))
    return C.standard_first(C.source_column(C.constant(named, "Manufacturer", "Acme"), "https://shop.example"))


@query("default_from_other_column", "select p_partkey, case when p_size % 2 = 0 then p_type else p_name end as family from part")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.col("p_name"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise("").alias("family"))
    return C.default_from(p, "family", "p_name").select("p_partkey", "family")


@query("export_view_blanks", "select p_partkey::varchar as id, case when p_size > 9 then p_name else '' end as name from part")
def _(spark, sf):
    return C.to_export(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 9, F.col("p_name")).alias("name")))


@query("realign_by_header", "select p_partkey::varchar as id, case when p_size > 9 then p_name end as name, null::varchar as extra from part")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.when(F.col("p_size") > 9, F.col("p_name")).otherwise("  ").alias("name"), S("p_partkey").alias("id"), F.lit("x").alias("dropped"))
    return C.realign(p, ["id", "name", "extra"])


@query("order_columns_present", "select count(*) as n from lineitem")
def _(spark, sf):
    return C.require_columns(table(spark, sf, "lineitem"), ORDER).agg(F.count(F.lit(1)).alias("n"))
