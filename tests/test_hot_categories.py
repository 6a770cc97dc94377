"""A category with most of the rows does not meet in one task, a salted side is not held whole."""

import re

from pyspark.sql import functions as F

from lathe.operators import joins as J
from lathe.operators import ordered as O
from lathe.plans.catalog import collection_flow
from lathe.sources.tables import category_dim


def listing(spark, n):
    """Nine rows of ten in one category, some in none."""
    category = F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 20 == 9, "cold")
    return spark.range(n).select(category.alias("category"), (F.col("id") * 7919 % n).alias("ord"), "id")


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_across_moves_no_row_by_its_category(spark):
    rows = listing(spark, 2000).withColumn("place", F.when(F.col("category") == "cold", 0).otherwise(1))
    out = O.index_across(rows, "category", "place", ["ord"], "idx")
    got = out.orderBy("idx").collect()
    want = sorted(rows.collect(), key=lambda r: (r["place"], r["category"] or "", r["ord"]))
    assert [r["idx"] for r in got] == list(range(1, 2001))
    assert [r["id"] for r in got] == [r["id"] for r in want]
    assert not re.search(r"SortMergeJoin|ShuffledHashJoin|hashpartitioning\(category", plan_of(out))


def test_collection_flow_joins_no_rows_by_category(spark):
    rows = listing(spark, 2000).select("category", F.col("id").cast("string").alias("handle"), F.lit(None).cast("string").alias("sku"), F.lit("a ring").alias("product_type"), "ord")
    out = collection_flow(rows.unionByName(rows), category_dim(spark, {"hot": {"scope": "global"}, "cold": {"type_filter": "ring"}}))
    kept = out.collect()
    assert len(kept) == 1900 and len({(r["category"], r["handle"]) for r in kept}) == 1900
    assert not re.search("SortMergeJoin|ShuffledHashJoin", plan_of(out))


def test_a_salted_side_is_not_broadcast(spark):
    left = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 50), (None, 51)], "link string, n int")
    right = spark.createDataFrame([("a", "x", 2), ("a ", "first", 1), ("c", "y", 1)], "url string, name string, ord int")
    out = J.merge_results(left, right, "link", "url", "ord", salts=4, spread="n")
    assert sorted((r["n"], r["name"]) for r in out.collect()) == [(i, "first") for i in range(50)] + [(50, None), (51, None)]
    assert "BroadcastHashJoin" not in plan_of(out)
