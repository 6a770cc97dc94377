"""Numbered batches: files are written, listed and read by a given number of tasks, however many there are."""

import os

import pytest
from pyspark.sql import functions as F

from lathe.queries import load
from lathe.sinks.tables import write_numbered_batches


def test_no_step_of_the_query_has_a_task_for_each_folder(spark, tmp_path):
    orders = spark.range(10_000).select((F.lit(9_999) - F.col("id")).alias("o_orderkey"), F.rand(1).alias("o_totalprice"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.sparkContext.setJobGroup("numbered", "numbered")
    try:
        rows = load()["numbered_batch_files"].run(spark, str(tmp_path)).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = sorted((r["batch"], r["files"], r["n"], r["first_key"], r["last_key"]) for r in rows)
    assert got == [(b, 1, 50, 50 * b - 50, 50 * b - 1) for b in range(1, 201)]
    seen = spark.sparkContext.statusTracker()
    stages = [seen.getStageInfo(s) for job in seen.getJobIdsForGroup("numbered") for s in seen.getJobInfo(job).stageIds]
    assert stages and max(s.numTasks for s in stages if s) < 200


def test_spark_reads_the_columns_as_they_were(spark, tmp_path):
    from lathe.sources.tables import read_numbered_batches

    kinds = ["timestamp'1500-03-01 01:02:03.123456' as at", "timestamp_ntz'2024-01-01 00:00:00' as ntz", "date'1500-03-01' as day", "cast(id as decimal(38, 10)) as price", "X'00ff' as raw"]
    more = ["array(struct(id as a, 'x' as b)) as parts", "map('k', array(1, null)) as m", "if(id = 3, null, named_struct('a', 1)) as s", "if(id % 2 = 0, null, 'é') as `a.b c`", "interval '1 02:03:04.5' day to second as gap"]
    rows = spark.range(20).selectExpr("20 - id as k", *kinds, *more)
    write_numbered_batches(rows, f"{tmp_path}/b", "k", 7)
    back = spark.read.parquet(f"{tmp_path}/b")
    assert back.drop("batch").schema.simpleString() == rows.schema.simpleString()
    wanted = sorted(map(str, rows.withColumn("batch", F.ceil(F.col("k") / 7).cast("int")).collect()))
    assert sorted(map(str, back.collect())) == wanted
    assert sorted(map(str, read_numbered_batches(spark, f"{tmp_path}/b").withColumn("batch", F.col("batch").cast("int")).drop("file").collect())) == wanted


def test_a_batch_larger_than_what_python_gets_at_once_is_one_sorted_file(spark, tmp_path):
    from lathe.sources.tables import read_numbered_batches

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        write_numbered_batches(spark.range(101).select((F.lit(100) - F.col("id")).alias("k")), f"{tmp_path}/b", "k", 50)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = read_numbered_batches(spark, f"file://{tmp_path}/b", ["k"]).collect()
    assert sorted((r["batch"], r["k"]) for r in rows) == [(k // 50 + 1, k) for k in range(101)]
    assert len({r["file"] for r in rows}) == 3
    for file in {r["file"] for r in rows}:
        keys = [r["k"] for r in spark.read.parquet(f"file://{file}").collect()]
        assert keys == sorted(keys)


def test_a_second_write_replaces_the_first_and_leaves_nothing_beside_it(spark, tmp_path):
    write_numbered_batches(spark.range(500).toDF("k"), f"{tmp_path}/b", "k", 50)
    write_numbered_batches(spark.range(120).toDF("k"), f"{tmp_path}/b", "k", 50)
    assert sorted(os.listdir(f"{tmp_path}/b")) == ["_SUCCESS", "batch=1", "batch=2", "batch=3"]
    assert spark.read.parquet(f"{tmp_path}/b").count() == 120
    assert os.listdir(tmp_path) == ["b"]


def test_a_failed_write_leaves_the_files_as_they_were(spark, tmp_path):
    from lathe.sinks.numbered import write_folders

    write_numbered_batches(spark.range(100).toDF("k"), f"{tmp_path}/b", "k", 50)
    broken = spark.range(0, 100, 1, 1).select("id", F.when(F.col("id") == 90, F.raise_error(F.lit("broken"))).otherwise(F.col("id") * 0).cast("bigint").alias("batch"))
    with pytest.raises(Exception, match="broken"):
        write_folders(broken, f"{tmp_path}/b", "batch")
    assert sorted(r["k"] for r in spark.read.parquet(f"{tmp_path}/b").collect()) == list(range(100))
    assert os.listdir(tmp_path) == ["b"]
