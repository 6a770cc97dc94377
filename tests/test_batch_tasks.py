"""Files of numbered batches are written by many tasks, however few bytes they hold."""

import re

from pyspark.sql import functions as F

from lathe.sinks.tables import write_numbered_batches


def test_small_batches_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(2000).select((F.lit(2000) - F.col("id")).alias("k"), F.lit(None).cast("string").alias("note"))
    write_numbered_batches(rows, f"{tmp_path}/out", "k", 50)
    back = spark.read.parquet(f"{tmp_path}/out").withColumn("file", F.input_file_name())
    found = back.groupBy("batch").agg(F.countDistinct("file").alias("files"), F.min("k").alias("low"), F.max("k").alias("high"), F.min("file").alias("file")).collect()
    assert sorted((r["batch"], r["files"], r["low"], r["high"]) for r in found) == [(b, 1, 50 * b - 49, 50 * b) for b in range(1, 41)]
    writers = {re.search(r"part-(\d+)", r["file"]).group(1) for r in found}
    assert len(writers) >= 4
