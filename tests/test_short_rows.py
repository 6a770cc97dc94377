"""Short rows in one small file: read in many tasks, and each text cut once."""

import pytest
from pyspark.sql import functions as F

from lathe.queries.registry import texts
from lathe.spec import attrs as A
from lathe.spec import lines as L

RULED = "Weight (lb): 9\nDimension (IN): W1 D2\"\nSeat Height (IN) 18\nNumber of Cushions: 2\nNumber of Cushions: 3\nStandard Cushion: foam\nStandard Cushion: down\nContent: oak\nColor: red\nColor: other"
SHEET = "Body Material: oak\nColor: red\nPowder Coat: black\nColor: blue\nMade in: Italy\nempty:"
LIGHT = "Finish\nbrass\nColor Temperature\nwarm\n2700 K\nSocket Type\nE26\nWattage\n40W"
PIPED = "Item Weight: 9 lb | ARM WIDTH: 4 | Seat Arm Width: about | COM: 1 | Shade Included?: yes"


def test_a_small_file_is_read_in_many_tasks(spark, tmp_path):
    spark.range(500).withColumn("p_name", F.lit("x")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    plain = spark.read.parquet(f"{tmp_path}/part.parquet")
    rows = texts(spark, str(tmp_path), "part")
    sizes = [r[1] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert plain.rdd.getNumPartitions() == 1
    assert sum(sizes) == 500 and len(sizes) >= 8 and max(sizes) < 100
    assert rows.select("id").exceptAll(plain.select("id")).isEmpty()


@pytest.mark.parametrize(
    "read, text, field, value",
    [
        (L.ordered_line_rules, RULED, "cushion", "3, down"),
        (L.ordered_line_rules, RULED, "color", "red"),
        (L.sheet_attributes, SHEET, "finish", "blue"),
        (L.sheet_attributes, SHEET, "shade", None),
        (A.lighting_lines, LIGHT, "color_temperature", "2700 K"),
        (A.pipe_fields, PIPED, "arm_width", "about"),
        (A.pipe_fields, PIPED, "weight", "9"),
        (lambda c: {"block": L.block_after(c, "Shade", ["Canopy"])}, "Shade:\na\nb\nCanopy\nc", "block", "a b"),
        (lambda c: {"map": F.try_element_at(A.measure_map(c), F.lit("Seat Height"))}, "Seat Height 18 seat height: 19", "map", "18"),
    ],
)
def test_a_text_is_cut_once_for_a_field(spark, read, text, field, value):
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    one = df.select(read(F.col("t"))[field].alias("v"))
    assert [r["v"] for r in one.collect()] == [value, None, None]
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    cuts = plan.count("split(") + plan.count("regexp_extract_all(")
    # Two readings of the socket and wattage labels aside, a field needs the text's parts once.
    assert cuts == 1
