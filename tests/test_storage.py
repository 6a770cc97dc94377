"""Sources, sinks and streams on files."""

import pytest
from pyspark.sql import functions as F

from lathe.session import cut_lineage
from lathe.sinks import tables as B
from lathe.sources import tables as A
from lathe.streaming import incremental as M


@pytest.fixture
def products(spark):
    rows = [(i, ["Rugs", "Lamps", "Beds"][i % 3], f"u{i}", None if i % 4 == 0 else f"n{i}") for i in range(1, 31)]
    return spark.createDataFrame(rows, "ord bigint, category string, url string, name string")


def test_csv_round_trip_keeps_the_null_rule(spark, products, tmp_path):
    path = str(tmp_path / "flat")
    B.write_flat(products, path, "csv")
    back = A.read_flat(spark, path, "csv", products.columns)
    assert sorted((r["url"], r["name"]) for r in back.fillna("").collect()) == sorted((r["url"], r["name"] or "") for r in products.collect())


def test_banner_sheets(spark, tmp_path):
    (tmp_path / "Rugs.csv").write_text('Brand,Acme\nLink,"https://a, https://b"\n\nIndex,Product URL,Product Name\n1,https://a/1,"Red, big"\n,,\n2,,no url\n3,https://a/3,nan\n')
    (tmp_path / "Beds.csv").write_text("Brand,Acme\nLink,https://c\n\nIndex,Product URL,Product Name\n1,https://c/1,Bed\n")
    lines = A.number_lines(spark, str(tmp_path))
    rows = A.banner_rows(lines, 4, ["Index", "Product URL", "Product Name"])
    got = sorted((r["Category"], r["Product URL"], r["Product Name"] or "") for r in rows.collect())
    assert got == [("Beds", "https://c/1", "Bed"), ("Rugs", "https://a/1", "Red, big"), ("Rugs", "https://a/3", "")]
    assert {(r["sheet"], r["brand"], r["link"]) for r in A.banner_meta(lines).collect()} == {("Rugs", "Acme", "https://a, https://b"), ("Beds", "Acme", "https://c")}


def test_line_breaks_stay_in_their_cells(spark, tmp_path):
    """One file in many tasks against Python's own CSV reader."""
    import csv
    import random

    draw = random.Random(7)
    piece = ["a", ",", '"', "\n", "\r\n", " ", "é", "x" * 40]
    rows = [["Key", "Note", "More"]] + [[str(i), "".join(draw.choices(piece, k=draw.randint(0, 9))), draw.choice(["", "m"])] for i in range(1, 3000)]
    for name in ("One, two.csv", "Three.csv"):
        with open(tmp_path / name, "w", newline="", encoding="utf-8-sig") as f:
            csv.writer(f).writerows(rows)
    (tmp_path / "Empty.csv").write_text("")
    (tmp_path / "Other.csv").write_text("More,Key,Last\nm,7,z\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        records = A.number_lines(spark, str(tmp_path))
        assert records.rdd.getNumPartitions() > 20
        numbered = records.filter("sheet = 'Three'").select("line_no").collect()
        assert sorted(r[0] for r in numbered) == list(range(1, 3001))
        got = A.read_sheets(spark, str(tmp_path))
        assert got.columns == ["Key", "More", "Note", "Last", "Category"]
        got = got.fillna("").collect()
        for sheet in ("One, two", "Three"):
            same = sorted((int(r["Key"]), r["Note"], r["More"]) for r in got if r["Category"] == sheet)
            assert same == [(int(k), n, m) for k, n, m in rows[1:]]
        assert [(r["Key"], r["More"], r["Note"], r["Last"]) for r in got if r["Category"] == "Other"] == [("7", "m", "", "z")]
        assert not [r for r in got if r["Category"] == "Empty"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_banner_links_may_stand_on_lines_of_their_own(spark, tmp_path):
    (tmp_path / "Rugs.csv").write_text('Brand,Acme\nLink,"https://a\nhttps://b"\n\nIndex,Product URL,Product Name\n1,https://a/1,"Red ""wide""\nrug"\n')
    lines = A.number_lines(spark, str(tmp_path))
    row = A.banner_rows(lines, 4, ["Index", "Product URL", "Product Name"]).collect()[0]
    assert (row["line_no"], row["Product Name"]) == (5, 'Red "wide"\nrug')
    assert A.banner_meta(lines).collect()[0]["link"] == "https://a\nhttps://b"


def test_sheets_stamp_their_category(spark, tmp_path):
    (tmp_path / "Rugs.csv").write_text("Product URL\nhttps://a/1\n")
    (tmp_path / "Beds.csv").write_text("Product URL\nhttps://c/1\n")
    got = A.read_sheets(spark, str(tmp_path), ["Product URL"])
    assert {(r["Category"], r["Product URL"]) for r in got.collect()} == {("Rugs", "https://a/1"), ("Beds", "https://c/1")}
    both = A.union_sheets({"Rugs": got.drop("Category").limit(1), "Beds": got.drop("Category").limit(1)})
    assert both.groupBy("Category").count().count() == 2


def test_category_output_is_numbered(spark, products, tmp_path):
    B.write_by_category(products, str(tmp_path / "o"), "category", "ord")
    for r in spark.read.parquet(str(tmp_path / "o")).groupBy("category").agg(F.sort_array(F.collect_list("Index")).alias("i")).collect():
        assert r["i"] == list(range(1, 11))


def test_replace_touches_only_its_categories(spark, products, tmp_path):
    path = str(tmp_path / "o")
    B.replace_categories(products, path, "category")
    B.replace_categories(products.filter("category = 'Rugs' and ord < 10"), path, "category")
    got = {r["category"]: r["count"] for r in spark.read.parquet(path).groupBy("category").count().collect()}
    assert got == {"Rugs": 3, "Lamps": 10, "Beds": 10}


def test_upsert_twice_is_once(spark, products, tmp_path):
    path = str(tmp_path / "o")
    B.upsert_by_category(products.filter("ord < 20"), path, "category", "url", "ord")
    changed = products.withColumn("name", F.lit("changed"))
    for _ in range(2):
        B.upsert_by_category(changed, path, "category", "url", "ord")
    got = {r["url"]: r["name"] for r in spark.read.parquet(path).collect()}
    assert len(got) == 30
    assert all((got[f"u{i}"] == "changed") == (i >= 20) for i in range(1, 31))


def test_batch_files_hold_fifty_rows(spark, tmp_path):
    B.write_batches(spark.range(120).coalesce(1), str(tmp_path / "b"), 50)
    got = A.read_batches(spark, str(tmp_path / "b"), "*.parquet").groupBy("source_file").count().collect()
    assert sorted(r["count"] for r in got) == [20, 50, 50]


def test_report_master_and_dead_letters(spark, products, tmp_path):
    done = products.filter("ord > 5").select("url", F.lit("x").alias("detail"))
    rows = B.with_status(products, done, "url")
    assert rows.count() == 30
    B.write_dead_letters(rows, str(tmp_path / "dead"))
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 5
    B.write_report(rows, rows.groupBy("status").count(), str(tmp_path / "rep"))
    assert spark.read.parquet(str(tmp_path / "rep/summary")).count() == 2
    B.write_master_and_categories(products, str(tmp_path / "m"), "category", "ord")
    assert spark.read.parquet(str(tmp_path / "m/by_category")).count() == spark.read.parquet(str(tmp_path / "m/master")).count() == 30


def test_sheet_meta(spark):
    dim = A.category_dim(spark, {"Rugs": {"links": ["a", "b"]}, "Beds": {"links": []}})
    got = {r["category"]: r["link"] for r in B.sheet_meta(dim, "Acme").collect()}
    assert got == {"Rugs": "a, b", "Beds": ""}


def test_stream_resumes_with_new_files_only(spark, products, tmp_path):
    src, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    products.filter("ord <= 10").write.parquet(src + "/a")

    def run():
        s = M.landing_stream(spark, src + "/*", products.schema)
        M.append_stream(M.first_sightings(s, "url"), out, state).awaitTermination()

    run()
    products.filter("ord between 8 and 20").write.parquet(src + "/b")
    run()
    got = [r["url"] for r in spark.read.schema(products.schema).parquet(out).collect()]
    assert sorted(got) == sorted(f"u{i}" for i in range(1, 21))


def test_stream_upsert_equals_batch(spark, products, tmp_path):
    src = str(tmp_path / "in")
    products.repartition(4).write.parquet(src)
    s = M.landing_stream(spark, src, products.schema, files_per_batch=1)
    M.upsert_stream(s, str(tmp_path / "s"), str(tmp_path / "c"), "category", "url", "ord").awaitTermination()
    B.upsert_by_category(products, str(tmp_path / "b"), "category", "url", "ord")
    read = lambda p: sorted((r["url"], r["name"] or "", r["ord"]) for r in spark.read.parquet(str(tmp_path / p)).collect())
    assert read("s") == read("b")


def test_retry_rounds(spark):
    tries = spark.createDataFrame([("a", False), ("a", False), ("b", False), ("b", True), ("c", False)], "url string, ok boolean")
    assert [r["url"] for r in M.retry_round(M.attempt_counts(tries, "url", "ok"), 2).collect()] == ["c"]


def test_lineage_cut_reads_the_shared_folder(spark, products):
    df = cut_lineage(products)
    assert df.count() == 30
    assert spark.sparkContext.getCheckpointDir()


def test_upsert_keeps_every_row(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(None, "a", 1, "x"), ("007", "a", 2, "x"), ("7", "a", 3, "x"), ("c", None, 4, "x")], "category string, url string, ord int, extra string")
    second = spark.createDataFrame([(None, "a", 9, "n"), (None, "b", 5, "n"), ("007", "a", 9, "n"), ("d", "a", 6, "n"), ("c", None, 9, "n")], "category string, url string, ord int, fresh string")
    for batch in (first, second, second):
        B.upsert_by_category(batch, path, "category", "url", "ord")
    rows = spark.read.option("mergeSchema", True).schema("url string, ord int, extra string, fresh string, category string").parquet(path).collect()
    got = sorted((repr((r["category"], r["url"], r["ord"], r["extra"], r["fresh"])) for r in rows))
    assert got == sorted(map(repr, [(None, "a", 1, "x", None), ("007", "a", 2, "x", None), ("7", "a", 3, "x", None), ("c", None, 4, "x", None), (None, "b", 5, None, "n"), ("d", "a", 6, None, "n")]))


def test_late_sightings_survive(spark, tmp_path):
    schema = "url string, landed timestamp"
    batches = [[("a", "2025-05-01 00:00:00"), ("b", "2025-05-01 00:00:00")], [("late", "2020-01-01 00:00:00"), ("a", "2020-01-01 00:00:00")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "url string, landed string").selectExpr("url", "cast(landed as timestamp) as landed").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        s = M.landing_stream(spark, str(tmp_path / "in/*"), schema, files_per_batch=1)
        M.sightings_stream(s, str(tmp_path / "rows"), str(tmp_path / "state"), "url", "landed").awaitTermination()
    assert sorted(r["url"] for r in spark.read.parquet(str(tmp_path / "rows")).collect()) == ["a", "b", "late"]


def test_blank_category_is_null_and_replays_add_nothing(spark, tmp_path):
    path = str(tmp_path / "cats")
    rows = spark.createDataFrame([("", "a", 1), (None, "b", 2), ("x", "a", 3)], "category string, key string, ord int")
    for _ in range(3):
        B.upsert_by_category(rows, path, "category", "key", "ord")
    assert sorted(map(tuple, spark.read.parquet(path).select("category", "key").collect()), key=str) == [("x", "a"), (None, "a"), (None, "b")]


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    from lathe.streaming.incremental import landing_stream, sightings_stream

    for name, keys in (("one", ["x", "x", "y"]), ("two", ["y", "z"])):
        spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, at int").write.parquet(str(tmp_path / name))
        stream = landing_stream(spark, str(tmp_path / name), "key string, at int")
        sightings_stream(stream, str(tmp_path / "seen"), str(tmp_path / f"state-{name}"), "key", "at").awaitTermination()
    assert sorted(r["key"] for r in spark.read.parquet(str(tmp_path / "seen")).collect()) == ["x", "y", "z"]


def test_numbered_batches_are_whole_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from lathe.sinks.tables import write_numbered_batches

    write_numbered_batches(spark.range(1234).select(F.expr("(id * 7) % 1234").alias("k")).repartition(9), str(tmp_path / "b"), "k", 50)
    back = spark.read.parquet(str(tmp_path / "b")).select("k", "batch", F.input_file_name().alias("f")).collect()
    assert len(back) == 1234 and all(r["batch"] == r["k"] // 50 + 1 for r in back)
    assert len({r["f"] for r in back}) == len({r["batch"] for r in back}) == 25
