"""Outputs: flat, per category, upsert, batches, reports."""

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.rx import as_col, present
from ..operators.dedup import keep_first
from ..operators.ordered import batch_number, running_index, sheet_order
from ..operators.projection import to_export
from ..session import local_path, plain, usual_tasks
from .numbered import write_folders

SHEET_NAME_LIMIT = 31


def write_flat(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The commit protocol makes the write atomic; CSV shows NULL as blank."""
    if fmt == "csv":
        to_export(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def sheet_name(c, ellipsis: bool = False) -> Column:
    """Forbidden characters to blanks, cut to 31 characters (or 28 and dots)."""
    name = F.regexp_replace(as_col(c), r"[\\/*?:\[\]]", " ")
    if ellipsis:
        return F.when(F.length(name) > SHEET_NAME_LIMIT, F.concat(F.substring(name, 1, SHEET_NAME_LIMIT - 3), F.lit("..."))).otherwise(name)
    return F.substring(name, 1, SHEET_NAME_LIMIT)


def sheet_name_clashes(df: DataFrame, category: str) -> DataFrame:
    """Sheet names that stand for more than one category after the cut."""
    names = df.select(category).distinct().withColumn("sheet", sheet_name(category))
    return names.groupBy("sheet").agg(F.count(F.lit(1)).alias("categories")).filter(F.col("categories") > 1)


def category_rows(df: DataFrame, category: str, order) -> DataFrame:
    """B2: rows with their Index inside the category, skew-safe."""
    return running_index(df, order, [category], "Index")


def sheet_list(df: DataFrame, category: str, order: str, category_dim: DataFrame | None = None) -> DataFrame:
    """Sheets with rows, in configured order or by first appearance. Empty categories vanish."""
    seen = sheet_order(df, category, order)
    if category_dim is None:
        return seen.select(category, "sheet_ord")
    dim = category_dim.select(F.col("category").alias("__c"), F.col("ord").alias("__o"))
    return seen.join(dim, F.col(category) == F.col("__c"), "left").select(category, F.coalesce(F.col("__o"), F.col("sheet_ord")).cast("bigint").alias("sheet_ord"))


def brand_category_links(df: DataFrame, brand: str, category: str, link: str, order: str) -> DataFrame:
    """Sorted (brand, category) groups with the link of their first row; missing keys dropped."""
    ok = df.filter(present(brand).isNotNull() & present(category).isNotNull())
    return ok.groupBy(brand, category).agg(F.min_by(link, order).alias(link)).orderBy(brand, category)


def sheet_meta(category_dim: DataFrame, brand: str, separator: str = ", ") -> DataFrame:
    """Banner sidecar (category, brand, links, date)."""
    return category_dim.select("category", F.lit(brand).alias("brand"), F.array_join("links", separator).alias("link"), F.lit(date.today().isoformat()).alias("scraped"))


def write_by_category(df: DataFrame, path: str, category: str, order) -> None:
    """B2: one folder per category."""
    category_rows(df, category, order).hint("rebalance", category).write.mode("overwrite").partitionBy(category).parquet(path)


def replace_categories(df: DataFrame, path: str, category: str) -> None:
    """Only the categories in ``df`` are replaced; ``df`` must not read them.

    The rebalance hint gives each category few files and lets AQE cut a large
    category into several tasks.
    """
    df.hint("rebalance", category).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(category).parquet(path)


def stored_categories(spark: SparkSession, path: str, category: str) -> DataFrame | None:
    """Rows written per category so far, columns of all files together; None before the first write.

    The category is read as the text that names its folder: "007" stays "007".
    """
    try:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException as missing:  # nothing written yet
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    fields = [StructField(f.name, StringType()) if f.name == category else f for f in found]
    return spark.read.schema(StructType(fields)).parquet(path)


def written(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The rows written so far; None before the first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def upsert_by_category(new: DataFrame, path: str, category: str, key: str, order) -> None:
    """Previous rows win, so rows of unseen (category, key) pairs are appended and nothing is rewritten.

    NULL is a category and a key like any other; an empty category is NULL, as
    its folder could not tell them apart. A column that only the stored
    or only the new rows have stays, NULL for the others. Writing the same
    rows twice changes nothing; a failed write leaves the table as it was. The
    rebalance hint gives each category few files and cuts a large one.
    """
    fresh = keep_first(new.withColumn(category, F.nullif(F.col(category).cast("string"), F.lit(""))), [category, key], order)
    old = stored_categories(new.sparkSession, path, category)
    if old is not None:
        seen = old.select(F.col(category).alias("__c"), F.col(key).alias("__k"))
        fresh = fresh.join(seen, F.col(category).eqNullSafe(F.col("__c")) & F.col(key).eqNullSafe(F.col("__k")), "left_anti")
    fresh.hint("rebalance", category).write.mode("append").partitionBy(category).parquet(path)


def write_numbered_batches(df: DataFrame, path: str, order, rows_per_file: int = 50) -> None:
    """Folder ``batch=k`` holds the rows k * n - n + 1 to k * n of the order, in one file, sorted.

    Files cost more than their rows, so the number of tasks is given: AQE would join the small ones. On the local
    file system tasks write the files themselves (``sinks.numbered``); elsewhere, and columns of types that pyarrow does
    not know, Spark writes them.
    """
    placed = batch_number(df, order, rows_per_file, "batch")
    names = [order] if isinstance(order, str) else list(order)
    rows = placed.repartitionByRange(usual_tasks(df.sparkSession), "batch").sortWithinPartitions("batch", *names)
    if (local := local_path(df.sparkSession, path)) is not None and plain(rows.schema):
        write_folders(rows, local, "batch")
    else:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").parquet(path)


def write_batches(df: DataFrame, path: str, rows_per_file: int = 50) -> None:
    """Files of a fixed number of rows."""
    df.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_report(detail: DataFrame, summary: DataFrame, path: str) -> None:
    """B10."""
    detail.write.mode("overwrite").parquet(f"{path}/detail")
    summary.write.mode("overwrite").parquet(f"{path}/summary")


def with_status(listing: DataFrame, detail: DataFrame, url: str) -> DataFrame:
    """Every listing row stays; without a detail it is failed and its fields are blank."""
    marked = detail.withColumn("__found", F.lit(True))
    joined = listing.join(marked, url, "left")
    return joined.withColumn("status", F.when(F.col("__found"), "success").otherwise("failed")).drop("__found")


def write_dead_letters(df: DataFrame, path: str) -> None:
    """B11."""
    df.filter(F.col("status") == "failed").write.mode("overwrite").parquet(path)


def write_master_and_categories(df: DataFrame, path: str, category: str, order) -> None:
    """Master table, then the category folders read from it, so the plan runs once."""
    df.write.mode("overwrite").parquet(f"{path}/master")
    write_by_category(df.sparkSession.read.parquet(f"{path}/master"), f"{path}/by_category", category, order)
