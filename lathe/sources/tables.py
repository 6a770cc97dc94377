"""Landed tables, sheets, batch files, collections and configuration."""

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.numbers import price_two_places
from ..functions.rx import as_col, blank_to_null, first_present, present
from ..functions.text import html_to_text
from ..functions.urls import valid_url
from ..operators.ordered import top_n
from ..operators.projection import to_raw
from ..session import local_path, plain, stored
from ..spec.lines import sheet_attributes
from .numbered import folder_schema, read_folders


def read_flat(spark: SparkSession, path: str, fmt: str = "parquet", columns=None) -> DataFrame:
    """A1: header row 1, all text, null rule applied. CSV cells may hold line breaks; see ``sheet_table``."""
    df = sheet_table(spark, path, 1, columns).drop("Category") if fmt == "csv" else spark.read.format(fmt).load(path)
    return to_raw(df)


def read_batches(spark: SparkSession, folder: str, pattern: str = "batch_*.parquet") -> DataFrame:
    """A4: all batch files of a folder, with the file each row came from."""
    df = spark.read.option("pathGlobFilter", pattern).parquet(folder)
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def read_numbered_batches(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """A4: the rows of all files in the folders ``batch=k``, with ``batch`` and the ``file`` each came from.

    Spark's reader keeps every folder and file on the driver and starts a task for each folder to list them. Here, on
    the local file system, one task lists the folders and as many as a shuffle has read them (``sources.numbered``).
    """
    if (local := local_path(spark, path)) is not None and plain(schema := folder_schema(spark, local, columns)):
        return read_folders(spark, local, "batch", schema)
    rows = spark.read.parquet(path).withColumns({"batch": F.col("batch").cast("bigint"), "file": F.input_file_name()})
    return rows.select(*columns, "batch", "file") if columns else rows


def read_sheets(spark: SparkSession, folder: str, columns=None, key: str | None = None) -> DataFrame:
    """A3: the rows of all CSV sheets; the file name (or the folder ``key=...``) is the category."""
    return sheet_table(spark, folder, 1, columns, key)


def union_sheets(sheets: dict[str, DataFrame], category: str = "Category") -> DataFrame:
    """A3 for frames at hand."""
    from ..operators.report import union_all

    return union_all([df.withColumn(category, F.lit(name)) for name, df in sheets.items()])


def _quote_scan(batches):
    """Adds to (path, block, quotes, ...) each line's place in its block, whether a quote stands open
    before it, and the records begun so far if the block began outside or inside a cell.

    A block is one split of a file, and a task sees its lines in order.
    """
    last, place, quotes, outside, inside = None, 0, 0, 0, 0
    for batch in batches:
        path, block, held = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        code = path.dictionary_encode().indices.to_numpy()
        new = np.flatnonzero((np.diff(code) != 0) | (np.diff(block) != 0)) + 1
        found = []
        for start, end in pairwise([0, *new.tolist(), batch.num_rows]):
            if start == end:
                continue
            if (path[start].as_py(), block[start]) != last:
                last, place, quotes, outside, inside = (path[start].as_py(), block[start]), 0, 0, 0, 0
            count = held[start:end]
            is_open = (quotes + np.cumsum(count) - count) & 1
            begun_inside = inside + np.cumsum(is_open)
            begun_outside = outside + np.cumsum(1 - is_open)
            found.append((place + np.arange(end - start), is_open, begun_outside, begun_inside))
            place, quotes, outside, inside = place + end - start, quotes + int(count.sum()), int(begun_outside[-1]), int(begun_inside[-1])
        added = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 4
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "place", "open", "outside", "inside"])


def _scanned(lines: DataFrame) -> DataFrame:
    known = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema)
    return lines.mapInArrow(_quote_scan, f"{known}, place bigint, open bigint, outside bigint, inside bigint")


def sheet_records(spark: SparkSession, folder: str) -> DataFrame:
    """A1-A3 landing: (path, line_no, line), one row per CSV record, numbered from 1 in its file.

    A record may go over several lines: a line break between an odd and an
    even quote belongs to its cell. Files are read in splits, so one large file
    is many tasks. A split does not know whether it begins inside a cell; it
    counts its quotes and the records begun under either assumption, and sums
    over the splits before it, one row each, tell which one holds. Only
    records of several lines are shuffled. Line breaks are kept as they
    are in cells; a byte order mark goes. Empty lines are records; an empty
    file has none. A quote that is never closed makes the rest of its file
    one record, as it does for any CSV reader.
    """
    text = spark.read.option("lineSep", "\n").text(folder)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), quotes.cast("bigint").alias("quotes"), F.col("value").alias("line"))
    totals = _scanned(lines.drop("line")).groupBy("path", "block").agg(F.sum("quotes").alias("quotes"), F.max("outside").alias("outside"), F.max("inside").alias("inside"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    began = totals.withColumn("began", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    began = began.withColumn("records", F.when(F.col("began") == 0, F.col("outside")).otherwise(F.col("inside")))
    began = stored(began.select("path", "block", "began", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("records")), "splits")
    each = _scanned(lines).join(began, ["path", "block"])
    each = each.withColumn("line_no", F.col("records") + F.when(F.col("began") == 0, F.col("outside")).otherwise(F.col("inside")))
    starts, odd = F.col("open") == F.col("began"), F.col("quotes") % 2 == 1
    whole = each.filter(starts & ~odd).select("path", "line_no", "line")
    parts = each.filter(~(starts & ~odd)).groupBy("path", "line_no").agg(F.sort_array(F.collect_list(F.struct("block", "place", "line"))).alias("parts"))
    joined = parts.select("path", "line_no", F.array_join("parts.line", "\n").alias("line"))
    clean = F.regexp_replace(F.when(F.col("line_no") == 1, F.regexp_replace("line", "^\ufeff", "")).otherwise(F.col("line")), r"\r$", "")
    return whole.unionByName(joined).withColumn("line", clean)


def sheet_of(path, key: str | None = None) -> Column:
    """Sheet of a file: its name without ``.csv``, or the value of the folder ``key=...``."""
    at = F.regexp_extract(path, r"([^/]*?)(?:\.csv)?$", 1) if key is None else F.regexp_extract(path, f"/{key}=([^/]*)/", 1)
    return F.url_decode(F.replace(at, F.lit("+"), F.lit("%2B")))


def number_lines(spark: SparkSession, folder: str, key: str | None = None) -> DataFrame:
    """A2 landing: (sheet, line_no, line) of exported sheets; a line is a sheet's row, whatever line breaks its cells hold."""
    return sheet_records(spark, folder).select(sheet_of("path", key).alias("sheet"), "line_no", "line")


def _cells(line, names) -> Column:
    return F.from_csv(line, _ddl(names), {"escape": '"', "maxCharsPerColumn": "-1"})


def sheet_table(spark: SparkSession, folder: str, header_row: int = 1, columns=None, key: str | None = None) -> DataFrame:
    """A1/A3: rows below each file's own header, cells found by name, all text.

    ``columns`` are the names to read (default: all names of all headers, in
    order of place, then name); one that a file lacks is NULL there, of
    a name that stands twice the first counts. Empty lines go.
    """
    records = sheet_records(spark, folder)
    heads = records.filter(F.col("line_no") == header_row)
    width = heads.agg(F.max(F.size(F.split("line", ",")))).first()[0] or 1
    places = [f"c{i}" for i in range(width)]
    names = F.transform(F.array(*[F.col(f"r.{p}") for p in places]), lambda c: F.trim(c))
    heads = stored(heads.select("path", _cells("line", places).alias("r")).select("path", names.alias("names")), "headers")
    if columns is None:
        found = heads.select(F.posexplode("names").alias("pos", "name")).filter("name <> ''").groupBy("name").agg(F.min("pos").alias("pos"))
        columns = [r["name"] for r in found.orderBy("pos", "name").collect()]
    body = records.filter((F.col("line_no") > header_row) & (F.col("line") != "")).select("path", _cells("line", places).alias("r"))
    body = body.join(heads, "path").withColumn("cells", F.array(*[F.col(f"r.{p}") for p in places]))
    each = [F.expr("get(cells, cast(array_position(names, {}) - 1 as int))".format(_text(c))).alias(c) for c in columns]
    return body.select(*each, sheet_of("path", key).alias("Category"))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def banner_rows(lines: DataFrame, header_row: int, columns, url: str = "Product URL") -> DataFrame:
    """A2: data rows below the banner; blank rows and rows without a URL go."""
    body = lines.filter((F.col("line_no") > header_row) & ~F.col("line").rlike(r"^[\s,]*$"))
    rows = body.select("sheet", "line_no", _cells("line", columns).alias("r")).select("sheet", "line_no", "r.*")
    rows = rows.select(F.col("sheet").alias("Category"), "line_no", *[present(f"`{c}`").alias(c) for c in columns])
    return rows.filter(valid_url(f"`{url}`"))


def _ddl(columns) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def banner_meta(lines: DataFrame) -> DataFrame:
    """Brand and links of each sheet, from the cells B1 and B2."""
    cells = lines.filter(F.col("line_no") <= 2).select("sheet", "line_no", _cells("line", ["a", "b"]).alias("r"))
    return cells.groupBy("sheet").agg(F.min_by(F.when(F.col("line_no") == 1, F.col("r.b")), F.when(F.col("line_no") == 1, 1)).alias("brand"), F.min_by(F.when(F.col("line_no") == 2, F.col("r.b")), F.when(F.col("line_no") == 2, 1)).alias("link"))


# --- A5 collection JSON ---------------------------------------------------

VARIANT = "struct<id:bigint,sku:string,price:string,option1:string,option2:string,option3:string>"
PRODUCT = (
    "struct<handle:string,title:string,body_html:string,product_type:string,tags:array<string>,"
    f"images:array<struct<src:string,variant_ids:array<bigint>>>,options:array<struct<name:string>>,variants:array<{VARIANT}>>"
)
COLLECTION = f"struct<products:array<{PRODUCT}>>"


def collection_products(df: DataFrame, json_col: str) -> DataFrame:
    """A5: one row per product of each collection page, with its position."""
    rest = [c for c in df.columns if c != json_col]
    parsed = df.select(*rest, F.from_json(json_col, f"products array<{PRODUCT}>").alias("__j"))
    return parsed.select(*rest, F.posexplode("__j.products").alias("pos", "product"))


def finish_values(product) -> Column:
    """G6 inside one product: distinct values of its colour or finish option, in order."""
    p = as_col(product)
    named = F.transform(p["options"], lambda o: F.lower(o["name"]).isin("color", "finish", "colour"))
    at = F.array_position(named, True)
    values = F.transform(p["variants"], lambda v: F.trim(F.when(at == 1, v["option1"]).when(at == 2, v["option2"]).when(at == 3, v["option3"])))
    return F.array_join(F.array_distinct(F.filter(values, lambda v: v != "")), ", ")


def product_columns(df: DataFrame, site: str) -> DataFrame:
    """A5: listing columns of each product."""
    p = F.col("product")
    first = F.get(p["variants"], F.lit(0))
    rest = [c for c in df.columns if c != "product"]
    return df.filter(present("product.handle").isNotNull()).select(
        *rest,
        p["handle"].alias("handle"),
        F.concat(F.lit(f"{site}/products/"), p["handle"]).alias("source"),
        F.trim(p["title"]).alias("product_name"),
        present(first["sku"]).alias("sku"),
        price_two_places(first["price"]).alias("price"),
        F.get(p["images"], F.lit(0))["src"].alias("image_url"),
        html_to_text(p["body_html"]).alias("description"),
        p["product_type"].alias("product_type"),
        blank_to_null(finish_values("product")).alias("finish"),
        F.array_join(p["tags"], ", ").alias("tags"),
    )


def variant_rows(df: DataFrame) -> DataFrame:
    """One row per variant with label, price and its own image."""
    from ..operators.joins import variant_image
    from ..operators.report import variant_label

    rest = [c for c in df.columns if c != "product"]
    v = df.select(*rest, "product", F.posexplode_outer("product.variants").alias("variant_pos", "variant"))
    default = F.get(F.col("product.variants"), F.lit(0))["price"]
    return v.select(
        *rest,
        F.col("product.handle").alias("handle"),
        "variant_pos",
        F.col("variant.sku").alias("sku"),
        first_present("variant.price", default).alias("price"),
        variant_label("variant.option1", "variant.option2", "variant.option3").alias("variant_label"),
        variant_image("product.images", "variant.id").alias("image_url"),
    )


# --- A10-A12 --------------------------------------------------------------


def spec_sheets(df: DataFrame, ids, text_col: str) -> DataFrame:
    """A10: attributes of extracted spec-sheet text."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    return df.select(*ids, *[c.alias(n) for n, c in sheet_attributes(text_col).items()])


def category_dim(spark: SparkSession, config: dict[str, dict]) -> DataFrame:
    """Configured categories in order, with links, de-duplication scope and type filter."""
    rows = [(name, i, c.get("links", []), c.get("scope", "local"), c.get("type_filter")) for i, (name, c) in enumerate(config.items())]
    return spark.createDataFrame(rows, "category string, ord int, links array<string>, dedup_scope string, type_filter string")


def category_links(dim: DataFrame) -> DataFrame:
    """One row per link, in order."""
    return dim.select("category", "ord", F.posexplode("links").alias("link_pos", "link"))


def find_vendor(tracker: DataFrame, text: str, order, vendor: str = "Vendor", regex: bool = False) -> DataFrame:
    """First tracker row whose vendor contains the text, ignoring case."""
    hit = F.col(vendor).rlike(f"(?i){text}") if regex else F.lower(F.col(vendor)).contains(text.lower())
    return top_n(tracker.filter(hit), 1, order)
