"""Many small files, one or a few for each folder ``key=k``, listed by one task and read by many (A4)."""

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import usual_tasks

#: Names listed, and rows read, before they are handed on together.
AT_ONCE = 10_000
#: Beginnings of names that Spark's readers skip.
HIDDEN = ("_", ".")


def _folder_lister(root: str, key: str):
    """The folders ``key=k`` below ``root``; anything else there is an error, as it is for Spark."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        keys = []
        with os.scandir(root) as found:
            for name in (e.name for e in found if not e.name.startswith(HIDDEN)):
                if not name.startswith(f"{key}="):
                    raise ValueError(f"{root}/{name} is no folder of {key}")
                keys.append(int(name.removeprefix(f"{key}=")))
                if len(keys) == AT_ONCE:
                    yield pa.RecordBatch.from_pydict({key: pa.array(keys, pa.int64())})
                    keys = []
        yield pa.RecordBatch.from_pydict({key: pa.array(keys, pa.int64())})

    return listed


def _folder_reader(root: str, key: str, schema: pa.Schema):
    """All rows of all files of the folders named, in the columns of ``schema``, with the key and the file."""
    full = pa.schema([*schema, pa.field(key, pa.int64()), pa.field("file", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for k in (k for b in batches for k in b.column(0).to_pylist()):
            folder = f"{root}/{key}={k}"
            for path in (f"{folder}/{name}" for name in os.listdir(folder) if not name.startswith(HIDDEN)):
                with pa.OSFile(path) as f, pq.ParquetFile(f, coerce_int96_timestamp_unit="us", page_checksum_verification=True) as file:
                    for part in file.iter_batches(AT_ONCE, columns=schema.names, use_threads=False):
                        n = part.num_rows
                        columns = [part.column(c.name).cast(c.type) for c in schema]
                        held.append(pa.RecordBatch.from_arrays([*columns, pa.repeat(pa.scalar(k, pa.int64()), n), pa.repeat(path, n)], schema=full))
                        rows += n
                        if rows >= AT_ONCE:
                            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                            held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return read


def _some_file(root: str) -> str | None:
    with os.scandir(root) as folders:
        for folder in folders:
            if not folder.name.startswith(HIDDEN) and folder.is_dir():
                for name in os.listdir(folder.path):
                    if not name.startswith(HIDDEN):
                        return f"{folder.path}/{name}"
    return None


def folder_schema(spark: SparkSession, path: str, columns=None) -> StructType:
    """Columns (all, or those named) and types of the first file found below the local ``path``."""
    first = _some_file(path)
    if first is None:
        raise FileNotFoundError(f"no files in folders below {path}")
    found = spark.read.parquet(f"file://{first}")
    return (found.select(*columns) if columns else found).schema


def read_folders(spark: SparkSession, path: str, key: str, schema: StructType) -> DataFrame:
    """The rows below the local ``path`` with a bigint ``key`` and the ``file``."""
    out = StructType([*schema, StructField(key, LongType()), StructField("file", StringType())])
    folders = spark.range(0, 1, 1, 1).mapInArrow(_folder_lister(path, key), f"`{key}` bigint")
    return folders.repartition(usual_tasks(spark), key).mapInArrow(_folder_reader(path, key, to_arrow_schema(schema)), out)
