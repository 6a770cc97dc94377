"""Many small files, one for each folder ``key=k``, written by the tasks themselves.

Without Hadoop's native library, Spark's writer starts four processes for a file on the local file system
(to set rights: 4,052 counted for 1,000 files), and its driver then renames all folders one by one. Here a
task writes a file with pyarrow under a name of its own and renames it into its folder, and one rename of
the whole tree makes the result visible. A repeated task writes the same files again, under the same names.
"""

import os
import shutil
import uuid
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

#: Folder for unfinished files; Spark's readers skip names that begin so.
UNFINISHED = "_temporary"


def _folder_writer(root: str, key: str, names: list[str], job: str, codec: str, footer: dict[str, str]):
    """Writes rows sorted by their first column, the key, to ``root/key=k/part-<task>-<job>.parquet``; gives the number of files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{job}.{codec}.parquet"
        unfinished = f"{root}/{UNFINISHED}/{task.partitionId()}-{task.taskAttemptId()}"
        writer, at, files = None, None, 0

        def finish():
            writer.close()
            os.makedirs(f"{root}/{key}={at}", exist_ok=True)
            os.rename(unfinished, f"{root}/{key}={at}/{name}")

        for batch in batches:
            keys = batch.column(0).to_numpy()
            schema = pa.schema([f.with_name(n) for f, n in zip(list(batch.schema)[1:], names, strict=True)], footer)
            rows = pa.RecordBatch.from_arrays(batch.columns[1:], schema=schema)
            for start, end in pairwise([0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), batch.num_rows]):
                if start == end:
                    continue
                if writer is None or keys[start] != at:
                    if writer is not None:
                        finish()
                    at, files = int(keys[start]), files + 1
                    writer = pq.ParquetWriter(unfinished, schema, compression=codec, write_page_checksum=True)
                writer.write_batch(rows.slice(start, end - start))
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_pydict({"files": [files]})

    return write


def write_folders(rows: DataFrame, path: str, key: str) -> None:
    """Replaces what is at the local ``path``; all rows of a ``key`` are in one partition, which is sorted by it.

    The old tree goes only when the new one is whole; a failed write leaves it as it was. The footer has
    the schema as Spark's files do, so ``spark.read.parquet`` gives the same columns and types.
    """
    spark, path, job = rows.sparkSession, os.path.realpath(path), uuid.uuid4().hex
    hidden = f"{os.path.dirname(path)}/_{os.path.basename(path)}-{job}"
    made, old = f"{hidden}.new", f"{hidden}.old"
    codec = {"uncompressed": "none", "lz4_raw": "lz4"}.get(c := spark.conf.get("spark.sql.parquet.compression.codec").lower(), c)
    schema = rows.drop(key).schema
    footer = {"org.apache.spark.version": spark.version, "org.apache.spark.sql.parquet.row.metadata": schema.json()}
    # mapInArrow does not take names with dots.
    sent = rows.select(key, *[f"`{n.replace('`', '``')}`" for n in schema.names]).toDF("key", *[f"c{i}" for i in range(len(schema))])
    os.makedirs(f"{made}/{UNFINISHED}")
    try:
        sent.mapInArrow(_folder_writer(made, key, schema.names, job, codec, footer), "files bigint").agg(F.sum("files")).collect()
        shutil.rmtree(f"{made}/{UNFINISHED}")
        open(f"{made}/_SUCCESS", "w").close()
        if os.path.lexists(path):
            os.rename(path, old)
        os.rename(made, path)
    except BaseException:
        shutil.rmtree(made, ignore_errors=True)
        if os.path.lexists(old) and not os.path.lexists(path):
            os.rename(old, path)
        raise
    shutil.rmtree(old, ignore_errors=True)
