"""Incremental work as streams (M1-M4)."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.rx import is_blank
from ..operators.dedup import append_old_wins, keep_first
from ..session import stored
from ..sinks.tables import upsert_by_category, written


def landing_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Files as they land; ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def first_sightings(stream: DataFrame, key: str, landed: str | None = None, horizon: str | None = None) -> DataFrame:
    """M1: rows whose key was not seen before; state keeps every key.

    With ``landed`` and ``horizon``, keys older than the horizon are forgotten
    and rows older than it dropped; only where that is wanted. To keep late
    rows without growing state use ``sightings_stream``.
    """
    named = stream.filter(~is_blank(key))
    if landed and horizon:
        named = named.withColumn(landed, F.col(landed).cast("timestamp"))
        return named.withWatermark(landed, horizon).dropDuplicatesWithinWatermark([key])
    return named.dropDuplicates([key])


def sightings_stream(stream: DataFrame, path: str, checkpoint: str, key: str, order, once: bool = True) -> StreamingQuery:
    """M1: rows of keys that the written table does not have, however late they land; no state.

    What is there stays, also for a new checkpoint; replays change nothing. A
    batch finds its own keys in the table first, so Spark may send a small
    batch to the table instead of shuffling the table.
    """
    schema = stream.schema

    def add(batch: DataFrame, batch_id: int) -> None:
        fresh = keep_first(batch.filter(~is_blank(key)), key, order)
        done = written(batch.sparkSession, path, schema)
        if done is not None:
            fresh = stored(fresh, "batch")
            known = done.select(key).join(fresh.select(key), key, "left_semi").distinct()
            fresh = fresh.join(known, key, "left_anti")
        fresh.write.mode("append").parquet(path)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def discovered_urls(seeds: DataFrame, found: DataFrame, url: str) -> DataFrame:
    """M3: seeds and discovered URLs join the queue once, ignoring case; a stream's state keeps every URL, see ``discovered_stream``."""
    return _urls(seeds, found, url).dropDuplicates([url])


def discovered_stream(seeds: DataFrame, found: DataFrame, url: str, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """M3 without state: the queue is the written table, which a batch is compared with. A new checkpoint loses and repeats nothing."""
    return sightings_stream(_urls(seeds, found, url), path, checkpoint, url, [url], once)


def _urls(seeds: DataFrame, found: DataFrame, url: str) -> DataFrame:
    both = seeds.select(F.lower(F.trim(F.col(url))).alias(url)).union(found.select(F.lower(F.trim(F.col(url))).alias(url)))
    return both.filter(~is_blank(url))


def attempt_counts(attempts: DataFrame, key: str, ok: str) -> DataFrame:
    """M4: attempts and success per key; a stateful aggregate in a stream, a plain one in batch."""
    return attempts.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.max(F.col(ok).cast("int")).alias("done"))


def retry_round(counts: DataFrame, max_attempts: int) -> DataFrame:
    """M4: keys still to try."""
    return counts.filter((F.col("done") == 0) & (F.col("attempts") < max_attempts))


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, category: str, key: str, order, once: bool = True) -> StreamingQuery:
    """M2: every micro-batch is merged into its categories; replaying a batch changes nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_by_category(batch, path, category, key, order)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def append_stream(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """M1: new rows appended with exactly-once files; a restart resumes from the checkpoint."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def enrich_new(todo: DataFrame, done: DataFrame, key: str, order, step) -> DataFrame:
    """M1 in batch: only unseen keys go through ``step``; previous rows win."""
    from ..operators.joins import pending

    return append_old_wins(done, step(pending(todo, done, key)), key, order)
