"""Name -> (Spark callable, oracle SQL) registry behind ``__spark_entry__``."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import dealt, spread


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}

#: Tables whose rows are whole texts: their files have many splits.
LONG = ("pages", "documents")


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in ENTRIES:
            raise ValueError(f"duplicate query {name}")
        ENTRIES[name] = Entry(fn, sql)
        return fn

    return add


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are costly to read: long ones (pages, documents) see ``dealt``, short ones ``spread``."""
    rows = table(spark, sf_dir, name)
    return dealt(rows) if name in LONG else spread(rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
