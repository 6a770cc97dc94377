"""Session defaults and the shared folder used to cut lineage."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, UserDefinedType, VariantType, YearMonthIntervalType

#: Setting: tasks that text tables are dealt to before costly per-row work.
TEXT_TASKS = "lathe.text.tasks"


def build_session(app: str = "lathe", master: str | None = None, shuffle_partitions: int | None = None, text_tasks: int | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    On a cluster leave ``master`` and ``shuffle_partitions`` to the submit
    command: AQE coalesces small shuffles and splits skewed join partitions.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if text_tasks:
        b = b.config(TEXT_TASKS, str(text_tasks))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local folder is made only in local mode, where there is no other
    machine; a cluster without a named folder is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lathe-"))
    return sc.getCheckpointDir()


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as Python's own file calls take it; None if it is not on the local (or a mounted) file system."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = named.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(named).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def plain(kind: DataType) -> bool:
    """Whether pyarrow writes and reads all values of the type as Spark does."""
    if isinstance(kind, StructType):
        return all(plain(f.dataType) for f in kind)
    if isinstance(kind, MapType):
        return plain(kind.keyType) and plain(kind.valueType)
    if isinstance(kind, ArrayType):
        return plain(kind.elementType)
    return not isinstance(kind, (VariantType, YearMonthIntervalType, UserDefinedType))


def dealt(df: DataFrame) -> DataFrame:
    """The frame in as many tasks as the session's ``lathe.text.tasks`` says; unset (the default), as it is.

    For costly per-row work on files that Spark cannot split. It shuffles the
    rows, so whoever runs the job decides.
    """
    tasks = df.sparkSession.conf.get(TEXT_TASKS, None)
    return df.repartition(int(tasks)) if tasks else df


def usual_tasks(spark: SparkSession) -> int:
    """As many tasks as a shuffle has, and no fewer than there are cores: for small rows whose work AQE cannot see."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """Short rows that are costly to read, dealt to as many tasks as a shuffle has, and no fewer than there are cores.

    Millions of such rows fit in a file of a few megabytes, which Spark reads in
    one task; next to the work on them the shuffle costs little. The number is
    given, so AQE does not join the tasks again. ``lathe.text.tasks`` goes before it.
    """
    spark = df.sparkSession
    return df.repartition(int(spark.conf.get(TEXT_TASKS, None) or usual_tasks(spark)))


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """The frame written once to the shared folder and read back.

    For results that several later steps scan: they read only the columns
    they need, and a lost executor costs no recomputation of the plan. The
    folder's own retention removes it, like checkpoints.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, key: str, label: str = "bucketed") -> Iterator[DataFrame]:
    """The frame stored in as many buckets of ``key`` as a shuffle has partitions.

    Inside the block, a join on the key shuffles the other side only. The table's
    name goes at the end of the block; its files stay in the shared folder.
    """
    spark = df.sparkSession
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{label}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", fresh_dir(spark, label)).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"drop table {name}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
