"""Exact duplicates by sorting contents. Native: expressions and sorts only.

Texts are normalised (A-Z to lower case), cut into ranges by sampled
splitters, sorted inside each range, and neighbours compared whole. Splitters
are sampled over the first characters and a digest of the text, so a shared
opening does not gather in one range and samples stay short. Texts that more
rows than a range holds are told by a count that combines before the shuffle;
their rows are dealt by their place in the input, whatever their ids, to as
many salts as they would fill ranges, and the totals over the salts, one row
each, go back to every salt. All other texts are done after the sort.

Defined cases: a null text counts as empty; equal ids in a group count as rows
of their own, and the row kept is one whose id is the largest (all of them, if
it repeats); a null id is smaller than any other; a group of null ids keeps
id null; other columns, whatever their names, are not read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of a text that splitters are sampled over, before its digest.
HEAD = 32


def normalised(text: Column) -> Column:
    """A-Z to lower case, nothing else. Plain ASCII takes the faster function."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col).cast("string")).alias("content"))
    texts = texts.select("id", "content", F.xxhash64("content").alias("mark"), F.monotonically_increasing_id().alias("row"))
    share = max(1, docs.count() // ranges)
    common = texts.groupBy("mark").count().where(F.col("count") > share)
    common = stored(common.select("mark", F.ceil(F.col("count") / share).cast("int").alias("salts")), "common")
    salt = F.coalesce(F.pmod(F.xxhash64("row"), F.col("salts")), F.lit(0)).cast("int")
    dealt = texts.join(common, "mark", "left").withColumn("salt", salt).withColumn("head", F.substring("content", 1, HEAD))
    sorted_ = dealt.repartitionByRange(ranges, "head", "mark", "salt")
    equal = Window.partitionBy("head", "mark", "salt", "content")
    found = sorted_.select(
        "id",
        F.sha2("content", 256).alias("sha"),
        F.max("id").over(equal).alias("largest"),
        F.count(F.lit(1)).over(equal).alias("size"),
        F.row_number().over(equal.orderBy(F.desc("id"))).alias("place"),
        "salts",
        "salt",
    )
    found = stored(found, "equal")
    salted = found.where("salts is not null")
    groups = salted.where("place = 1").groupBy("sha").agg(F.max("largest").alias("keep_id"), F.sum("size").alias("group_size"), F.max("salts").alias("salts"))
    each = groups.select("sha", "keep_id", "group_size", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    whole = found.where("salts is null").select("id", "sha", F.col("largest").alias("keep_id"), F.col("size").alias("group_size"))
    found = whole.unionByName(salted.select("id", "sha", "salt").join(each, ["sha", "salt"]).drop("salt"))
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
