"""Corpus pipeline: five stages over ``documents``, each one operator of the library.

Every stage reads all rows that the one before kept; a stage is written to the
shared folder and read again, so lineage ends there. Empty inputs give empty
outputs of the same columns.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm import exact, langid, nearcopies, packing, toxicity
from lathe.llm.queries import table, tokenizer_path
from lathe.session import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Texts without a letter go, and those that no language fits clearly better than another.
LEAST_LANGUAGE_SCORE = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; trained on the labels not held out."""
    labels = table(spark, sf_dir, "labels").where(langid.fold(F.col("doc_id"), 3) != 1)
    model = toxicity.train(docs, labels)
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, as told from their text; ``lang`` stays as it came."""
    model = langid.train(docs.where(langid.fold(F.col("doc_id"), 4) != 2))
    told = langid.identify(docs.select(*COLUMNS), model)
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*COLUMNS)


def numbered(docs: DataFrame) -> DataFrame:
    """Rows with a number: ``docs`` is a written table, so each read gives a row the same one."""
    return docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row"))


def only(rows: DataFrame, kept: DataFrame) -> DataFrame:
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def drop_equal_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document, that with the largest id; null ids come last, of rows alike in id too the last row."""
    rows = numbered(docs)
    found = exact.exact_duplicates(rows.select(F.struct("doc_id", "row").alias("place"), "text"), "place")
    return only(rows, found.where("kept").select("place.row"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 5-word Jaccard 0.8 or more one document, that with the smallest id; ids come before null ones, of rows alike in id the first row."""
    rows = numbered(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("place")
    near = nearcopies.near_copies(rows.select(place, "text"), "place")
    return only(rows, near.where(F.col("place").eqNullSafe(F.col("component_id"))).select("place.row"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, packed into sequences."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_language),
    ("exact", drop_equal_texts),
    ("near", drop_near_duplicates),
    ("packing", pack),
]
#: Learned models and fingerprints are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
