"""From raw documents to token ids, in five stages.

Each stage takes all documents that the one before kept and returns what it keeps, in the columns of
documents; the last returns token ids.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm import op3_language, op6_exact, op7_decontaminate, op10_near
from gnomon.llm.common import ascii_lower, durable, fold, table
from gnomon.llm.op1_pieces import encode

#: A document goes if fewer of its words lie in spans of its language.
LEAST_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which most words are of one known language; those without letters, null and empty texts
    too, go. Repeated rows are decided alike, very long texts whole; with no row to learn from all go, and an
    empty table stays empty."""
    model = op3_language.fit(docs.where(fold(F.col("doc_id"), 5) != 0))
    found = op3_language.identify(rows_of(docs), model, keys=("row",), within="row")
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select("row.*")


def rows_of(docs: DataFrame) -> DataFrame:
    """Whole rows as one column, row, so that no column of theirs clashes with one that a stage adds."""
    return docs.select(F.struct(*(F.col(f"`{k}`") for k in docs.columns)).alias("row"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal after lower-casing A-Z (a null text is an empty one), the one with the largest
    doc_id; of rows repeated with that doc_id and text, one. Different texts under one doc_id, or none, all stay.
    Very long texts are compared whole; other columns are carried along; an empty table stays empty."""
    key = lambda doc_id, sha: F.concat_ws(":", sha, F.coalesce(doc_id.cast("string"), F.lit("none")))
    kept = op6_exact.exact_groups(docs).where("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias("key")).distinct()
    own = rows_of(docs).select("row", key(F.col("row.doc_id"), F.sha2(ascii_lower(F.col("row.text")).cast("binary"), 256)).alias("key"))
    return own.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id; of different
    texts under one doc_id each is decided on its own. Documents without doc_id, and those without words
    (null and empty texts too), stay; repeated rows of the one that stays all do. An empty table stays empty."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    own = rows_of(docs).select("row", F.when(F.col("row.doc_id").isNotNull(), F.struct("row.doc_id", F.sha2(text.cast("binary"), 256).alias("sha"))).alias("id"))
    kept = op10_near.near_groups(own.select("id", "row.text"), doc_id="id").where("kept").select(F.col("doc_id").alias("keep")).distinct()
    return own.join(kept, own["id"].eqNullSafe(kept["keep"]), "left_semi").select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item. Null and empty texts have none and stay; repeated rows
    are decided alike, very long texts whole; without benchmark items all stay, and an empty table stays empty."""
    found = op7_decontaminate.find(rows_of(docs), table(spark, sf_dir, "benchmark"), keys=("row",), within="row")
    return found.where("n_hit = 0").select("row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian unsigned 32-bit integers) and the decoded text of every row. A
    null or empty text has the begin and end ids; repeated rows stay; an empty table gives an empty one."""
    return encode(docs, decoded=True)


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pieces", pieces)]

#: Stages learn, hash and align in ways that SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
