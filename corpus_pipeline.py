"""A training-data pipeline over `documents`: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.decontaminate import contamination
from tidemark.llm.jaccard_join import similar_documents
from tidemark.llm.line_runs import dedup_lines
from tidemark.llm.queries import pattern, table, vocabulary
from tidemark.llm.toxicity import score, train
from tidemark.sources.scratch import cut_lineage, work_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below a half by a classifier fitted on `labels`; each row by its text alone, a null one as empty."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, name="__score").where(F.col("__score") < 0.5).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the lines that three documents share; null texts stay null."""
    out = dedup_lines(docs).withColumn("text", F.when(F.col("text").isNotNull(), F.col("__kept")))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


#: Keys of at most this many rows (40 MB) go to every task; more are shuffled, with the texts.
BROADCAST_KEYS = 200_000


def _without(docs: DataFrame, gone: DataFrame, key: Column) -> DataFrame:
    """Rows whose key is not among the distinct ones of `gone` (one column, null equal to null)."""
    gone = cut_lineage(gone.select(F.col(gone.columns[0]).alias("__gone")), "gone")
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    return docs.withColumn("__key", key).join(gone, F.col("__key").eqNullSafe(F.col("__gone")), "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; texts without words all stay.

    Rows are kept by id: rows that share the id that stays all stay, and so do rows with
    a null id if one of them stays.
    """
    stays = F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = similar_documents(docs).groupBy("doc_id").agg(stays.alias("stays")).where("NOT stays").select("doc_id")
    return _without(docs, gone, F.col("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of any benchmark item.

    An item of fewer words, but not none, is one window.  Rows are judged one by one:
    only rows equal in id and text, null or not, share a verdict.
    """
    key = F.sha2(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))), 256)
    found = contamination(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("n_hit > 0").select("doc_id").distinct(), key)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with a digest of them and of the bytes they decode to; a null text has none.  Every row stays."""
    path = vocabulary("byte_bpe_50k.tiktoken")
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, pattern(), decoded=True)
    return out.select("doc_id", "lang", "source", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: Encoding and classification can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
