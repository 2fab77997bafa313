"""Corpus pipeline: quality rules, line dedup, near duplicates, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. ``run`` writes each stage's rows as Parquet below spark.checkpoint.dir and
reads them again for the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklift.llm import decontaminate, line_dedup, ngram_jaccard, packing, quality
from ranklift.llm.queries import tokenizer_path
from ranklift.llm.storage import cut, release
from ranklift.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; every document stays, if only with an empty text."""
    out = line_dedup.drop_duplicate_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return out.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one document stays: the one with the smallest id (a null id
    last), then by hash of its text. Documents are told apart by id and text, so a text that is no one's copy
    stays whatever its id; rows equal in both stay once; documents without words are no one's
    copies. No text moves but those of repeated rows."""
    rows = docs.withColumn("__key", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text").cast("string")))
    classes = cut(ngram_jaccard.near_duplicates(rows.select(F.col("__key").alias("doc_id"), "text")).select(F.col("doc_id").alias("__key"), F.col("component_id").alias("__class")))
    shared = classes.where("__key <> __class").select("__class").distinct()
    members = classes.join(shared, "__class").distinct()
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__key")
    first = members.join(rows.select("__key", "doc_id"), "__key").groupBy("__class").agg(F.min(place).alias("first"))  # combined map-side
    gone = cut(members.join(first, "__class").where("__key <> first.__key").select("__key"))
    again = cut(classes.groupBy("__key").count().where("count > 1").select("__key").join(gone, "__key", "left_anti"))
    once = rows.join(again, "__key", "left_semi").dropDuplicates(["__key"])
    return rows.join(gone.union(again), "__key", "left_anti").unionByName(once).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; each id of a document lies in exactly one piece."""
    return packing.pack_texts(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", lines),
    ("ngram_jaccard", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("packing", pack),
]

#: Packing needs the tokenizer, which SQL cannot express; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        release(spark)
        docs = spark.read.parquet(out)
    return docs
