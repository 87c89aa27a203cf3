"""Corpus pipeline: documents -> packed training sequences.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept, and its decisions take effect. All but the last return the columns of
documents; the last returns the packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulon.llm.common import cut
from tabulon.llm.decontaminate import contaminated
from tabulon.llm.jaccard import jaccard_components
from tabulon.llm.packing import pack_documents
from tabulon.llm.quality import keep_good
from tabulon.llm.substrings import dedup_substrings

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label quality classifier accepts."""
    return keep_good(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each component of the
    Jaccard join (five words, similarity 0.8). Documents without words are
    linked with nothing and stay. Of rows that repeat a doc_id, the one with
    the smallest text stays; rows with a null doc_id all stay."""
    groups = cut(jaccard_components(docs, n=5, percent=80).select("doc_id", "component_id"))
    later = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.select(*COLUMNS).join(later, "doc_id", "left_anti")
    again = groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if not again.isEmpty():
        first = Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("text"))
        one = kept.join(again, "doc_id", "left_semi").withColumn("_n", F.row_number().over(first)).filter("_n = 1")
        kept = kept.join(again, "doc_id", "left_anti").unionByName(one.drop("_n"))
    return kept.select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that an earlier document
    has; documents of which nothing is left go."""
    found = dedup_substrings(docs.select(*COLUMNS), threshold=PASSAGE_WORDS)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return (found.filter("n_removed = 0 or n_removed < n_words")
            .select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("bigint").alias("n_chars")))


PASSAGE_WORDS = 50


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verbatim, paraphrased or edited test item. Rows with
    a null doc_id are documents of their own, told apart by the hash of their text."""
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = docs.select(*COLUMNS)
    hits = contaminated(docs.filter("doc_id is not null"), tests)
    kept = docs.join(hits.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)
    unnamed = docs.filter("doc_id is null")
    if unnamed.isEmpty():
        return kept
    text = F.xxhash64("text")
    bad = contaminated(unnamed.select(text.alias("doc_id"), "text"), tests).select(F.col("doc_id").alias("_text")).distinct()
    return (kept.filter("doc_id is not null")
            .unionByName(unnamed.withColumn("_text", text).join(bad, "_text", "left_anti").select(*COLUMNS)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of 1024 tokens."""
    return pack_documents(docs)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", substrings),
          ("benchmark decontamination", decontaminated), ("best-fit packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row; each result is checkpointed before the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
