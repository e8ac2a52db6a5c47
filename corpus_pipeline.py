"""The corpus pipeline: documents through toxicity, near duplicates, benchmark passages, secrets and tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotledger.llm import bpe, decontaminate, jaccard_join, queries, secret_scan, toxicity
from lotledger.llm.arrays import small_batches
from lotledger.session import scratch_dir

#: Near duplicates share four fifths of their five-word shingles.
SHINGLE_WORDS, PERCENT = 5, 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a probability of toxicity below the threshold; empty texts stay, unless most labels are 1."""
    model = toxicity.train(docs, queries.read(spark, sf_dir, "labels"))
    name = "_toxicity"
    while name in map(str.lower, docs.columns):
        name += "_"
    return toxicity.score(docs, model, name).where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id; of rows that repeat it, one.

    Documents without shingles or without an id are nobody's copies and stay.
    """
    small_batches(spark)
    found = jaccard_join.components(docs, SHINGLE_WORDS, PERCENT)
    kept = docs.join(found.where("component_id <> doc_id").select("doc_id").distinct(), "doc_id", "left_anti")
    again = docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    single = kept.join(again, "doc_id", "left_anti")
    return single.unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    safe = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = safe.columns[docs.columns.index("text")]
    found = decontaminate.occurrences(safe, queries.read(spark, sf_dir, "benchmark"), safe.columns, text=text)
    return found.where(F.size("hits") == 0).select(*safe.columns).toDF(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each secret in a text gives way to its kind in brackets."""
    small_batches(spark)
    return secret_scan.redact(docs, secret_scan.fit(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of ids of its text, and digests of the ids and of the text they decode to."""
    small_batches(spark)
    return bpe.digested(docs, queries.codec(), ["doc_id"])


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_dir(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Training, byte pairs and randomness tests are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None
