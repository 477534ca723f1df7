"""Corpus pipeline: documents in, cleaned and tokenised documents out.

Each stage gets what the one before kept, written as Parquet and reread, and
lets go of what the driver still holds of the stages before it.  No SQL can
express the trained and iterative stages, so ORACLE_SQL is None; tests/llm runs
every stage and the whole on a table with planted cases, and compares the
operators with brute-force versions.

Every stage keeps rows with null or empty texts and null ids (the near-copy
stage keeps all documents without words), treats repeated rows as one document
where ids and texts are equal, keeps further columns whatever their names, and
gives an empty result for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaystats.llm import byte_bpe, decontaminate, ngram_join, secret_scan, toxicity
from delaystats.llm.common import BATCH, free_names, release, table
from delaystats.llm.queries import byte_bpe_tokenizer
from delaystats.session import lowered, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model rejects go."""
    release(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.8)."""
    release(spark)
    return ngram_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    release(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; n_chars follows the text."""
    release(spark)
    forest = secret_scan.fit(secret_scan.labelled_findings(docs, path_col="source"), docs)
    _, secrets, redacted = names = tuple(free_names(docs, 3))
    found = secret_scan.scan(docs, forest, path_col="source", names=names)
    masked = {"text": F.col(redacted)}
    if "n_chars" in docs.columns:
        masked["n_chars"] = F.when(F.size(secrets) > 0, F.char_length(redacted).cast("long")).otherwise(F.col("n_chars"))
    return found.withColumns(masked).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the hash of what they decode to."""
    release(spark)
    bpe = byte_bpe_tokenizer()
    return byte_bpe.encoded(docs, bpe).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(bpe.decode(F.col("ids")), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", mask_secrets),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name)
        kept = stage(spark, docs, sf_dir)
        with lowered(spark, BATCH):
            kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
