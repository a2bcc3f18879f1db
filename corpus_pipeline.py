"""A corpus made ready for training: quality rules, near duplicates, secrets, packing.

Each stage works on what the one before kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.neardup import one_of_each
from quern.llm.packing import pack_documents, word_count
from quern.llm.quality import fit_quality, judge_quality
from quern.llm.secrets import BASE_RULES, MORE_RULES, redact, scan_secrets
from quern.llm.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the boosted trees keep; the trees are fitted on a bounded labelled sample."""
    forest = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge_quality(docs.select(*COLUMNS), forest).where("kept").select(*COLUMNS)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles: the one of the smallest id. A row is judged
    by its own text, also where ids repeat or are missing."""
    return one_of_each(docs.select(*COLUMNS), size=5, percent=80)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and n_chars counted anew where there was one."""
    found = scan_secrets(docs.select(*COLUMNS), [*BASE_RULES, *MORE_RULES])
    changed = F.when(F.size("secret_spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return redact(found).withColumn("n_chars", changed).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies: one row per piece, with its bin, the bin's size and its place in it."""
    return pack_documents(docs, word_count(F.col("text")))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicate_groups),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

# The trees, the sketches and the packing have no SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written as Parquet below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
