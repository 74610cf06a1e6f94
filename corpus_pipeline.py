"""Raw documents to packed training sequences: quality rules, near duplicates, secrets, mix, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm.common import saved
from lexloom.llm.minhash import distinct_documents
from lexloom.llm.mixing import mixed
from lexloom.llm.packing import digest, pack
from lexloom.llm.quality_rules import passing
from lexloom.llm.secrets import redacted, train


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy v2 rejects go, by one measurement of the whole text and the ledger's bits; the rest keep
    all their columns. Null, empty and short texts have too few words and go; each of repeated rows is judged alike,
    rows without a doc_id too; an empty table stays empty."""
    return passing(docs, "v2")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, at five-word shingles and 0.8, the smallest doc_id stays. Rows that repeat a
    doc_id that stays all stay; rows without a doc_id, and null or empty texts, are nobody's duplicates and stay; whole
    texts of any length are compared; other columns are as they were; an empty table stays empty."""
    return distinct_documents(docs, percent=80, words=5)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts and n_chars follows; every document stays, null and empty texts as they are, each
    of repeated rows alike, a null source as an empty path; an empty table stays empty."""
    return redacted(docs, train())


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix; every row stays, with its columns. A null source is a source of its own, a null
    or empty text takes no room, repeated rows stand side by side, a text longer than a block uses up the blocks it
    covers; an empty table stays empty."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 1024 ids, filled in the order of the files, which is that of the mix. A null or empty text has the end
    id alone, repeated rows and rows without a doc_id are packed like any other, a long text runs over as many windows
    as it needs; an empty table gives no rows."""
    return digest(pack(docs, in_file_order=True))


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: Tokenisation and minhash have no form in SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
