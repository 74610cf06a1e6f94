"""Helpers that all operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.steps import forget, saved, scratch, shared_path  # noqa: F401

#: Rows and bytes that one Arrow batch holds at most on its way to Python.
BATCH_ROWS, BATCH_BYTES = 4000, 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that long texts do not fill a Python worker. The session keeps the lower
    bounds: Spark reads them when a result is computed, which is after an operator has returned it."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        number = int(now) if now and now.isdigit() else 0
        if not 0 < number <= most:
            spark.conf.set(key, str(most))


def trim() -> None:
    """What this process has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library has no such call


def tidy(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``f``, and behind its last batch what it has freed goes back to the system: Spark keeps idle workers, whose
    memory counts against the executor's next stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        trim()

    return run


def tidy_group(f: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """As ``tidy``, for a function of one group."""

    def run(*tables: pa.Table) -> pa.Table:
        found = f(*tables)
        trim()
        return found

    # Spark tells functions with a key from those without by their number of arguments.
    return (lambda left, right: run(left, right)) if f.__code__.co_argcount > 1 else (lambda part: run(part))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, whatever other columns the table has."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def raw_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every value, a null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
