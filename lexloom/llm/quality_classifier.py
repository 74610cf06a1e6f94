"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken from whole texts. The trees are fitted on the driver from a
bounded sample of labelled rows and sent out as flat arrays.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, raw_bytes, texts, tidy
from .quality_rules import measure
from .trees import Forest, boost

#: Labelled rows that a fit takes at most.
MOST_ROWS = 20_000
_TAILS, _UPPER, _DIGITS = bytes(range(0x80, 0xC0)), bytes(range(65, 91)), bytes(range(48, 58))
_PUNCTUATION = bytes(i for i in range(33, 127) if not chr(i).isalnum())
_HIGH = bytes(range(0x80, 0x100))
FEATURES = ("log_words", "word_length", "symbols", "duplicate_lines", "repeated_words", "exclamations", "upper", "digits", "punctuation", "high", "distinct", "top_word", "line_words", "longest_word", "squeezed", "blanks")


def statistics(text: bytes) -> list[float]:
    n_words, word_chars, n_symbols, n_lines, n_dup, n_repeat, n_exclaim = measure(text)
    words, size = text.split(), max(1, len(text))
    counts = Counter(words)
    of = lambda drop: (len(text) - len(text.translate(None, drop))) / size
    per = max(1, n_words)
    return [
        math.log1p(n_words), word_chars / per, n_symbols / per, n_dup / max(1, n_lines), n_repeat / per, n_exclaim / per,
        of(_UPPER), of(_DIGITS), of(_PUNCTUATION), of(_HIGH), len(counts) / per, max(counts.values(), default=0) / per,
        n_words / max(1, n_lines), max(map(len, words), default=0), len(zlib.compress(text, 1)) / size, (len(text) - len(text.translate(None, b" \t\n\r\x0b\x0c"))) / size,
    ]


@dataclass
class Model:
    start: float
    forest: Forest | None

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start) + (self.forest.sum(x) if self.forest and len(x) else 0.0)
        return 1 / (1 + np.exp(-z))


def _features(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(x) for x in raw_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.mapInArrow(tidy(run), "doc_id long, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", most_rows: int = MOST_ROWS, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> Model:
    """Learn ``target`` (0 or 1) from at most ``most_rows`` labelled rows, the first by a hash
    of their id. Null ids and labels are left out; a document with several labels counts
    with their maximum. Without any label every score is one half; with one kind of label
    alone every score is near that label."""
    own = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{target}`").cast("int").alias("y"))
    chosen = own.where("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    view = texts(docs, id_col, text_col)
    # most_rows bounds what is broadcast and what is collected.
    sample = _features(view.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")).join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("x")).limit(most_rows).toPandas()
    if not len(sample):
        return Model(0.0, None)
    return Model(*boost(np.stack(sample["x"].to_numpy()), sample["y"].to_numpy(float), **kwargs))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1): one row a row of ``docs``, null texts as empty, repeated rows and rows without an
    id each on their own, whole texts of any length. An empty table gives no rows. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in raw_bytes(batch.column(1))]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    return texts(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, score double")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; rows whose crc32 of the id is divisible by 5 are held out of the fit. A row without
    an id has no such remainder: it is scored and not held out."""
    docs, fold = documents(spark, sf_dir), F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 5")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold != 0))
    return score(docs, model).select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))
