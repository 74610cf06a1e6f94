"""Packing by concatenate and cut: two-pass prefix sums, then fixed windows.

Pass one encodes every document once and writes its ids with the running total
of its partition; pass two adds the totals of all partitions before it, which
gives each document its place in one long stream of ids, and cuts the stream
into windows. A document that crosses a window's edge yields one boundary
record (piece) a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, saved, texts, tidy
from .tokens import encoder

_ENCODED = "part string, block_start long, doc_id long, before long, n long, ids binary"


def _units(docs: DataFrame, id_col: str, text_col: str, in_file_order: bool) -> DataFrame:
    """doc_id, text and the unit of a row: its place in a file, or its partition."""
    view = texts(docs, id_col, text_col)
    if not in_file_order:
        return view.select("doc_id", "text", F.lpad(F.spark_partition_id().cast("string"), 10, "0").alias("part"), F.lit(0).cast("long").alias("block_start"))
    small = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").cast("long").alias("block_start"))
    return small


def encode_partitions(units: DataFrame, vocabulary: str = "byte_bpe_50k", end_id: int = 0) -> DataFrame:
    """Each document's ids with ``end_id`` behind them, and the ids before it in its unit.
    Rows of a unit are read by one task and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary).encode, np.array([end_id], "<u4")
        totals: dict[tuple, int] = {}
        for batch in batches:
            ids = [np.concatenate([x, end]).tobytes() for x in encode(batch.column(1))]
            n, before = [len(x) // 4 for x in ids], []
            for unit, size in zip(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True), n, strict=True):
                before.append(totals.get(unit, 0))
                totals[unit] = before[-1] + size
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), batch.column(0), pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["part", "block_start", "doc_id", "before", "n", "ids"])

    return units.mapInArrow(tidy(run), _ENCODED)


def pack(docs: DataFrame, seq_len: int = 1024, vocabulary: str = "byte_bpe_50k", end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", in_file_order: bool = False) -> DataFrame:
    """Every document's pieces, one row a piece, with the piece's ``ids``.

    Columns: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset. Sequences are filled without gaps; only the last one can
    be shorter than ``seq_len``. A null or empty text has the end id alone; equal
    rows and null doc_ids are packed like any other row; a very long text is one row
    of ids until it is cut; an empty table gives no rows. Order: the partitions of
    ``docs`` one after the other, each in its own order, or, ``in_file_order``, the rows
    of the files that ``docs`` is read from, by the files' whole paths (folders of a
    partitioned table may hold equal names). Totals (one row a partition or file split) are the only thing summed in
    one place, and Spark joins them back by broadcast only below its own size threshold.
    """
    held = saved(encode_partitions(_units(docs, id_col, text_col, in_file_order), vocabulary, end_id), "packing-ids")
    totals = held.groupBy("part", "block_start").agg(F.sum("n").alias("total"))
    bases = saved(totals.select("part", "block_start", (F.sum("total").over(Window.orderBy("part", "block_start")) - F.col("total")).alias("base")), "packing-bases")
    at = F.col("base") + F.col("before")
    placed = held.join(bases, ["part", "block_start"]).select("doc_id", "n", "ids", at.alias("at"))

    def piece(seq: F.Column) -> F.Column:
        begin = F.greatest(F.col("at"), seq * seq_len)
        end = F.least(F.col("at") + F.col("n"), (seq + 1) * seq_len)
        start, length = begin - F.col("at"), end - begin
        cut = F.substring(F.col("ids"), (start * 4 + 1).cast("int"), (length * 4).cast("int"))
        return F.struct(start.alias("start"), length.alias("length"), cut.alias("ids"), seq.alias("sequence_id"), (begin - seq * seq_len).alias("offset"))

    first, last = F.expr(f"at div {seq_len}"), F.expr(f"(at + n - 1) div {seq_len}")
    pieces = placed.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(F.transform(F.sequence(first, last), piece)).alias("p"))
    return pieces.select("doc_id", "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset")


def assemble(pieces: DataFrame) -> DataFrame:
    """The sequences themselves: ids of at most one window, joined in order. Bounded by the window."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 1024 ids."""
    return digest(pack(documents(spark, sf_dir)))
