"""Token counts by separator scan over flat, unindexed token files.

A flat file is nothing but ids one after the other, each document closed by an
end-of-document id. Files are cut into blocks of equal size; every block is
searched for the end id with one vectorised comparison, and a prefix scan over
the blocks' counts and last separators stitches the documents that cross a
block's edge and numbers all documents of a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, saved, shared_path, texts, tidy
from .tokens import encoder

#: Bytes of a block, a multiple of every token width; blocks of a scan unit of the prefix scan.
BLOCK_BYTES, UNIT_BLOCKS = 4 << 20, 1024


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or an absolute local path (local, HDFS, S3, GCS)."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = "byte_bpe_50k", end_id: int = 50256, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Flat token files, one a task, and the manifest (file, ordinal, doc_id).

    A file's name holds its task's attempt, and only the attempt that Spark
    accepts reports its rows, so a retried task leaves at most an unused file.
    Ids equal to ``end_id`` inside a text are impossible unless the text holds the
    special string itself; they are written as 0 so that documents stay whole.
    Null and empty texts become documents of no tokens, an empty table no files and no
    rows; a very long text is encoded whole. An id that ``width`` bytes can't hold is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = encoder(vocabulary).encode, np.dtype(f"<u{width}")
        end = np.array([end_id], kind).tobytes()
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        name, n, out = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin", 0, None
        for batch in batches:
            out = out or store.open_output_stream(f"{root}/{name}")
            for ids in encode(batch.column(1)):
                if len(ids) and int(ids.max()) >> 8 * width:
                    raise ValueError(f"id {ids.max()} does not fit into {width} bytes")
                if (ids == end_id).any():
                    ids = np.where(ids == end_id, 0, ids)
                out.write(ids.astype(kind).tobytes() + end)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([name] * rows), pa.array(range(n, n + rows), pa.int64()), batch.column(0)], ["file", "ordinal", "doc_id"])
            n += rows
        if out:
            out.close()

    return saved(texts(docs, id_col, text_col).mapInArrow(tidy(run), "file string, ordinal long, doc_id long"), "token-manifest")


def blocks(spark: SparkSession, files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, file, length) to one row a block. Needs the files' lengths, never their content."""
    count = F.expr(f"(length + {block_bytes - 1}) div {block_bytes}")
    numbered = files.where("length > 0").select("path", "file", "length", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("block"))
    return numbered.select("path", "file", "block", F.least(F.lit(block_bytes), F.col("length") - F.col("block") * block_bytes).alias("bytes"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, file (base name) and length of the token files in a folder; Spark lists, nothing is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), "length")


def separator_scan(block_rows: DataFrame, end_id: int = 50256, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: file, ordinal, start, n_tokens (without the separator), terminated.

    Ordinals and starts count from 0 in each file. Ids behind a file's last
    separator form one more document with ``terminated`` false. Two separators in a
    row enclose a document of 0 tokens. Bytes that don't fill an id at the end of a
    file are ignored. An empty table gives no rows.
    """
    per = block_bytes // width

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype(f"<u{width}")
        for batch in batches:
            for path, file, block, size in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                store, where = open_store(path)
                with store.open_input_file(where) as f:
                    ids = np.frombuffer(f.read_at(size - size % width, block * block_bytes), kind)
                found = np.flatnonzero(ids == end_id).astype(np.int64) + block * per
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([len(found)], pa.int64()), pa.array([int(found[-1]) if len(found) else None], pa.int64()), pa.array([found], pa.list_(pa.int64()))], ["file", "block", "n_ids", "n_ends", "last_end", "ends"])

    width_of_job = max(2, block_rows.sparkSession.sparkContext.defaultParallelism * 2)
    dealt = block_rows.select("path", "file", "block", "bytes").repartition(width_of_job, "path", "block")
    scanned = saved(dealt.mapInArrow(tidy(scan), "file string, block long, n_ids long, n_ends long, last_end long, ends array<long>"), "token-blocks")
    # Prefix scan in two levels: inside units of blocks, then over the units of a file.
    unit = F.expr(f"block div {UNIT_BLOCKS}")
    narrow = scanned.select("file", "block", "n_ids", "n_ends", "last_end", unit.alias("unit"))
    inside = Window.partitionBy("file", "unit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    totals = narrow.groupBy("file", "unit").agg(F.sum("n_ends").alias("n"), F.max("last_end").alias("last"), F.max("block").alias("top"))
    units = totals.select("file", "unit", F.sum("n").over(before).alias("unit_n"), F.max("last").over(before).alias("unit_last"), F.max("top").over(Window.partitionBy("file")).alias("file_top"))
    scan_rows = narrow.select("file", "unit", "block", F.sum("n_ends").over(inside).alias("own_n"), F.max("last_end").over(inside).alias("own_last"))
    zero = F.lit(0).cast("long")
    prefix = scan_rows.join(units, ["file", "unit"]).select("file", "block", (F.coalesce("own_n", zero) + F.coalesce("unit_n", zero)).alias("ordinal"), (F.coalesce("own_last", "unit_last", F.lit(-1).cast("long")) + 1).alias("start"), (F.col("block") == F.col("file_top")).alias("is_last"))
    rest = F.when(F.col("is_last"), F.array(F.struct((F.col("block") * per + F.col("n_ids")).alias("end"), F.lit(False).alias("terminated")))).otherwise(F.array())
    every = F.concat(F.transform("ends", lambda x: F.struct(x.alias("end"), F.lit(True).alias("terminated"))), rest)
    opened = scanned.join(prefix, ["file", "block"]).select("file", "ordinal", "start", "ends", F.posexplode(every).alias("k", "e"))
    begin = F.when(F.col("k") == 0, F.col("start")).otherwise(F.expr("try_element_at(ends, k)") + 1)
    rows = opened.select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), begin.alias("start"), (F.col("e.end") - begin).alias("n_tokens"), "e.terminated")
    return rows.where("terminated OR n_tokens > 0")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, found by scanning the flat files that hold them."""
    folder = shared_path(spark, "token-files")
    manifest = write_token_files(documents(spark, sf_dir), folder)
    counted = separator_scan(blocks(spark, list_files(spark, folder)))
    # The manifest names the files of accepted attempts only.
    both = manifest.join(counted, ["file", "ordinal"])
    return both.select("doc_id", F.substring("file", 1, 6).cast("long").alias("file_no"), "ordinal", "start", "n_tokens")
