"""Sinks. Tables are written by Spark's committer; a folder is replaced only once it is complete."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from .steps import session, spread


def _swap(df: DataFrame, path: str, write, dry_run: bool = False) -> int | None:
    """Write beside the target and rename over it; a dry run counts the rows and writes nothing."""
    if dry_run:
        return df.count()
    sc = df.sparkSession.sparkContext
    at = lambda p: sc._jvm.org.apache.hadoop.fs.Path(p)
    fs, fresh = at(path).getFileSystem(sc._jsc.hadoopConfiguration()), f"{path}.{uuid.uuid4().hex}"
    write(fresh)
    fs.delete(at(path), True)
    if not fs.rename(at(fresh), at(path)):
        raise OSError(f"cannot rename to {path}")


def json_lines(df: DataFrame, path: str, order: list[Column | str] | None = None, dry_run: bool = False) -> int | None:
    """JSON lines, nulls left out; with ``order`` in total order."""
    out = df.orderBy(*order) if order else df
    return _swap(df, path, lambda p: out.write.option("ignoreNullFields", True).json(p), dry_run)


def dictionary(entries: DataFrame, path: str, dry_run: bool = False) -> int | None:
    """Entries in the alphabet's order."""
    return json_lines(entries, path, [T.collation_key(F.col("word")), F.col("word")], dry_run)


def shards(records: DataFrame, path: str, n: int) -> None:
    """Records in n shards by lemma, each by kind and falling count."""
    kinds = F.array_position(F.array(*map(F.lit, ("unknown", "derived", "name", "fragment", "known"))), F.col("kind"))
    out = records.repartition(n, "lemma").sortWithinPartitions(kinds, F.col("count").desc(), "lemma")
    _swap(records, path, lambda p: out.write.json(p))


def table(df: DataFrame, path: str, order: list[Column | str] | None = None) -> None:
    """Tab-separated values with a header. A tab or newline in a field is an error."""
    bad = lambda c: F.col(c).cast("string").rlike("[\t\n\r]")
    safe = df.select(*(F.when(bad(c), F.raise_error(F.concat(F.lit(f"tab or newline in {c}: "), F.col(c).cast("string"))).cast("string")).otherwise(F.col(c).cast("string")).alias(c) for c in df.columns))
    out = safe.orderBy(*order) if order else safe
    _swap(df, path, lambda p: out.write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(p))


def texts(docs: DataFrame, path: str) -> None:
    """One folder of text a source."""
    _swap(docs, path, lambda p: docs.select("source", F.regexp_replace("text", "\n$", "").alias("value")).write.partitionBy("source").text(p))


def text_files(docs: DataFrame, path: str, most: int = 20_000) -> None:
    """One text file a row (``source``, ``text``), named by its source and ended by one newline, in folders of at most ``most``
    files; a row without text has no file. A name that comes again goes to another folder; all of a name but ASCII letters,
    digits and ``-._~``, and a dot or an underscore at its start, is escaped.

    Hadoop's local file system starts a process a file and writes a checksum beside each, so tasks write with
    ``pyarrow.fs``. A task names the folders it has filled, and those of attempts that failed are deleted."""

    def write(fresh: str) -> None:
        sc = docs.sparkSession.sparkContext
        at = lambda p: sc._jvm.org.apache.hadoop.fs.Path(p)
        fs = at(fresh).getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(at(fresh))
        uri = fs.makeQualified(at(fresh)).toUri()
        where = uri.getPath() if uri.getScheme() == "file" else uri.toString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, root = pafs.FileSystem.from_uri(where)
            folder, names = "", set()
            for batch in batches:
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if not folder or len(names) == most or name in names:
                        folder, names = uuid.uuid4().hex, set()
                        store.create_dir(f"{root}/{folder}", recursive=True)
                        yield pa.RecordBatch.from_arrays([pa.array([folder])], ["folder"])
                    names.add(name)
                    put, raw = quote(name, safe=""), text.as_py()
                    put = f"%{ord(put[0]):02X}{put[1:]}" if put[:1] in (".", "_") else put
                    with store.open_output_stream(f"{root}/{folder}/{put}.txt") as out:
                        out.write(raw if raw.endswith(b"\n") else raw + b"\n")

        rows = spread(docs.where("text IS NOT NULL").select("source", F.col("text").cast("binary").alias("text")))
        with session(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="256", spark__sql__execution__arrow__maxBytesPerBatch=str(16 << 20)):
            whole = {r["folder"] for r in rows.mapInArrow(run, "folder string").collect()}
        for found in fs.listStatus(at(fresh)):
            if found.getPath().getName() not in whole:
                fs.delete(found.getPath(), True)

    _swap(docs, path, write)


def append(df: DataFrame, path: str) -> None:
    """Provenance records are only ever added to."""
    df.write.mode("append").json(path)


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file, sha256 (12 hex digits of the file's bytes), bytes: what a published manifest of files is compared with."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.substring(F.sha2("content", 256), 1, 12).alias("sha256"), F.col("length").alias("bytes"))


def digest_manifest(named: dict[str, DataFrame], note: dict[str, str] | None = None) -> DataFrame:
    """file, sha256 (12 hex digits over the rows' digests in order), rows, note."""
    rows = []
    for name, df in named.items():
        each = F.sha2(F.to_json(F.struct(*df.columns)), 256)
        # Digests of rows are combined by sums of their parts: order doesn't matter and no row is gathered.
        parts = [F.sum(F.conv(F.substring(each, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).alias(f"p{i}") for i in range(4)]
        rows.append(df.agg(F.count("*").alias("rows"), *parts).select(F.lit(name).alias("file"), T.short_digest(F.concat_ws(",", *(F.col(f"p{i}").cast("string") for i in range(4)))).alias("sha256"), "rows", F.lit((note or {}).get(name, "")).alias("note")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def bundle(df: DataFrame, order: str, most: int = 1_000_000) -> DataFrame:
    """A small table as one JSON array, for a page to load; more than ``most`` rows are an error."""
    return df.agg(F.when(F.count("*") > most, F.raise_error(F.lit(f"more than {most} rows for one page")).cast("string")).otherwise(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct(order, F.struct(*df.columns).alias("row")))), lambda x: x["row"]))).alias("value"))


def unchanged(new: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows (file, sha256) whose digest a manifest doesn't hold yet."""
    return new.join(manifest.select("file", "sha256"), ["file", "sha256"], "left_anti")
