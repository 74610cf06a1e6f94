"""Steps between queries: tables written to the shared folder, and small inputs dealt over the cluster.

Intermediate tables go to the folder that the session names in
``spark.checkpoint.dir`` through Spark's own committer, so that every executor
can read them and a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from itertools import chain

from pyspark.sql import DataFrame, SparkSession

#: Bytes of input a core under which a table is dealt anew: cheap by definition, and a table that is one file or
#: one row group then keeps more than one core busy.
SMALL = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session. Where none is named, a temporary one on a local master, and an error
    on any other: executors could not read what the driver's machine holds."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="lexloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


_SCRATCH: ContextVar[list | None] = ContextVar("scratch", default=None)


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lexloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextmanager
def session(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Settings (dots written as two underscores) for the time of a step, put back behind it."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def saved(df: DataFrame, name: str, codec: str = "zstd", further: Iterable[DataFrame] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here. Spark deletes the step's shuffle
    files when it is written. ``further`` tables of its columns are made and added one after another."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with session(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        for part in chain((df,), further):
            part.write.mode("append").option("compression", codec).parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.saved_at = path
    if (held := _SCRATCH.get()) is not None:
        held.append(found)
    return found


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def forget(*tables: DataFrame) -> None:
    """Delete tables from ``saved`` that nothing still to be computed reads."""
    for df in tables:
        _delete(df.sparkSession, df.saved_at)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """All tables saved inside are deleted behind it, but for those that are handed to what it yields (they come
    back as they are): what a result that isn't computed yet still reads."""
    held: list[DataFrame] = []
    kept: set[str] = set()
    mark = _SCRATCH.set(held)

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df.saved_at)
        return df

    try:
        yield keep
    finally:
        _SCRATCH.reset(mark)
        forget(*(df for df in held if df.saved_at not in kept))


def sweep(spark: SparkSession) -> None:
    """Delete all tables that this application has saved, once its results are written."""
    _delete(spark, f"{shared_dir(spark)}/lexloom/{spark.sparkContext.applicationId}")


def spread(df: DataFrame) -> DataFrame:
    """A table of less than ``SMALL`` bytes a core, by Spark's own estimate, dealt over all cores; larger ones as
    they are. For operators whose work is by the row: a text table may come as one row group."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * SMALL else df
