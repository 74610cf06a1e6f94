"""Streams: messages of a crawl, once each, by month, appended with an audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def once(stream: DataFrame, key: str, time: str, late: str = "7 days") -> DataFrame:
    """First row of each key. State is bounded by time: a key comes back only after ``late``."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def first_rows(rows: DataFrame, keys: list[str], time: str, tie: str) -> DataFrame:
    """What ``once`` keeps of rows that arrive in the order of their time: the first row of the keys, ties by a column."""
    rest = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(F.col(time).cast("timestamp_ntz"), tie)).alias("f"))
    return first.select(*keys, "f.*")


def by_month(rows: DataFrame, time: str) -> DataFrame:
    return rows.withColumn("month", F.date_format(F.date_trunc("month", F.col(time).cast("timestamp")), "yyyy-MM"))


def month_counts(rows: DataFrame, time: str, key: str) -> DataFrame:
    return by_month(rows, time).groupBy("month").agg(F.count("*").alias("n"), F.count(F.col(key)).alias("n_keys"))


def append_audited(stream: DataFrame, out: str, audit: str, checkpoint: str) -> StreamingQuery:
    """Append each batch and one audit row, resuming where the last run stopped."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        batch.write.mode("append").parquet(out)
        batch.agg(F.lit(number).alias("batch"), F.count("*").alias("rows"), F.current_timestamp().alias("at")).write.mode("append").json(audit)
        batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def mbox_entry(identity: Column, epoch_ms: Column, author: Column, subject: Column, body: Column, group: str) -> Column:
    """A message as an mbox entry, its body without tags on one line. An id without an @ gets one."""
    at = F.concat(F.date_format(F.to_utc_timestamp(F.timestamp_millis(epoch_ms), F.current_timezone()), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    name = F.when(F.coalesce(identity, F.lit("")) == "", epoch_ms.cast("string")).otherwise(identity)
    msgid = F.when(name.contains("@"), name).otherwise(F.concat(F.lit("<gg-"), name, F.lit("@scrape>")))
    flat = F.trim(F.regexp_replace(F.regexp_replace(body, "<[^>]+>", " "), r"\s+", " "))
    row = lambda head, value: F.concat(F.lit(head), value, F.lit("\n"))
    return F.concat(row("From nobody ", at), row("Message-ID: ", msgid), row("From: ", F.translate(F.coalesce(author, F.lit("nobody")), "\n", " ")), row("Newsgroups: ", F.lit(group)), row("Subject: [gg-scrape] ", F.coalesce(subject, F.lit(""))), row("Date: ", at), F.lit("\n"), row("", flat))


def append_mbox(stream: DataFrame, out: str, audit: str, checkpoint: str, group: str) -> StreamingQuery:
    """Messages (id, epoch_ms, author, subject, html), once each already, appended as mbox files, and the rows themselves
    as JSON lines. Each batch adds files of its own, so what is written is never touched again."""

    def write(batch: DataFrame, number: int) -> None:
        entry = mbox_entry(F.col("id"), F.col("epoch_ms"), F.col("author"), F.col("subject"), F.col("html"), group)
        batch.select(entry.alias("value")).write.mode("append").text(out)
        batch.withColumn("batch", F.lit(number)).write.mode("append").json(audit)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling(stream: DataFrame, time: str, width: str, late: str) -> DataFrame:
    """Counts by time windows; beyond what the crawl itself needs."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width)).agg(F.count("*").alias("n"))
