"""Reports: counts, distributions, completeness, listings, and Markdown for a page."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as T


def link_statistics(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links scanned, pairs made, and sides that are originals (base 0 or the null mark)."""
    original = lambda c: F.col(c).isin("0", r"\N").cast("long")
    made = pairs.agg(F.count("*").alias("pairs"), F.coalesce(F.sum(original("left_base")), F.lit(0)).alias("left_originals"), F.coalesce(F.sum(original("right_base")), F.lit(0)).alias("right_originals"))
    return links.agg(F.count("*").alias("scanned")).crossJoin(made)  # one row each


def addition_counts(entries: DataFrame) -> DataFrame:
    """Entries of each official addition."""
    tag = F.regexp_extract("source", "^ReVo/OA-([0-9]+)$", 1)
    return entries.where(tag != "").groupBy(tag.cast("int").alias("addition")).agg(F.count("*").alias("n"))


def distribution(rows: DataFrame, column: str) -> DataFrame:
    """Values by falling count."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), column)


def options(entries: DataFrame, column: str) -> DataFrame:
    """What a filter can be set to."""
    return entries.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def site_totals(entries: DataFrame, sources: DataFrame) -> DataFrame:
    counts = entries.agg(F.count("*").alias("entries"), F.count_if(F.size("citations") > 0).alias("cited"))
    return counts.crossJoin(sources.agg(F.count("*").alias("sources")))  # one row each


def near_misses(books: DataFrame, most: int = 40) -> DataFrame:
    """Rejected books with the most good pages."""
    return books.where("reason IS NOT NULL").orderBy(F.col("good").desc(), "book").limit(most)


def conflict_split(candidates: DataFrame) -> DataFrame:
    """Candidates with clashing verdicts, and with clashing glosses alone."""
    clash = lambda n: F.exists("conflicts", lambda c: c["field"] == n)
    verdict, gloss = clash("verdict"), clash("gloss")
    return candidates.agg(F.count_if(verdict).alias("verdicts"), F.count_if(gloss & ~verdict).alias("glosses_only"))


def missing_shards(records: DataFrame, expected: int, column: str = "shard") -> DataFrame:
    """Numbers of the shards (``shard-i-of-n``) that no record comes from."""
    found = records.select(F.regexp_extract(column, "shard-([0-9]+)-of", 1).cast("long").alias("i")).distinct()
    return records.sparkSession.range(expected).withColumnRenamed("id", "i").join(found, "i", "left_anti")


def article_statistics(pages: DataFrame) -> DataFrame:
    """title, is_redirect, raw and clean characters of pages with a ``clean`` column."""
    return pages.select("title", "is_redirect", F.length("text").alias("raw_chars"), F.coalesce(F.length("clean"), F.lit(0)).alias("clean_chars"))


def provenance_index(articles: DataFrame, base_url: str) -> DataFrame:
    """name, title, sha256, url of kept articles."""
    return articles.select(T.file_name(F.col("title")).alias("name"), "title", F.sha2("text", 256).alias("sha256"), F.concat(F.lit(base_url), F.translate("title", " ", "_")).alias("url"))


def markdown_html(text: str) -> str:
    """Headings (with ids for numbered sections), tables, lists and paragraphs of a guide as HTML."""
    def inline(s: str) -> str:
        s = html.escape(s, quote=False)
        s = re.sub(r"`([^`]+)`", r"<code>\1</code>", s)
        s = re.sub(r"\*\*([^*]+)\*\*", r"<strong>\1</strong>", s)
        s = re.sub(r"\*([^*]+)\*", r"<em>\1</em>", s)
        return re.sub(r"\[([^\]]+)\]\(([^)\s]+)\)", r'<a href="\2">\1</a>', s)

    def block(lines: list[str]) -> str:
        if m := re.match(r"(#{1,6})\s+(.*)", lines[0]):
            number = re.match(r"([\d.]*\d)", m[2])
            ident = f' id="section-{number[1].replace(".", "-")}"' if number else ""
            rest = block(lines[1:]) if lines[1:] else ""
            return f"<h{len(m[1])}{ident}>{inline(m[2])}</h{len(m[1])}>{rest}"
        if all(x.startswith("|") for x in lines):
            rows = [[c.strip() for c in x.strip("|").split("|")] for x in lines if not re.fullmatch(r"[|\s:-]+", x)]
            cells = ["".join(f"<{t}>{inline(c)}</{t}>" for c in r) for r, t in zip(rows, ["th", *["td"] * len(rows)], strict=False)]
            return "<table>" + "".join(f"<tr>{c}</tr>" for c in cells) + "</table>"
        if all(re.match(r"[-*]\s+", x) for x in lines):
            return "<ul>" + "".join(f"<li>{inline(re.sub(r'^[-*]\s+', '', x))}</li>" for x in lines) + "</ul>"
        return f"<p>{inline(' '.join(lines))}</p>"

    return "\n".join(block(b.split("\n")) for b in re.split(r"\n\s*\n", text.strip()) if b.strip())


@F.pandas_udf(StringType())
def guide_html(text: pd.Series) -> pd.Series:
    """``markdown_html`` of a column of guides, nulls as they are."""
    return text.map(lambda x: None if x is None else markdown_html(x))
