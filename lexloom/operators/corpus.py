"""Corpus operators: normalisation, scoring, search, licences, books, pairs, catalogue."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as T

# Page furniture.
GUTENBERG_START = r"\*\*\*\s*START OF TH[EI]S? PROJECT GUTENBERG"
GUTENBERG_END = r"\*\*\*\s*END OF TH[EI]S? PROJECT GUTENBERG|^End of (?:the )?Project Gutenberg('s)?\b"
METADATA_LINE = r"(?U)^(?:collection|book|[0-9]+)(?=[^\W0-9_])"
NAVIGATION = r"^\s*(?:[←→►◄]|Elŝuti kiel|Indekso\s*:|\(p\.\s|Paĝo\.\s*$)"
# Cyrillic letters that look like Latin ones, and the Latin ones.
LOOKALIKES = ("аеорсухіѵјѕАЕОРСХІЈ", "aeopcyxivjsAEOPCXIJ")


def body_slice(lines: Column) -> Column:
    """Lines between the first start marker and the next end marker, null if one is missing, with what was cut at either end."""
    mark = lambda pattern, after: F.array_min(F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(pattern) & (i > after), i)), lambda i: i.isNotNull()))
    start = mark(GUTENBERG_START, F.lit(-1))
    end = mark(GUTENBERG_END, start)
    return F.when(start.isNotNull() & end.isNotNull(), F.struct(F.slice(lines, start + 2, end - start - 1).alias("body"), (start + 1).alias("head"), (F.size(lines) - end).alias("tail")))


def front_matter(lines: Column) -> Column:
    """How many lines of credit and transcriber's note a body opens with. A fold with a state: 0 blanks,
    1 credit, 2 blanks behind it, 3 note, 4 body."""
    def step(acc: Column, x: Column) -> Column:
        blank, state = F.trim(x) == "", acc["state"]
        now = F.when(state == 4, 4).when((state == 0) & blank, 0).when((state == 0) & x.rlike("^Produced by\\b"), 1).when((state == 1) & ~blank, 1).when(state.isin(1, 2) & blank, 2).when((state != 3) & x.rlike(r"(?i)^\s*TRANSCRIBER'?S NOTE"), 3).when((state == 3) & ~x.rlike(r"^\s{4,}\S"), 3).otherwise(4)
        return F.struct(now.cast("int").alias("state"), (acc["n"] + (now != 4).cast("int")).alias("n"))

    return F.aggregate(lines, F.struct(F.lit(0).alias("state"), F.lit(0).alias("n")), step)["n"]


def preamble(lines: Column) -> Column:
    """(body, method, head): lines behind the metadata line, or without the leading furniture."""
    at = F.array_min(F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(METADATA_LINE), i)), lambda i: i.isNotNull()))
    first = F.transform(F.slice(lines, 1, 20), lambda x: F.trim(x))
    author = F.trim(F.substring(F.try_element_at(F.filter(first, lambda x: x.startswith("de ")), F.lit(1)), F.lit(4), F.lit(1_000_000)))
    title = F.trim(F.regexp_replace(F.try_element_at(F.filter(first, lambda x: x.startswith("Indekso")), F.lit(1)), "^[^:]*:", ""))
    furniture = lambda x: (F.trim(x) == "") | x.rlike(NAVIGATION) | F.coalesce(F.trim(x) == author, F.lit(False)) | F.coalesce(F.trim(x) == title, F.lit(False))
    head = F.coalesce(F.array_min(F.filter(F.transform(lines, lambda x, i: F.when(~furniture(x), i)), lambda i: i.isNotNull())), F.size(lines))
    cut = F.coalesce(at + 1, head)
    return F.struct(F.slice(lines, cut + 1, F.size(lines)).alias("body"), F.when(at.isNotNull(), "wsrc-marker").otherwise("wsrc-fallback").alias("method"), cut.alias("head"))


def clean_lines(lines: Column) -> Column:
    """Lines without navigation and footnote arrows, single blank lines, none at the edges."""
    spaced = F.transform(lines, lambda x: F.replace(x, F.lit(" "), F.lit(" ")))
    prose = F.filter(spaced, lambda x: ~x.rlike(NAVIGATION) & ~(x.rlike(r"[→►]\s*$") & (F.length(F.trim(x)) < 60)))
    bare = F.transform(prose, lambda x: F.regexp_replace(F.regexp_replace(x, r"^\s*↑\s*", ""), r"\s+$", ""))
    return collapse_blanks(bare)


def collapse_blanks(lines: Column) -> Column:
    """Runs of blank lines to one, none at the edges."""
    joined = F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n")
    trimmed = F.regexp_replace(joined, "^\n+|\n+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "\n"))


def repair_lookalikes(text: Column) -> Column:
    """Cyrillic letters to Latin in tokens that hold both scripts. Mixed tokens are found by one pattern and
    mapped one by one; a text without any is left as it is."""
    mixed = r"(?U)\b(?=\w*[Ѐ-ӿ])(?=\w*[A-Za-zĉĝĥĵŝŭ])\w+\b"
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(mixed), F.lit(0)))
    swap = lambda acc, w: F.regexp_replace(acc, F.concat(F.lit(r"(?U)\b\Q"), w, F.lit(r"\E\b")), F.translate(w, *LOOKALIKES))
    return F.when(F.size(found) > 0, F.aggregate(found, text, swap)).otherwise(text)


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def source_fixes(source: Column, text: Column, fixes: dict[str, list[tuple[str, str]]]) -> Column:
    """(text, count) with the patterns of a source replaced."""
    out, count = text, F.lit(0)
    for name, rules in fixes.items():
        for pattern, put in rules:
            own = source == name
            count = count + F.when(own, F.regexp_count(out, F.lit(pattern))).otherwise(0)
            out = F.when(own, F.regexp_replace(out, pattern, put)).otherwise(out)
    return F.struct(out.alias("text"), count.alias("fixes"))


def method(source: Column) -> Column:
    return F.when(source.startswith("pg-"), "pg-markers").when(source.startswith("wsdump-"), "wsdump-clean").when(source.startswith("wp-"), "wp-clean").otherwise("wsrc")


def normalise(raw: DataFrame, fixes: dict[str, list[tuple[str, str]]] | None = None) -> DataFrame:
    """Raw sources (source, text) to clean text with its manifest columns; ``error`` where a source can't be sliced.
    Every step is a column of one row: no shuffle."""
    rows = raw.withColumn("lines", T.lines(F.col("text"))).withColumn("how", method(F.col("source"))).withColumn("pg", F.when(F.col("how") == "pg-markers", body_slice(F.col("lines")))).withColumn("ws", F.when(F.col("how") == "wsrc", preamble(F.col("lines"))))
    rows = rows.withColumn("front", F.when(F.col("pg").isNotNull(), front_matter(F.col("pg.body"))))
    body = F.when(F.col("how") == "pg-markers", F.slice("pg.body", F.col("front") + 1, F.greatest(F.size("pg.body"), F.lit(0)))).when(F.col("how") == "wsrc", F.col("ws.body")).otherwise(F.col("lines"))
    rows = rows.withColumn("clean", F.concat(F.array_join(clean_lines(body), "\n"), F.lit("\n")))
    hits = F.regexp_count("clean", F.lit("(?i)[cghjsu]x"))
    rows = rows.withColumn("x", T.x_system(F.col("clean"))).withColumn("h", T.h_system(F.col("x")))
    mixed = F.regexp_count("h", F.lit(r"(?U)\b(?=\w*[Ѐ-ӿ])(?=\w*[A-Za-zĉĝĥĵŝŭ])\w+\b"))
    rows = rows.withColumn("fixed", source_fixes(F.col("source"), repair_lookalikes(F.col("h")), fixes or {})).withColumn("out", nfc(F.col("fixed.text")))
    dash = lambda n: F.when(n > 0, n.cast("string")).otherwise("-")
    return rows.select(
        "source", F.coalesce("ws.method", "how").alias("method"), F.size("lines").alias("in_lines"), F.regexp_count("out", F.lit("\n")).alias("out_lines"), F.coalesce(F.col("pg.head") + F.col("front"), "ws.head", F.lit(0)).alias("head_stripped"),
        F.coalesce("pg.tail", F.lit(0)).alias("tail_stripped"), F.when(hits >= 100, F.concat(F.lit("converted:"), hits)).when(hits > 0, F.concat(F.lit("left:"), hits)).otherwise("-").alias("xsystem"), F.when(F.col("h") != F.col("x"), "converted").otherwise("-").alias("hsystem"),
        dash(mixed).alias("homoglyphs"), dash(F.col("fixed.fixes")).alias("fixes"), T.short_digest(F.col("out")).alias("sha256"), F.col("out").alias("text"), F.when((F.col("how") == "pg-markers") & F.col("pg").isNull(), "missing Gutenberg marker").alias("error"),
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count_if(F.col("error").isNull()).alias("normalized"), F.count("*").alias("sources"), F.sum("out_lines").alias("kept"), (F.sum("in_lines") - F.sum("out_lines")).alias("dropped"), F.count_if(F.col("xsystem").startswith("converted")).alias("x_converted"), F.count_if(F.col("hsystem") == "converted").alias("h_converted"), F.sort_array(F.collect_list(F.when(F.col("method") == "wsrc-fallback", F.col("source")))).alias("fallback"))


def text_score(forms: DataFrame, known: DataFrame) -> DataFrame:
    """source, tokens, recognised and singletons in percent, from (source, form, n) and the recognised forms."""
    hit = forms.join(known.select("form").distinct().withColumn("k", F.lit(True)), "form", "left")
    long = F.length("form") > 1
    total = F.sum(F.when(long, F.col("n")).otherwise(0))
    return hit.groupBy("source").agg(total.cast("long").alias("tokens"), F.round(100.0 * F.sum(F.when(long & F.col("k"), F.col("n")).otherwise(0)) / F.greatest(total, F.lit(1)), 6).alias("recognised"), F.round(100.0 * F.sum(F.when(~long, F.col("n")).otherwise(0)) / F.greatest(total, F.lit(1)), 6).alias("singletons"))


def triage(recognised: Column, singletons: Column) -> Column:
    """Usable, marginal or poor; what the rules leave open is unclassified."""
    return F.when((recognised >= 80) & (singletons < 5), "usable").when((recognised < 65) | (singletons >= 10), "poor").when(recognised.between(65, 80), "marginal").otherwise("unclassified")


def message_score(messages: DataFrame, known: DataFrame, least: float = 0.70, tokens: int = 10) -> DataFrame:
    """Messages (msgid, text) with the share of known tokens, all lengths counted, and whether they are kept."""
    cells = messages.select("msgid", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-zĉĝĥĵŝŭ]+"), F.lit(0))).alias("form"))
    cells = cells.groupBy("msgid", "form").agg(F.count("*").alias("n"))
    hit = cells.join(known.select("form").distinct().withColumn("k", F.lit(1)), "form", "left").groupBy("msgid").agg(F.sum("n").alias("tokens"), F.sum(F.when(F.col("k") == 1, F.col("n")).otherwise(0)).alias("hits"))
    return hit.withColumn("score", F.col("hits") / F.col("tokens")).withColumn("kept", (F.col("score") >= least) & (F.col("tokens") >= tokens))


def messages_by_year(scored: DataFrame, date: str = "date") -> DataFrame:
    """Kept messages (kept, date as YYYY-MM-DD or empty) of each year; undated ones have none."""
    year = F.substring(date, 1, 4)
    return scored.where(F.col("kept") & (year != "")).groupBy(year.alias("year")).agg(F.count("*").alias("n"))


def search_lines(lines: DataFrame, pattern: str, most: int = 10, shortest: int = 30, longest: int = 200) -> DataFrame:
    """Examples of a pattern spread over sources in turn; all hits are counted (by one aggregate beside the search, so
    that no task gathers them), short and long lines not shown."""
    found = lines.where(F.col("text").rlike(f"(?iu){pattern}"))
    hits = found.withColumn("total", found.agg(F.count("*").alias("n")).scalar())
    shown = hits.where(F.length(F.trim("text")).between(shortest, longest))
    turn = shown.withColumn("again", F.row_number().over(Window.partitionBy("source").orderBy("line"))).where(F.col("again") <= most)
    return turn.orderBy("again", "source").limit(most)


def compare_patterns(lines: DataFrame, a: str, b: str) -> DataFrame:
    return lines.agg(F.count_if(F.col("text").rlike(f"(?iu){a}")).alias("lines_a"), F.count_if(F.col("text").rlike(f"(?iu){b}")).alias("lines_b"))


def context(lines: DataFrame, key: str = "source", order: str = "line", before: int = 1, after: int = 2) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-before, after)
    return lines.withColumn("window", F.array_join(F.collect_list("text").over(w), "\n"))


def check_citations(citations: DataFrame, lines: DataFrame, before: int = 1, after: int = 2) -> DataFrame:
    """Citations (quote, source, line) against the lines about the cited one, white space apart."""
    near = citations.withColumn("at", F.explode(F.sequence(F.col("line") - before, F.col("line") + after))).join(lines.select("source", F.col("line").alias("at"), "text"), ["source", "at"], "left")
    flat = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    joined = near.groupBy("source", "line", "quote").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("at", "text")))), lambda x: x["text"]), " ").alias("found"))
    return joined.withColumn("status", F.when(F.col("found") == "", "no such line").when(flat(F.col("found")).contains(flat(F.col("quote"))), "ok").otherwise("not found"))


def book_assembly(pages: DataFrame) -> DataFrame:
    """Pages (book, title, text, level) to books in page order with the number of good pages. Furniture goes per page, before joining."""
    bare = F.regexp_replace(F.regexp_replace("text", "(?s)<noinclude>.*?</noinclude>", ""), "(?s)<noinclude>.*$", "")
    rows = pages.select("book", T.page_key(F.col("title")).alias("key"), bare.alias("text"), "level")
    return rows.groupBy("book").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("key", "text"))), lambda x: x["text"]), "\n").alias("text"), F.count_if(F.col("level") >= 3).alias("good"), F.count("*").alias("scanned"))


def free_to_use(death: Column, year: Column, as_of: int = 2026) -> Column:
    """Reasons why a work is free: 71 years after the last author's death, or 96 after publication."""
    return F.array_compact(F.array(F.when(death + 71 <= as_of, "source-country"), F.when(year + 96 <= as_of, "US")))


def names_in(books: DataFrame, names: DataFrame, gram: int = 4) -> DataFrame:
    """Books (book) with the names (name, ...) that their text contains, as a join on a name's first letters: a book
    offers all its stretches of one to ``gram`` letters, so neither side has to be small."""
    every = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(gram)), lambda n: F.when(F.length("book") >= n, F.transform(F.sequence(F.lit(1), F.length("book") - n + 1), lambda i: F.substring(F.col("book"), i, n))).otherwise(F.array().cast("array<string>"))))
    offered = books.select("book", F.explode(F.array_distinct(every)).alias("start"))
    return offered.join(names.where("name != ''").withColumn("start", F.substring("name", 1, gram)), "start").where(F.col("book").contains(F.col("name"))).drop("start")


def licence_verdict(books: DataFrame, authors: DataFrame, held: tuple[str, ...] = (), least_pages: int = 100, as_of: int = 2026) -> DataFrame:
    """Books (book, good) with credited authors (name, death) found in the title, the title's latest year and the first reason against."""
    credited = names_in(books.select("book").distinct(), authors).groupBy("book").agg(F.max("death").alias("death"), F.sort_array(F.collect_set("name")).alias("authors"))
    credited = books.select("book").distinct().join(credited, "book", "left").select("book", "death", F.coalesce("authors", F.array().cast("array<string>")).alias("authors"))
    named = books.join(credited, "book").withColumn("year", T.latest_year(F.col("book"))).withColumn("basis", free_to_use(F.col("death"), F.col("year"), as_of))
    is_held = reduce(lambda c, h: c | F.col("book").contains(h), held, F.lit(False))
    why = F.when(is_held, "held").when(F.size("basis") == 0, "not free").when(F.col("good") < least_pages, "too few pages")
    return named.withColumn("reason", why)


def acquisition_gate(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates (name, rights, text) with the first reason against taking them: held, rights, copy, markers."""
    held = existing.select("name").distinct().withColumn("is_held", F.lit(True))
    copies = existing.select(F.sha2("text", 256).alias("sha")).distinct().withColumn("is_copy", F.lit(True))
    rows = candidates.withColumn("sha", F.sha2("text", 256)).join(held, "name", "left").join(copies, "sha", "left")
    marked = F.col("text").rlike(GUTENBERG_START) & F.col("text").rlike("(?m)" + GUTENBERG_END)
    return rows.select("name", "sha", F.when(F.col("is_held"), "already held").when(~F.lower("rights").contains("public domain"), "rights").when(F.col("is_copy"), "exact copy").when(~marked, "markers missing").alias("reason"))


def new_content(candidates: DataFrame, existing: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text no existing row has, by digest."""
    return candidates.withColumn("__sha", F.sha2(text, 256)).join(existing.select(F.sha2(text, 256).alias("__sha")).distinct(), "__sha", "left_anti").drop("__sha")


def parallel_pairs(links: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Links (a, b), in either direction, between sentences (id, text) of two languages; each pair once."""
    a, b = left.select(F.col("id").alias("left_id"), F.col("text").alias("left_text")), right.select(F.col("id").alias("right_id"), F.col("text").alias("right_text"))
    turned = links.select(F.col("a").alias("left_id"), F.col("b").alias("right_id")).unionByName(links.select(F.col("b").alias("left_id"), F.col("a").alias("right_id")))
    return turned.join(a.select("left_id"), "left_id", "left_semi").join(b.select("right_id"), "right_id", "left_semi").distinct().join(a, "left_id").join(b, "right_id").select("left_id", "right_id", "left_text", "right_text")


def with_bases(pairs: DataFrame, bases: DataFrame) -> DataFrame:
    """Pairs with the base of either side (id, base); a side without one is an error when the rows are read."""
    base = bases.groupBy("id").agg(F.max("base").alias("base"))
    joined = pairs.join(base.select(F.col("id").alias("left_id"), F.col("base").alias("left_base")), "left_id", "left").join(base.select(F.col("id").alias("right_id"), F.col("base").alias("right_base")), "right_id", "left")
    need = lambda c, i: F.when(F.col(c).isNull(), F.raise_error(F.concat(F.lit("no base for sentence "), F.col(i).cast("string"))).cast("string")).otherwise(F.col(c))
    return joined.withColumns({"left_base": need("left_base", "left_id"), "right_base": need("right_base", "right_id")})


def missing_bases(pairs: DataFrame, bases: DataFrame) -> DataFrame:
    wanted = pairs.select(F.col("left_id").alias("id")).unionByName(pairs.select(F.col("right_id").alias("id"))).distinct()
    return wanted.join(bases.select("id"), "id", "left_anti")


def subset_of(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs both of whose sentences are in the given sets."""
    return pairs.join(left.select(F.col("id").alias("left_id")), "left_id", "left_semi").join(right.select(F.col("id").alias("right_id")), "right_id", "left_semi")


def drifted(subset: DataFrame, full: DataFrame) -> DataFrame:
    """Sentences of a subset whose text isn't that of the full set."""
    return subset.join(full.select("id", F.col("text").alias("full_text")), "id", "left").where(~F.col("text").eqNullSafe(F.col("full_text")))


def catalogue(provenance: DataFrame, manifest: DataFrame, multilingual: DataFrame, english: DataFrame, poor: DataFrame) -> DataFrame:
    """Provenance (file, ...; the last row of a file counts) with its manifest columns and an exclusion label."""
    last = provenance.withColumn("__r", F.row_number().over(Window.partitionBy("file").orderBy(F.col("ord").desc()))).where("__r = 1").drop("__r")
    flag = lambda d, n: d.select("file").distinct().withColumn(n, F.lit(True))
    rows = last.join(manifest, "file", "left").join(flag(english, "e"), "file", "left").join(flag(multilingual, "m"), "file", "left").join(flag(poor, "p"), "file", "left")
    return rows.withColumn("excluded", F.when(F.col("e"), "english").when(F.col("m"), "multilingual").when(F.col("p"), "OCR")).drop("e", "m", "p")


def catalogue_counts(rows: DataFrame) -> DataFrame:
    """All, pool, excluded and quarantined; here an excluded source that is quarantined counts as quarantined only."""
    out, q = F.col("excluded").isNotNull(), F.coalesce("quarantined", F.lit(False))
    return rows.agg(F.count("*").alias("n_all"), F.count_if(~out & ~q).alias("n_pool"), F.count_if(out & ~q).alias("n_excluded"), F.count_if(q).alias("n_quarantined"))


def catalogue_filter(rows: DataFrame, which: str = "all", needle: str = "") -> DataFrame:
    """As the catalogue's reader filters: here 'excluded' holds quarantined sources too."""
    out, q = F.col("excluded").isNotNull(), F.coalesce("quarantined", F.lit(False))
    keep = {"all": F.lit(True), "pool": ~out & ~q, "excluded": out | q, "quarantined": q}[which]
    text = F.lower(F.concat_ws(" ", "file", "title", "origin"))
    return rows.where(keep & text.contains(needle.lower()))


def dictionary_search(entries: DataFrame, needle: str = "", pos: str | None = None, source: str | None = None, limit: int = 50) -> DataFrame:
    """The first entries, in their order, that match part of speech, source prefix and a part of word or gloss."""
    keep = F.lower("word").contains(needle.lower()) | F.lower("gloss_en").contains(needle.lower())
    if pos:
        keep &= F.col("pos") == pos
    if source:
        keep &= F.col("source").startswith(source)
    return entries.where(keep).orderBy("ord").limit(limit)


def pack_shards(sizes: DataFrame, shards: int, most: int = 100_000) -> DataFrame:
    """Files (name, size) to shards, longest first into the lightest, the lowest on ties. A fold over one sorted
    array, for lists of files that are planned by hand: more than ``most`` files are an error."""
    listed = F.collect_list(F.struct("size", "name"))
    bounded = F.when(F.count("*") > most, F.raise_error(F.lit(f"more than {most} files to pack"))).otherwise(listed)
    order = F.array_sort(bounded, lambda a, b: F.when(a["size"] != b["size"], F.when(a["size"] > b["size"], -1).otherwise(1)).when(a["name"] > b["name"], -1).when(a["name"] < b["name"], 1).otherwise(0))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("w"), F.array().cast("array<struct<name: string, size: bigint, shard: int>>").alias("out"))

    def step(acc: Column, f: Column) -> Column:
        at = F.array_position(acc["w"], F.array_min(acc["w"])).cast("int")
        return F.struct(F.transform(acc["w"], lambda x, i: F.when(i + 1 == at, x + f["size"]).otherwise(x)).alias("w"), F.concat(acc["out"], F.array(F.struct(f["name"].alias("name"), f["size"].cast("long").alias("size"), (at - 1).cast("int").alias("shard")))).alias("out"))

    return sizes.agg(F.aggregate(order, start, step)["out"].alias("o")).select(F.inline("o"))


def curation(articles: DataFrame, column: str = "n_chars", bars: tuple[int, ...] = (1000, 2000, 3000, 5000)) -> DataFrame:
    return articles.agg(F.count("*").alias("articles"), *(F.count_if(F.col(column) >= b).alias(f"at_least_{b}") for b in bars))


def size_gate(articles: DataFrame, least: int, most: int, column: str = "n_chars") -> DataFrame:
    return articles.where(F.col(column).between(least, most))


def months(first: str, last: str, spark) -> DataFrame:
    """Month windows of a crawl, as YYYY-MM."""
    return spark.sql(f"SELECT date_format(m, 'yyyy-MM') AS month FROM (SELECT explode(sequence(DATE '{first}-01', DATE '{last}-01', INTERVAL 1 MONTH)) AS m)")
