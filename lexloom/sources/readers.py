"""Readers: text, lines, JSON lines, tables of tab-separated values, XML dumps, archives, Markdown."""

from __future__ import annotations

import html
import json
import re
import tarfile
import xml.etree.ElementTree as ET
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as X
from .steps import saved, session

#: Schemas of the tables that operators exchange.
ENTRY = "word string, pos string, gloss_en string, gloss_fr string, root string, morphology struct<prefixes: array<struct<m: string, gloss: string>>, stem: string, suffixes: array<struct<m: string, gloss: string>>, ending: string>, source string, derived boolean, dated_gloss string, english_headwords array<string>, grammar_refs array<struct<section: string, topic: string>>, attestation struct<count: bigint, sources: bigint, sources_lit: bigint, sources_wiki: bigint>, citations array<struct<source: string, text: string>>"
LEMMA = "lemma string, kind string, count bigint, pos_guess string, forms map<string, bigint>, citations array<struct<source: string, line: bigint, text: string>>, caps bigint, lower bigint, files array<string>, verdict string, gloss string, note string"
LEDGER = "lemma string, verdict string, gloss string, note string, reviewed_in array<string>, disputed array<struct<field: string, shard: string, value: string, kept: string>>"


def text_files(spark: SparkSession, path: str, pattern: str = "*.txt", without: DataFrame | None = None) -> DataFrame:
    """source (file name) and whole text; ``without`` (source) is left out, and Spark skips files without a byte. Names that end in .txt say that nothing is packed:
    their bytes are taken as they are, since Spark's text reader copies the session's settings for every file."""
    reader, source = spark.read.option("pathGlobFilter", pattern), F.col("_metadata.file_name").alias("source")
    plain = pattern.endswith(".txt")
    found = reader.format("binaryFile").load(path).select(source, F.col("content").cast("string").alias("text")) if plain else reader.text(path, wholetext=True).select(source, F.col("value").alias("text"))
    return found if without is None else found.join(without.select("source"), "source", "left_anti")


def folders_of_texts(spark: SparkSession, path: str, name: str, pick: Callable[[DataFrame], DataFrame], pattern: str = "*.txt", without: DataFrame | None = None) -> DataFrame:
    """``pick`` of the text files in the folders of a folder, saved. The driver holds the name and place of every file that
    a read lists, so files are read a folder at a time; small files are packed by what opening one costs."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    folders = sorted(f.getPath().toString() for f in found if f.isDirectory())
    none = pick(spark.createDataFrame([], "source string, text string"))
    with session(spark, spark__sql__files__openCostInBytes=str(64 << 10)):
        return saved(none, name, further=(pick(text_files(spark, f, pattern, without)) for f in folders))


def text_lines(docs: DataFrame) -> DataFrame:
    """source, line (from 1), text."""
    return docs.select("source", F.posexplode(X.lines(F.col("text"))).alias("line", "text")).withColumn("line", F.col("line") + 1)


def json_lines(spark: SparkSession, path: str, schema: str, pattern: str = "*.jsonl", corrupt: bool = False) -> DataFrame:
    """One object a line, blank lines skipped. A bad line fails the read, or with ``corrupt`` is kept in ``_corrupt``."""
    reader = spark.read.schema(schema + (", _corrupt string" if corrupt else "")).option("pathGlobFilter", pattern).option("mode", "PERMISSIVE" if corrupt else "FAILFAST")
    return (reader.option("columnNameOfCorruptRecord", "_corrupt") if corrupt else reader).json(path)


def shards(spark: SparkSession, path: str, pattern: str = "shard-*.jsonl") -> DataFrame:
    """Lemma records of all shard files with the file's name as ``shard``."""
    return spark.read.schema(LEMMA).option("pathGlobFilter", pattern).json(path).select("*", F.col("_metadata.file_name").alias("shard"))


def decisions(text: DataFrame, column: str = "value") -> DataFrame:
    """One JSON object of objects to lemma, verdict, gloss, note."""
    whole = F.from_json(F.col(column), "map<string, struct<verdict: string, gloss: string, note: string>>")
    return text.select(F.explode(whole).alias("lemma", "d")).select("lemma", "d.*")


def table(spark: SparkSession, path: str, schema: str | None = None, header: bool = True) -> DataFrame:
    """Tab-separated values without quoting; also from bz2."""
    reader = spark.read.option("sep", "\t").option("quote", "").option("header", header)
    return (reader.schema(schema) if schema else reader).csv(path)


def manifest(spark: SparkSession, path: str, key: str = "source") -> DataFrame:
    """A manifest with one row a source, the last one. Files follow each other by their paths and rows as they stand there:
    Spark reads large files first, so the order in which rows arrive says nothing."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    rows = table(spark, path).withColumn("__at", at)
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in (key, "__at")]), "__at").alias("r")).select(key, "r.*")


def sentences(spark: SparkSession, path: str, lang: str) -> DataFrame:
    """Sentences (id, lang, text[, date]); short rows, other languages and repeated ids are errors when read."""
    rows = spark.read.text(path).select(F.split("value", "\t").alias("c"))
    fail = lambda what: F.raise_error(F.concat(F.lit(what + ": "), F.array_join("c", "\t"))).cast("string")
    text = F.when(F.size("c") < 3, fail("fewer than 3 columns")).when(F.col("c")[1] != lang, fail("another language")).otherwise(F.col("c")[2])
    named = rows.select(F.col("c")[0].cast("long").alias("id"), text.alias("text"))
    counted = named.groupBy("id").agg(F.min("text").alias("text"), F.count("*").alias("n"))
    return counted.select("id", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("repeated id "), F.col("id").cast("string"))).cast("string")).otherwise(F.col("text")).alias("text"))


class TarMember(DataSource):
    """Lines of one named member of a tar archive: ``spark.read.format("tar_member").option("path", …).option("member", …)``."""

    @classmethod
    def name(cls) -> str:
        return "tar_member"

    def schema(self) -> str:
        return "line long, value string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _TarReader(self.options)


class _TarReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.member = options["path"], options["member"]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # an archive can only be read from its start

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with tarfile.open(self.path, "r|*") as archive:
            for found in archive:
                if found.name == self.member and (f := archive.extractfile(found)):
                    for i, line in enumerate(f, 1):
                        yield i, line.decode().rstrip("\r\n")
                    return
        raise FileNotFoundError(f"no member {self.member} in {self.path}")


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """title, ns, is_redirect, text of a dump's pages; bz2 is read as it is."""
    schema = "title string, ns string, redirect struct<_title: string>, revision struct<text: struct<_VALUE: string>>"
    found = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    text = F.coalesce("revision.text._VALUE", F.lit(""))
    return found.select("title", "ns", (F.col("redirect").isNotNull() | F.trim(text).rlike("(?i)^#(REDIRECT|ALIDIREKTI)")).alias("is_redirect"), text.alias("text"))


def articles(pages: DataFrame) -> DataFrame:
    return pages.where("ns = '0' AND NOT is_redirect")


def scanned_pages(pages: DataFrame) -> DataFrame:
    """book, title, level, text of proofread pages (ns 104); a page without a level has 0."""
    level = F.coalesce(F.nullif(F.regexp_extract("text", '<pagequality level="([0-9])"', 1), F.lit("")).cast("int"), F.lit(0))
    bare = F.regexp_replace("title", "^[^:]*:", "")
    return pages.where("ns = '104'").select(F.regexp_replace(bare, "/[^/]*$", "").alias("book"), "title", level.alias("level"), "text")


def provenance(lines: DataFrame, column: str = "value") -> DataFrame:
    """Bullets of a provenance list: file, title, sha, origin, url, quarantined."""
    m = lambda i: F.regexp_extract(F.col(column), r"^- (~~)?`([^`]+)`(?:~~)?\s*[—-]\s*(.*)$", i)
    rows = lines.where(m(2) != "").select(m(2).alias("file"), (m(1) != "").alias("quarantined"), F.transform(F.split(F.regexp_replace(m(3), "~~", ""), r"\s+—\s+"), lambda p: F.trim(p)).alias("p"))
    sha, url = F.filter("p", lambda p: p.startswith("sha256:")), F.filter("p", lambda p: p.startswith("http"))
    rest = F.filter(F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))), lambda p: ~p.startswith("sha256:") & ~p.startswith("http"))
    return rows.select("file", F.col("p")[0].alias("title"), F.regexp_replace(F.try_element_at(sha, F.lit(1)), "^sha256:\\s*", "").alias("sha"), F.try_element_at(rest, F.lit(1)).alias("origin"), F.try_element_at(url, F.lit(1)).alias("url"), F.when(F.col("quarantined"), True).alias("quarantined"))


def cited_lines(text: Column) -> Column:
    """Citations *quote* — `source:line` of a Markdown text, as structs."""
    pattern = r"(?s)\*([^*]+)\*\s*—\s*`([^`:]+):([0-9]+)`"
    parts = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in (1, 2, 3)]
    return F.transform(F.arrays_zip(*parts), lambda x: F.struct(x["0"].alias("quote"), x["1"].alias("source"), x["2"].cast("int").alias("line")))


def bibliography(page: Column) -> Column:
    """Title, author and rights out of a catalogue page's HTML."""
    cell = lambda name: F.nullif(unescape(X.strip_tags(F.regexp_extract(page, rf"(?is)<th[^>]*>\s*{name}\s*</th>\s*<td[^>]*>(.*?)</td>", 1))), F.lit(""))
    return F.struct(cell("Title").alias("title"), cell("Author").alias("author"), cell("Copyright Status").alias("rights"))


@F.pandas_udf(StringType())
def unescape(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else html.unescape(x))


#: What makes a value of a reply a time (seconds since 1970 in milliseconds, by size or by 13 digits from
#: 1), and a string a message's body.
TIME_DIGITS, TIME_RANGE, BODY_LENGTH, BODY_SIGN = r"1[0-9]{12}", (7e11, 2e12), 200, "<div"


def _role(x: object) -> str:
    """What a value of a reply's array may be: time, body, name or nothing of interest."""
    if isinstance(x, str):
        return "time" if re.fullmatch(TIME_DIGITS, x) else "body" if len(x) > BODY_LENGTH or BODY_SIGN in x else "name"
    return "time" if type(x) in (int, float) and TIME_RANGE[0] < x < TIME_RANGE[1] else ""


def _arrays(root: object) -> Iterator[list]:
    """All arrays of a parsed reply, outer ones first, those written out in strings too."""
    waiting = deque([root])
    while waiting:
        node = waiting.popleft()
        if isinstance(node, str) and node.startswith(("[", "{")):
            try:
                node = json.loads(node)
            except ValueError:
                continue
        if isinstance(node, list):
            yield node
            waiting.extendleft(reversed(node))


def messages_in(reply: str) -> Iterator[dict]:
    """Message-shaped arrays anywhere in a batchexecute reply: id, author, epoch_ms, html. Such an array has four values
    or more, among them a time and a body; its first other strings are the id and the author."""
    try:
        root = json.loads(reply.removeprefix(")]}'").strip())
    except ValueError:
        return
    for node in _arrays(root):
        by = {role: [x for x in node if _role(x) == role] for role in ("time", "body", "name")}
        if len(node) >= 4 and by["time"] and by["body"]:
            identity, author = [*by["name"], "", ""][:2]
            yield {"id": identity, "author": author, "epoch_ms": int(by["time"][0]), "html": by["body"][0]}


_MESSAGE = T.StructType([T.StructField("id", T.StringType()), T.StructField("author", T.StringType()), T.StructField("epoch_ms", T.LongType()), T.StructField("html", T.StringType())])
_DERIVATIVE = T.StructType([T.StructField(c, T.StringType()) for c in ("word", "rad", "tail", "ofc", "gloss_en", "gloss_fr")])


@F.udtf(returnType=_MESSAGE)
class CrawlMessages:
    """Rows of ``messages_in`` for each reply."""

    def eval(self, reply: str):
        for m in messages_in(reply or ""):
            yield m["id"], m["author"], m["epoch_ms"], m["html"]


#: Entities that XML itself resolves.
XML_ENTITIES = frozenset(["amp", "lt", "gt", "quot", "apos"])


def resolve_entities(text: str, custom: dict[str, str] | None = None) -> str:
    """Named entities to characters; the five of XML stay, unknown names lose their marks, names with ``_`` go."""
    known = {**{k: f"&{k};" for k in XML_ENTITIES}, **{k: v for k, v in (custom or {}).items() if v and k not in XML_ENTITIES}}
    return re.sub(r"&(\w+);", lambda m: known.get(m[1]) or html.entities.html5.get(f"{m[1]};") or ("" if "_" in m[1] else m[1]), text)


#: Elements of a headword that aren't said.
UNSAID = ("fnt", "ofc")


def _whole(node: ET.Element | None) -> str:
    return "" if node is None else "".join(node.itertext()).strip()


def _headword(node: ET.Element, root: str) -> str:
    """A derivative's headword: its text with the root in place of the tilde, without blanks and bars."""
    said = lambda e: root if e.tag == "tld" else "" if e.tag in UNSAID else "".join(e.itertext())
    return re.sub(r"[\s/]+", "", (node.text or "") + "".join(said(e) + (e.tail or "") for e in node)).lower()


def article_derivatives(raw: str, custom: dict[str, str] | None = None) -> list[tuple]:
    """(word, root, tail, official, gloss_en, gloss_fr) of the derivatives in a dictionary article's XML: each with a
    headword other than the root, and its first translation in either language. Broken XML has none."""
    try:
        article = ET.fromstring(resolve_entities(re.sub(r"<!DOCTYPE[^>]*>", "", raw, count=1), custom)).find("art")
    except ET.ParseError:
        return []
    root, official = (_whole(None if article is None else article.find(f"kap/{x}")) for x in ("rad", "ofc"))
    if len(root) < 2 or "/" in root:
        return []
    heads = [(_headword(drv.find("kap"), root), drv) for drv in article.findall("drv") if drv.find("kap") is not None]
    first = lambda drv, lang: next((t for t in map(_whole, drv.findall(f".//trd[@lng='{lang}']")) if t), "")
    return [(word, root, word[-1] if word[-1] in "oaei" else "o", official, first(drv, "en"), first(drv, "fr")) for word, drv in heads if word not in ("", root)]


@F.udtf(returnType=_DERIVATIVE)
class ArticleDerivatives:
    def eval(self, raw: str):
        yield from article_derivatives(raw or "")


#: Languages of a dictionary's glosses, in their order, and letters of its heads.
GLOSSES = ("fr", "en", "de", "ru", "pl")
HEAD_LETTERS = "abcĉdefgĝhĥijĵklmnoprsŝtuŭvzABCĈDEFGĜHĤIJĴKLMNOPRSŜTUŬVZ"
_ENTRIES = "array<struct<word: string, fr: string, en: string, de: string, ru: string, pl: string>>"


def piped_entries(lines: Iterable[str], letters: str = HEAD_LETTERS) -> list[tuple[str, list[str]]]:
    """Pass A: a word alone on a line, its gloss the lines up to the next one, with four pipes."""
    head = re.compile(rf"[{letters}][{letters}']*")
    found, word, gloss = [], None, []
    for line in [*map(str.strip, lines), None]:
        if line is not None and not head.fullmatch(line):
            gloss.append(line)
            continue
        fields = [x.strip() for x in " ".join(" ".join(gloss).split()).split("|")]
        if word and len(fields) == len(GLOSSES):
            found.append((word, [*fields[:-1], re.sub(r"\s*\.$", "", fields[-1])]))
        word, gloss = line, []
    return found


def flowing_entries(text: str, letters: str = HEAD_LETTERS) -> list[tuple[str, list[str]]]:
    """Passes B and C: ``word a | b | c | d | e.`` in running text, the word behind a full stop, a closing
    quotation mark, a section letter or the start."""
    word = rf"[{letters}]+(?:'[{letters}]+)*'?"
    field = r"\s*([^|]{1,300}?)\s*"
    entry = re.compile(rf"(?:^|(?<=[.»]))\s*(?:[A-ZĈĜĤĴŜŬ]\s+)?({word}){field}\|{field}\|{field}\|{field}\|\s*(.{{1,350}}?)\s*\.(?=\s*(?:[{letters}]|$))")
    return [(m[1], list(m.groups()[1:])) for m in entry.finditer(" ".join(text.split()))]


def dictionary_pages(pages: DataFrame, flowing: bool = False, html_column: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """Entries (word, ord, fr, en, de, ru, pl) of a dictionary's pages: by words on lines of their own (pass A), or in running
    text (passes B and C). Scripts, styles and tags go first, inside the JVM."""
    read = flowing_entries if flowing else (lambda text: piped_entries(text.split("\n")))

    @F.udf(_ENTRIES, useArrow=True)
    def entries(text):
        return [(word, *fields) for word, fields in read(text or "")]

    bare = F.regexp_replace(F.regexp_replace(html_column, r"(?s)<(script|style)[^>]*>.*?</\1>", ""), "<[^>]+>", " ")
    plain = F.regexp_replace(F.translate(bare, "\u00a0", " "), "[ \t]+", " ")
    return pages.select(*keep, F.posexplode(entries(plain)).alias("ord", "e")).select(*keep, "ord", "e.*")


#: The two formats of lines of a printed dictionary.
PRINTED_LINE = r"^([A-Z][A-Za-z' -]{1,40}?)\s*(\([^)]{1,40}\))?\s*=\s*([a-zĉĝĥĵŝŭ,\s'-]{2,60})\.\s*$"
AFFIX_LINE = r"^([a-zĉĝĥĵŝŭ']{2,20})\s*=\s*([^,;]{2,40})[,;]\s*([a-zĉĝĥĵŝŭ']{2,25})\s*=\s*([^.;]{2,50})"


def printed_pairs(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines ``Head (sense) = a, b.`` to english, sense, word, kind: headword, phrase or reject."""
    m = lambda i: F.regexp_extract(F.trim(column), PRINTED_LINE, i)
    cells = lines.where(m(1) != "").select(F.trim(m(1)).alias("english"), F.regexp_replace(m(2), r"^[() ]+|[() ]+$", "").alias("sense"), F.explode(F.split(m(3), ",")).alias("word"))
    words = cells.withColumn("word", F.replace(F.trim("word"), F.lit("'"), F.lit(""))).where("word != ''")
    return words.withColumn("kind", F.when(X.headword(F.col("word")), "headword").when(X.phrase(F.col("word")), "phrase").otherwise("reject"))


def affix_pairs(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines ``base = gloss, derived = gloss``: both with their glosses, and the derived word as segmented."""
    m = lambda i: F.trim(F.regexp_extract(F.trim(column), AFFIX_LINE, i))
    bare = lambda c: F.replace(c, F.lit("'"), F.lit(""))
    return lines.where(m(1) != "").select(bare(m(1)).alias("base"), m(2).alias("base_gloss"), bare(m(3)).alias("derived"), m(4).alias("derived_gloss"), m(3).alias("segmentation"))
