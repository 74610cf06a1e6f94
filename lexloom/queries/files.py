"""Queries that write a table with a sink and read it again with a reader, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import reports as R
from ..sources import markup, readers, sinks
from ..sources.steps import saved, shared_path
from ..streaming import crawl
from .common import SQL_LINES, table


def json_round_trip(spark, d):
    """Documents as JSON lines and back, in the order of their ids."""
    at = shared_path(spark, "json-lines")
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    assert sinks.json_lines(docs, at, ["doc_id"], dry_run=True) == docs.count()
    sinks.json_lines(docs, at, ["doc_id"])
    back = readers.json_lines(spark, at, "doc_id long, text string, lang string", "*.json")
    return back.select("doc_id", T.short_digest(F.col("text")).alias("digest"), "lang")


def json_bad_lines(spark, d):
    """Lines that are no objects are kept apart, blank ones skipped."""
    at = shared_path(spark, "json-bad")
    line = F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit('{"doc_id": '), "source")).when(F.col("doc_id") % 10 == 4, "").otherwise(F.to_json(F.struct("doc_id", "lang")))
    table(spark, d, "documents").select(line.alias("value")).write.text(at)
    back = saved(readers.json_lines(spark, at, "doc_id long, lang string", "*.txt", corrupt=True), "json-kept")
    return back.select("doc_id", "lang", F.col("_corrupt").alias("corrupt"))


def tsv_round_trip(spark, d):
    at = shared_path(spark, "table")
    sinks.table(table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), at, ["c_custkey"])
    return readers.table(spark, at, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")


def manifest_last_rows(spark, d):
    """A manifest with a row a document and a source a name: the last row of each counts."""
    at = shared_path(spark, "manifest")
    sinks.table(table(spark, d, "documents").select("source", "doc_id", "lang"), at, [F.col("doc_id").cast("long")])
    return readers.manifest(spark, at).select("source", F.col("doc_id").cast("long").alias("doc_id"), "lang")


def shard_round_trip(spark, d):
    """Records by word of the parts' names, in shards and back, with the number of their shard's files."""
    parts = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("lemma"), "p_brand", "p_size")
    records = parts.groupBy("lemma").agg(F.count("*").alias("count"), F.max("p_size").alias("top"), F.sort_array(F.collect_set("p_brand")).alias("files"))
    kind = F.when(F.col("top") > 49, "known").otherwise("unknown")
    at = shared_path(spark, "shards")
    sinks.shards(records.select("lemma", kind.alias("kind"), "count", F.create_map("lemma", "count").alias("forms"), "files"), at, 4)
    back = readers.shards(spark, at, "part-*.json")
    return back.select("lemma", "kind", "count", F.col("forms")[F.col("lemma")].alias("form_count"), F.size("files").cast("long").alias("n_files"), F.col("shard").isNotNull().alias("named"))


def decisions_scan(spark, d):
    """One object of objects a region: a verdict and a gloss for each nation."""
    at = shared_path(spark, "decisions")
    nations = table(spark, d, "nation")
    cell = F.struct(F.when(F.col("n_nationkey") % 2 == 0, "lemma").otherwise("foreign").alias("verdict"), F.lower("n_name").alias("gloss"))
    nations.groupBy("n_regionkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", cell)))).alias("value")).select("value").write.text(at)
    return readers.decisions(spark.read.text(at)).select("lemma", "verdict", "gloss")


def sentence_scan(spark, d):
    """Turns of users as sentences of a bz2 table, tabs and newlines made blanks first."""
    at = shared_path(spark, "sentences")
    turns = table(spark, d, "conversations").where("role = 'user'")
    line = F.concat_ws("\t", (F.col("conv_id") * 1000 + F.col("turn")).cast("string"), F.lit("epo"), T.one_field(F.col("text")))
    turns.select(line.alias("value")).write.option("compression", "bzip2").text(at)
    return readers.sentences(spark, at, "epo").select("id", T.short_digest(F.col("text")).alias("digest"))


def provenance_scan(spark, d):
    """Bullets of a provenance list about suppliers, some struck through, some without digest or address."""
    at = shared_path(spark, "provenance")
    key = F.col("s_suppkey")
    mark = F.when(key % 9 == 0, "~~").otherwise("")
    parts = F.concat_ws(" — ", F.col("s_name"), F.when(key % 3 != 0, F.concat(F.lit("sha256: "), T.short_digest(F.col("s_name")))), F.when(key % 4 != 0, F.concat(F.lit("nation "), "s_nationkey")), F.when(key % 5 != 0, F.concat(F.lit("https://x.org/"), "s_suppkey")))
    line = F.concat(F.lit("- "), mark, F.lit("`f"), "s_suppkey", F.lit(".txt`"), mark, F.lit(" — "), parts)
    heading = spark.createDataFrame([("# Sources",), ("| a | table |",)], "value string")
    table(spark, d, "supplier").select(line.alias("value")).unionByName(heading).write.text(at)
    return readers.provenance(spark.read.text(at))


def cited_line_scan(spark, d):
    """Citations in a Markdown text of each conversation: the turns' first letters with source and line."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", F.regexp_replace(F.substring("text", 1, 12), "[*\n`]", "_").alias("q"))
    piece = F.concat(F.lit("So *"), "q", F.lit("* — `c"), "conv_id", F.lit(":"), "turn", F.lit("` it is."))
    guides = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", piece.alias("p")))), lambda x: x["p"]), "\n\n").alias("text"))
    return guides.select(F.explode(readers.cited_lines(F.col("text"))).alias("c")).select("c.quote", "c.source", F.col("c.line").cast("long").alias("line"))


def printed_dictionary(spark, d):
    """Lines of a printed dictionary about parts, their words in the alphabet's letters or not."""
    line = F.concat(F.initcap("p_name"), F.when(F.col("p_size") > 25, F.concat(F.lit(" (size "), F.lit("x)"))).otherwise(""), F.lit(" = "), F.lower(F.translate("p_type", "QWXY", "kvsj")), F.lit("o, "), F.lower("p_name"), F.lit("."))
    return readers.printed_pairs(table(spark, d, "part").select(line.alias("value"))).groupBy("english", "sense", "word", "kind").agg(F.count("*").alias("n"))


def affix_preface(spark, d):
    """Lines ``base = gloss, derived = gloss`` about parts; other lines aren't taken."""
    word = F.element_at(F.split("p_name", " "), 1)
    line = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("Note: "), word)).otherwise(F.concat(word, F.lit("'o = "), "p_name", F.lit(", "), word, F.lit("'in'o = female "), word, F.lit(".")))
    return readers.affix_pairs(table(spark, d, "part").select(line.alias("value"))).groupBy("base", "base_gloss", "derived", "derived_gloss", "segmentation").agg(F.count("*").alias("n"))


def article_scan(spark, d):
    """XML articles about suppliers: a root, two derivatives with a tilde, translations in two languages, entities."""
    root = F.concat(F.lit("rad"), F.translate(F.col("s_suppkey").cast("string"), "0123456789", "abcdefghij"))
    xml = F.concat(
        F.lit("<?xml version='1.0'?><!DOCTYPE vortaro SYSTEM 'x.dtd'><vortaro><art><kap><ofc>"), (F.col("s_nationkey") % 10).cast("string"), F.lit("</ofc><rad>"), root, F.lit("</rad>/o</kap>"),
        F.lit("<drv><kap><tld/>o <fnt>x</fnt></kap><snc><trd lng='en'>"), "s_name", F.lit(" &amp; co &eacute;</trd><trd lng='en'>no</trd><trdgrp lng='fr'><trd lng='fr'>f"), "s_nationkey", F.lit("</trd></trdgrp></snc></drv>"),
        F.lit("<drv><kap>mal<tld/>a/</kap><trd lng='fr'>&unknown; &a_b;g</trd></drv><drv><kap><tld/></kap></drv></art></vortaro>"),
    )
    at = shared_path(spark, "articles")
    table(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 7 == 6, "<broken").otherwise(xml).alias("value")).write.text(at)
    rows = spark.read.text(at).createOrReplaceTempView("lexloom_articles")
    spark.udtf.register("lexloom_derivatives", readers.ArticleDerivatives)
    rows = spark.sql("SELECT f.word, f.rad, f.tail, f.ofc, f.gloss_en, f.gloss_fr FROM lexloom_articles, LATERAL lexloom_derivatives(value) f")
    return rows


def crawl_replies(spark, d):
    """Replies of a crawl about events: arrays in arrays, one level written out as a string."""
    ms = (F.lit(1_000_000_000_000) + F.col("event_id")).cast("long")
    item = F.concat(F.lit('["id'), "event_id", F.lit('", "u'), "user_id", F.lit('", '), ms, F.lit(', "<div>'), "event_type", F.lit('</div>"]'))
    reply = F.concat(F.lit(")]}'\n"), F.lit('[["wrb", '), F.when(F.col("event_id") % 2 == 0, F.to_json(F.array(item)).substr(F.lit(2), F.length(F.to_json(F.array(item))) - 2)).otherwise(item), F.lit(', null], ["x", 1]]'))
    table(spark, d, "events").select(reply.alias("reply")).createOrReplaceTempView("lexloom_replies")
    spark.udtf.register("lexloom_messages", readers.CrawlMessages)
    return spark.sql("SELECT f.id, f.author, f.epoch_ms, f.html FROM lexloom_replies, LATERAL lexloom_messages(reply) f")


def mail_round_trip(spark, d):
    """Turns as messages of a crawl, appended as mail folders by a stream and read again by their envelopes."""
    turns = table(spark, d, "conversations")
    number = F.col("conv_id") * 1000 + F.col("turn")
    rows = turns.select(F.concat(F.lit("m"), number).alias("id"), (F.lit(800_000_000_000) + number * 1000).cast("long").alias("epoch_ms"), F.concat("role", F.lit("@x.org")).alias("author"), F.lit("s").alias("subject"), F.col("text").alias("html"))
    at = shared_path(spark, "mail")
    rows.write.parquet(f"{at}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{at}/in")
    crawl.append_mbox(stream, f"{at}/mbox", f"{at}/audit", f"{at}/state", "a.group").awaitTermination()
    spark.dataSource.register(markup.Mbox)
    return spark.read.format("mbox").load(f"{at}/mbox").select("msgid", "author", "subject", "date", T.short_digest(F.col("text")).alias("digest"))


def stream_once(spark, d):
    """Events as a stream, one a user and type, appended with an audit; a second run finds nothing new."""
    at = shared_path(spark, "events")
    rows = table(spark, d, "events").select("user_id", "event_type", F.concat_ws("/", "user_id", "event_type").alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    rows.write.parquet(f"{at}/in")
    for _ in range(2):
        stream = spark.readStream.schema(rows.schema).parquet(f"{at}/in")
        crawl.append_audited(crawl.once(stream, "key", "ts", "1000 days"), f"{at}/out", f"{at}/audit", f"{at}/state").awaitTermination()
    return spark.read.parquet(f"{at}/out").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


def wiki_dump(spark, d):
    """Documents as pages of an XML dump: namespaces, redirects, scanned pages with their levels."""
    at, key = shared_path(spark, "dump"), F.col("doc_id")
    text = F.when(key % 11 == 5, "#REDIRECT [[x]]").when(key % 4 == 1, F.concat(F.lit('<noinclude><pagequality level="'), (key % 5).cast("string"), F.lit('" user="u" /></noinclude>'), F.substring("source", 1, 9))).otherwise(F.concat(F.lit("T "), F.col("lang"), F.lit(" & <b>"), F.col("source"), F.lit("</b>")))
    pages = table(spark, d, "documents").select(F.concat(F.lit("Page:Book "), (key % 7).cast("string"), F.lit("/"), key.cast("string")).alias("title"), F.when(key % 4 == 1, "104").when(key % 13 == 2, "1").otherwise("0").alias("ns"), F.struct(F.struct(text.alias("_VALUE"), F.length(text).alias("_bytes")).alias("text")).alias("revision"))
    pages.write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").save(at)
    return saved(readers.wiki_pages(spark, at), "wiki-pages")


def wiki_articles(spark, d):
    """Articles of the dump that are no redirects, with sizes and addresses."""
    kept = readers.articles(wiki_dump(spark, d)).withColumn("clean", F.upper("text"))
    sizes = R.article_statistics(kept)
    return sizes.join(R.provenance_index(kept, "https://x.org/"), "title").select("title", "is_redirect", F.col("raw_chars").cast("long").alias("raw_chars"), F.col("clean_chars").cast("long").alias("clean_chars"), "name", F.substring("sha256", 1, 12).alias("digest"), "url")


def wiki_books(spark, d):
    """Scanned pages of the dump by book and level."""
    return readers.scanned_pages(wiki_dump(spark, d)).groupBy("book", "level").agg(F.count("*").alias("n"), F.min("title").alias("first"))


def page_bundle(spark, d):
    """Nations as one JSON array, read back from it."""
    one = sinks.bundle(table(spark, d, "nation"), "n_nationkey")
    return one.select(F.posexplode(F.from_json("value", "array<struct<n_nationkey: int, n_name: string, n_regionkey: int>>")).alias("place", "r")).select("place", "r.*")


def provenance_append(spark, d):
    """Records are only ever added to: two batches of suppliers behind each other."""
    at = shared_path(spark, "records")
    rows = table(spark, d, "supplier").select("s_suppkey", "s_name")
    sinks.append(rows.where("s_suppkey % 2 = 0"), at)
    sinks.append(rows.where("s_suppkey % 3 = 0"), at)
    return readers.json_lines(spark, at, "s_suppkey long, s_name string", "*.json")


def dictionary_pass_a(spark, d):
    """A dictionary's pages about parts: heads on lines of their own, glosses with four pipes, some with three."""
    body = F.array_join(F.array(F.lit("<p>"), F.concat(F.element_at(F.split("p_name", " "), 1), F.lit("'")), F.concat(F.lit(" f1 "), "p_brand", F.lit(" | e "), "p_type")), "\n")
    tail = F.when(F.col("p_partkey") % 4 == 0, "| d | r .").otherwise("| d <i>2</i>|\n r | p .")
    html = F.concat(F.lit("<style>a|b</style>"), body, tail, F.lit("\n</p>"))
    return readers.dictionary_pages(table(spark, d, "part").select("p_partkey", html.alias("html")), keep=("p_partkey",)).select("p_partkey", "word", "fr", "en", "de", "ru", "pl")


def dictionary_pass_b(spark, d):
    """The same in running text: entries behind full stops."""
    word = F.translate(F.element_at(F.split("p_name", " "), 1), "qwxy", "kvsj")
    piece = lambda n: F.concat(word, F.lit(f"{n}' f {n} | e "), F.lower("p_brand"), F.lit(" | d | r | p ."))
    html = F.concat(F.translate(piece("o"), "#", " "), F.lit(" "), F.translate(piece("a"), "#", " "))
    return readers.dictionary_pages(table(spark, d, "part").select("p_partkey", html.alias("html")), flowing=True, keep=("p_partkey",)).select("p_partkey", F.col("ord").cast("long").alias("ord"), "word", "fr", "en", "pl")


def text_file_scan(spark, d):
    """One text file a document, read whole, without those of a list. A document without text has no file and no digest."""
    at, docs = shared_path(spark, "texts"), table(spark, d, "documents")
    name = F.concat_ws("-", F.col("doc_id").cast("string"), F.monotonically_increasing_id())
    sinks.text_files(docs.select(name.alias("source"), "text"), at)
    files = readers.folders_of_texts(spark, at, "text-digests", lambda f: f.select("source", T.short_digest(F.col("text")).alias("digest")))
    if one := files.head():
        path = f"{at}/*/{one['source']}"
        left = readers.text_files(spark, path, without=files.select("source").limit(0)).count()
        assert left == 1 and readers.text_files(spark, path, without=files.select("source")).count() == 0
    every = files.select("digest").unionByName(docs.where("text IS NULL").select(F.lit(None).cast("string").alias("digest")))
    return every.groupBy("digest").agg(F.count("*").alias("n"))


def line_scan(spark, d):
    """Lines of each source with their numbers, by digest of the first ten letters."""
    rows = readers.text_lines(table(spark, d, "documents").select(F.col("doc_id").alias("source"), "text"))
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.col("line") * F.length("text")).alias("weight"))


def guide_pages(spark, d):
    """Guides of regions as pages: numbered headings, tables, lists, paragraphs."""
    text = F.concat(F.lit("# 2.1 "), "r_name", F.lit("\n\n| a | b |\n|---|---|\n| *x* | `"), "r_regionkey", F.lit("` |\n\n- one\n- **two**\n\nText & [link](https://x.org/)."))
    return table(spark, d, "region").select("r_regionkey", R.guide_html(text).alias("page"))


_NAMED = [
    text_file_scan, line_scan, guide_pages, json_round_trip, json_bad_lines, tsv_round_trip, manifest_last_rows, shard_round_trip, decisions_scan, sentence_scan, provenance_scan, cited_line_scan, printed_dictionary, affix_preface, article_scan, crawl_replies, mail_round_trip,
    stream_once, wiki_dump, wiki_articles, wiki_books, page_bundle, provenance_append, dictionary_pass_a, dictionary_pass_b,
]
QUERIES = {f.__name__: f for f in _NAMED}
_DIGEST = "left(sha256({x}), 12)"
_DUMP = """pg AS (SELECT 'Page:Book ' || doc_id % 7 || '/' || doc_id AS title, CASE WHEN doc_id % 4 = 1 THEN '104' WHEN doc_id % 13 = 2 THEN '1' ELSE '0' END AS ns, doc_id % 11 = 5 AS is_redirect, doc_id,
  CASE WHEN doc_id % 11 = 5 THEN '#REDIRECT [[x]]' WHEN doc_id % 4 = 1 THEN '<noinclude><pagequality level="' || doc_id % 5 || '" user="u" /></noinclude>' || left(source, 9) ELSE 'T ' || lang || ' & <b>' || source || '</b>' END AS text FROM documents)"""
ORACLE_SQL = {
    "text_file_scan": r"SELECT left(sha256(regexp_replace(text, '\n$', '') || chr(10)), 12) AS digest, count(*) AS n FROM documents GROUP BY 1",
    "line_scan": f"WITH {SQL_LINES} SELECT doc_id AS source, count(*) AS n, CAST(sum(line * length(txt)) AS BIGINT) AS weight FROM lines GROUP BY 1",
    "guide_pages": """SELECT r_regionkey, '<h1 id="section-2-1">2.1 ' || r_name || '</h1>' || chr(10) || '<table><tr><th>a</th><th>b</th></tr><tr><td><em>x</em></td><td><code>' || r_regionkey || '</code></td></tr></table>' || chr(10) || '<ul><li>one</li><li><strong>two</strong></li></ul>' || chr(10) || '<p>Text &amp; <a href="https://x.org/">link</a>.</p>' AS page FROM region""",
    "json_round_trip": "SELECT doc_id, left(sha256(text), 12) AS digest, lang FROM documents",
    "json_bad_lines": "SELECT CASE WHEN doc_id % 10 <> 3 THEN doc_id END AS doc_id, CASE WHEN doc_id % 10 <> 3 THEN lang END AS lang, CASE WHEN doc_id % 10 = 3 THEN '{\"doc_id\": ' || source END AS corrupt FROM documents WHERE doc_id % 10 <> 4",
    "tsv_round_trip": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "manifest_last_rows": "SELECT source, max(doc_id) AS doc_id, arg_max(lang, doc_id) AS lang FROM documents GROUP BY source",
    "shard_round_trip": """WITH w AS (SELECT unnest(string_split(p_name, ' ')) AS lemma, p_brand, p_size FROM part)
      SELECT lemma, CASE WHEN max(p_size) > 49 THEN 'known' ELSE 'unknown' END AS kind, count(*) AS "count", count(*) AS form_count, count(DISTINCT p_brand) AS n_files, true AS named FROM w GROUP BY lemma""",
    "decisions_scan": "SELECT n_name AS lemma, CASE WHEN n_nationkey % 2 = 0 THEN 'lemma' ELSE 'foreign' END AS verdict, lower(n_name) AS gloss FROM nation",
    "sentence_scan": r"SELECT conv_id * 1000 + turn AS id, left(sha256(trim(regexp_replace(text, '[\t\n\r]+', ' ', 'g'))), 12) AS digest FROM conversations WHERE role = 'user'",
    "provenance_scan": """SELECT 'f' || s_suppkey || '.txt' AS file, s_name AS title, CASE WHEN s_suppkey % 3 <> 0 THEN left(sha256(s_name), 12) END AS sha, CASE WHEN s_suppkey % 4 <> 0 THEN 'nation ' || s_nationkey END AS origin,
      CASE WHEN s_suppkey % 5 <> 0 THEN 'https://x.org/' || s_suppkey END AS url, CASE WHEN s_suppkey % 9 = 0 THEN true END AS quarantined FROM supplier""",
    "cited_line_scan": r"SELECT regexp_replace(left(text, 12), '[*\n`]', '_', 'g') AS quote, 'c' || conv_id AS source, turn AS line FROM conversations",
    "printed_dictionary": """WITH p AS (SELECT array_to_string([upper(left(x, 1)) || substr(x, 2) for x in string_split(p_name, ' ')], ' ') AS english, CASE WHEN p_size > 25 THEN 'size x' ELSE '' END AS sense, unnest([lower(translate(p_type, 'QWXY', 'kvsj')) || 'o', p_name]) AS word FROM part)
      SELECT english, sense, word, CASE WHEN regexp_full_match(word, '[abcĉdefgĝhĥijĵklmnoprsŝtuŭvz]*[oaei]') THEN 'headword' WHEN regexp_full_match(word, '[abcĉdefgĝhĥijĵklmnoprsŝtuŭvz]+( [abcĉdefgĝhĥijĵklmnoprsŝtuŭvz]+)+') THEN 'phrase' ELSE 'reject' END AS kind, count(*) AS n FROM p GROUP BY ALL""",
    "affix_preface": """WITH p AS (SELECT p_name, string_split(p_name, ' ')[1] AS w FROM part WHERE p_partkey % 5 <> 0)
      SELECT w || 'o' AS base, p_name AS base_gloss, w || 'ino' AS derived, 'female ' || w AS derived_gloss, w || '''in''o' AS segmentation, count(*) AS n FROM p GROUP BY ALL""",
    "article_scan": """WITH s AS (SELECT *, 'rad' || translate(CAST(s_suppkey AS VARCHAR), '0123456789', 'abcdefghij') AS rad, CAST(s_nationkey % 10 AS VARCHAR) AS ofc FROM supplier WHERE s_suppkey % 7 <> 6)
      SELECT rad || 'o' AS word, rad, 'o' AS tail, ofc, s_name || ' & co é' AS gloss_en, 'f' || s_nationkey AS gloss_fr FROM s UNION ALL SELECT 'mal' || rad || 'a', rad, 'a', ofc, '', 'unknown g' FROM s""",
    "crawl_replies": "SELECT 'id' || event_id AS id, 'u' || user_id AS author, 1000000000000 + event_id AS epoch_ms, '<div>' || event_type || '</div>' AS html FROM events",
    "mail_round_trip": r"""WITH m AS (SELECT conv_id * 1000 + turn AS n, role, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS flat FROM conversations)
      SELECT '<gg-m' || n || '@scrape>' AS msgid, role AS author, '[gg-scrape] s' AS subject, strftime(make_timestamp((800000000 + n) * 1000000), '%Y-%m-%d') AS date, left(sha256(CASE WHEN length(flat) <= 1 OR regexp_matches(flat, '^([>|]|--$|begin [0-7]{3} |-----BEGIN )') THEN '' ELSE flat END), 12) AS digest FROM m""",
    "stream_once": "SELECT DISTINCT user_id, event_type, CAST(1 AS BIGINT) AS n FROM events",
    "wiki_dump": f"WITH {_DUMP} SELECT title, ns, is_redirect, text FROM pg",
    "wiki_articles": f"""WITH {_DUMP} SELECT title, false AS is_redirect, length(text) AS raw_chars, length(text) AS clean_chars, 'wp-' || translate(title, '/ ', '__') || '.txt' AS name, left(sha256(text), 12) AS digest, 'https://x.org/' || replace(title, ' ', '_') AS url FROM pg WHERE ns = '0' AND NOT is_redirect""",
    "wiki_books": f"""WITH {_DUMP} SELECT 'Book ' || doc_id % 7 AS book, CAST(CASE WHEN is_redirect THEN 0 ELSE doc_id % 5 END AS INT) AS level, count(*) AS n, min(title) AS "first" FROM pg WHERE ns = '104' GROUP BY ALL""",
    "page_bundle": "SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INT) AS place, * FROM nation",
    "provenance_append": "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 = 0",
    "dictionary_pass_a": "SELECT p_partkey, string_split(p_name, ' ')[1] || '''' AS word, 'f1 ' || p_brand AS fr, 'e ' || p_type AS en, 'd 2' AS de, 'r' AS ru, 'p' AS pl FROM part WHERE p_partkey % 4 <> 0 AND regexp_full_match(string_split(p_name, ' ')[1], '[abcĉdefgĝhĥijĵklmnoprsŝtuŭvz]+')",
    "dictionary_pass_b": "SELECT p_partkey, CAST(CASE WHEN x = 'o' THEN 0 ELSE 1 END AS BIGINT) AS ord, translate(string_split(p_name, ' ')[1], 'qwxy', 'kvsj') || x || '''' AS word, 'f ' || x AS fr, 'e ' || replace(lower(p_brand), '#', ' ') AS en, 'p' AS pl FROM part, (VALUES ('o'), ('a')) v(x)",
}
