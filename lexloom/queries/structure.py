"""Queries of the join, ledger, lexicon, catalogue, pair, book and stream operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus as O
from ..operators import curation as C
from ..operators import lexicon as L
from ..streaming import crawl
from .common import LETTERS, SQL_CITE, table

AUTHORS = [("Apache", 1917), ("MIT", 1962), ("Creative", 1950), ("src1", 1959)]


def _sides(spark, d):
    turns = table(spark, d, "conversations").withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    return turns.where("role = 'user'").select("id", "text"), turns.where("role = 'assistant'").select("id", "text"), turns


def _links(turns):
    return turns.select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(turns.where("id % 2 = 0").select((F.col("id") + 1).alias("a"), F.col("id").alias("b")))


def parallel_pairs(spark, d):
    left, right, turns = _sides(spark, d)
    return O.parallel_pairs(_links(turns), left, right)


def pairs_cc0(spark, d):
    left, right, _ = _sides(spark, d)
    return O.subset_of(parallel_pairs(spark, d), left.where("id % 3 = 0"), right.where("id % 2 = 0")).select("left_id", "right_id")


def base_completeness(spark, d):
    _, _, turns = _sides(spark, d)
    return O.missing_bases(parallel_pairs(spark, d), turns.where("id % 7 != 0").select("id"))


def _forms(spark, d, name):
    return table(spark, d, name).select(F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("t")).select(F.lower("t").alias("form")).distinct()


def ledger_fallback_join(spark, d):
    """Forms of the documents with a ledger over the benchmark's forms: by the form, else by its citation form."""
    ledger = _forms(spark, d, "benchmark").select(F.col("form").alias("lemma"), F.when(F.length("form") > 5, "lemma").otherwise("inflection").alias("verdict"), F.lit(None).cast("string").alias("gloss"), F.lit(1).alias("ord"))
    return C.replay(_forms(spark, d, "documents").select(F.col("form").alias("lemma")), ledger).select("lemma", "verdict", "matched")


def english_index(spark, d):
    parts = table(spark, d, "part").select(F.col("p_brand").alias("english"), F.lit("").alias("sense"), F.col("p_name").alias("word"), F.col("p_partkey").alias("ord"))
    return L.english_index(parts).select("english", F.array_join("words", "|").alias("words"))


def entries_from_heads(spark, d):
    parts = table(spark, d, "part").select(F.col("p_type").alias("english"), F.lit("").alias("sense"), F.col("p_brand").alias("word"), F.col("p_partkey").alias("ord"))
    return L.entries_from_heads(parts).select("word", "pos", "gloss_en", F.array_join("english_headwords", "|").alias("heads"))


def _catalog(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    prov = docs.select(F.col("doc_id").alias("file"), F.col("source").alias("title"), F.col("lang").alias("origin"), F.col("doc_id").alias("ord"), (F.col("n_chars") < 100).alias("quarantined"))
    man = labels.select(F.col("doc_id").alias("file"), "quality")
    pick = lambda c: docs.where(c).select(F.col("doc_id").alias("file"))
    return O.catalogue(prov, man, pick("lang = 'fr'"), pick("lang = 'en' AND n_chars > 3000"), pick("source = 'src3'"))


def source_catalog(spark, d):
    return _catalog(spark, d).select("file", "title", "origin", "quality", "excluded", "quarantined")


def catalog_counts(spark, d):
    return O.catalogue_counts(_catalog(spark, d))


def license_union(spark, d):
    """Documents as books credited by names in their text's first line, free by an author's death or a year."""
    books = table(spark, d, "documents").select(F.concat_ws(" ", "source", F.regexp_extract("text", "(Apache|MIT|Creative)", 1), F.lit("1922")).alias("book"), F.col("n_chars").alias("good"), "doc_id")
    once = books.groupBy("book").agg(F.max("good").alias("good"))
    return O.licence_verdict(once, spark.createDataFrame(AUTHORS, "name string, death int"), ("src2",), 3000).select("book", "death", "year", F.array_join("basis", ",").alias("basis"), "reason")


def shard_packing(spark, d):
    sizes = table(spark, d, "documents").groupBy(F.col("source").alias("name")).agg(F.sum("n_chars").alias("size"))
    return O.pack_shards(sizes, 4)


def book_assembly(spark, d):
    pages = table(spark, d, "conversations").select(F.col("conv_id").alias("book"), F.concat(F.lit("b/"), F.col("turn").cast("string")).alias("title"), "text", F.when(F.col("role") == "user", 3).otherwise(1).alias("level"))
    return O.book_assembly(pages)


def context_window(spark, d):
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("source"), F.col("turn").alias("line"), "text")
    return O.context(turns).select("source", "line", "window")


def citation_check(spark, d):
    """First words of each conversation's turns, looked for about the turn before."""
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("source"), F.col("turn").alias("line"), "text")
    cites = turns.select(F.substring("text", 1, 20).alias("quote"), "source", (F.col("line") - 1).alias("line"))
    return O.check_citations(cites, turns).select("source", "line", "status")


def month_windows(spark, d):
    return crawl.month_counts(table(spark, d, "events"), "ts", "user_id").select("month", "n")


def event_dedup(spark, d):
    """The first event of each user and type, as the stream's deduplication keeps it."""
    return crawl.first_rows(table(spark, d, "events"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id")


def month_series(spark, d):
    return O.months("1995-05", "2002-12", spark)


_NAMED = [
    parallel_pairs, pairs_cc0, base_completeness, ledger_fallback_join, english_index, entries_from_heads, source_catalog, catalog_counts, license_union,
    shard_packing, book_assembly, context_window, citation_check, month_windows, event_dedup, month_series,
]
QUERIES = {f.__name__: f for f in _NAMED}
_TURNS = "turns AS (SELECT *, conv_id * 1000 + turn AS id FROM conversations), l AS (SELECT id AS a, id + 1 AS b FROM turns UNION ALL SELECT id + 1, id FROM turns WHERE id % 2 = 0), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), p AS (SELECT x.id AS left_id, y.id AS right_id, x.text AS left_text, y.text AS right_text FROM e JOIN turns x ON x.id = a AND x.role = 'user' JOIN turns y ON y.id = b AND y.role = 'assistant')"
_P = LETTERS.replace("'", "''")
_CAT = "cat AS (SELECT doc_id AS file, d.source AS title, lang AS origin, quality, CASE WHEN lang = 'en' AND n_chars > 3000 THEN 'english' WHEN lang = 'fr' THEN 'multilingual' WHEN d.source = 'src3' THEN 'OCR' END AS excluded, n_chars < 100 AS quarantined FROM documents d LEFT JOIN labels USING (doc_id))"
ORACLE_SQL = {
    "parallel_pairs": f"WITH {_TURNS} SELECT * FROM p",
    "pairs_cc0": f"WITH {_TURNS} SELECT left_id, right_id FROM p WHERE left_id % 3 = 0 AND right_id % 2 = 0",
    "base_completeness": f"WITH {_TURNS}, w AS (SELECT left_id AS id FROM p UNION SELECT right_id FROM p) SELECT id FROM w WHERE id NOT IN (SELECT id FROM turns WHERE id % 7 <> 0)",
    "ledger_fallback_join": f"""WITH v AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{_P}'))) AS lemma FROM benchmark), led AS (SELECT lemma, CASE WHEN length(lemma) > 5 THEN 'lemma' ELSE 'inflection' END AS verdict FROM v),
      f AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{_P}'))) AS form FROM documents), c AS (SELECT form, {SQL_CITE} AS cited FROM f)
      SELECT form AS lemma, coalesce(a.verdict, b.verdict) AS verdict, CASE WHEN a.verdict IS NOT NULL THEN 'exact' WHEN b.verdict IS NOT NULL THEN 'citation form' END AS matched FROM c LEFT JOIN led a ON a.lemma = form LEFT JOIN led b ON b.lemma = cited""",
    "english_index": "WITH f AS (SELECT p_brand, p_name, min(p_partkey) AS o FROM part GROUP BY ALL) SELECT p_brand AS english, string_agg(p_name, '|' ORDER BY o, p_name) AS words FROM f GROUP BY 1",
    "source_catalog": f"WITH {_CAT} SELECT * FROM cat",
    "catalog_counts": f"WITH {_CAT} SELECT count(*) AS n_all, count(*) FILTER (WHERE excluded IS NULL AND NOT quarantined) AS n_pool, count(*) FILTER (WHERE excluded IS NOT NULL AND NOT quarantined) AS n_excluded, count(*) FILTER (WHERE quarantined) AS n_quarantined FROM cat",
    "license_union": """WITH b AS (SELECT concat_ws(' ', source, regexp_extract(text, '(Apache|MIT|Creative)', 1), '1922') AS book, max(n_chars) AS good FROM documents GROUP BY 1),
      c AS (SELECT book, good, max(death) AS death FROM b LEFT JOIN (VALUES ('Apache', 1917), ('MIT', 1962), ('Creative', 1950), ('src1', 1959)) a(name, death) ON contains(book, name) GROUP BY ALL),
      y AS (SELECT *, 1922 AS year, concat_ws(',', CASE WHEN death + 71 <= 2026 THEN 'source-country' END, 'US') AS basis FROM c)
      SELECT book, death, year, basis, CASE WHEN contains(book, 'src2') THEN 'held' WHEN good < 3000 THEN 'too few pages' END AS reason FROM y""",
    "book_assembly": "SELECT conv_id AS book, string_agg(text, chr(10) ORDER BY turn, text) AS text, count(*) FILTER (WHERE role = 'user') AS good, count(*) AS scanned FROM conversations GROUP BY 1",
    "context_window": """SELECT conv_id AS source, turn AS line, string_agg(text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS "window" FROM conversations""",
    "citation_check": r"""WITH c AS (SELECT DISTINCT conv_id AS source, turn - 1 AS line, left(text, 20) AS quote FROM conversations),
      n AS (SELECT c.source, c.line, quote, string_agg(text, ' ' ORDER BY turn) AS found FROM c LEFT JOIN conversations v ON v.conv_id = c.source AND turn BETWEEN c.line - 1 AND c.line + 2 GROUP BY ALL)
      SELECT source, line, CASE WHEN found IS NULL THEN 'no such line' WHEN contains(trim(regexp_replace(found, '\s+', ' ', 'g')), trim(regexp_replace(quote, '\s+', ' ', 'g'))) THEN 'ok' ELSE 'not found' END AS status FROM n""",
    "entries_from_heads": """WITH g AS (SELECT p_brand AS word, lower(p_type) AS gloss, min(p_partkey) AS o FROM part GROUP BY ALL), gl AS (SELECT word, string_agg(gloss, '; ' ORDER BY o) FILTER (WHERE r <= 6) AS gloss_en FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY o) AS r FROM g) GROUP BY word),
      h AS (SELECT p_brand AS word, string_agg(p_type, '|' ORDER BY p_partkey) FILTER (WHERE r <= 8) AS heads FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part) GROUP BY 1)
      SELECT word, 'unknown' AS pos, gloss_en, heads FROM gl JOIN h USING (word)""",
    "shard_packing": """WITH RECURSIVE s AS (SELECT source AS name, CAST(sum(n_chars) AS BIGINT) AS size FROM documents GROUP BY source), o AS (SELECT *, row_number() OVER (ORDER BY size DESC, name DESC) AS i FROM s),
      p AS (SELECT CAST(0 AS BIGINT) AS i, CAST('' AS VARCHAR) AS name, CAST(0 AS BIGINT) AS size, CAST(-1 AS INT) AS shard, [0::BIGINT, 0, 0, 0] AS w
        UNION ALL SELECT o.i, o.name, o.size, CAST(list_position(w, list_min(w)) - 1 AS INT), [CASE WHEN j = list_position(w, list_min(w)) THEN w[j] + o.size ELSE w[j] END for j in range(1, 5)] FROM p JOIN o ON o.i = p.i + 1)
      SELECT name, size, shard FROM p WHERE i > 0""",
    "month_windows": "SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n FROM events GROUP BY 1",
    "event_dedup": "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1",
    "month_series": "SELECT strftime(m, '%Y-%m') AS month FROM (SELECT unnest(generate_series(DATE '1995-05-01', DATE '2002-12-01', INTERVAL 1 MONTH)) AS m)",
}
