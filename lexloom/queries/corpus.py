"""Queries of the text, normalisation, markup, search and content operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.model import DEFAULT
from ..operators import corpus as O
from ..operators import lexicon as L
from ..sources import markup
from .common import LETTERS, SQL_LINES, table

#: Literal rows that both engines hold, for what the tables don't contain.
DIGRAPHS = ["cxu gxi sxi", "cxu ĝi", "cxu gxi sxi ĉ", "CXU Gxi sxi", "sauxo kaj eĥo", "plain text"]
MIXED = ["роv estas", "весна", "ѵоrt kaj vort", "latin only", "а b"]
COMPOSED = ["é", "ŭ kaj ĉ", "ŝ", "Å"]
WORDS = ["uz", "ŭa", "va", "zo", "cent", "ĉu", "da", "qa", "a", "aĉa", "aca"]
MAIL = ["Saluton\n> citaĵo\na\nmondo\n-- \nZamenhof", "unua linio\n\ndua linio", "> nur citaĵo"]
WIKI_PAGES = ["{{lang|pl|Prus}} skribis '''libron'''. [[Dosiero:x.png]]\n== Notoj ==\nne\n=== sub ===\nne\n== Vivo ==\nJes [[a|bela]] vivo.", "#REDIRECT [[x]]", "* listo\nProzo <ref>x</ref>plu."]
TEMPLATES = ["{{lang|pl|Prus}}", "{{SIC|as-printed|corrected}}", "{{rh|x}}", "{{center|teksto}}"]


def _lines(spark, d):
    return table(spark, d, "documents").select("doc_id", "source", F.posexplode(T.lines(F.col("text"))).alias("line", "text")).withColumn("line", F.col("line") + 1)


def spread_examples(spark, d):
    """Examples of a pattern in turn by source."""
    rows = _lines(spark, d).select("source", F.struct("doc_id", "line").alias("line"), "doc_id", F.col("line").alias("n"), "text")
    return O.search_lines(rows, "licen[cs]e|apache", 10, 5, 400).select("source", "doc_id", F.col("n").alias("line"), "total")


def pattern_compare(spark, d):
    return O.compare_patterns(_lines(spark, d), r"\bthe the\b|der die", "und")


def exact_copies(spark, d):
    """Texts that several documents have, by digest."""
    return table(spark, d, "documents").groupBy(T.short_digest(F.col("text")).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


def dedup_against_existing(spark, d):
    docs = table(spark, d, "documents")
    return O.new_content(docs.where("source != 'src7'"), docs.where("source = 'src7'")).select("doc_id")


def line_cleanup(spark, d):
    """Documents with their lines cleaned: lines left and a digest."""
    out = table(spark, d, "documents").select("doc_id", O.clean_lines(T.lines(F.col("text"))).alias("l"))
    return out.select("doc_id", F.size("l").cast("long").alias("n_lines"), T.short_digest(F.array_join("l", "\n")).alias("digest"))


def blank_run_collapse(spark, d):
    rows = table(spark, d, "pages").select("page_id", T.lines(F.regexp_replace("html", "<[^>]+>", "\n")).alias("l"))
    return rows.select("page_id", F.size(O.collapse_blanks(F.transform("l", lambda x: F.regexp_replace(x, r"\s+$", "")))).cast("long").alias("n_lines"))


def digraph_fold(spark, d):
    mail = spark.createDataFrame([(x,) for x in DIGRAPHS], "text string")
    docs = table(spark, d, "documents").select("text")
    return mail.select("text", T.message_fold(F.col("text")).alias("folded")).unionByName(docs.select(T.short_digest(F.col("text")).alias("text"), T.short_digest(T.message_fold(F.col("text"))).alias("folded")))


def homoglyph_repair(spark, d):
    return spark.createDataFrame([(x,) for x in MIXED], "text string").select("text", O.repair_lookalikes(F.col("text")).alias("repaired"))


def nfc(spark, d):
    return spark.createDataFrame([(x,) for x in COMPOSED], "text string").unionByName(table(spark, d, "documents").select("text")).select(T.short_digest(O.nfc(F.col("text"))).alias("digest"))


def html_text(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))


def page_titles(spark, d):
    return table(spark, d, "pages").select("page_id", F.trim(F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"), T.slug(F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1)).alias("slug"))


def wikitext_prose(spark, d):
    return spark.createDataFrame([(x,) for x in WIKI_PAGES], "text string").select("text", markup.wiki_prose(F.col("text")).alias("prose"))


def template_resolve(spark, d):
    return spark.createDataFrame([(x,) for x in TEMPLATES], "text string").select("text", markup.wiki_book(F.col("text")).alias("plain"))


def mail_clean(spark, d):
    return spark.createDataFrame([(x,) for x in MAIL], "text string").select("text", markup.clean_mail(F.col("text")).alias("body"))


def curation_histogram(spark, d):
    return O.curation(table(spark, d, "documents"))


def size_gate(spark, d):
    return O.size_gate(table(spark, d, "documents"), 500, 5000).select("doc_id", "n_chars")


def collation_sort_rank(spark, d):
    """Words by the alphabet: the key's place among all keys."""
    words = spark.createDataFrame([(x,) for x in WORDS], "word string")
    forms = table(spark, d, "documents").select(F.explode(T.tokens(F.col("text"))).alias("w")).select(F.lower("w").alias("word"))
    return words.unionByName(forms).distinct().select("word", T.collation_key(F.col("word")).alias("key"))


def normalised_manifest(spark, d):
    """One raw source a document, normalised as an encyclopedia's article."""
    raw = table(spark, d, "documents").select(F.concat(F.lit("wp-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("source"), "text")
    return O.normalise(raw).select("source", "method", "in_lines", "out_lines", "xsystem", "hsystem", "homoglyphs", "sha256")


def headword_checks(spark, d):
    """Benchmark tokens: plausible headwords, slugs and digests."""
    words = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("w")).distinct()
    return words.select("w", T.headword(F.col("w")).alias("headword"), T.short_digest(F.col("w")).alias("digest"), T.infinitive(F.col("w")).alias("infinitive"), T.is_roman(F.lower("w")).alias("roman"), L.bare_class(F.lower("w")).alias("class"))


_NAV = r"^\s*(?:[←→►◄]|Elŝuti kiel|Indekso\s*:|\(p\.\s|Paĝo\.\s*$)"
_CLEAN = rf"""{SQL_LINES}, keep AS (SELECT doc_id, line, regexp_replace(regexp_replace(replace(txt, chr(160), ' '), '^\s*↑\s*', ''), '\s+$', '') AS l FROM lines
  WHERE NOT regexp_matches(replace(txt, chr(160), ' '), '{_NAV}') AND NOT (regexp_matches(txt, '[→►]\s*$') AND length(trim(txt)) < 60)),
  j AS (SELECT doc_id, string_agg(l, chr(10) ORDER BY line) AS s FROM keep GROUP BY doc_id),
  c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(s, '\n{{3,}}', chr(10) || chr(10), 'g'), '^\n+', ''), '\n+$', '') AS s FROM j)"""


def _values(rows: list[str]) -> str:
    return ", ".join("('" + r.replace("'", "''") + "')" for r in rows)


def _fold(x: str) -> str:
    for a, b in T.X_SYSTEM:
        for p, q in ((a, b), (a.upper(), b.upper()), (a.capitalize(), b.upper())):
            x = f"replace({x}, '{p}', '{q}')"
    return x


_FOLDED = f"CASE WHEN len(regexp_extract_all(text, '(?i)[cghjsu]x')) >= 3 AND len(regexp_extract_all(text, '{T.DIACRITICS}')) <= len(regexp_extract_all(text, '(?i)[cghjsu]x')) * 0.02 THEN {_fold('text')} ELSE text END"
_NAMED = [
    spread_examples, pattern_compare, exact_copies, dedup_against_existing, line_cleanup, blank_run_collapse, digraph_fold, homoglyph_repair, nfc, html_text, page_titles, wikitext_prose, template_resolve, mail_clean,
    curation_histogram, size_gate, collation_sort_rank, normalised_manifest, headword_checks,
]
QUERIES = {f.__name__: f for f in _NAMED}
_STRIP = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"
ORACLE_SQL = {
    "spread_examples": f"""WITH {SQL_LINES}, h AS (SELECT *, count(*) OVER () AS total FROM lines WHERE regexp_matches(txt, '(?i)licen[cs]e|apache')), s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, line) AS again FROM h WHERE length(trim(txt)) BETWEEN 5 AND 400)
      SELECT source, doc_id, CAST(line AS INT) AS line, total FROM s WHERE again <= 10 ORDER BY again, source LIMIT 10""",
    "pattern_compare": rf"WITH {SQL_LINES} SELECT count(*) FILTER (WHERE regexp_matches(txt, '(?i)\bthe the\b|der die')) AS lines_a, count(*) FILTER (WHERE regexp_matches(txt, '(?i)und')) AS lines_b FROM lines",
    "exact_copies": "SELECT left(sha256(text), 12) AS digest, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1",
    "dedup_against_existing": "SELECT doc_id FROM documents WHERE source <> 'src7' AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src7')",
    "line_cleanup": f"WITH {_CLEAN} SELECT d.doc_id, CASE WHEN coalesce(s, '') = '' THEN 0 ELSE len(string_split(s, chr(10))) END AS n_lines, left(sha256(coalesce(s, '')), 12) AS digest FROM documents d LEFT JOIN c USING (doc_id)",
    "digraph_fold": f"SELECT text, {_FOLDED} AS folded FROM (VALUES {_values(DIGRAPHS)}) v(text) UNION ALL SELECT left(sha256(text), 12), left(sha256({_FOLDED}), 12) FROM documents",
    "homoglyph_repair": "SELECT * FROM (VALUES ('роv estas', 'pov estas'), ('весна', 'весна'), ('ѵоrt kaj vort', 'vort kaj vort'), ('latin only', 'latin only'), ('а b', 'а b')) v(text, repaired)",
    "nfc": "SELECT left(sha256(nfc_normalize(text)), 12) AS digest FROM (SELECT text FROM documents UNION ALL SELECT * FROM (VALUES " + ", ".join("(" + " || ".join(f"chr({ord(c)})" for c in x) + ")" for x in COMPOSED) + ") v(text))",
    "html_text": f"SELECT page_id, {_STRIP.format(x='html')} AS text FROM pages",
    "page_titles": r"SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '(?i)\.djvu$', ''), '[^\p{L}\p{N}\p{M}_]+', '_', 'g'), '_') AS slug FROM pages",
    "template_resolve": "SELECT * FROM (VALUES ('{{lang|pl|Prus}}', 'Prus'), ('{{SIC|as-printed|corrected}}', 'corrected'), ('{{rh|x}}', ''), ('{{center|teksto}}', 'teksto')) v(text, plain)",
    "blank_run_collapse": r"""WITH a AS (SELECT page_id, string_split(regexp_replace(regexp_replace(html, '<[^>]+>', chr(10), 'g'), '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM pages),
      b AS (SELECT page_id, [regexp_replace(x, '\s+$', '') for x in CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END] AS ls FROM a), c AS (SELECT page_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM b), k AS (SELECT page_id, i, ls[i] = '' AS blank, i > 1 AND ls[i - 1] = '' AS after FROM c),
      e AS (SELECT page_id, min(i) FILTER (WHERE NOT blank) AS lo, max(i) FILTER (WHERE NOT blank) AS hi FROM k GROUP BY page_id)
      SELECT p.page_id, count(*) FILTER (WHERE i BETWEEN lo AND hi AND NOT (blank AND after)) AS n_lines FROM pages p LEFT JOIN k USING (page_id) LEFT JOIN e USING (page_id) GROUP BY p.page_id""",
    "wikitext_prose": "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("NULL" if x is None else "'" + x.replace("'", "''") + "'" for x in (page, said)) + ")" for page, said in zip(WIKI_PAGES, ["skribis libron. Jes bela vivo.", None, "Prozo plu."], strict=True)) + ") v(text, prose)",
    "mail_clean": "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in (mail, said)) + ")" for mail, said in zip(MAIL, ["Saluton mondo", "unua linio dua linio", ""], strict=True)) + ") v(text, body)",
    "headword_checks": f"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{LETTERS.replace("'", "''")}')) AS w FROM benchmark), x AS (SELECT w, lower(w) AS l FROM w)
      SELECT w, regexp_full_match(l, '[abcĉdefgĝhĥijĵklmnoprsŝtuŭvz]+') AND (regexp_matches(l, '[oaei]$') OR l IN ({", ".join("'" + c + "'" for c in sorted(DEFAULT.closed_class))})) AS headword, left(sha256(w), 12) AS digest,
      CASE {" ".join(f"WHEN l LIKE '%{t}' AND length(l) > 3 THEN left(l, length(l) - 2) || 'i'" for t in ("as", "is", "os", "us"))} ELSE l END AS infinitive, regexp_full_match(l, '[ivxlcdm]+') AS roman,
      CASE {" ".join(f"WHEN l IN ({', '.join(chr(39) + c + chr(39) for c in words)}) THEN '{name}'" for name, words in L.BARE_CLASSES)} ELSE 'particle' END AS "class" FROM x""",
    "curation_histogram": "SELECT count(*) AS articles, " + ", ".join(f"count(*) FILTER (WHERE n_chars >= {b}) AS at_least_{b}" for b in (1000, 2000, 3000, 5000)) + " FROM documents",
    "size_gate": "SELECT doc_id, n_chars FROM documents WHERE n_chars BETWEEN 500 AND 5000",
    "collation_sort_rank": f"""WITH w AS (SELECT DISTINCT word FROM (SELECT lower(unnest(regexp_extract_all(text, '{LETTERS.replace("'", "''")}'))) AS word FROM documents UNION ALL SELECT * FROM (VALUES {_values(WORDS)}) v(word)))
      SELECT word, translate(regexp_replace(word, '[^abcĉdefgĝhĥijĵklmnoprsŝtuŭvz]', '~', 'g'), 'abcĉdefgĝhĥijĵklmnoprsŝtuŭvz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ[]') AS key FROM w""",
}
