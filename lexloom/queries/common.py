"""What the queries share: tables, the register predicate, SQL fragments of the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sources that play the encyclopedia's part.
WIKI = ("src0", "src1", "src2", "src3", "src4")
LETTERS = "[a-zA-ZĉĝĥĵŝŭĈĜĤĴŜŬ']+"

SQL_WIKI = "source IN ('src0','src1','src2','src3','src4')"
SQL_TOKENS = f"""tok AS (SELECT doc_id, source, unnest(regexp_extract_all(text, '{LETTERS.replace("'", "''")}')) AS token FROM documents), t AS (SELECT *, lower(token) AS form FROM tok)"""
SQL_LINES = r"""ln0 AS (SELECT doc_id, source, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM documents),
ln AS (SELECT doc_id, source, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS txt, len(ls) AS n FROM ln0),
lines AS (SELECT doc_id, source, line, txt FROM ln WHERE NOT (line = n AND txt = ''))"""
SQL_VOCAB = f"""vocab AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{LETTERS.replace("'", "''")}'))) AS form FROM benchmark)"""
ENDINGS = ("ajn", "ojn", "aj", "oj", "an", "on", "en", "as", "is", "os", "us", "a", "o", "e", "i", "u", "n", "j")
SQL_STRIP = "CASE " + " ".join(f"WHEN form LIKE '%{e}' AND length(form) > {len(e) + 1} THEN left(form, length(form) - {len(e)})" for e in ENDINGS) + " ELSE form END"
SQL_POS = "CASE WHEN regexp_matches(form, '(oj|ojn|on)$') THEN 'noun' WHEN regexp_matches(form, '(aj|ajn|an)$') THEN 'adj' WHEN regexp_matches(form, '[aiou]s$') THEN 'verb' WHEN regexp_matches(form, '[aio]nta$') THEN 'participle' WHEN form LIKE '%o' THEN 'noun' WHEN form LIKE '%a' THEN 'adj' WHEN form LIKE '%e' THEN 'adv' WHEN form LIKE '%i' THEN 'verb' ELSE 'unknown' END"


def _cite(x: str) -> str:
    cut = lambda n, put="": f"left({x}, length({x}) - {n}) || '{put}'"
    rules = [f"WHEN {x} LIKE '%u' AND length({x}) > 3 THEN {cut(1, 'i')}"]
    rules += [f"WHEN {x} LIKE '%{t}' AND length({x}) > 3 THEN {cut(2, 'i')}" for t in ("as", "is", "os", "us")]
    rules += [f"WHEN {x} LIKE '%{e}' AND length({x}) > {len(e) + 1} THEN {cut(len(e), p)}" for e, p in (("ojn", "o"), ("ajn", "a"), ("oj", "o"), ("aj", "a"), ("on", "o"), ("an", "a"), ("en", "e"))]
    rules += [f"WHEN regexp_matches({x}, '[oa]j$') AND length({x}) > 2 THEN {cut(1)}", f"WHEN regexp_matches({x}, '[oaeu]n$') AND length({x}) > 2 THEN {cut(1)}"]
    return " ".join(rules)


#: Citation form of ``form``; ``b`` is the form without apostrophes at its edges.
SQL_CITE = "CASE WHEN form LIKE '%''' THEN left(form, length(form) - 1) || 'o' " + _cite("trim(form, '''')") + " ELSE trim(form, '''') END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wiki(source: str = "source") -> Column:
    return F.col(source).isin(*WIKI)
