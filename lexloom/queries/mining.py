"""Queries of the token, mining and gap operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import morphology as M
from ..functions import text as T
from ..operators import curation as C
from ..operators import mining as O
from ..sources.steps import saved, spread
from .common import SQL_CITE, SQL_LINES, SQL_POS, SQL_STRIP, SQL_TOKENS, SQL_VOCAB, SQL_WIKI, LETTERS, table, wiki

_PATTERN = LETTERS.replace("'", "''")


def _tokens(spark, d, by_line=False):
    return O.token_rows(table(spark, d, "documents"), by_line=by_line, keep=("doc_id",))


def _vocabulary(spark, d):
    return O.token_rows(table(spark, d, "benchmark").withColumn("source", F.lit("benchmark"))).select("form").distinct()


def token_attestation(spark, d):
    return O.attestation(_tokens(spark, d), wiki())


def token_forms_map_counts(spark, d):
    """Surface forms of each stem, as the map's entries."""
    forms = _tokens(spark, d).groupBy("form").agg(F.count("*").alias("n")).withColumn("stem", T.strip_ending(F.col("form")))
    maps = forms.groupBy("stem").agg(F.map_from_entries(F.collect_list(F.struct("form", "n"))).alias("forms"))
    return maps.select("stem", F.size("forms").cast("long").alias("n_forms"), F.explode("forms").alias("form", "n"))


def ending_strip_pos(spark, d):
    forms = _tokens(spark, d).groupBy("form").agg(F.count("*").alias("n"))
    return forms.groupBy(T.strip_ending(F.col("form")).alias("stem"), T.guess_pos(F.col("form")).alias("pos")).agg(F.sum("n").alias("n"))


def citation_form_groups(spark, d):
    forms = _tokens(spark, d).groupBy("form").agg(F.count("*").alias("n"))
    return forms.withColumn("lemma", T.citation_form(F.col("form"))).groupBy("lemma").agg(F.sum("n").alias("n"), F.count("*").alias("n_forms"))


def first_k_citations(spark, d):
    """The first two lines of each form, in the order of document, line and position."""
    docs = table(spark, d, "documents")
    tokens = O.token_rows(docs, source="doc_id", by_line=True)
    found = O.first_citations(tokens, O.line_rows(docs, source="doc_id"), 2, "form")
    return found.select("form", "rank", F.col("source").alias("doc_id"), "line", "text")


def round_robin_citations(spark, d):
    """Up to five lines of each form, in turn by source."""
    rows = _tokens(spark, d, True).groupBy("form", "source", "doc_id", "line").agg(F.count("*").alias("hits"))
    cites = rows.select("form", "source", "doc_id", "line", F.struct("doc_id", "line").alias("ord"))
    return O.round_robin(cites, "form", 5, wiki()).select("form", "turn", "source", "doc_id", "line")


def concordance_citations(spark, d):
    """Headwords of the benchmark through their inflected forms, with up to three citations from different sources."""
    heads = _vocabulary(spark, d).withColumn("pos", T.guess_pos(F.col("form")))
    forms = heads.select(F.col("form").alias("word"), F.explode(F.array_distinct(T.inflected(F.col("form"), F.col("pos"), True))).alias("form"))
    tokens = _tokens(spark, d, True)
    found = O.concordance(tokens, forms, O.line_rows(table(spark, d, "documents"), keep=("doc_id",)))
    return found.select("word", "occurrences", "sources", F.coalesce(F.array_join(F.transform("citations", lambda c: c["source"]), ","), F.lit("")).alias("cited"))


def _counts(spark, d):
    """form, source, n, caps: all that the candidate queries ask of the texts, counted once and written."""
    rows = _tokens(spark, d).groupBy("form", "source").agg(F.count("*").alias("n"), F.count_if(O.is_capital(F.col("token"))).alias("caps"))
    return saved(rows, "form-counts")


def _records(spark, d):
    """Partials by source: a shard's view of each form."""
    known = _vocabulary(spark, d).withColumn("known", F.lit(True))
    part = _counts(spark, d).withColumnRenamed("n", "count").join(known, "form", "left")
    kind = O.name_rule(F.when(F.col("known"), "known").otherwise("unknown"), F.col("count") - F.col("caps"))
    return part.select(F.col("form").alias("lemma"), F.col("source").alias("shard"), kind.alias("kind"), "count", (F.col("count") - F.col("caps")).alias("lower"), T.guess_pos(F.col("form")).alias("pos_guess"), F.create_map("form", F.col("count")).alias("forms"), F.array("source").alias("files"), F.expr("cast(array() as array<struct<source: string, line: bigint, text: string>>)").alias("citations"), F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("string").alias("gloss"), F.lit(None).cast("string").alias("note"))


def lemma_reduce(spark, d):
    found = O.reduce_records(_records(spark, d))
    return found.select("lemma", "kind", "count", "lower", F.size("sources").cast("long").alias("n_sources"), F.size("shards").cast("long").alias("n_shards"))


def noise_floor(spark, d):
    return O.noise_floor(lemma_reduce(spark, d).withColumn("verdict", F.when(F.col("lemma").like("%qu%"), "lemma")), 3).select("lemma", "count")


def name_rule(spark, d):
    counts = _tokens(spark, d).groupBy("form").agg(F.count("*").alias("n"), F.count_if(O.is_capital(F.col("token"))).alias("caps"))
    return counts.select("form", "n", "caps", O.name_rule(F.lit("unknown"), F.col("n") - F.col("caps")).alias("kind"))


def _buckets(spark, d):
    known, counts = saved(_vocabulary(spark, d), "vocabulary"), _counts(spark, d)
    att = O.attestation(counts, wiki(), per_source=True, sums=("caps",))
    lower = F.col("occurrences") - F.col("caps")
    cands = att.select(F.col("form").alias("lemma"), O.name_rule(F.lit("unknown"), lower).alias("kind"), F.col("occurrences").alias("count"), lower.alias("lower"), F.lit(None).cast("string").alias("verdict"), F.create_map("form", F.col("occurrences")).alias("forms"), F.col("sources_lit").alias("other"), F.col("sources_wiki").alias("wp"))
    cands = saved(cands, "candidates")
    english = C.english_words(table(spark, d, "part"), "p_name")
    stems = cands.select(F.regexp_extract("lemma", "^(.+?)(a|i|o)n?t(a|e)$", 1).alias("stem")).join(known.select(F.col("form").alias("stem")), "stem", "left_semi")
    return C.gap_buckets(cands, known.withColumnRenamed("form", "word"), english, stems)


def gap_buckets(spark, d):
    return _buckets(spark, d).groupBy("bucket", "kind").agg(F.count("*").alias("n"))


def evidence_tiers(spark, d):
    att = O.attestation(_tokens(spark, d), wiki())
    return att.select("form", C.tier(F.col("occurrences"), F.col("sources_lit"), F.col("sources_wiki"), C.Bars(mixed_wp=2, wp_only=4)).alias("tier"))


def gap_queue(spark, d):
    return C.queue(_buckets(spark, d)).select("lemma", "tier", "count", "other", "wp")


def fragment_tokens(spark, d):
    """Tokens that a hyphen or a letter outside the alphabet touches."""
    return O.fragments(spread(table(spark, d, "documents").select("text")))


def text_score(spark, d):
    forms = _tokens(spark, d).groupBy("source", "form").agg(F.count("*").alias("n"))
    from ..operators.corpus import text_score as score

    return score(forms, _vocabulary(spark, d))


def quality_triage(spark, d):
    from ..operators.corpus import triage

    return text_score(spark, d).select("source", triage(F.col("recognised"), F.col("singletons")).alias("triage"))


def recognised_score(spark, d):
    """As ``text_score``, by the scorer's own morphology over distinct forms."""
    from ..operators.corpus import text_score as score

    words = _vocabulary(spark, d)
    forms = saved(_tokens(spark, d).groupBy("source", "form").agg(F.count("*").alias("n")), "form-counts")
    known = M.first_reading(forms.select("form"), M.scorer_ways, M.dictionary(words, words), "boolean", False).where("value").select("form")
    return score(forms, known)


def peel_exists(spark, d):
    """Whether affixes lead from a form to a word of the benchmark, and to which."""
    roots = _vocabulary(spark, d).where("length(form) >= 2")
    found = M.first_reading(_tokens(spark, d).select("form"), M.peel_ways, M.dictionary(None, roots), "string")
    return found.select("form", F.col("value").alias("root"))


def best_segmentation(spark, d):
    stock = dict.fromkeys((r["s"] for r in M.dictionary(None, _vocabulary(spark, d).where("length(form) >= 2")).collect()), (0, 0))
    shape = lambda x: (lambda s: None if s is None else "+".join((*s[0], s[1].upper(), *s[2])))(M.segment(x, stock))
    return M.on_distinct_forms(_tokens(spark, d).select("form").distinct(), "form", shape, "string", "split").where("split IS NOT NULL")


def compound_split(spark, d):
    stock = _vocabulary(spark, d).where("length(form) >= 3")
    found = M.first_reading(_tokens(spark, d).select("form"), M.compound_ways, M.dictionary(None, stock), "boolean", False)
    return found.select("form", F.col("value").alias("compound"))


def analysed_kinds(spark, d):
    """Tokens by the kind that the analysis and its refinement give."""
    words = _vocabulary(spark, d)
    cells = saved(_tokens(spark, d).groupBy("token", "form").agg(F.count("*").alias("n")), "token-counts")
    rows = cells.join(M.analysed(cells.select("form"), words, words), "form")
    return O.refine_kind(rows).groupBy("kind").agg(F.sum("n").alias("n"), F.count_distinct("lemma").alias("lemmas"))


_CAP = "substr(token, 1, 1) <> lower(substr(token, 1, 1))"
_ATT = f"""per AS (SELECT form, source, count(*) AS n FROM t GROUP BY form, source),
att AS (SELECT form, CAST(sum(n) AS BIGINT) AS occurrences, count(*) AS sources, count(*) FILTER (WHERE NOT ({SQL_WIKI})) AS sources_lit, count(*) FILTER (WHERE {SQL_WIKI}) AS sources_wiki FROM per GROUP BY form)"""
_NAMES = f"names AS (SELECT form, count(*) AS n, count(*) FILTER (WHERE {_CAP}) AS caps FROM t GROUP BY form)"
_LINE_TOKENS = f"{SQL_LINES}, lt0 AS (SELECT doc_id, source, line, txt, regexp_extract_all(txt, '{_PATTERN}') AS a FROM lines), lt AS (SELECT doc_id, source, line, txt, unnest(range(0, len(a))) AS pos, unnest(a) AS token FROM lt0)"
_FUNCTION = ", ".join(f"'{w}'" for w in C.ENGLISH_FUNCTION)
_FOREIGN = ", ".join(f"'{w}'" for w in C.FOREIGN_FUNCTION)
_BUCKETS = f"""WITH {SQL_TOKENS}, {_ATT}, {_NAMES}, {SQL_VOCAB}, eng AS (SELECT DISTINCT unnest(regexp_extract_all(lower(p_name), '[a-z]+')) AS word FROM part UNION SELECT unnest([{_FUNCTION}])),
c AS (SELECT att.form AS lemma, CASE WHEN n - caps = 0 THEN 'name' ELSE 'unknown' END AS kind, occurrences AS cnt, n - caps AS lower_n, sources_lit AS other, sources_wiki AS wp,
 regexp_extract(att.form, '^(.+?)(a|i|o)n?t(a|e)$', 1) AS stem, trim(att.form, '''’') AS bare FROM att JOIN names USING (form)),
b AS (SELECT *, CASE WHEN cnt < 5 THEN NULL WHEN other >= 3 THEN 'broad' WHEN other >= 1 AND wp >= 10 THEN 'mixed' WHEN other = 0 AND wp >= 50 THEN 'wp-only' END AS tier FROM c),
k AS (SELECT *, CASE WHEN lemma IN (SELECT form FROM vocab) THEN 'in-dict' WHEN kind NOT IN ('unknown', 'derived') THEN 'closed-class' WHEN NOT regexp_matches(lemma, '[oaei]$') OR contains(lemma, '''') THEN 'no-ending'
 WHEN bare IN (SELECT word FROM eng) OR (bare LIKE '%s' AND left(bare, length(bare) - 1) IN (SELECT word FROM eng)) OR (bare LIKE '%ed' AND left(bare, length(bare) - 2) IN (SELECT word FROM eng)) THEN 'english'
 WHEN regexp_matches(lemma, '[qwxy]') OR lemma IN ({_FOREIGN}) THEN 'foreign'
 WHEN stem <> '' AND (stem || 'i' IN (SELECT form FROM vocab) OR stem || 'i' IN (SELECT lemma FROM c) OR stem IN (SELECT form FROM vocab)) THEN 'participle'
 WHEN lower_n < 0.25 * cnt THEN 'capitalised' WHEN tier IS NULL THEN 'thin' ELSE 'queue' END AS bucket FROM b)"""
_SCORE = f"""WITH {SQL_TOKENS}, {SQL_VOCAB}, s AS (SELECT source, count(*) FILTER (WHERE length(form) > 1) AS tokens, count(*) FILTER (WHERE length(form) > 1 AND form IN (SELECT form FROM vocab)) AS hits, count(*) FILTER (WHERE length(form) = 1) AS ones FROM t GROUP BY source),
r AS (SELECT source, tokens, round(100.0 * hits / greatest(tokens, 1), 6) AS recognised, round(100.0 * ones / greatest(tokens, 1), 6) AS singletons FROM s)"""
_REDUCED = f"""WITH {SQL_TOKENS}, {SQL_VOCAB}, p AS (SELECT form, source, count(*) AS n, count(*) FILTER (WHERE NOT ({_CAP})) AS lower_n FROM t GROUP BY form, source),
k AS (SELECT *, CASE WHEN form IN (SELECT form FROM vocab) THEN 'known' WHEN lower_n = 0 THEN 'name' ELSE 'unknown' END AS kind FROM p),
r AS (SELECT form AS lemma, CASE WHEN bool_or(kind = 'known') THEN 'known' WHEN bool_or(kind = 'unknown') THEN 'unknown' ELSE 'name' END AS kind, CAST(sum(n) AS BIGINT) AS "count", CAST(sum(lower_n) AS BIGINT) AS "lower", count(*) AS n_sources, count(*) AS n_shards FROM k GROUP BY form)"""
_SNIP = "trim(regexp_replace(txt, '\\s+', ' ', 'g'))"

_NAMED = [
    token_attestation, token_forms_map_counts, ending_strip_pos, citation_form_groups, first_k_citations, round_robin_citations, concordance_citations, lemma_reduce, noise_floor, name_rule, gap_buckets, evidence_tiers,
    gap_queue, fragment_tokens, text_score, quality_triage, recognised_score, peel_exists, best_segmentation, compound_split, analysed_kinds,
]
QUERIES = {f.__name__: f for f in _NAMED}
ORACLE_SQL = {
    "token_attestation": f"WITH {SQL_TOKENS}, {_ATT} SELECT * FROM att",
    "token_forms_map_counts": f"WITH {SQL_TOKENS}, s AS (SELECT {SQL_STRIP} AS stem, form, count(*) AS n FROM t GROUP BY ALL) SELECT stem, count(*) OVER (PARTITION BY stem) AS n_forms, form, n FROM s",
    "ending_strip_pos": f"WITH {SQL_TOKENS} SELECT {SQL_STRIP} AS stem, {SQL_POS} AS pos, count(*) AS n FROM t GROUP BY ALL",
    "citation_form_groups": f"WITH {SQL_TOKENS}, f AS (SELECT form, count(*) AS n FROM t GROUP BY form) SELECT {SQL_CITE} AS lemma, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_forms FROM f GROUP BY 1",
    "first_k_citations": f"""WITH {_LINE_TOKENS}, r AS (SELECT lower(token) AS form, CAST(row_number() OVER (PARTITION BY lower(token) ORDER BY doc_id, line, pos) AS INT) AS rank, doc_id, CAST(line AS INT) AS line, token, {_SNIP} AS flat FROM lt)
      SELECT form, rank, doc_id, line, CASE WHEN length(flat) > 160 THEN CASE WHEN greatest(0, instr(flat, token) - 71) > 0 THEN '…' ELSE '' END || substr(flat, CAST(greatest(0, instr(flat, token) - 71) AS BIGINT) + 1, 150) || '…' ELSE flat END AS text FROM r WHERE rank <= 2""",
    "round_robin_citations": f"""WITH {_LINE_TOKENS}, h AS (SELECT DISTINCT lower(token) AS form, source, doc_id, line FROM lt WHERE length(token) >= 8),
      a AS (SELECT *, row_number() OVER (PARTITION BY form, source ORDER BY doc_id, line) AS again, min(doc_id * 1000000 + line) OVER (PARTITION BY form, source) AS opened FROM h),
      b AS (SELECT *, CAST(row_number() OVER (PARTITION BY form ORDER BY again, {SQL_WIKI}, opened, source) AS INT) AS turn FROM a) SELECT form, turn, source, doc_id, CAST(line AS INT) AS line FROM b WHERE turn <= 5""",
    "lemma_reduce": f"{_REDUCED} SELECT * FROM r",
    "noise_floor": f"""{_REDUCED} SELECT lemma, "count" FROM r WHERE "count" >= 3 OR lemma LIKE '%qu%'""",
    "name_rule": f"WITH {SQL_TOKENS}, {_NAMES} SELECT form, n, caps, CASE WHEN n = caps THEN 'name' ELSE 'unknown' END AS kind FROM names",
    "gap_buckets": f"{_BUCKETS} SELECT bucket, kind, count(*) AS n FROM k GROUP BY bucket, kind",
    "evidence_tiers": f"WITH {SQL_TOKENS}, {_ATT} SELECT form, CASE WHEN occurrences < 5 THEN NULL WHEN sources_lit >= 3 THEN 'broad' WHEN sources_lit >= 1 AND sources_wiki >= 2 THEN 'mixed' WHEN sources_lit = 0 AND sources_wiki >= 4 THEN 'wp-only' END AS tier FROM att",
    "gap_queue": f"""{_BUCKETS} SELECT lemma, tier, cnt AS "count", other, wp FROM k WHERE bucket = 'queue'""",
    "text_score": f"{_SCORE} SELECT * FROM r",
    "quality_triage": f"{_SCORE} SELECT source, CASE WHEN recognised >= 80 AND singletons < 5 THEN 'usable' WHEN recognised < 65 OR singletons >= 10 THEN 'poor' WHEN recognised BETWEEN 65 AND 80 THEN 'marginal' ELSE 'unclassified' END AS triage FROM r",
    "fragment_tokens": rf"""WITH m AS (SELECT unnest(regexp_extract_all(text, '([^a-zA-ZĉĝĥĵŝŭĈĜĤĴŜŬ''\P{{L}}]|-)?({_PATTERN})([^a-zA-ZĉĝĥĵŝŭĈĜĤĴŜŬ''\P{{L}}]|-)?')) AS m FROM documents),
      x AS (SELECT m, regexp_extract(m, '({_PATTERN})', 1) AS token FROM m) SELECT lower(token) AS form, count(*) AS n, count(*) FILTER (WHERE length(m) > length(token)) AS n_fragment FROM x GROUP BY 1""",
    "compound_split": f"""WITH {SQL_TOKENS}, {SQL_VOCAB}, stock AS (SELECT form AS part FROM vocab WHERE length(form) >= 3 AND form NOT IN ({{barred}})), f AS (SELECT DISTINCT form FROM t),
      c AS (SELECT form, unnest(range(3, length(form) - 2)) AS i FROM f), parts AS (SELECT form, left(form, i) AS a, substr(form, i + 1) AS b FROM c), half AS (SELECT form, b FROM parts SEMI JOIN stock ON stock.part = parts.a),
      tails AS (SELECT form, b FROM half UNION ALL SELECT form, substr(b, 2) FROM half WHERE left(b, 1) = 'o' AND length(b) > 3), ok AS (SELECT DISTINCT form FROM tails SEMI JOIN stock ON stock.part = tails.b)
      SELECT form, form IN (SELECT form FROM ok) AS compound FROM f""",
}
_MODEL = M.DEFAULT
ORACLE_SQL["compound_split"] = ORACLE_SQL["compound_split"].replace("{barred}", ", ".join(f"'{w}'" for w in sorted(_MODEL.affix_roots | _MODEL.closed_class | set(_MODEL.preposition_prefixes))))
_INFL = "CASE " + "WHEN pos IN ('noun', 'adj') THEN [form, form || 'j', form || 'n', form || 'jn'] WHEN pos = 'adv' THEN [form, form || 'n'] WHEN pos = 'verb' THEN [" + ", ".join(f"left(form, length(form) - 1) || '{e}'" for e in ("i", "as", "is", "os", "us", "u", *(v + t for v in ("ant", "int", "ont") for t in "aeo"))) + "] ELSE [form] END"
ORACLE_SQL["concordance_citations"] = f"""WITH {_LINE_TOKENS}, {SQL_VOCAB}, heads AS (SELECT form, {SQL_POS} AS pos FROM vocab WHERE length(form) >= 4), fx AS (SELECT DISTINCT form AS word, unnest({_INFL}) AS form FROM heads),
  hit AS (SELECT word, source, line, pos, trim(txt) AS txt FROM lt JOIN fx ON lower(token) = fx.form), cnt AS (SELECT word, count(*) AS occurrences, count(DISTINCT source) AS sources FROM hit GROUP BY word),
  good AS (SELECT DISTINCT word, source FROM hit WHERE length(txt) BETWEEN 35 AND 180), rk AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY source) AS r FROM good)
  SELECT cnt.word, occurrences, sources, coalesce(string_agg(source, ',' ORDER BY r) FILTER (WHERE r <= 3), '') AS cited FROM cnt LEFT JOIN rk USING (word) GROUP BY ALL"""
