"""From a corpus to a review queue and to promoted entries.

One lineage where shards and their files used to be: tokens are analysed over distinct
forms, mined, reduced, met with the ledger and classified. The dictionary and the
ledger are input tables of a given version; nothing is fed back implicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import morphology as M
from ..functions import text as T
from ..functions.model import DEFAULT, LanguageModel
from ..operators import curation as C
from ..operators import mining as N
from ..sources.steps import saved


def roots_of(entries: DataFrame) -> DataFrame:
    return entries.select(F.explode(F.array_compact(F.array("root", "stem"))).alias("r"))


def mined(docs: DataFrame, entries: DataFrame, min_count: int = 1, citations: int = 3, model: LanguageModel = DEFAULT, without: DataFrame | None = None, most_sources: int | None = None) -> DataFrame:
    """Lemma records of a corpus (source, text) against a dictionary (word, root, stem). ``without`` (source): sources
    left out; ``most_sources``: only so many sources, the first by name, for a trial run.

    Tokens are counted by spelling and source, and their first places found, once each; all else works
    on these two tables."""
    if without is not None:
        docs = docs.join(without.select("source"), "source", "left_anti")
    if most_sources is not None:
        docs = docs.join(docs.select("source").distinct().orderBy("source").limit(most_sources), "source", "left_semi")
    tokens = N.token_rows(docs, model, by_line=True)
    cells, places = saved(N.counted(tokens), "token-counts"), saved(N.first_places(tokens, citations), "token-places")
    forms = M.analysed(cells.select("form"), entries.select("word"), roots_of(entries), model).where("lemma IS NOT NULL")
    kinds = saved(N.refine_kind(cells.select("token", "form").distinct().join(forms, "form")), "token-kinds")
    return N.mine(cells, kinds, places, N.line_rows(docs), min_count, citations)


def review_queue(records: DataFrame, entries: DataFrame, ledger: DataFrame, english: DataFrame, bars: C.Bars = C.Bars(), model: LanguageModel = DEFAULT) -> DataFrame:
    """Records with verdicts replayed, bucketed; the queue is what ``curation.queue`` takes from it."""
    wp = F.size(F.filter("files", lambda s: T.is_encyclopedia(s))).cast("long")
    known = C.replay(records.drop("verdict", "gloss") if "verdict" in records.columns else records, ledger)
    candidates = known.select("lemma", "kind", "count", "lower", "verdict", "forms", (F.size("files") - wp).alias("other"), wp.alias("wp"))
    stems = candidates.select(F.regexp_extract("lemma", "^(.+?)(a|i|o)n?t(a|e)$", 1).alias("stem")).where("stem != ''")
    verbs = M.first_reading(stems, lambda x, longest: M.peel_ways(x, longest, model), M.dictionary(None, roots_of(entries)), "string").where("value IS NOT NULL").select(F.col("form").alias("stem"))
    return C.gap_buckets(candidates, entries.select(F.lower("word").alias("word")), english, verbs, bars)


def promoted(ledger: DataFrame, entries: DataFrame, counts: DataFrame, stock: DataFrame, model: LanguageModel = DEFAULT, glosses: dict[str, str] | None = None) -> DataFrame:
    """New entries of reviewed lemmas with morphology and attestation (word, occurrences, sources)."""
    roots = {r["root"]: (r["rank"], r["neg_prod"]) for r in stock.limit(M.MOST_ENTRIES + 1).collect()}
    if len(roots) > M.MOST_ENTRIES:
        raise ValueError(f"more than {M.MOST_ENTRIES} roots")
    new = C.dispositions(ledger, entries).where("disposition = 'promoted'").select("word", "pos", "gloss")
    shaped = M.on_distinct_forms(new, "word", lambda w: M.morphology(w, roots, model, glosses) or {"prefixes": None, "stem": None, "suffixes": None, "ending": None}, M.MORPHOLOGY_TYPE, "morphology")
    derived = F.when((F.size("morphology.prefixes") > 0) | (F.size("morphology.suffixes") > 0), True)
    return shaped.join(counts, "word", "left").withColumn("derived", derived)
