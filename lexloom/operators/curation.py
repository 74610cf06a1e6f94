"""Ledger, gap report and promotion: what reviewers decide, and what is left to decide."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Verdicts a reviewer may give.
VERDICTS = ("lemma", "inflection", "proper-noun", "foreign", "ocr-artifact", "fragment", "uncertain")
#: Function words that are no headwords of an index, and foreign ones with an open-class ending.
ENGLISH_FUNCTION = ("a", "about", "above", "after", "again", "all", "also", "an", "and", "any", "are", "as", "at", "be", "because", "been", "before", "being", "below", "between", "both", "but", "by", "can", "could", "did", "do", "does", "doing", "down", "during", "each", "few", "for", "from", "further", "had", "has", "have", "having", "he", "her", "here", "hers", "him", "his", "how", "i", "if", "in", "into", "is", "it", "its", "just", "like", "made", "make", "me", "might", "more", "most", "must", "my", "no", "nor", "not", "now", "of", "off", "on", "once", "one", "only", "or", "other", "our", "out", "over", "own", "same", "she", "should", "so", "some", "such", "take", "than", "that", "the", "their", "them", "then", "there", "these", "they", "this", "those", "through", "to", "too", "under", "until", "up", "upon", "very", "was", "we", "were", "what", "when", "where", "which", "while", "who", "whom", "why", "will", "with", "would", "you", "your")
FOREIGN_FUNCTION = ("della", "delle", "dalla", "nella", "alla", "sulla", "degli", "dei", "questo", "questa", "quelle", "cette", "notre", "votre", "comme", "elle", "une", "chose", "beide", "eine", "keine", "meine", "seine", "diese", "desde", "este", "esta")


@dataclass(frozen=True)
class Bars:
    """Evidence a lemma needs."""

    min_count: int = 5
    min_sources: int = 3
    mixed_wp: int = 10
    wp_only: int = 50
    capital_share: float = 0.25


def parse_review(lines: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rows of review files (file, line, value): lemma, verdict, gloss, note, error. Two to four
    columns, trimmed; comments and blank lines are skipped; a bad row carries its error."""
    cells = F.transform(F.split(F.col("value"), "\t"), lambda c: F.trim(c))
    rows = lines.where(~F.trim("value").startswith("#") & (F.trim("value") != "")).withColumn("c", cells)
    cell = lambda i: F.coalesce(F.try_element_at("c", F.lit(i)), F.lit(""))
    named = rows.select("file", "line", cell(1).alias("lemma"), cell(2).alias("verdict"), cell(3).alias("gloss"), cell(4).alias("note"), F.size("c").alias("width"))
    at = F.concat(F.col("file"), F.lit(":"), F.col("line").cast("string"), F.lit(": "))
    error = F.when(~F.col("width").between(2, 4), F.concat(at, F.lit("2 to 4 columns expected"))).when(F.col("lemma") == "", F.concat(at, F.lit("no lemma"))).when(~F.col("verdict").isin(*VERDICTS), F.concat(at, F.lit("unknown verdict"))).when((F.col("verdict") == "lemma") & (F.col("gloss") == ""), F.concat(at, F.lit("a lemma needs a gloss")))
    checked = named.withColumn("error", error)
    if known is not None:
        keys = known.select(F.col("lemma").alias("k")).distinct()
        checked = checked.join(keys, F.col("lemma") == F.col("k"), "left").withColumn("error", F.coalesce("error", F.when(F.col("k").isNull(), F.concat(at, F.lit("not a mined lemma"))))).drop("k")
    return checked.drop("width")


def all_or_nothing(checked: DataFrame) -> DataFrame:
    """The rows, or an error naming the first faults: nothing is applied in part."""
    faults = [r["error"] for r in checked.where("error IS NOT NULL").orderBy("file", "line").limit(20).select("error").collect()]
    if faults:
        raise ValueError("; ".join(faults))
    return checked.drop("error")


def upsert(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """Ledger (lemma, verdict, gloss, note, ord) with a batch over it: a batch row replaces verdict and
    gloss, notes are joined once each, new lemmas come behind. The last row of a lemma in a batch counts."""
    new = batch.groupBy("lemma").agg(F.max_by("verdict", "ord").alias("v"), F.max_by("gloss", "ord").alias("g"), F.max_by("note", "ord").alias("n"), F.min("ord").alias("o"))
    both = ledger.join(new, "lemma", "full_outer")
    note = T.distinct_notes(F.array_join(F.filter(F.array(F.coalesce("note", F.lit("")), F.coalesce("n", F.lit(""))), lambda x: x != ""), "; "))
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return both.select("lemma", F.coalesce("v", "verdict").alias("verdict"), F.coalesce(blank("g"), "gloss").alias("gloss"), note.alias("note"), F.col("ord").isNull().alias("is_new"), F.coalesce("ord", "o").alias("ord"))


def replay(mined: DataFrame, ledger: DataFrame) -> DataFrame:
    """Mined lemmas with verdicts: by the lemma itself, else by its citation form. Later ledger rows win."""
    last = ledger.groupBy("lemma").agg(F.max_by(F.struct("verdict", "gloss"), "ord").alias("r"))
    exact, cited = last.select(F.col("lemma"), F.col("r").alias("r1")), last.select(F.col("lemma").alias("cited"), F.col("r").alias("r2"))
    found = mined.withColumn("cited", T.citation_form(F.col("lemma"))).join(exact, "lemma", "left").join(cited, "cited", "left")
    chosen = F.coalesce("r1", "r2")
    by = F.when(F.col("r1").isNotNull(), "exact").when(F.col("r2").isNotNull(), "citation form")
    return found.select(*mined.columns, chosen["verdict"].alias("verdict"), chosen["gloss"].alias("gloss"), by.alias("matched"))


def apply_decisions(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Records with a shard's decisions; ``unmatched`` reports the rest."""
    d = decisions.select(F.col("lemma"), *(F.col(c).alias(f"d_{c}") for c in ("verdict", "gloss", "note")))
    return records.join(d, "lemma", "left").withColumns({c: F.coalesce(f"d_{c}", c) for c in ("verdict", "gloss", "note")}).drop("d_verdict", "d_gloss", "d_note")


def unmatched(decisions: DataFrame, records: DataFrame) -> DataFrame:
    return decisions.join(records.select("lemma"), "lemma", "left_anti")


def tier(count: Column, other: Column, wp: Column, bars: Bars = Bars()) -> Column:
    """How broad the evidence is; null if too thin."""
    return F.when(count < bars.min_count, F.lit(None)).when(other >= bars.min_sources, "broad").when((other >= 1) & (wp >= bars.mixed_wp), "mixed").when((other == 0) & (wp >= bars.wp_only), "wp-only")


def english_words(index: DataFrame, column: str = "english") -> DataFrame:
    """word: all words of the index's heads and the function words."""
    heads = index.select(F.explode(F.regexp_extract_all(F.lower(column), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return heads.unionByName(index.sparkSession.createDataFrame([(w,) for w in ENGLISH_FUNCTION], "word string")).distinct()


def english_forms(forms: DataFrame, english: DataFrame) -> DataFrame:
    """form, is_english: in the set, or the plural or past form of one. Three candidates a form, one equi-join."""
    bare = F.regexp_replace(F.col("form"), "^['’]+|['’]+$", "")
    cut = lambda n: F.substring(bare, F.lit(1), F.length(bare) - n)
    tries = forms.select("form").distinct().select("form", F.explode(F.array_compact(F.array(bare, F.when(bare.endswith("s"), cut(1)), F.when(bare.endswith("ed"), cut(2))))).alias("word"))
    hits = tries.join(english, "word", "left_semi").select("form").distinct().withColumn("is_english", F.lit(True))
    return forms.select("form").distinct().join(hits, "form", "left").select("form", F.coalesce("is_english", F.lit(False)).alias("is_english"))


def gap_buckets(candidates: DataFrame, words: DataFrame, english: DataFrame, verbs_known: DataFrame, bars: Bars = Bars()) -> DataFrame:
    """Candidates (lemma, kind, count, lower, verdict, forms map, other, wp) with ``bucket`` and ``tier``.

    The order of the cases is their meaning. Membership is settled by left joins to flags;
    ``words`` (word) is the dictionary, ``verbs_known`` (stem) the stems with a known root in them.
    """
    verb_stem = F.nullif(F.regexp_extract("lemma", "^(.+?)(a|i|o)n?t(a|e)$", 1), F.lit(""))
    base = candidates.withColumns({"verb": F.concat(verb_stem, F.lit("i")), "stem": verb_stem})
    flag = lambda df, key, name: df.select(F.col(df.columns[0]).alias(key)).distinct().withColumn(name, F.lit(True))
    foreign_forms = candidates.select("lemma", F.explode(F.map_keys("forms")).alias("form"))
    all_english = foreign_forms.join(english_forms(foreign_forms, english), "form").groupBy("lemma").agg(F.min("is_english").alias("english"))
    joined = base.join(flag(words, "lemma", "held"), "lemma", "left").join(flag(words, "verb", "verb_held"), "verb", "left").join(flag(candidates.select("lemma"), "verb", "verb_candidate"), "verb", "left").join(flag(verbs_known, "stem", "verb_root"), "stem", "left").join(all_english, "lemma", "left")
    level = tier(F.col("count"), F.col("other"), F.col("wp"), bars)
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    bucket = (
        F.when(yes("held"), "in-dict").when(F.coalesce("verdict", F.lit("")) != "", "reviewed").when(~F.col("kind").isin("unknown", "derived"), "closed-class")
        .when(~F.col("lemma").rlike("[oaei]$") | F.col("lemma").contains("'"), "no-ending").when(yes("english"), "english").when(F.col("lemma").rlike("[qwxy]") | F.col("lemma").isin(*FOREIGN_FUNCTION), "foreign")
        .when(F.col("stem").isNotNull() & (yes("verb_held") | yes("verb_candidate") | yes("verb_root")), "participle").when(F.col("lower") < bars.capital_share * F.col("count"), "capitalised").when(level.isNull(), "thin").otherwise("queue")
    )
    return joined.select(*candidates.columns, bucket.alias("bucket"), level.alias("tier"))


def queue(buckets: DataFrame) -> DataFrame:
    """What is left to review, best evidence first: a total order, kept as ``place``-able columns."""
    rank = F.when(F.col("tier") == "broad", 0).when(F.col("tier") == "mixed", 1).otherwise(2)
    return buckets.where("bucket = 'queue'").orderBy(rank, F.col("other").desc(), F.col("wp").desc(), F.col("count").desc(), "lemma")


def bucket_counts(buckets: DataFrame) -> DataFrame:
    """Bucket by kind with totals."""
    return buckets.rollup("bucket", "kind").agg(F.count("*").alias("n"))


def pending(records: DataFrame, kinds: tuple[str, ...] = ("unknown",), most: int = 100) -> DataFrame:
    """Unreviewed records, frequent first, with their four commonest forms and two citations."""
    top = F.slice(F.array_sort(F.map_entries("forms"), lambda a, b: F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1).when(a["key"] < b["key"], -1).otherwise(1)), 1, 4)
    return records.where(F.col("kind").isin(*kinds) & (F.coalesce("verdict", F.lit("")) == "")).orderBy(F.col("count").desc(), "lemma").limit(most).select("lemma", "kind", "count", F.transform(top, lambda e: e["key"]).alias("top_forms"), F.slice("citations", 1, 2).alias("citations"))


def top_per_kind(records: DataFrame, n: int, by: str = "kind") -> DataFrame:
    w = Window.partitionBy(by).orderBy(F.col("count").desc(), "lemma")
    return records.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def other_first(citations: Column, keep: int = 3, prefix: str = "wp-") -> Column:
    """The first citations, those outside the encyclopedia before those in it, each in order."""
    wp = lambda c: c["source"].startswith(prefix)
    return F.slice(F.concat(F.filter(citations, lambda c: ~wp(c)), F.filter(citations, wp)), 1, keep)


def dispositions(verdicts: DataFrame, entries: DataFrame, model_prepositions: tuple[str, ...] = ()) -> DataFrame:
    """What becomes of each reviewed lemma (lemma, verdict, gloss, ord): promoted, or the first reason against."""
    held = entries.select(F.lower("word").alias("word")).distinct().withColumn("held", F.lit(True))
    named = verdicts.withColumn("word", T.infinitive(F.col("lemma"))).withColumn("pos", T.part_of_speech(F.col("word"), F.coalesce("gloss", F.lit("")), prepositions=model_prepositions))
    candidate = (F.col("verdict") == "lemma") & (F.coalesce("gloss", F.lit("")) != "")
    joined = named.join(held, "word", "left").withColumn("first", F.row_number().over(Window.partitionBy("word", candidate & F.col("held").isNull()).orderBy("ord")) == 1)
    why = F.when(F.coalesce("verdict", F.lit("")) != "lemma", "not a lemma").when(F.coalesce("gloss", F.lit("")) == "", "no gloss").when(F.col("held"), "already held").when(~F.col("first"), "duplicate citation form").when(F.col("pos").isNull(), "part of speech unresolved").otherwise("promoted")
    return joined.select("lemma", "word", "pos", "verdict", "gloss", why.alias("disposition"))


def rebuild(entries: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Entries with rebuilt ones in place of those of the same word."""
    return entries.join(rebuilt.select(F.lower("word").alias("__w")).distinct(), F.lower("word") == F.col("__w"), "left_anti").unionByName(rebuilt, allowMissingColumns=True)


def recite(entries: DataFrame, candidates: DataFrame, keep: int = 3, prefix: str = "wp-") -> DataFrame:
    """Entries (word, citations) with the first citations of the candidate of their word (lemma, citations), where these hold
    more from outside the encyclopedia; others stay as they are."""
    other = lambda c: F.size(F.filter(F.coalesce(c, F.array()), lambda x: ~x["source"].startswith(prefix)))
    new = candidates.select(F.col("lemma").alias("__w"), other_first(F.col("citations"), keep, prefix).alias("__c"))
    better = F.col("__w").isNotNull() & (other(F.col("__c")) > other(F.col("citations")))
    return entries.join(new, F.col("word") == F.col("__w"), "left").withColumns({"recited": better, "citations": F.when(better, F.col("__c")).otherwise(F.col("citations"))}).drop("__w", "__c")


def is_segmented(morphology: Column) -> Column:
    """A shape with an affix."""
    return (F.coalesce(F.size(morphology["prefixes"]), F.lit(0)) > 0) | (F.coalesce(F.size(morphology["suffixes"]), F.lit(0)) > 0)


def rederive(entries: DataFrame, source: str = "corpus-mined") -> DataFrame:
    """Entries whose derived flag follows their morphology again (null where it has no affix); those of other sources stay."""
    flag = F.coalesce(is_segmented(F.col("morphology")), F.lit(False))
    own = (F.col("source") == source) & (flag != F.coalesce("derived", F.lit(False)))
    return entries.withColumns({"rederived": F.coalesce(own, F.lit(False)), "derived": F.when(own, F.when(flag, True)).otherwise(F.col("derived"))})


def resegment(entries: DataFrame, shapes: DataFrame, ledger: DataFrame, prefixes: list[str], source: str = "corpus-mined") -> DataFrame:
    """Entries of a source that were reviewed in a batch with one of the prefixes, with the new shape of their word (word,
    shape) where there is one and it differs."""
    due = batches_matching(entries.where(F.col("source") == source), ledger, prefixes).select(F.col("word").alias("__w")).distinct()
    new = shapes.join(due, F.col("word") == F.col("__w"), "left_semi").select(F.col("word").alias("__w"), F.col("shape").alias("__s"))
    changed = F.col("__s").isNotNull() & ~F.col("__s").eqNullSafe(F.col("morphology")) & (F.col("source") == source)
    return entries.join(new, F.col("word") == F.col("__w"), "left").withColumns({"resegmented": F.coalesce(changed, F.lit(False)), "morphology": F.when(changed, F.col("__s")).otherwise(F.col("morphology"))}).drop("__w", "__s")


def refresh_attestation(entries: DataFrame, counts: DataFrame) -> DataFrame:
    """Entries (word, count) with new counts (word, occurrences) where those are positive and different."""
    new = counts.select(F.col("word").alias("__w"), F.col("occurrences").alias("__n"))
    changed = (F.coalesce("__n", F.lit(0)) > 0) & ~F.col("__n").eqNullSafe(F.col("count"))
    return entries.join(new, F.lower("word") == F.col("__w"), "left").withColumns({"changed": changed, "count": F.when(changed, F.col("__n")).otherwise(F.col("count"))}).drop("__w", "__n")


def batches_matching(entries: DataFrame, ledger: DataFrame, prefixes: list[str]) -> DataFrame:
    """Entries whose lemma was reviewed in a batch whose name starts with one of the prefixes."""
    reviewed = ledger.where(F.exists("reviewed_in", lambda b: F.array_contains(F.transform(F.array(*map(F.lit, prefixes)), lambda p: b.startswith(p)), True)))
    return entries.join(reviewed.select(F.lower("lemma").alias("__w")).distinct(), F.lower("word") == F.col("__w"), "left_semi")
