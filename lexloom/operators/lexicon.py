"""Lexicon: layers merged by precedence, index and entries, glosses, grammar references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import morphology as M
from ..functions import text as T
from ..functions.model import DEFAULT, LanguageModel

# Dated terms of a 1906 source and their replacements.
DATED_GLOSSES = {
    "negro": "Black person", "heathenism": "paganism, idol worship", "heathen": "pagan", "lunatic": "person with mental illness", "imbecile": "person with intellectual disability",
    "crippled": "disabled", "idiot": "person with intellectual disability", "oaf": "fool, simpleton", "dumbness": "inability to speak", "dumb show": "pantomime (performance without speech)",
    "dumb": "unable to speak", "savage": "wild, untamed", "oriental": "eastern, of the East",
}
# Word classes of bare words, the first that holds a word counts.
BARE_CLASSES = [
    ("ending", ["a", "o", "e", "i", "as", "is", "os", "us", "u", "j", "n"]),
    ("art", ["la"]),
    ("pron", ["mi", "vi", "li", "ŝi", "ĝi", "ni", "ili", "si", "oni"]),
    ("num", ["unu", "du", "tri", "kvar", "kvin", "ses", "sep", "ok", "naŭ", "dek", "cent", "mil"]),
    ("prep", ["al", "apud", "ĉe", "ĉirkaŭ", "da", "de", "dum", "el", "en", "ekster", "ĝis", "inter", "je", "kontraŭ", "krom", "kun", "per", "po", "por", "post", "preter", "pri", "pro", "sen", "sub", "super", "sur", "tra", "trans", "anstataŭ", "antaŭ", "malgraŭ", "kvazaŭ"]),
    ("conj", ["kaj", "aŭ", "ke", "ĉu", "se", "ĉar", "ol", "nek"]),
    ("adj", ["tia", "ia", "ĉia", "nenia"]),
    ("adv", ["kie", "kial", "kiel", "kiam", "tie", "tial", "tiel", "tiam", "ĉie", "ĉial", "ĉiel", "ĉiam", "ie", "ial", "iel", "iam", "nenie", "nenial", "neniel", "neniam", "for", "tuj", "nun", "jam", "ĵus", "ankoraŭ", "plu", "nur", "eĉ", "preskaŭ", "plej", "pli", "tre", "tro", "baldaŭ", "ambaŭ", "hieraŭ", "hodiaŭ", "morgaŭ", "do", "ja", "tamen", "des", "ju"]),
    ("pron", ["kiu", "kio", "kies", "kiom", "tiu", "tio", "tiom", "ĉiu", "ĉio", "ĉiom", "iu", "io", "iom", "ies", "neniu", "nenio", "nenies", "neniom"]),
    ("particle", ["ajn", "ĉi", "jen", "ne", "jes"]),
    ("interj", ["adiaŭ", "ho", "ha"]),
]
NUMERALS = ["unu", "du", "tri", "kvar", "kvin", "ses", "sep", "ok", "naŭ", "dek", "cent", "mil"]
ADJECTIVES = ["bel", "bon", "malbon", "grand", "long", "alt", "rapid", "facil", "malfacil", "fort", "malfort", "ĝust", "fals", "san", "malsan", "varm", "malvarm", "blank", "nigr", "ruĝ", "flav", "verd", "blu", "griz", "brun", "glat", "mol", "dur", "dik", "simpl", "plen", "malplen", "komplet", "cert", "official", "natur", "liber", "egal", "simil", "diferenc", "konstant", "sentim", "kuraĝ"]
OPEN_POS = {"o": "noun", "a": "adj", "e": "adv", "i": "verb"}


def bare_class(word: Column) -> Column:
    return reduce(lambda c, kv: c.when(word.isin(*kv[1]), kv[0]), BARE_CLASSES, F.when(F.lit(False), "")).otherwise("particle")


def root_class(stem: Column, fr: Column, de: Column, en: Column) -> Column:
    """Word class of a root by what its glosses look like."""
    en, fr, de = F.coalesce(en, F.lit("")), F.lower(F.trim(F.coalesce(fr, F.lit("")))), F.lower(F.trim(F.coalesce(de, F.lit(""))))
    adjective = "(ous|ful|ish|able|ible|y|al|ic|ive|ent)$"
    de_verb = de.endswith("en") & (F.length(de) > 3)
    fr_verb = fr.rlike("(er|ir|oir)$") | (fr.endswith("re") & (F.length(fr) > 3))
    return (
        F.when(stem.isin(*ADJECTIVES), "adj").when(en.startswith("to "), "verb").when((en != "") & F.element_at(F.split(en, ","), 1).rlike(adjective), "adj")
        .when(fr.rlike("(eux|euse|ible|able)$") & (en != "") & F.element_at(F.split(en, r"\s+"), -1).rlike(adjective), "adj").when(fr_verb & de_verb, "verb").when(fr.rlike("(oir|ir)$") & (F.length(fr) > 3), "verb")
        .when(fr.endswith("er") & de_verb & ~de.rlike("(isch|lich|haft|los|bar|ig)$"), "verb").otherwise("noun")
    )


def entry_kind(word: Column, affixes: Column) -> Column:
    """How a Fundamento head is turned into an entry."""
    bare = F.regexp_replace(word, "'", "")
    return F.when(~word.contains("'"), "bare").when(F.array_contains(affixes, bare), "affix").when(bare.isin(*NUMERALS), "numeral").otherwise("root")


def modern_gloss(gloss: Column, pos: Column) -> Column:
    """Dated terms replaced as whole words, longest first; senses that repeat or are part of another go."""
    terms = [*sorted(DATED_GLOSSES, key=lambda t: (-len(t), t)), "cripple"]
    dated = gloss.rlike(r"(?iU)\b(" + "|".join(terms) + r")\b")
    new = gloss
    for t in terms[:-1]:
        new = F.regexp_replace(new, rf"(?iU)\b{t}\b", DATED_GLOSSES[t])
    new = F.when(pos == "verb", F.regexp_replace(new, r"(?iU)\bcripple\b", "disable")).otherwise(F.regexp_replace(new, r"(?iU)\bcripple\b", "person with physical disability"))
    senses = F.array_distinct(F.split(new, "; "))
    words = lambda s: F.array_distinct(F.regexp_extract_all(s, F.lit(r"(?U)\w+"), F.lit(0)))
    kept = F.filter(senses, lambda p: ~F.exists(senses, lambda q: (p != q) & (F.size(F.array_except(words(p), words(q))) == 0)))
    return F.when(dated, F.array_join(kept, "; ")).otherwise(gloss)


def first_by_precedence(layers: list[DataFrame], key: str = "word") -> DataFrame:
    """Rows of all layers, the earlier layer's for a key that several have; within a layer the first by ``ord``."""
    every = reduce(DataFrame.unionByName, [d.withColumn("layer", F.lit(i)) for i, d in enumerate(layers)])
    w = Window.partitionBy(key).orderBy("layer", "ord")
    return every.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def repair_pass(first: DataFrame, second: DataFrame, extra: tuple[str, ...] = ("dek", "cent", "mil", "ju", "des")) -> DataFrame:
    """Pass A put right: the bogus M goes, L is the article, and five bare words come from pass B if they are missing."""
    fixed = first.where("word != 'M'").withColumn("word", F.when(F.col("word") == "L", "la").otherwise(F.col("word")))
    more = second.where(F.col("word").isin(*extra) & T.sane_gloss(F.lower("en"))).join(fixed.select("word").distinct(), "word", "left_anti")
    return fixed.unionByName(first_by_precedence([more]).drop("layer"))


def merge_derivatives(entries: DataFrame, derivatives: DataFrame) -> DataFrame:
    """Derivatives (word, gloss_en, ofc, ord) that no entry holds, first seen. A first one without a gloss
    hides later ones, so it is ranked before it is dropped."""
    w = Window.partitionBy(F.lower("word")).orderBy("ord")
    new = derivatives.join(entries.select(F.lower("word").alias("__w")).distinct(), F.lower("word") == F.col("__w"), "left_anti")
    first = new.withColumn("__r", F.row_number().over(w)).where("__r = 1 AND coalesce(gloss_en, '') != ''").drop("__r")
    return first.withColumn("source", source_tag(F.col("ofc")))


def source_tag(ofc: Column) -> Column:
    return F.when(ofc.rlike("^[0-9]{1,2}$"), F.concat(F.lit("ReVo/OA-"), ofc)).when(ofc == "*", "ReVo/UV-*").otherwise("ReVo")


def english_index(pairs: DataFrame) -> DataFrame:
    """(english, sense, word, ord) to english, words in order, each once."""
    head = F.when(F.coalesce("sense", F.lit("")) != "", F.concat("english", F.lit(" ("), F.col("sense"), F.lit(")"))).otherwise(F.col("english"))
    first = pairs.select(head.alias("english"), "word", "ord").groupBy("english", "word").agg(F.min("ord").alias("ord"))
    return first.groupBy("english").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "word"))), lambda x: x["word"]).alias("words"))


def entries_from_heads(pairs: DataFrame, held: DataFrame | None = None, glosses: int = 6, heads: int = 8) -> DataFrame:
    """One entry a word from the heads that point at it: its first distinct glosses and heads."""
    gloss = F.when(F.coalesce("sense", F.lit("")) != "", F.concat(F.lower("english"), F.lit(" ("), F.col("sense"), F.lit(")"))).otherwise(F.lower("english"))
    listed = F.sort_array(F.collect_list(F.struct("ord", "gloss", "english")))
    rows = pairs.withColumn("gloss", gloss).groupBy("word").agg(listed.alias("l"))
    last = F.substring("word", -1, 1)
    pos = reduce(lambda c, kv: c.when(last == kv[0], kv[1]), OPEN_POS.items(), F.when(F.lit(False), "")).otherwise("unknown")
    out = rows.select("word", pos.alias("pos"), F.array_join(F.slice(F.array_distinct(F.transform("l", lambda x: x["gloss"])), 1, glosses), "; ").alias("old"), F.slice(F.transform("l", lambda x: x["english"]), 1, heads).alias("english_headwords"))
    out = out.withColumn("gloss_en", modern_gloss(F.col("old"), F.col("pos"))).withColumn("dated_gloss", F.when(F.col("gloss_en") != F.col("old"), F.col("old"))).drop("old")
    return out if held is None else out.join(held.select(F.lower("word").alias("__w")).distinct(), F.lower("word") == F.col("__w"), "left_anti")


def grammar_refs(word: Column, pos: Column, source: Column, affixes: Column, suffixes: Column) -> Column:
    """Rules of the grammar that an entry illustrates, as (section, topic) in rule order. ``affixes``: how
    many its morphology has; ``suffixes``: their names."""
    initial = F.regexp_extract(word, "^(neni|ki|ti|ĉi|i)(o|u|a|es|e|am|al|el|om)$", 1)
    grid = (initial != "") & pos.isin("pron", "adv", "adj", "particle", "noun")
    participle = F.array(*map(F.lit, ("ant", "int", "ont", "at", "it", "ot")))
    mined = (source == "corpus-mined") & (F.coalesce(affixes, F.lit(0)) > 0)
    rules = [
        (pos.isin("prefix", "suffix"), "2", "Morfologio — affix inventory"), (grid, "3", "Sintakso — La tabelvortoj (correlatives)"), (grid & word.startswith("neni"), "6.2", "Negation is single, not doubled"),
        ((pos == "suffix") & F.array_contains(participle, word), "2", "Morfologio — participles"), ((pos == "suffix") & word.isin("at", "it"), "6.6", "Passive participles: ongoing action (-ata) vs resulting state (-ita)"),
        ((word == "ujo") | ((pos == "suffix") & (word == "uj")), "6.1", "Country names: -ujo dominates, not -io"), ((word == "ĉi") & pos.isin("particle", "adv"), "6.4", "Demonstrative particle ĉi: preposed vs postposed"),
        ((word == "po") & (pos == "prep"), "6.11", "Distributive preposition po"), ((word == "je") & (pos == "prep"), "6.13", "Indefinite preposition je"),
        (mined, "2", "Morfologio — affix inventory"), (mined & F.arrays_overlap(F.coalesce(suffixes, F.array().cast("array<string>")), participle), "2", "Morfologio — participles"),
    ]
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(s).alias("section"), F.lit(t).alias("topic"))) for c, s, t in rules)))


def cited_sources(citations: DataFrame, sources: DataFrame) -> DataFrame:
    """Citations (source, ...) with the title of their source in a catalogue (file, title, ord); of rows of one file the last
    counts, and a source that isn't held has no title."""
    last = sources.groupBy("file").agg(F.max_by("title", "ord").alias("title"))
    return citations.join(last, F.col("source") == F.col("file"), "left").drop("file")


def printed_derived(entries: DataFrame, roots: DataFrame, model: LanguageModel = DEFAULT) -> DataFrame:
    """Entries (word) of the printed layer with ``derived``: the word without its ending is no root, but affixes lead from
    it to one."""
    bare = F.when(F.lower(F.substring("word", -1, 1)).isin(*OPEN_POS), F.expr("substring(word, 1, length(word) - 1)")).otherwise(F.col("word"))
    stems = entries.withColumn("form", bare)
    found = M.first_reading(stems.select("form"), lambda x, longest: M.peel_ways(x, longest, model), M.dictionary(None, roots), "string")
    return stems.join(found, "form", "left").withColumn("derived", F.coalesce(F.lower("value") != F.lower("form"), F.lit(False))).drop("form", "value")


def fundamento_entries(heads: DataFrame, prefixes: dict[str, str], suffixes: dict[str, str], most: int = M.MOST_ENTRIES) -> DataFrame:
    """Entries of a layer's heads (word with apostrophes behind its parts, fr, en, de): bare words by their class, affixes,
    numerals, and roots with an inferred class, its ending and their shape, affixes taken off as long as what is left is a
    root (at most ``most`` of them, as a layer written by hand has)."""
    stem = F.lower(F.replace("word", F.lit("'"), F.lit("")))
    roots = [r["r"] for r in heads.where(F.col("word").contains("'")).select(stem.alias("r")).distinct().limit(most + 1).collect()]
    if len(roots) > most:
        raise ValueError(f"more than {most} roots")
    held = frozenset(roots)

    @F.udf("struct<prefixes: array<string>, stem: string, suffixes: array<string>>", useArrow=True)
    def shape(s):
        before, core, after = M.greedy_segment(s, held, prefixes, [x for x in suffixes if len(x) >= 2]) or ((), s, ())
        return (list(before), core, list(after))

    single = F.size(F.filter(F.split("word", "'"), lambda p: p != "")) == 1
    affix = F.array(*map(F.lit, [*prefixes, *suffixes])).cast("array<string>")
    kind = F.when(single | ~F.col("word").contains("'"), entry_kind(F.lower("word"), affix)).otherwise("root")
    root_pos = root_class(F.col("stem"), F.col("fr"), F.col("de"), F.col("en"))
    pos = F.when(F.col("kind") == "bare", bare_class(F.col("word"))).when(F.col("kind") == "affix", F.when(F.col("stem").isin(*prefixes), "prefix").otherwise("suffix")).when(F.col("kind") == "numeral", "num").otherwise(root_pos)
    named = heads.withColumns({"stem": stem, "kind": kind}).withColumn("pos", pos)
    ending = F.when(F.col("pos") == "verb", "i").when(F.col("pos") == "adj", "a").otherwise("o")
    is_root = F.col("kind") == "root"
    gloss = F.trim(F.coalesce("en", F.lit("")))
    known = {**suffixes, **prefixes}
    of = lambda c: affix_glosses(c, known)
    shaped = named.withColumn("shape", F.when(is_root, shape("stem"))).withColumn("ending", ending)
    morphology = F.when(is_root, F.struct(of(F.col("shape.prefixes")).alias("prefixes"), F.col("shape.stem").alias("stem"), of(F.col("shape.suffixes")).alias("suffixes"), F.col("ending").alias("ending")))
    word = F.when(F.col("kind") == "bare", F.col("word")).when(is_root, F.concat(F.replace("word", F.lit("'"), F.lit("")), "ending")).otherwise(F.col("stem"))
    affix_gloss = F.create_map(*[F.lit(x) for kv in (known or {"": ""}).items() for x in kv])
    gloss = F.when((F.col("kind") == "affix") & (gloss == ""), F.coalesce(affix_gloss[F.col("stem")], F.lit(""))).otherwise(gloss)
    return shaped.select(word.alias("word"), "pos", F.when(F.col("kind").isin("affix", "root"), F.col("stem")).alias("root"), gloss.alias("gloss_en"), F.trim(F.coalesce("fr", F.lit(""))).alias("gloss_fr"), morphology.alias("morphology"), F.lit("Fundamento/UV-1905").alias("source"), "kind")


def affix_glosses(morphemes: Column, glosses: dict[str, str]) -> Column:
    """Morphemes with their glosses, '' where there is none."""
    known = F.create_map(*[F.lit(x) for kv in glosses.items() for x in kv])
    return F.transform(morphemes, lambda m: F.struct(m.alias("m"), F.coalesce(known[m], F.lit("")).alias("gloss")))


def correlatives_missing(cells: DataFrame, entries: DataFrame, lines: DataFrame, strict: bool = False) -> DataFrame:
    """Correlative cells (word, source, line) no entry holds, each with its pinned line, which must contain the word: that
    is ``checked``, and with ``strict`` a cell for which it doesn't hold is an error when the rows are read."""
    new = cells.join(entries.select(F.lower("word").alias("__w")).distinct(), F.lower("word") == F.col("__w"), "left_anti")
    checked = F.coalesce(F.lower("text").contains(F.col("word")), F.lit(False))
    fault = F.raise_error(F.concat(F.lit("not on its pinned line: "), F.col("word"))).cast("boolean")
    return new.join(lines, ["source", "line"], "left").withColumn("checked", F.when(~checked, fault).otherwise(checked) if strict else checked)


def sorted_entries(entries: DataFrame) -> DataFrame:
    """By the alphabet, ties by the word itself."""
    return entries.orderBy(T.collation_key(F.col("word")), "word")
