"""Queries of word, gloss, ledger, entry and report operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import morphology as M
from ..functions import text as T
from ..functions.model import DEFAULT
from ..operators import corpus as O
from ..operators import curation as C
from ..operators import lexicon as L
from ..operators import mining as N
from ..operators import reports as R
from ..sources.steps import saved
from .common import LETTERS, SQL_CITE, SQL_LINES, SQL_POS, SQL_TOKENS, SQL_VOCAB, table
from .mining import _BUCKETS, _buckets, _tokens, _vocabulary

PREPOSITIONS = ("al", "de", "en", "sur", "la", "um")
NUMBERS = ["dudek", "tricent", "unu", "dumil", "dudeko", "kvar", "nu"]
AFFIXES = {"mal": "opposite", "re": "again", "in": "female", "et": "small", "th": "x"}
HEADS = [("kaj", "et", "and", "und"), ("mal'", "contraire", "opposite", "Gegenteil"), ("in'", "", "", ""), ("dek'", "dix", "ten", "zehn"), ("am'", "aimer", "to love", "lieben"), ("patr'", "père", "father", "Vater"), ("patr'in'", "mère", "mother", "Mutter"), ("mal'am'", "haïr", "to hate", "hassen"), ("bon'", "bon", "good", "gut"), ("la", "le", "the", "der")]
GRAMMAR = [("kiu", "pron", "x", 0, ""), ("neniam", "adv", "x", 0, ""), ("ant", "suffix", "x", 0, ""), ("it", "suffix", "x", 0, ""), ("mal", "prefix", "x", 0, ""), ("ujo", "noun", "x", 0, ""), ("uj", "suffix", "x", 0, ""), ("ĉi", "particle", "x", 0, ""), ("po", "prep", "x", 0, ""), ("je", "prep", "x", 0, ""), ("amanta", "adj", "corpus-mined", 1, "ant"), ("kies", "verb", "x", 0, "")]
HSYSTEM = ["chu ghi shi laudis neuzebla", "chu ĝi ĉu ŝi ĥo", "plain words", "Chiu SHI jhus Europo reuzi"]


def _forms(spark, d):
    return _tokens(spark, d).select("form").distinct()


def minable_forms(spark, d):
    f = F.col("form")
    return _forms(spark, d).select("form", T.minable(f).alias("minable"), T.is_roman(f).alias("roman"))


def parts_of_speech(spark, d):
    """Dictionary classes of all forms, some with an interjection's gloss."""
    gloss = F.when(F.col("form").startswith("h"), "an Interjection").otherwise("word")
    return _forms(spark, d).select("form", F.coalesce(T.part_of_speech(F.col("form"), gloss, prepositions=PREPOSITIONS), F.lit("none")).alias("pos"))


def numeral_forms(spark, d):
    words = _forms(spark, d).unionByName(spark.createDataFrame([(w,) for w in NUMBERS], "form string")).distinct()
    return M.on_distinct_forms(words, "form", M.is_numeral, "boolean", "numeral")


def gloss_checks(spark, d):
    """Which names of parts, lines of the benchmark and types are sane glosses, phrases or headwords."""
    texts = table(spark, d, "part").select(F.explode(F.array("p_name", "p_type", F.lower("p_brand"))).alias("w")).unionByName(table(spark, d, "benchmark").select(F.explode(T.lines(F.col("text"))).alias("w")))
    w = F.col("w")
    return texts.distinct().select("w", T.sane_gloss(F.lower(w)).alias("sane"), T.phrase(w).alias("phrase"), T.headword(w).alias("headword"))


def epoch_checks(spark, d):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    value = F.element_at(F.array(ms.cast("string"), F.concat(F.lit("2"), ms.cast("string").substr(2, 12)), F.concat(ms.cast("string"), F.lit("5")), "event_type", F.col("user_id").cast("string")), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", value.alias("value")).withColumn("is_time", T.epoch_like(F.col("value")))


def one_field_texts(spark, d):
    return table(spark, d, "documents").select("doc_id", T.short_digest(T.one_field(F.col("text"))).alias("digest"))


def x_system_texts(spark, d):
    """Texts with twenty digraphs of the x-system or more, folded, by digest."""
    folded = T.x_system(F.col("text"), 20)
    rows = table(spark, d, "documents").select("doc_id", F.concat("text", F.when(F.col("doc_id") % 3 == 0, F.repeat(F.lit(" cxu Gxi SXI aux"), 5)).otherwise(" cxu")).alias("text"))
    return rows.select("doc_id", T.short_digest(folded).alias("digest"), (folded != F.col("text")).alias("changed"))


def h_system_texts(spark, d):
    return spark.createDataFrame([(x,) for x in HSYSTEM], "text string").select("text", T.h_system(F.col("text"), 2).alias("folded"))


def fixed_sources(spark, d):
    """Patterns of two sources replaced and counted."""
    rules = {"src1": [("(?i)the", "TEH"), ("  +", " ")], "src5": [("und", "u.")]}
    rows = table(spark, d, "documents").select("doc_id", O.source_fixes(F.col("source"), F.col("text"), rules).alias("f"))
    return rows.select("doc_id", F.col("f.fixes").cast("long").alias("fixes"), T.short_digest(F.col("f.text")).alias("digest"))


def source_methods(spark, d):
    name = F.concat(F.element_at(F.array(*map(F.lit, ("pg-", "wsdump-", "wp-", "wsrc-", "ia-"))), (F.col("doc_id") % 5 + 1).cast("int")), "source")
    ofc = F.element_at(F.array(F.lit("*"), F.lit("7"), F.lit("12"), F.lit("123"), F.lit("")), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", O.method(name).alias("method"), T.source_priority(name).alias("priority"), L.source_tag(ofc).alias("tag"))


def following_months(spark, d):
    month = F.date_format("ts", "yyyy-MM")
    return table(spark, d, "events").select(month.alias("month")).distinct().select("month", T.next_month(F.col("month")).alias("following"))


def root_classes(spark, d):
    """Word classes of roots by glosses made of parts' names."""
    word = lambda i: F.element_at(F.split("p_name", " "), i)
    key = F.col("p_partkey")
    en = F.when(key % 7 == 0, F.concat(F.lit("to "), word(1))).when(key % 7 == 1, F.concat(word(1), F.lit("ful, x"))).when(key % 7 == 2, "").otherwise(word(1))
    fr = F.when(key % 3 == 0, F.concat(word(2), F.lit("er"))).when(key % 3 == 1, F.concat(word(2), F.lit("ir"))).otherwise(word(2))
    de = F.when(key % 2 == 0, F.concat(word(2), F.lit("en"))).otherwise(F.concat(word(2), F.lit("lich")))
    stem = F.when(key % 11 == 0, "bel").otherwise(word(1))
    return table(spark, d, "part").select(key.alias("p_partkey"), L.root_class(stem, fr, de, en).alias("pos"))


def morpheme_glosses(spark, d):
    """Forms cut into pieces of two letters, each with its gloss."""
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.length("form") - 1) / 2).cast("int")), lambda i: F.substring(F.col("form"), i * 2 + 1, F.lit(2)))
    found = _forms(spark, d).select("form", L.affix_glosses(pieces, AFFIXES).alias("g"))
    return found.select("form", F.array_join(F.transform("g", lambda x: F.concat(x["m"], F.lit("="), x["gloss"])), ",").alias("glosses"))


def book_bodies(spark, d):
    """Documents between a book's markers, with credits and a note before them: lines left and cut."""
    key = F.col("doc_id")
    head = F.concat(F.lit("Title\n*** START OF THIS PROJECT GUTENBERG EBOOK ***\n\nProduced by A B\nand C\n\n"), F.when(key % 2 == 0, "TRANSCRIBER'S NOTE: x\ny\n\n").otherwise(""), F.lit("    Capitulo\n"))
    tail = F.when(key % 5 != 4, "\n*** END OF THIS PROJECT GUTENBERG EBOOK ***\nlicence\n").otherwise("\nno end\n")
    lines = T.lines(F.concat(head, F.col("text"), tail))
    rows = table(spark, d, "documents").select("doc_id", O.body_slice(lines).alias("b")).withColumn("front", O.front_matter(F.col("b.body")))
    return rows.select("doc_id", F.size("b.body").cast("long").alias("body"), F.col("b.head").cast("long").alias("head"), F.col("b.tail").cast("long").alias("tail"), F.when(F.col("b").isNotNull(), F.col("front")).cast("long").alias("front"))


def preambles(spark, d):
    """Documents behind a page's furniture, some with a metadata line: the way their body was found, and lines cut."""
    key = F.col("doc_id")
    head = F.when(key % 3 == 0, "Elŝuti kiel\nde Aŭtoro\nbookTitolo\n").otherwise("\nIndekso: Titolo\nTitolo\n ← x\nAŭtoro\nKomenco de\nde Aŭtoro\n")
    rows = table(spark, d, "documents").select("doc_id", O.preamble(T.lines(F.concat(head, F.regexp_replace("text", "(?m)^(collection|book|[0-9]+)", "x")))).alias("p"))
    return rows.select("doc_id", "p.method", F.col("p.head").cast("long").alias("head"))


def review_rows(spark, d):
    """Rows of a review file a source, with each fault that a row may have."""
    key = F.col("doc_id")
    word = F.concat(F.lit("w"), key % 40)
    line = (
        F.when(key % 9 == 0, F.lit("# note")).when(key % 9 == 1, "  ").when(key % 9 == 2, F.concat(word, F.lit("\tlemma"))).when(key % 9 == 3, F.concat(word, F.lit("\tnonsense\tg")))
        .when(key % 9 == 4, F.concat(word, F.lit("\tlemma\tg\tn\tx"))).when(key % 9 == 5, F.concat(F.lit("\tlemma\tg"))).when(key % 9 == 6, F.concat(F.lit(" "), word, F.lit("\tforeign"))).otherwise(F.concat(word, F.lit("\tlemma\t"), F.col("lang"), F.lit("\tn")))
    )
    rows = table(spark, d, "documents").select(F.col("source").alias("file"), key.cast("int").alias("line"), line.alias("value"))
    known = spark.range(30).select(F.concat(F.lit("w"), "id").alias("lemma"))
    return C.parse_review(rows, known)


def _pairs(spark, d):
    from .structure import parallel_pairs

    return parallel_pairs(spark, d)


def pairs_with_bases(spark, d):
    turns = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.when(F.col("turn") % 3 == 0, "0").otherwise(F.col("conv_id").cast("string")).alias("base"))
    return O.with_bases(_pairs(spark, d), turns).select("left_id", "right_id", "left_base", "right_base")


def link_counts(spark, d):
    turns = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("a"))
    return R.link_statistics(turns, pairs_with_bases(spark, d))


def drifted_texts(spark, d):
    """Texts of a second copy of the documents that aren't those of the first."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    other = docs.select("id", F.when(F.col("id") % 7 == 0, F.upper("text")).otherwise(F.col("text")).alias("text"))
    return O.drifted(other.unionByName(spark.createDataFrame([(-1, "x")], "id long, text string")), docs).select("id")


def _verdicts(spark, d):
    """A ledger over the benchmark's words."""
    return _vocabulary(spark, d).select(F.col("form").alias("lemma"), F.when(F.length("form") % 4 == 0, "foreign").otherwise("lemma").alias("verdict"), F.when(F.length("form") % 5 == 0, "").otherwise(F.concat(F.lit("g "), "form")).alias("gloss"), F.lit("n").alias("note"), F.xxhash64("form").alias("ord"))


def decided_records(spark, d):
    """Records of all forms with the decisions that there are."""
    records = _tokens(spark, d).groupBy(F.col("form").alias("lemma")).agg(F.count("*").alias("count")).select("lemma", "count", *(F.lit(None).cast("string").alias(c) for c in ("verdict", "gloss", "note")))
    return C.apply_decisions(records, _verdicts(spark, d).drop("ord"))


def promotion_report(spark, d):
    """What becomes of each reviewed word; words that the parts' names hold are there already."""
    entries = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    verdicts = _verdicts(spark, d).withColumn("ord", F.col("lemma"))
    return C.dispositions(verdicts, entries, PREPOSITIONS).select("lemma", "word", F.coalesce("pos", F.lit("none")).alias("pos"), "disposition")


def _entries(spark, d):
    """Entries of parts: a word a part's key, some mined and some not, with shapes and citations."""
    key = F.col("p_partkey")
    cites = F.transform(F.sequence(F.lit(1), (key % 4 + 1).cast("int")), lambda i: F.struct(F.when(i % 2 == 0, F.concat(F.lit("wp-"), i.cast("string"))).otherwise(F.concat(F.lit("ia-"), i.cast("string"))).alias("source"), F.lit("t").alias("text")))
    affix = F.when(key % 3 == 0, F.array(F.struct(F.lit("mal").alias("m"), F.lit("").alias("gloss")))).otherwise(F.array().cast("array<struct<m: string, gloss: string>>"))
    shape = F.struct(affix.alias("prefixes"), F.element_at(F.split("p_name", " "), 1).alias("stem"), F.array().cast("array<struct<m: string, gloss: string>>").alias("suffixes"), F.lit("o").alias("ending"))
    return table(spark, d, "part").select(F.concat(F.lit("w"), key).alias("word"), F.when(key % 2 == 0, "corpus-mined").otherwise("ReVo/OA-3").alias("source"), shape.alias("morphology"), F.when(key % 5 < 2, True).alias("derived"), cites.alias("citations"), (key % 10).alias("count"))


def _batches(spark, d):
    key = F.col("p_partkey")
    return table(spark, d, "part").select(F.concat(F.lit("w"), key).alias("lemma"), F.array(F.concat(F.lit("b"), (key % 7).cast("string")), F.lit("c1")).alias("reviewed_in"))


def batch_entries(spark, d):
    return C.batches_matching(_entries(spark, d), _batches(spark, d), ["b3", "b5", "x"]).select("word", "source")


def rederived_entries(spark, d):
    return C.rederive(_entries(spark, d)).select("word", "rederived", "derived")


def resegmented_entries(spark, d):
    """Entries of two batches with the shape of a word without affixes where that is new."""
    entries = _entries(spark, d)
    bare = F.col("morphology").withField("prefixes", F.array().cast("array<struct<m: string, gloss: string>>"))
    found = C.resegment(entries, entries.select("word", bare.alias("shape")), _batches(spark, d), ["b3", "b5"])
    return found.select("word", "resegmented", F.size("morphology.prefixes").cast("long").alias("n_prefixes"))


def recited_entries(spark, d):
    """Entries with the citations of candidates that have more from outside the encyclopedia."""
    entries = _entries(spark, d)
    pick = lambda n: F.struct(F.concat(F.lit("pg-"), n.cast("string")).alias("source"), F.lit("new").alias("text"))
    wp = F.array(F.struct(F.lit("wp-9").alias("source"), F.lit("new").alias("text")))
    size = (F.substring("word", 2, 9).cast("int") % 5).cast("int")
    cands = entries.select(F.col("word").alias("lemma"), F.concat(wp, F.when(size > 0, F.transform(F.sequence(F.lit(1), size), pick)).otherwise(F.array().cast("array<struct<source: string, text: string>>"))).alias("citations"))
    return C.recite(entries, cands).select("word", "recited", F.array_join(F.transform("citations", lambda c: c["source"]), ",").alias("sources"))


def refreshed_entries(spark, d):
    counts = table(spark, d, "part").select(F.concat(F.lit("w"), "p_partkey").alias("word"), (F.col("p_size") % 10).alias("occurrences")).where("occurrences != 4")
    return C.refresh_attestation(_entries(spark, d), counts).select("word", "changed", F.col("count").cast("long").alias("count"))


def rebuilt_entries(spark, d):
    entries = _entries(spark, d).select("word", "source")
    new = table(spark, d, "part").where("p_size > 40").select(F.concat(F.lit("W"), "p_partkey").alias("word"), F.lit("rebuilt").alias("source"))
    return C.rebuild(entries, new)


def cited_titles(spark, d):
    """Citations with the title of their source, the last one of a source that is listed twice."""
    cites = table(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit("src"), (F.col("conv_id") % 30).cast("string")).alias("source"))
    listed = table(spark, d, "documents").select(F.col("source").alias("file"), F.concat("lang", F.lit("-"), "doc_id").alias("title"), F.col("doc_id").alias("ord"))
    return L.cited_sources(cites, listed).select("conv_id", "turn", "source", "title")


def pinned_cells(spark, d):
    """Cells whose word no entry holds, and whether their pinned line holds it."""
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("source"), F.col("turn").alias("line"), "text")
    cells = turns.select(F.lower(F.regexp_extract("text", LETTERS, 0)).alias("word"), "source", F.when(F.col("line") % 3 == 2, F.col("line") + 1).otherwise(F.col("line")).alias("line"))
    return L.correlatives_missing(cells, table(spark, d, "benchmark").select(F.lower(F.regexp_extract("text", LETTERS, 0)).alias("word")), turns).select("source", "line", "word", "checked")


def merged_derivatives(spark, d):
    """Derivatives that no entry holds, the first of each word unless it has no gloss."""
    key = F.col("p_partkey")
    rows = table(spark, d, "part").select(F.initcap(F.element_at(F.split("p_name", " "), 1)).alias("w"), F.element_at(F.split("p_name", " "), 2).alias("v"), F.when(key % 3 == 0, "").otherwise("g").alias("gloss_en"), F.when(key % 2 == 0, "*").otherwise((key % 9).cast("string")).alias("ofc"), key.alias("ord"))
    rows = rows.select(F.concat("w", "v").alias("word"), "gloss_en", "ofc", "ord")
    return L.merge_derivatives(rows.where("ord % 50 = 1").select(F.upper("word").alias("word")), rows).select("word", "source", "ord")


def pass_a_repairs(spark, d):
    key = F.col("p_partkey")
    first = table(spark, d, "part").select(F.when(key % 100 == 0, "M").when(key % 100 == 1, "L").when(key % 100 == 2, "dek").otherwise(F.concat(F.lit("w"), key)).alias("word"), F.lit("x").alias("en"), key.alias("ord"))
    second = spark.createDataFrame([("dek", "ten", 1), ("cent", "hundred", 2), ("mil", "THOUSAND", 3), ("ju", "1", 4), ("des", "the more", 5), ("ho", "oh", 6)], "word string, en string, ord long")
    return L.repair_pass(first, second).groupBy("word").agg(F.count("*").alias("n"), F.min("en").alias("en"))


def dictionary_lookup(spark, d):
    """The first entries that hold a part of a word, in one layer."""
    entries = table(spark, d, "part").select(F.col("p_name").alias("word"), F.col("p_type").alias("gloss_en"), F.col("p_brand").alias("source"), F.when(F.col("p_size") > 20, "noun").otherwise("adj").alias("pos"), F.col("p_partkey").alias("ord"))
    return O.dictionary_search(entries, "Ri", "noun", "Brand#1", 50).select("ord", "word", "source")


def acquisition_reasons(spark, d):
    """Documents as candidates for a collection that holds some of them."""
    key = F.col("doc_id")
    body = F.when(key % 3 != 2, F.concat(F.lit("*** START OF THE PROJECT GUTENBERG EBOOK\n"), "text", F.lit("\n*** END OF THE PROJECT GUTENBERG EBOOK"))).otherwise(F.col("text"))
    rows = table(spark, d, "documents").select(key.alias("doc_id"), F.concat("source", F.lit("-"), key % 60).alias("name"), F.when(key % 5 == 0, "Copyrighted").otherwise("Public Domain in the USA").alias("rights"), body.alias("text"))
    held = rows.where("doc_id % 10 = 1").select("name", "text")
    return O.acquisition_gate(rows, held).groupBy(F.coalesce("reason", F.lit("taken")).alias("reason")).agg(F.count("*").alias("n"))


def _listed(spark, d):
    from .structure import _catalog

    return _catalog(spark, d)


def catalog_views(spark, d):
    """Sizes of the catalogue as its reader filters it, and by a word."""
    rows = saved(_listed(spark, d).withColumn("file", F.col("file").cast("string")), "catalogue")
    views = [("all", ""), ("pool", ""), ("excluded", ""), ("quarantined", ""), ("pool", "SRC1")]
    out = [O.catalogue_filter(rows, v, n).agg(F.lit(f"{v} {n}").alias("view"), F.count("*").alias("n")) for v, n in views]
    for o in out[1:]:
        out[0] = out[0].unionByName(o)
    return out[0]


def manifest_sums(spark, d):
    key = F.col("doc_id")
    rows = table(spark, d, "documents").select("source", F.when(key % 4 == 0, "wsrc-fallback").otherwise("wp-clean").alias("method"), (F.col("n_chars") % 500).alias("in_lines"), (F.col("n_chars") % 100).alias("out_lines"), F.when(key % 6 == 0, "converted:120").otherwise("left:3").alias("xsystem"), F.when(key % 9 == 0, "converted").otherwise("-").alias("hsystem"), F.when(key % 20 == 7, "missing Gutenberg marker").alias("error"))
    return O.manifest_totals(rows).withColumn("fallback", F.size("fallback").cast("long"))


def bucket_totals(spark, d):
    found = C.bucket_counts(_buckets(spark, d))
    return found.select(F.coalesce("bucket", F.lit("all")).alias("bucket"), F.coalesce("kind", F.lit("all")).alias("kind"), "n")


def type_distribution(spark, d):
    return R.distribution(table(spark, d, "part"), "p_type")


def brand_options(spark, d):
    return R.options(table(spark, d, "part").withColumn("p_brand", F.when(F.col("p_size") > 10, F.col("p_brand"))), "p_brand")


def addition_sizes(spark, d):
    return R.addition_counts(table(spark, d, "part").select(F.concat(F.lit("ReVo/OA-"), F.col("p_size") % 12).alias("source")).unionByName(spark.createDataFrame([("ReVo/UV-*",), ("ReVo/OA-x",)], "source string")))


def site_counts(spark, d):
    return R.site_totals(_entries(spark, d).withColumn("citations", F.when(F.col("count") > 2, F.col("citations"))), table(spark, d, "supplier"))


def rejected_books(spark, d):
    books = table(spark, d, "documents").select(F.col("doc_id").alias("book"), F.col("n_chars").alias("good"), F.when(F.col("lang") != "en", F.col("lang")).alias("reason"))
    return R.near_misses(books).select("book", "good", "reason")


def missing_shard_numbers(spark, d):
    rows = table(spark, d, "nation").where("n_nationkey % 4 != 1").select(F.concat(F.lit("shard-"), "n_nationkey", F.lit("-of-25.jsonl")).alias("shard"))
    return R.missing_shards(rows, 25)


def unchanged_files(spark, d):
    from ..sources.sinks import unchanged

    new = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("file"), T.short_digest(F.col("text")).alias("sha256"))
    old = new.select("file", F.when(F.col("file").endswith("3"), "0").otherwise(F.col("sha256")).alias("sha256")).where("NOT file LIKE '%7'")
    return unchanged(new, old).select("file")


def clashing_records(spark, d):
    """Records of fifty words in all sources with verdicts and glosses that clash: what stands, and the clashes."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    lemma = F.concat(F.lit("w"), F.col("doc_id") % 50)
    first = docs.groupBy(lemma.alias("lemma"), F.col("source").alias("shard")).agg(F.count("*").alias("count"), F.min_by("quality", "doc_id").alias("q"), F.min_by("lang", "doc_id").alias("gloss"))
    none = F.lit(None).cast("string")
    rows = first.select("lemma", "shard", F.lit("unknown").alias("kind"), "count", F.col("count").alias("lower"), F.lit("noun").alias("pos_guess"), F.create_map("lemma", "count").alias("forms"), F.array("shard").alias("files"), F.expr("cast(array() as array<struct<source: string, line: bigint, text: string>>)").alias("citations"), F.when(F.col("q") == 1, "lemma").when(F.col("q") == 0, "foreign").alias("verdict"), "gloss", none.alias("note"))
    return N.reduce_records(saved(rows, "records"))


def first_verdicts(spark, d):
    found = clashing_records(spark, d)
    text = F.array_join(F.transform("conflicts", lambda c: F.concat_ws(":", c["shard"], c["field"], c["value"], c["kept"])), ",")
    return found.select("lemma", "count", "verdict", "gloss", text.alias("clashes"))


def clash_counts(spark, d):
    return R.conflict_split(clashing_records(spark, d))


def pending_lemmas(spark, d):
    """The hundred most frequent unreviewed records with their four commonest forms."""
    counts = _tokens(spark, d).groupBy("form").agg(F.count("*").alias("n"))
    forms = counts.select(T.citation_form(F.col("form")).alias("lemma"), "form", "n")
    # An aggregate: what depends on the lemma alone would be filtered, and the lemma made, token by token.
    verdict = F.max(F.when(F.length("lemma") < 3, "lemma")).alias("verdict")
    records = forms.groupBy("lemma").agg(F.sum("n").alias("count"), F.map_from_entries(F.collect_list(F.struct("form", "n"))).alias("forms"), verdict).select("lemma", "count", "forms", F.lit("unknown").alias("kind"), "verdict", F.array(F.struct(F.lit("s").alias("source"))).alias("citations"))
    return C.pending(records).select("lemma", "count", F.array_join("top_forms", ",").alias("top"))


def top_forms_per_class(spark, d):
    forms = _tokens(spark, d).groupBy("form").agg(F.count("*").alias("count")).select(F.col("form").alias("lemma"), "count", T.guess_pos(F.col("form")).alias("kind"))
    return C.top_per_kind(forms, 20).select("kind", F.col("rank").cast("long").alias("rank"), "lemma", "count")


def scored_messages(spark, d):
    """Turns as messages: their share of known tokens, and whether they are kept."""
    turns = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("msgid"), "text")
    known = table(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-zĉĝĥĵŝŭ]+"), F.lit(0))).alias("form")).groupBy("form").agg(F.count("*").alias("n")).where("n > 20")
    return O.message_score(turns, known, 0.7, 10).select("msgid", "tokens", F.round("score", 6).alias("score"), "kept")


def kept_messages_by_year(spark, d):
    dated = scored_messages(spark, d).withColumn("date", F.when(F.col("msgid") % 4 == 0, "").otherwise(F.concat(F.col("msgid") % 9 + 1990, F.lit("-01-02"))))
    return O.messages_by_year(dated)


def mined_lemmas(spark, d):
    """Records of all words of the documents by citation form, without an analysis: counts, forms, first places."""
    docs = table(spark, d, "documents").select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("source"), "text")
    tokens = N.token_rows(docs, by_line=True)
    cells, places = saved(N.counted(tokens), "token-counts"), saved(N.first_places(tokens, 3), "token-places")
    kinds = saved(N.refine_kind(cells.select("token", "form").distinct().withColumns({"lemma": F.col("form"), "kind": F.lit("unknown")})), "token-kinds")
    found = N.mine(cells, kinds, places, N.line_rows(docs))
    cites = F.array_join(F.transform("citations", lambda c: F.concat_ws(":", c["source"], c["line"].cast("string"))), ",")
    return found.select("lemma", "kind", "count", "lower", F.size("files").cast("long").alias("n_files"), F.size("forms").cast("long").alias("n_forms"), "pos_guess", cites.alias("cites"))


def _turns(spark, d):
    """Conversations as sources, their turns as documents."""
    return table(spark, d, "conversations").select(F.concat(F.lit("c"), F.lpad(F.col("conv_id").cast("string"), 9, "0")).alias("source"), F.col("turn").alias("doc_id"), "text")


def citations_of_turns(spark, d):
    """Up to four lines of every form of the conversations, in turn by conversation, ten of these held to be the encyclopedia."""
    rows = N.token_rows(_turns(spark, d), by_line=True, keep=("doc_id",)).groupBy("form", "source", "doc_id", "line").agg(F.count("*").alias("hits"))
    cites = rows.select("form", "source", "doc_id", "line", F.struct("doc_id", "line").alias("ord"))
    return N.round_robin(cites, "form", 4, F.col("source").rlike("[05]$")).select("form", F.col("turn").cast("long").alias("turn"), "source", "doc_id", F.col("line").cast("long").alias("line"))


def concordance_of_turns(spark, d):
    """All words of the benchmark through their forms in the conversations: counts, and up to three citations with their lines."""
    heads = _vocabulary(spark, d).withColumn("pos", T.guess_pos(F.col("form")))
    forms = heads.select(F.col("form").alias("word"), F.explode(F.array_distinct(T.inflected(F.col("form"), F.col("pos"), True))).alias("form"))
    turns = _turns(spark, d)
    found = N.concordance(N.token_rows(turns, by_line=True, keep=("doc_id",)), forms, N.line_rows(turns, keep=("doc_id",)))
    cites = F.array_join(F.transform("citations", lambda c: F.concat_ws("=", c["source"], T.short_digest(c["text"]))), ",")
    return found.select("word", "occurrences", "sources", F.coalesce(cites, F.lit("")).alias("cited"))


def ranked_roots(spark, d):
    """Roots that layers of parts cite, by the best layer's rank and by how many entries hold them."""
    key = F.col("p_partkey")
    source = F.element_at(F.array(F.lit("Fundamento/UV-1905"), F.lit("ReVo/UV-*"), F.lit("ReVo/OA-4"), F.lit("ReVo"), F.lit("corpus-mined")), (key % 5 + 1).cast("int"))
    entries = table(spark, d, "part").select("p_name", source.alias("source"), F.element_at(F.split("p_name", " "), 1).alias("root"), F.when(key % 2 == 0, F.element_at(F.split("p_name", " "), 2)).alias("stem"))
    return M.root_stock(entries)


def last_resort_roots(spark, d):
    """Unsplit stems of the benchmark's words as roots of last resort, where nothing else is a root."""
    entries = _vocabulary(spark, d).select(F.col("form").alias("word"), F.when(F.length("form") % 3 == 0, "ReVo").otherwise("corpus-mined").alias("source"), (F.length("form") % 2 == 0).alias("prefixes_empty"), F.lit(True).alias("suffixes_empty"))
    return M.mined_roots(entries, {"in": (0, 0), "the": (0, 0)})


def grammar_links(spark, d):
    """Rules of the grammar that words illustrate: forms of the benchmark and some words of every rule."""
    words = spark.createDataFrame(GRAMMAR, "word string, pos string, source string, affixes int, suffix string")
    forms = _vocabulary(spark, d).select(F.col("form").alias("word"), T.guess_pos(F.col("form")).alias("pos"), F.lit("corpus-mined").alias("source"), (F.length("form") % 2).cast("int").alias("affixes"), F.substring("form", -2, 2).alias("suffix"))
    refs = L.grammar_refs(F.col("word"), F.col("pos"), F.col("source"), F.col("affixes"), F.array("suffix"))
    return words.unionByName(forms).select("word", "pos", F.array_join(F.transform(refs, lambda r: r["section"]), ",").alias("sections"))


def layer_heads(spark, d):
    """Entries of a layer's heads of every kind."""
    rows = spark.createDataFrame(HEADS, "word string, fr string, en string, de string")
    found = L.fundamento_entries(rows, {"mal": "opposite"}, {"in": "female"})
    shape = F.concat_ws("+", F.transform("morphology.prefixes", lambda x: x["m"]), F.upper("morphology.stem"), F.transform("morphology.suffixes", lambda x: x["m"]), "morphology.ending")
    return found.select("word", "pos", "kind", F.coalesce("root", F.lit("")).alias("root"), "gloss_en", shape.alias("shape"))


def layer_precedence(spark, d):
    """Source of each word where every source is a layer, from the last name to the first: the first layer that has
    it, and its smallest document."""
    docs = _tokens(spark, d).groupBy(F.col("form").alias("word"), "source").agg(F.min("doc_id").alias("ord"))
    docs = saved(docs, "layers")
    names = sorted((r["source"] for r in docs.select("source").distinct().collect()), reverse=True)
    return L.first_by_precedence([docs.where(F.col("source") == s) for s in names]).select("word", "source", "ord")


def _decided(spark, d):
    return table(spark, d, "labels").select(F.concat(F.lit("w"), "doc_id").alias("lemma"), F.when(F.col("quality") == 1, "lemma").otherwise("foreign").alias("verdict"), F.lit(None).cast("string").alias("gloss"), F.lit("seen").alias("note"), F.col("doc_id").alias("ord"))


def _batch(spark, d):
    return table(spark, d, "documents").select(F.concat(F.lit("w"), "doc_id").alias("lemma"), F.lit("uncertain").alias("verdict"), F.col("lang").alias("gloss"), F.concat(F.lit("seen; "), "source").alias("note"), F.col("doc_id").alias("ord"))


def ledger_merge(spark, d):
    """A ledger of the labelled documents with a batch about all documents over it."""
    return C.upsert(_decided(spark, d), _batch(spark, d)).select("lemma", "verdict", "gloss", "note", "is_new")


def verdicts_without_lemma(spark, d):
    """Rows of the batch about all documents that the ledger doesn't hold."""
    return C.unmatched(_batch(spark, d), _decided(spark, d)).select("lemma", "gloss")


_NAMED = [
    minable_forms, parts_of_speech, numeral_forms, gloss_checks, epoch_checks, one_field_texts, x_system_texts, h_system_texts, fixed_sources, source_methods, following_months, root_classes, morpheme_glosses, book_bodies, preambles, review_rows,
    pairs_with_bases, link_counts, drifted_texts, decided_records, promotion_report, batch_entries, rederived_entries, resegmented_entries, recited_entries, refreshed_entries, rebuilt_entries, cited_titles, pinned_cells, merged_derivatives,
    pass_a_repairs, dictionary_lookup, acquisition_reasons, catalog_views, manifest_sums, bucket_totals, type_distribution, brand_options, addition_sizes, site_counts, rejected_books, missing_shard_numbers, unchanged_files, first_verdicts,
    last_resort_roots, grammar_links, clash_counts, pending_lemmas, top_forms_per_class, scored_messages, kept_messages_by_year, mined_lemmas, citations_of_turns, concordance_of_turns, ranked_roots, layer_heads, layer_precedence, ledger_merge, verdicts_without_lemma,
]
QUERIES = {f.__name__: f for f in _NAMED}

_FRONT = "|".join(DEFAULT.prefixes + DEFAULT.preposition_prefixes)
_BACK = "|".join(DEFAULT.suffixes + DEFAULT.participles)
_F = f"{SQL_TOKENS}, f AS (SELECT DISTINCT form FROM t)"
_LIST = lambda words: ", ".join("'" + w.replace("'", "''") + "'" for w in words)
_LETTERS = "abcĉdefgĝhĥijĵklmnoprsŝtuŭvz"
_NUM = "(" + "|".join(sorted(DEFAULT.numerals, key=lambda n: (-len(n), n))) + ")+"
_FOLD = [(p, q) for a, b in T.X_SYSTEM for p, q in ((a, b), (a.upper(), b.upper()), (a.capitalize(), b.upper()))]


def _replaced(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, '{a}', '{b}')"
    return x


_X_TEXT = "xt AS (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN repeat(' cxu Gxi SXI aux', 5) ELSE ' cxu' END AS t FROM documents), xf AS (SELECT doc_id, t, CASE WHEN len(regexp_extract_all(t, '(?i)[cghjsu]x')) >= 20 THEN " + _replaced("t", _FOLD) + " ELSE t END AS folded FROM xt)"
_BOOK = r"""bk AS (SELECT doc_id, doc_id % 5 <> 4 AS ok, doc_id % 2 = 0 AS note, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls, text FROM documents),
  bn AS (SELECT *, CAST(len(ls) AS BIGINT) AS n FROM bk)"""
_PRE = r"""pre AS (SELECT doc_id, doc_id % 3 = 0 AS marked, string_split(regexp_replace(CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'Komenco ' END || regexp_replace(text, '(?m)^(collection|book|[0-9]+)', 'x', 'g'), '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM documents)"""
_PAIRS = "turns AS (SELECT *, conv_id * 1000 + turn AS id FROM conversations), l AS (SELECT id AS a, id + 1 AS b FROM turns), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), p AS (SELECT x.id AS left_id, y.id AS right_id, x.turn AS lt, x.conv_id AS lc, y.turn AS rt, y.conv_id AS rc FROM e JOIN turns x ON x.id = a AND x.role = 'user' JOIN turns y ON y.id = b AND y.role = 'assistant')"
_BASES = "SELECT left_id, right_id, CASE WHEN lt % 3 = 0 THEN '0' ELSE CAST(lc AS VARCHAR) END AS left_base, CASE WHEN rt % 3 = 0 THEN '0' ELSE CAST(rc AS VARCHAR) END AS right_base FROM p"
_VERDICTS = f"{SQL_VOCAB}, led AS (SELECT form AS lemma, CASE WHEN length(form) % 4 = 0 THEN 'foreign' ELSE 'lemma' END AS verdict, CASE WHEN length(form) % 5 = 0 THEN '' ELSE 'g ' || form END AS gloss FROM vocab)"
_INF = "CASE " + " ".join(f"WHEN lemma LIKE '%{t}' AND length(lemma) > 3 THEN left(lemma, length(lemma) - 2) || 'i'" for t in ("as", "is", "os", "us")) + " ELSE lemma END"


def _class_of(word: str, gloss: str) -> str:
    """Part of speech of a dictionary word."""
    few = _LIST(PREPOSITIONS)
    return f"CASE WHEN contains(lower({gloss}), 'interjection') THEN 'interj' WHEN {word} LIKE '%o' THEN 'noun' WHEN {word} LIKE '%a' THEN 'adj' WHEN {word} LIKE '%e' THEN 'adv' WHEN {word} LIKE '%i' THEN 'verb' WHEN regexp_full_match({word}, '{_NUM}') THEN 'num' WHEN {word} IN ({few}) THEN 'prep' WHEN {word} LIKE '%aŭ' THEN 'adv' WHEN regexp_replace({word}, '''$', '') IN ({few}) THEN 'prep' ELSE 'none' END"


_ENTRIES = "e AS (SELECT p_partkey AS k, 'w' || p_partkey AS word, CASE WHEN p_partkey % 2 = 0 THEN 'corpus-mined' ELSE 'ReVo/OA-3' END AS source, p_partkey % 3 = 0 AS affix, p_partkey % 5 < 2 AS derived FROM part)"
_RECORDS = """fr AS (SELECT 'w' || d.doc_id % 50 AS lemma, source AS shard, count(*) AS n, arg_min(lang, d.doc_id) AS gloss, arg_min(CASE WHEN quality IS NULL THEN -1 ELSE quality END, d.doc_id) AS q FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY ALL),
  rec AS (SELECT lemma, shard, n, gloss, CASE q WHEN 1 THEN 'lemma' WHEN 0 THEN 'foreign' END AS verdict FROM fr),
  stands AS (SELECT lemma, CAST(sum(n) AS BIGINT) AS n, arg_min(verdict, shard) FILTER (WHERE verdict IS NOT NULL) AS v, arg_min(gloss, shard) AS g FROM rec GROUP BY lemma),
  cl AS (SELECT r.lemma, r.shard, 'verdict' AS field, r.verdict AS value, s.v AS kept FROM rec r JOIN stands s USING (lemma) WHERE r.verdict <> s.v UNION ALL SELECT r.lemma, r.shard, 'gloss', r.gloss, s.g FROM rec r JOIN stands s USING (lemma) WHERE r.gloss <> s.g)"""
_MESSAGES = """kn AS (SELECT form FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-zĉĝĥĵŝŭ]+')) AS form FROM documents) GROUP BY form HAVING count(*) > 20),
  mt AS (SELECT conv_id * 1000 + turn AS msgid, unnest(regexp_extract_all(lower(text), '[a-zĉĝĥĵŝŭ]+')) AS form FROM conversations),
  ms AS (SELECT msgid, count(*) AS tokens, count(*) FILTER (WHERE form IN (SELECT form FROM kn)) AS hits FROM mt GROUP BY msgid),
  sc AS (SELECT msgid, tokens, round(hits / tokens, 6) AS score, hits / tokens >= 0.7 AND tokens >= 10 AS kept FROM ms)"""
_TURN_TOKENS = rf"""tl0 AS (SELECT 'c' || lpad(CAST(conv_id AS VARCHAR), 9, '0') AS source, turn AS doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM conversations),
  tl AS (SELECT source, doc_id, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS txt FROM tl0), ta AS (SELECT *, regexp_extract_all(txt, '{LETTERS.replace("'", "''")}') AS a FROM tl), tt AS (SELECT source, doc_id, line, txt, unnest(range(0, len(a))) AS pos, unnest(a) AS token FROM ta)"""

ORACLE_SQL = {
    "minable_forms": f"WITH {_F} SELECT form, length(form) >= 2 AND form NOT IN ({_LIST(sorted(DEFAULT.stopwords))}) AND NOT regexp_full_match(form, '[ivxlcdm]+') AS minable, regexp_full_match(form, '[ivxlcdm]+') AS roman FROM f",
    "parts_of_speech": f"WITH {_F} SELECT form, CASE WHEN form LIKE 'h%' THEN 'interj' ELSE {_class_of('form', chr(39) + 'word' + chr(39))} END AS pos FROM f",
    "numeral_forms": f"WITH {_F}, w AS (SELECT form FROM f UNION SELECT * FROM (VALUES {', '.join(f'({_LIST([x])})' for x in NUMBERS)}) v(form)) SELECT form, regexp_full_match(form, '{_NUM}') AS numeral FROM w",
    "gloss_checks": rf"""WITH ln0 AS (SELECT string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM benchmark), ln AS (SELECT unnest(CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END) AS w FROM ln0),
      w AS (SELECT DISTINCT w FROM (SELECT unnest([p_name, p_type, lower(p_brand)]) AS w FROM part UNION ALL SELECT w FROM ln))
      SELECT w, length(w) BETWEEN 2 AND 120 AND regexp_full_match(lower(w), '[a-zàáâäèéêëìíîïòóôöùúûüçñßæœåøđł ''’()0-9,;:/.?‖\-―–—"!]+') AS sane, regexp_full_match(lower(w), '[{_LETTERS}]+( [{_LETTERS}]+)+') AS phrase,
      regexp_full_match(lower(w), '[{_LETTERS}]+') AND (regexp_matches(lower(w), '[oaei]$') OR lower(w) IN ({_LIST(sorted(DEFAULT.closed_class))})) AS headword FROM w""",
    "epoch_checks": """WITH v AS (SELECT event_id, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ms, event_type, user_id FROM events), x AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN ms WHEN 1 THEN '2' || substr(ms, 2, 12) WHEN 2 THEN ms || '5' WHEN 3 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS value FROM v)
      SELECT event_id, value, regexp_full_match(value, '1[0-9]{12}') OR coalesce(try_cast(value AS DOUBLE) BETWEEN 7e11 AND 2e12, false) AS is_time FROM x""",
    "one_field_texts": r"SELECT doc_id, left(sha256(trim(regexp_replace(text, '[\t\n\r]+', ' ', 'g'))), 12) AS digest FROM documents",
    "x_system_texts": f"WITH {_X_TEXT} SELECT doc_id, left(sha256(folded), 12) AS digest, folded <> t AS changed FROM xf",
    "h_system_texts": "SELECT * FROM (VALUES ('chu ghi shi laudis neuzebla', 'ĉu ĝi ŝi laŭdis neuzebla'), ('chu ĝi ĉu ŝi ĥo', 'chu ĝi ĉu ŝi ĥo'), ('plain words', 'plain words'), ('Chiu SHI jhus Europo reuzi', 'Ĉiu ŜI ĵus Eŭropo reuzi')) v(text, folded)",
    "fixed_sources": r"""WITH a AS (SELECT doc_id, source, text, CASE WHEN source = 'src1' THEN regexp_replace(text, '(?i)the', 'TEH', 'g') ELSE text END AS a FROM documents)
      SELECT doc_id, CASE source WHEN 'src1' THEN len(regexp_extract_all(text, '(?i)the')) + len(regexp_extract_all(a, '  +')) WHEN 'src5' THEN len(regexp_extract_all(text, 'und')) ELSE 0 END AS fixes,
      left(sha256(CASE source WHEN 'src1' THEN regexp_replace(a, '  +', ' ', 'g') WHEN 'src5' THEN replace(text, 'und', 'u.') ELSE text END), 12) AS digest FROM a""",
    "source_methods": "SELECT doc_id, ['pg-markers', 'wsdump-clean', 'wp-clean', 'wsrc', 'wsrc'][doc_id % 5 + 1] AS method, CAST([0, 1, 3, 1, 2][doc_id % 5 + 1] AS INT) AS priority, ['ReVo/UV-*', 'ReVo/OA-7', 'ReVo/OA-12', 'ReVo', 'ReVo'][doc_id % 5 + 1] AS tag FROM documents",
    "following_months": "SELECT DISTINCT strftime(ts, '%Y-%m') AS month, strftime(date_trunc('month', ts) + INTERVAL 1 MONTH, '%Y-%m') AS following FROM events",
    "root_classes": """WITH w AS (SELECT p_partkey AS k, string_split(p_name, ' ')[1] AS w1, string_split(p_name, ' ')[2] AS w2 FROM part),
      g AS (SELECT k, w1, CASE k % 7 WHEN 0 THEN 'to ' || w1 WHEN 1 THEN w1 || 'ful, x' WHEN 2 THEN '' ELSE w1 END AS en, CASE k % 3 WHEN 0 THEN w2 || 'er' WHEN 1 THEN w2 || 'ir' ELSE w2 END AS fr, CASE WHEN k % 2 = 0 THEN w2 || 'en' ELSE w2 || 'lich' END AS de FROM w),
      h AS (SELECT *, regexp_matches(string_split(en, ',')[1], '(ous|ful|ish|able|ible|y|al|ic|ive|ent)$') AS adj1, regexp_matches(string_split(en, ' ')[-1], '(ous|ful|ish|able|ible|y|al|ic|ive|ent)$') AS adj2, length(de) > 3 AND de LIKE '%en' AS dv, regexp_matches(fr, '(er|ir|oir)$') OR (fr LIKE '%re' AND length(fr) > 3) AS fv FROM g)
      SELECT k AS p_partkey, CASE WHEN k % 11 = 0 THEN 'adj' WHEN en LIKE 'to %' THEN 'verb' WHEN en <> '' AND adj1 THEN 'adj' WHEN regexp_matches(fr, '(eux|euse|ible|able)$') AND en <> '' AND adj2 THEN 'adj' WHEN fv AND dv THEN 'verb' WHEN regexp_matches(fr, '(oir|ir)$') AND length(fr) > 3 THEN 'verb' WHEN fr LIKE '%er' AND dv THEN 'verb' ELSE 'noun' END AS pos FROM h""",
    "morpheme_glosses": f"""WITH {_F}, c AS (SELECT form, unnest(range(0, CAST((length(form) + 1) // 2 AS BIGINT))) AS i FROM f), m AS (SELECT form, i, substr(form, 2 * i + 1, 2) AS m FROM c)
      SELECT form, string_agg(m || '=' || CASE m {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in AFFIXES.items())} ELSE '' END, ',' ORDER BY i) AS glosses FROM m GROUP BY form""",
    "book_bodies": f"WITH {_BOOK} SELECT doc_id, CASE WHEN ok THEN n + 5 + CASE WHEN note THEN 3 ELSE 0 END END AS body, CAST(CASE WHEN ok THEN 2 END AS BIGINT) AS head, CAST(CASE WHEN ok THEN 2 END AS BIGINT) AS tail, CAST(CASE WHEN ok THEN 4 + CASE WHEN note THEN 3 ELSE 0 END END AS BIGINT) AS front FROM bn",
    "preambles": rf"""WITH {_PRE} SELECT doc_id, CASE WHEN marked THEN 'wsrc-marker' ELSE 'wsrc-fallback' END AS method, CAST(CASE WHEN marked THEN 3 ELSE 5 END AS BIGINT) AS head FROM pre""",
    "review_rows": """WITH r AS (SELECT source AS file, CAST(doc_id AS INT) AS line, doc_id % 9 AS k, 'w' || doc_id % 40 AS w, doc_id % 40 >= 30 AS strange, lang, source || ':' || doc_id || ': ' AS here FROM documents WHERE doc_id % 9 > 1)
      SELECT file, line, CASE WHEN k = 5 THEN '' ELSE w END AS lemma, CASE k WHEN 3 THEN 'nonsense' WHEN 6 THEN 'foreign' ELSE 'lemma' END AS verdict, CASE WHEN k IN (2, 6) THEN '' WHEN k IN (7, 8) THEN lang ELSE 'g' END AS gloss, CASE WHEN k IN (4, 7, 8) THEN 'n' ELSE '' END AS note,
      CASE k WHEN 2 THEN here || 'a lemma needs a gloss' WHEN 3 THEN here || 'unknown verdict' WHEN 4 THEN here || '2 to 4 columns expected' WHEN 5 THEN here || 'no lemma' ELSE CASE WHEN strange THEN here || 'not a mined lemma' END END AS error FROM r""",
    "pairs_with_bases": f"WITH {_PAIRS} {_BASES}",
    "link_counts": f"WITH {_PAIRS}, b AS ({_BASES}) SELECT (SELECT count(*) FROM conversations) AS scanned, count(*) AS pairs, count(*) FILTER (WHERE left_base = '0') AS left_originals, count(*) FILTER (WHERE right_base = '0') AS right_originals FROM b",
    "drifted_texts": "SELECT doc_id AS id FROM documents WHERE doc_id % 7 = 0 AND upper(text) <> text UNION ALL SELECT -1",
    "decided_records": f"""WITH {SQL_TOKENS}, {_VERDICTS}, c AS (SELECT form, count(*) AS n FROM t GROUP BY form) SELECT form AS lemma, n AS "count", verdict, gloss, CASE WHEN led.lemma IS NOT NULL THEN 'n' END AS note FROM c LEFT JOIN led ON led.lemma = form""",
    "promotion_report": f"""WITH {_VERDICTS}, x AS (SELECT lemma, verdict, gloss, {_INF} AS word FROM led), y AS (SELECT *, {_class_of('word', 'gloss')} AS pos, word IN (SELECT lower(unnest(string_split(p_name, ' '))) FROM part) AS held FROM x),
      z AS (SELECT *, row_number() OVER (PARTITION BY word, verdict = 'lemma' AND gloss <> '' AND NOT held ORDER BY lemma) AS r FROM y)
      SELECT lemma, word, pos, CASE WHEN verdict <> 'lemma' THEN 'not a lemma' WHEN gloss = '' THEN 'no gloss' WHEN held THEN 'already held' WHEN r > 1 THEN 'duplicate citation form' WHEN pos = 'none' THEN 'part of speech unresolved' ELSE 'promoted' END AS disposition FROM z""",
    "batch_entries": f"WITH {_ENTRIES} SELECT word, source FROM e WHERE k % 7 IN (3, 5)",
    "rederived_entries": f"WITH {_ENTRIES} SELECT word, source = 'corpus-mined' AND affix <> derived AS rederived, CASE WHEN CASE WHEN source = 'corpus-mined' THEN affix ELSE derived END THEN true END AS derived FROM e",
    "resegmented_entries": f"WITH {_ENTRIES}, r AS (SELECT *, source = 'corpus-mined' AND affix AND k % 7 IN (3, 5) AS changed FROM e) SELECT word, changed AS resegmented, CAST(affix AND NOT changed AS BIGINT) AS n_prefixes FROM r",
    "recited_entries": """WITH e AS (SELECT p_partkey AS k, p_partkey % 4 + 1 AS n, p_partkey % 5 AS m FROM part), c AS (SELECT k, n, m, (n + 1) // 2 AS lit, least(m, 3) AS new FROM e)
      SELECT 'w' || k AS word, new > lit AS recited, CASE WHEN new > lit THEN array_to_string(['pg-' || i for i in range(1, new + 1)] || CASE WHEN m < 3 THEN ['wp-9'] ELSE [] END, ',') ELSE array_to_string([CASE WHEN i % 2 = 0 THEN 'wp-' ELSE 'ia-' END || i for i in range(1, n + 1)], ',') END AS sources FROM c""",
    "refreshed_entries": """SELECT 'w' || p_partkey AS word, p_size % 10 NOT IN (0, 4) AND p_size % 10 <> p_partkey % 10 AS changed, CASE WHEN p_size % 10 IN (0, 4) THEN p_partkey % 10 ELSE p_size % 10 END AS "count" FROM part""",
    "rebuilt_entries": "SELECT 'w' || p_partkey AS word, CASE WHEN p_partkey % 2 = 0 THEN 'corpus-mined' ELSE 'ReVo/OA-3' END AS source FROM part WHERE p_size <= 40 UNION ALL SELECT 'W' || p_partkey, 'rebuilt' FROM part WHERE p_size > 40",
    "cited_titles": "SELECT conv_id, turn, 'src' || conv_id % 30 AS source, title FROM conversations LEFT JOIN (SELECT source AS file, arg_max(lang || '-' || doc_id, doc_id) AS title FROM documents GROUP BY source) ON file = 'src' || conv_id % 30",
    "pinned_cells": f"""WITH c AS (SELECT conv_id AS source, CASE WHEN turn % 3 = 2 THEN turn + 1 ELSE turn END AS line, lower(regexp_extract(text, '{LETTERS.replace("'", "''")}')) AS word FROM conversations), h AS (SELECT lower(regexp_extract(text, '{LETTERS.replace("'", "''")}')) AS word FROM benchmark)
      SELECT c.source, c.line, word, coalesce(contains(lower(l.text), word), false) AS checked FROM c LEFT JOIN conversations l ON l.conv_id = c.source AND l.turn = c.line WHERE word NOT IN (SELECT word FROM h)""",
    "merged_derivatives": """WITH w AS (SELECT upper(left(string_split(p_name, ' ')[1], 1)) || substr(string_split(p_name, ' ')[1], 2) || string_split(p_name, ' ')[2] AS word, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'g' END AS gloss, CASE WHEN p_partkey % 2 = 0 THEN 'ReVo/UV-*' ELSE 'ReVo/OA-' || p_partkey % 9 END AS source, p_partkey AS ord FROM part),
      n AS (SELECT *, row_number() OVER (PARTITION BY lower(word) ORDER BY ord) AS r FROM w WHERE lower(word) NOT IN (SELECT lower(word) FROM w WHERE ord % 50 = 1)) SELECT word, source, ord FROM n WHERE r = 1 AND gloss <> ''""",
    "pass_a_repairs": """WITH a AS (SELECT CASE p_partkey % 100 WHEN 1 THEN 'la' WHEN 2 THEN 'dek' ELSE 'w' || p_partkey END AS word, 'x' AS en FROM part WHERE p_partkey % 100 <> 0), b AS (SELECT * FROM (VALUES ('dek', 'ten'), ('cent', 'hundred'), ('mil', 'THOUSAND'), ('des', 'the more')) v(word, en))
      SELECT word, count(*) AS n, min(en) AS en FROM (SELECT * FROM a UNION ALL SELECT * FROM b WHERE word NOT IN (SELECT word FROM a)) GROUP BY word""",
    "dictionary_lookup": "SELECT p_partkey AS ord, p_name AS word, p_brand AS source FROM part WHERE (contains(lower(p_name), 'ri') OR contains(lower(p_type), 'ri')) AND p_size > 20 AND p_brand LIKE 'Brand#1%' ORDER BY p_partkey LIMIT 50",
    "acquisition_reasons": """WITH c AS (SELECT doc_id, source || '-' || doc_id % 60 AS name, doc_id % 5 <> 0 AS free, doc_id % 3 <> 2 AS marked, sha256(CASE WHEN doc_id % 3 <> 2 THEN '*** START OF THE PROJECT GUTENBERG EBOOK' || chr(10) || text || chr(10) || '*** END OF THE PROJECT GUTENBERG EBOOK' ELSE text END) AS sha FROM documents), h AS (SELECT * FROM c WHERE doc_id % 10 = 1)
      SELECT CASE WHEN name IN (SELECT name FROM h) THEN 'already held' WHEN NOT free THEN 'rights' WHEN sha IN (SELECT sha FROM h) THEN 'exact copy' WHEN NOT marked THEN 'markers missing' ELSE 'taken' END AS reason, count(*) AS n FROM c GROUP BY 1""",
    "catalog_views": """WITH c AS (SELECT doc_id, source, lang, (lang = 'en' AND n_chars > 3000) OR lang = 'fr' OR source = 'src3' AS x, n_chars < 100 AS q FROM documents)
      SELECT 'all ' AS view, count(*) AS n FROM c UNION ALL SELECT 'pool ', count(*) FROM c WHERE NOT x AND NOT q UNION ALL SELECT 'excluded ', count(*) FROM c WHERE x OR q UNION ALL SELECT 'quarantined ', count(*) FROM c WHERE q UNION ALL SELECT 'pool SRC1', count(*) FROM c WHERE NOT x AND NOT q AND contains(doc_id || ' ' || source || ' ' || lang, 'src1')""",
    "manifest_sums": "SELECT count(*) FILTER (WHERE doc_id % 20 <> 7) AS normalized, count(*) AS sources, CAST(sum(n_chars % 100) AS BIGINT) AS kept, CAST(sum(n_chars % 500) - sum(n_chars % 100) AS BIGINT) AS dropped, count(*) FILTER (WHERE doc_id % 6 = 0) AS x_converted, count(*) FILTER (WHERE doc_id % 9 = 0) AS h_converted, count(*) FILTER (WHERE doc_id % 4 = 0) AS fallback FROM documents",
    "bucket_totals": f"{_BUCKETS} SELECT coalesce(bucket, 'all') AS bucket, coalesce(kind, 'all') AS kind, count(*) AS n FROM k GROUP BY ROLLUP (bucket, kind)",
    "type_distribution": "SELECT p_type, count(*) AS n FROM part GROUP BY p_type",
    "brand_options": "SELECT DISTINCT p_brand FROM part WHERE p_size > 10",
    "addition_sizes": "SELECT CAST(p_size % 12 AS INT) AS addition, count(*) AS n FROM part GROUP BY 1",
    "site_counts": "SELECT count(*) AS entries, count(*) FILTER (WHERE p_partkey % 10 > 2) AS cited, (SELECT count(*) FROM supplier) AS sources FROM part",
    "rejected_books": "SELECT doc_id AS book, n_chars AS good, lang AS reason FROM documents WHERE lang <> 'en' ORDER BY n_chars DESC, doc_id LIMIT 40",
    "missing_shard_numbers": "SELECT CAST(n_nationkey AS BIGINT) AS i FROM nation WHERE n_nationkey % 4 = 1",
    "unchanged_files": "SELECT CAST(doc_id AS VARCHAR) AS file FROM documents WHERE doc_id % 10 IN (3, 7)",
    "first_verdicts": f"""WITH {_RECORDS} SELECT s.lemma, s.n AS "count", s.v AS verdict, s.g AS gloss, coalesce(string_agg(concat_ws(':', shard, field, value, kept), ',' ORDER BY shard, field DESC), '') AS clashes FROM stands s LEFT JOIN cl USING (lemma) GROUP BY ALL""",
    "clash_counts": f"WITH {_RECORDS}, k AS (SELECT lemma, bool_or(field = 'verdict') AS v, bool_or(field = 'gloss') AS g FROM cl GROUP BY lemma) SELECT count(*) FILTER (WHERE v) AS verdicts, count(*) FILTER (WHERE g AND NOT v) AS glosses_only FROM k",
    "pending_lemmas": f"""WITH {SQL_TOKENS}, f AS (SELECT form, count(*) AS n FROM t GROUP BY form), c AS (SELECT {SQL_CITE} AS lemma, form, n FROM f), r AS (SELECT *, row_number() OVER (PARTITION BY lemma ORDER BY n DESC, form) AS r, sum(n) OVER (PARTITION BY lemma) AS total FROM c WHERE length(lemma) >= 3)
      SELECT lemma, CAST(total AS BIGINT) AS "count", string_agg(form, ',' ORDER BY r) FILTER (WHERE r <= 4) AS top FROM r GROUP BY lemma, total ORDER BY total DESC, lemma LIMIT 100""",
    "top_forms_per_class": f"""WITH {SQL_TOKENS}, f AS (SELECT form, count(*) AS n FROM t GROUP BY form), r AS (SELECT {SQL_POS} AS kind, form, n, row_number() OVER (PARTITION BY {SQL_POS} ORDER BY n DESC, form) AS rank FROM f) SELECT kind, rank, form AS lemma, n AS "count" FROM r WHERE rank <= 20""",
    "scored_messages": f"WITH {_MESSAGES} SELECT * FROM sc",
    "kept_messages_by_year": f"WITH {_MESSAGES} SELECT CAST(msgid % 9 + 1990 AS VARCHAR) AS year, count(*) AS n FROM sc WHERE kept AND msgid % 4 <> 0 GROUP BY 1",
    "mined_lemmas": f"""WITH {SQL_LINES}, lt0 AS (SELECT doc_id, line, regexp_extract_all(txt, '{LETTERS.replace("'", "''")}') AS a FROM lines), lt AS (SELECT doc_id, line, unnest(range(0, len(a))) AS pos, unnest(a) AS token FROM lt0),
      x AS (SELECT *, lower(token) AS form, substr(token, 1, 1) <> lower(substr(token, 1, 1)) AS cap FROM lt), g AS (SELECT * FROM x WHERE length(form) >= 2 AND form NOT IN ({_LIST(sorted(DEFAULT.stopwords))}) AND NOT regexp_full_match(form, '[ivxlcdm]+')),
      l AS (SELECT *, CASE WHEN cap THEN form ELSE {SQL_CITE} END AS lemma, {SQL_POS} AS p FROM g), r AS (SELECT *, row_number() OVER (PARTITION BY lemma ORDER BY doc_id, line, pos) AS r FROM l)
      SELECT lemma, CASE WHEN count(*) FILTER (WHERE NOT cap) = 0 THEN 'name' ELSE 'unknown' END AS kind, count(*) AS "count", count(*) FILTER (WHERE NOT cap) AS "lower", count(DISTINCT doc_id) AS n_files, count(DISTINCT form) AS n_forms, arg_min(p, r) AS pos_guess,
      string_agg('d' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || ':' || line, ',' ORDER BY r) FILTER (WHERE r <= 3) AS cites FROM r GROUP BY lemma""",
    "citations_of_turns": f"""WITH {_TURN_TOKENS}, h AS (SELECT DISTINCT lower(token) AS form, source, doc_id, line FROM tt), a AS (SELECT *, row_number() OVER (PARTITION BY form, source ORDER BY doc_id, line) AS again, min(doc_id * 1000000 + line) OVER (PARTITION BY form, source) AS opened FROM h)
      SELECT form, turn, source, doc_id, line FROM (SELECT *, row_number() OVER (PARTITION BY form ORDER BY again, regexp_matches(source, '[05]$'), opened, source) AS turn FROM a) WHERE turn <= 4""",
    "concordance_of_turns": f"""WITH {_TURN_TOKENS}, {SQL_VOCAB}, hd AS (SELECT form AS word, {SQL_POS} AS pos FROM vocab),
      fx AS (SELECT DISTINCT word, unnest(CASE WHEN pos IN ('noun', 'adj') THEN [word, word || 'j', word || 'n', word || 'jn'] WHEN pos = 'adv' THEN [word, word || 'n'] WHEN pos = 'verb' THEN [left(word, length(word) - 1) || x for x in ['i', 'as', 'is', 'os', 'us', 'u', 'ante', 'inte', 'onte', 'ata', 'ita', 'ota', 'anta', 'inta', 'onta']] ELSE [word] END) AS form FROM hd),
      ht AS (SELECT word, source, doc_id, line, pos, trim(txt) AS txt FROM tt JOIN fx ON lower(token) = fx.form), ct AS (SELECT word, count(*) AS occurrences, count(DISTINCT source) AS sources FROM ht GROUP BY word),
      fi AS (SELECT *, row_number() OVER (PARTITION BY word, source ORDER BY line, pos, doc_id) AS r FROM ht WHERE length(txt) BETWEEN 35 AND 180), rk AS (SELECT word, source, txt, row_number() OVER (PARTITION BY word ORDER BY source) AS r FROM fi WHERE r = 1)
      SELECT ct.word, occurrences, sources, coalesce(string_agg(source || '=' || left(sha256(txt), 12), ',' ORDER BY r) FILTER (WHERE r <= 3), '') AS cited FROM ct LEFT JOIN rk USING (word) GROUP BY ALL""",
    "ranked_roots": f"""WITH e AS (SELECT p_partkey % 5 AS k, string_split(p_name, ' ')[1] AS root, CASE WHEN p_partkey % 2 = 0 THEN string_split(p_name, ' ')[2] END AS stem FROM part WHERE p_partkey % 5 < 4),
      c AS (SELECT k AS rank, root FROM e UNION ALL SELECT 0, stem FROM e WHERE k = 0 AND stem IS NOT NULL), pr AS (SELECT root, count(*) AS n FROM (SELECT root FROM e UNION ALL SELECT stem FROM e WHERE stem IS NOT NULL AND stem <> root) GROUP BY root),
      pt AS (SELECT unnest([{_LIST(sorted(w for w in DEFAULT.closed_class - DEFAULT.non_deriving if len(w) >= 3))}]) AS root), ba AS (SELECT unnest([{_LIST(sorted(DEFAULT.non_deriving | {w for w in DEFAULT.closed_class if len(w) < 3}))}]) AS root),
      s AS (SELECT root, min(rank) AS rank FROM (SELECT root, rank FROM c WHERE length(root) >= 2 AND root NOT IN (SELECT root FROM ba) UNION ALL SELECT root, 0 FROM pt) GROUP BY root) SELECT root, CAST(rank AS INT) AS rank, CAST(-coalesce(n, 0) AS INT) AS neg_prod FROM s LEFT JOIN pr USING (root)""",
    "last_resort_roots": f"WITH {SQL_VOCAB} SELECT DISTINCT left(form, length(form) - 1) AS root, 4 AS rank, 0 AS neg_prod FROM vocab WHERE length(form) % 3 <> 0 AND length(form) % 2 = 0 AND regexp_matches(form, '[oaei]$') AND length(form) >= 4 AND left(form, length(form) - 1) NOT IN ('in', 'the') AND NOT regexp_full_match(left(form, length(form) - 1), '({_FRONT}){{0,3}}(in|the)({_BACK}){{0,3}}')",
    "grammar_links": f"""WITH {SQL_VOCAB}, w AS (SELECT * FROM (VALUES {', '.join(f"('{w}', '{p}', '{s}', {n}, '{x}')" for w, p, s, n, x in GRAMMAR)}) v(word, pos, source, affixes, suffix) UNION ALL SELECT form, {SQL_POS}, 'corpus-mined', length(form) % 2, right(form, 2) FROM vocab),
      g AS (SELECT *, regexp_full_match(word, '(neni|ki|ti|ĉi|i)(o|u|a|es|e|am|al|el|om)') AND pos IN ('pron', 'adv', 'adj', 'particle', 'noun') AS grid, source = 'corpus-mined' AND affixes > 0 AS mined FROM w)
      SELECT word, pos, concat_ws(',', CASE WHEN pos IN ('prefix', 'suffix') THEN '2' END, CASE WHEN grid THEN '3' END, CASE WHEN grid AND word LIKE 'neni%' THEN '6.2' END, CASE WHEN pos = 'suffix' AND word IN ('ant', 'int', 'ont', 'at', 'it', 'ot') THEN '2' END, CASE WHEN pos = 'suffix' AND word IN ('at', 'it') THEN '6.6' END,
        CASE WHEN word = 'ujo' OR (pos = 'suffix' AND word = 'uj') THEN '6.1' END, CASE WHEN word = 'ĉi' AND pos IN ('particle', 'adv') THEN '6.4' END, CASE WHEN word = 'po' AND pos = 'prep' THEN '6.11' END, CASE WHEN word = 'je' AND pos = 'prep' THEN '6.13' END, CASE WHEN mined THEN '2' END, CASE WHEN mined AND suffix IN ('ant', 'int', 'ont', 'at', 'it', 'ot') THEN '2' END) AS sections FROM g""",
    "layer_heads": """SELECT * FROM (VALUES ('kaj', 'conj', 'bare', '', 'and', ''), ('mal', 'prefix', 'affix', 'mal', 'opposite', ''), ('in', 'suffix', 'affix', 'in', 'female', ''), ('dek', 'num', 'numeral', '', 'ten', ''), ('ami', 'verb', 'root', 'am', 'to love', 'AM+i'),
      ('patro', 'noun', 'root', 'patr', 'father', 'PATR+o'), ('patrino', 'noun', 'root', 'patrin', 'mother', 'PATR+in+o'), ('malami', 'verb', 'root', 'malam', 'to hate', 'mal+AM+i'), ('bona', 'adj', 'root', 'bon', 'good', 'BON+a'), ('la', 'art', 'bare', '', 'the', '')) v(word, pos, kind, root, gloss_en, shape)""",
    "layer_precedence": f"WITH {SQL_TOKENS}, g AS (SELECT form AS word, source, min(doc_id) AS ord FROM t GROUP BY ALL) SELECT word, source, ord FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY source DESC) AS r FROM g) WHERE r = 1",
    "ledger_merge": "SELECT coalesce('w' || d.doc_id, 'w' || l.doc_id) AS lemma, CASE WHEN d.doc_id IS NOT NULL THEN 'uncertain' WHEN quality = 1 THEN 'lemma' ELSE 'foreign' END AS verdict, lang AS gloss, CASE WHEN d.doc_id IS NOT NULL THEN 'seen; ' || source ELSE 'seen' END AS note, l.doc_id IS NULL AS is_new FROM documents d FULL JOIN labels l ON l.doc_id = d.doc_id",
    "verdicts_without_lemma": "SELECT 'w' || doc_id AS lemma, lang AS gloss FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
}

