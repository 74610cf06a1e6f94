"""Scalar text operators as column expressions, all inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .model import ALPHABET, COLLATION_KEY, DEFAULT, LanguageModel

# Spellings with a digraph for a letter with a diacritic.
X_SYSTEM = (("cx", "ĉ"), ("gx", "ĝ"), ("hx", "ĥ"), ("jx", "ĵ"), ("sx", "ŝ"), ("ux", "ŭ"))
H_SYSTEM = (("ch", "ĉ"), ("gh", "ĝ"), ("hh", "ĥ"), ("jh", "ĵ"), ("sh", "ŝ"))
U_COMPOUNDS = ("neuzebl", "neuzat", "neutil", "neuzind", "treuz", "reuz")
DIACRITICS = "[ĉĝĥĵŝŭĈĜĤĴŜŬ]"
LETTERS = "a-zA-Z0-9_ĉĝĥĵŝŭĈĜĤĴŜŬà-öø-ÿÀ-ÖØ-Þ"


def tokens(text: Column, model: LanguageModel = DEFAULT) -> Column:
    """Letters and apostrophes in a row."""
    return F.regexp_extract_all(text, F.lit(model.token_pattern), F.lit(0))


def lines(text: Column) -> Column:
    """Lines at any newline, without the empty one behind a final newline."""
    parts = F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


def is_roman(form: Column) -> Column:
    return form.rlike("^[ivxlcdm]+$")


def minable(form: Column, model: LanguageModel = DEFAULT) -> Column:
    """Long enough, no stop word, no Roman numeral."""
    return (F.length(form) >= 2) & ~form.isin(*sorted(model.stopwords)) & ~is_roman(form)


def strip_ending(word: Column, model: LanguageModel = DEFAULT) -> Column:
    """The stem without the first ending of the list that leaves two letters."""
    low = F.lower(word)
    steps = reduce(lambda c, e: c.when(low.endswith(e) & (F.length(low) > len(e) + 1), F.substring(low, F.lit(1), F.length(low) - len(e))), model.endings, F.when(F.lit(False), F.lit("")))
    return steps.otherwise(low)


def _tail(low: Column, ending: str, put: str, longer: int | None = None) -> tuple[Column, Column]:
    fits = low.endswith(ending) & (F.length(low) > (len(ending) + 1 if longer is None else longer))
    return fits, F.concat(F.substring(low, F.lit(1), F.length(low) - len(ending)), F.lit(put))


def citation_form(token: Column) -> Column:
    """The form a token is filed under: infinitive, or singular without accusative. Spark evaluates the trimmed word anew
    in every branch, so there are few of them and no pattern."""
    raw = F.lower(token)
    low = F.btrim(raw, F.lit("'"))
    cut = lambda x, n: F.substring(x, F.lit(1), F.length(x) - n)
    ends = lambda n, *endings: F.right(low, F.lit(n)).isin(*endings)
    plural = ends(3, "ojn", "ajn") & (F.length(low) > 4)
    single = ends(2, "oj", "aj", "on", "an", "en", "un") & (F.length(low) > 2)
    cited = F.when(raw.endswith("'"), F.concat(cut(raw, 1), F.lit("o"))).when(*_tail(low, "u", "i", 3)).when(ends(2, "as", "is", "os", "us") & (F.length(low) > 3), F.concat(cut(low, 2), F.lit("i")))
    return cited.when(plural, cut(low, 2)).when(single, cut(low, 1)).otherwise(low)


def infinitive(word: Column) -> Column:
    """Finite verbs as infinitives, all else as it is."""
    low = F.lower(word)
    return reduce(lambda c, t: c.when(*_tail(low, t, "i")), ("is", "os", "us"), F.when(*_tail(low, "as", "i"))).otherwise(low)


def guess_pos(token: Column) -> Column:
    low = F.lower(token)
    return F.when(low.rlike("(oj|ojn|on)$"), "noun").when(low.rlike("(aj|ajn|an)$"), "adj").when(low.rlike("[aiou]s$"), "verb").when(low.rlike("[aio]nta$"), "participle").when(low.endswith("o"), "noun").when(low.endswith("a"), "adj").when(low.endswith("e"), "adv").when(low.endswith("i"), "verb").otherwise("unknown")


def part_of_speech(word: Column, gloss: Column, model: LanguageModel = DEFAULT, prepositions: tuple[str, ...] = ()) -> Column:
    """Of a dictionary word: interjection by its gloss, then the last letter, numerals, prepositions, -aŭ adverbs."""
    low = F.lower(word)
    numeral = low.rlike("^(" + "|".join(sorted(model.numerals, key=lambda n: (-len(n), n))) + ")+$")
    return F.when(F.lower(gloss).contains("interjection"), "interj").when(low.endswith("o"), "noun").when(low.endswith("a"), "adj").when(low.endswith("e"), "adv").when(low.endswith("i"), "verb").when(numeral, "num").when(low.isin(*prepositions) if prepositions else F.lit(False), "prep").when(low.endswith("aŭ"), "adv").when(F.regexp_replace(low, "'$", "").isin(*prepositions) if prepositions else F.lit(False), "prep")


def inflected(word: Column, pos: Column, participles: bool = False) -> Column:
    """All forms a headword is counted under; with ``participles`` a verb's nine participles too."""
    low = F.lower(word)
    stem = F.substring(low, F.lit(1), F.length(low) - 1)
    of = lambda *ends: [F.concat(stem, F.lit(e)) for e in ends]
    extra = ["ante", "inte", "onte", "ata", "ita", "ota", "anta", "inta", "onta"] if participles else []
    return F.when((pos == "noun") | (pos == "adj"), F.array(low, *(F.concat(low, F.lit(x)) for x in ("j", "n", "jn")))).when(pos == "adv", F.array(low, F.concat(low, F.lit("n")))).when(pos == "verb", F.array(*of("i", "as", "is", "os", "us", "u", *extra))).otherwise(F.array(low))


def count_pattern(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def fold_digraphs(text: Column, pairs: tuple = X_SYSTEM) -> Column:
    """Digraphs to letters, in lower, upper and title case."""
    for pair, letter in pairs:
        for a, b in ((pair, letter), (pair.upper(), letter.upper()), (pair.capitalize(), letter.upper())):
            text = F.replace(text, F.lit(a), F.lit(b))
    return text


def x_system(text: Column, least: int = 100) -> Column:
    """The x-system undone where its digraphs are frequent enough to be no foreign words."""
    hits = count_pattern(text, "(?i)[cghjsu]x")
    return F.when(hits >= least, fold_digraphs(text)).otherwise(text)


def h_system(text: Column, least: int = 100, share: float = 0.05) -> Column:
    """The h-system undone in texts with many words that have its digraphs and next to no diacritics."""
    hits = sum((count_pattern(text, f"(?iu)[{LETTERS}]*{a}[{LETTERS}]*") for a, _ in H_SYSTEM), F.lit(0))
    folded = fold_digraphs(text, H_SYSTEM)
    for i, word in enumerate(U_COMPOUNDS):
        folded = F.regexp_replace(folded, rf"(?iu)(?<![{LETTERS}]){word}", f"\x01{i}\x01")
    for a, b in (("au", "aŭ"), ("AU", "AŬ"), ("Au", "Aŭ"), ("eu", "eŭ"), ("EU", "EŬ"), ("Eu", "Eŭ")):
        folded = F.replace(folded, F.lit(a), F.lit(b))
    for i, word in enumerate(U_COMPOUNDS):
        folded = F.replace(folded, F.lit(f"\x01{i}\x01"), F.lit(word))
    return F.when((hits >= least) & (count_pattern(text, DIACRITICS) < hits * share), folded).otherwise(text)


def message_fold(text: Column, least: int = 3, share: float = 0.02) -> Column:
    """The x-system undone at the scale of one message."""
    hits = count_pattern(text, "(?i)[cghjsu]x")
    return F.when((hits >= least) & (count_pattern(text, DIACRITICS) <= hits * share), fold_digraphs(text)).otherwise(text)


def strip_tags(html: Column) -> Column:
    """Tags to blanks, white space to single blanks; scripts and styles go with their content."""
    bare = F.regexp_replace(F.regexp_replace(html, "(?is)<script[^>]*>.*?</script>", " "), "(?is)<style[^>]*>.*?</style>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "<[^>]+>", " "), r"\s+", " "))


def one_field(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[\t\n\r]+", " "))


def snippet(line: Column, token: Column, most: int = 160, before: int = 70, width: int = 150) -> Column:
    """A line on one row; a long one cut around the token."""
    flat = F.trim(F.regexp_replace(line, r"\s+", " "))
    at = F.greatest(F.lit(0), F.position(token, flat) - 1 - before)
    cut = F.concat(F.when(at > 0, "…").otherwise(""), F.substring(flat, at + 1, F.lit(width)), F.lit("…"))
    return F.when(F.length(flat) > most, cut).otherwise(flat)


def short_digest(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 12)


def slug(title: Column) -> Column:
    """Runs of what is no letter or digit to single underscores, none at the edges."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(title, r"(?i)\.djvu$", ""), r"(?U)[^\w]+", "_"), "^_+|_+$", "")


def file_name(title: Column, prefix: str = "wp-") -> Column:
    return F.concat(F.lit(prefix), F.translate(title, "/ ", "__"), F.lit(".txt"))


def distinct_notes(notes: Column) -> Column:
    return F.array_join(F.filter(F.array_distinct(F.split(notes, "; ")), lambda x: x != ""), "; ")


def latest_year(text: Column) -> Column:
    return F.array_max(F.transform(F.regexp_extract_all(text, F.lit("1[6-9][0-9][0-9]"), F.lit(0)), lambda y: y.cast("int")))


def next_month(month: Column) -> Column:
    """The month behind a YYYY-MM."""
    return F.date_format(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), 1), "yyyy-MM")


def page_key(title: Column) -> Column:
    """Pages by the number behind the last slash, those without one last and by text."""
    tail = F.element_at(F.split(title, "/"), -1)
    return F.struct((~tail.rlike("^[0-9]+$")).alias("is_text"), F.when(tail.rlike("^[0-9]+$"), tail.cast("long")).otherwise(0).alias("number"), tail.alias("tail"))


def collation_key(word: Column, alphabet: str = ALPHABET) -> Column:
    """Sorts words by the alphabet, unknown characters behind all letters."""
    low = F.lower(word)
    return F.translate(F.regexp_replace(low, f"[^{alphabet}]", "~"), alphabet, COLLATION_KEY)


def source_priority(source: Column) -> Column:
    return F.when(source.startswith("pg-"), 0).when(source.rlike("^(wsdump|wsrc)-"), 1).when(source.startswith("wp-"), 3).otherwise(2)


def is_encyclopedia(source: Column, prefix: str = "wp-") -> Column:
    return source.startswith(prefix)


def sane_gloss(gloss: Column) -> Column:
    """2 to 120 lower-case letters, digits and punctuation, as lower-cased dictionary glosses have."""
    return F.length(gloss).between(2, 120) & gloss.rlike("^[a-zàáâäèéêëìíîïòóôöùúûüçñßæœåøđł '’()0-9,;:/.?‖\\-―–—\"!]+$")


def headword(word: Column, model: LanguageModel = DEFAULT) -> Column:
    low = F.lower(word)
    return low.rlike(f"^[{model.alphabet}]+$") & (low.rlike("[oaei]$") | low.isin(*sorted(model.closed_class)))


def phrase(word: Column, model: LanguageModel = DEFAULT) -> Column:
    return F.lower(word).rlike(f"^[{model.alphabet}]+( [{model.alphabet}]+)+$")


def in_english(form: Column, english: Column) -> Column:
    """In a set of words, or a plural or past form of one. ``english``: an array column."""
    bare = F.regexp_replace(form, "^['’]+|['’]+$", "")
    without = lambda n: F.substring(bare, F.lit(1), F.length(bare) - n)
    return F.array_contains(english, bare) | (bare.endswith("s") & F.array_contains(english, without(1))) | (bare.endswith("ed") & F.array_contains(english, without(2)))


def epoch_like(value: Column) -> Column:
    """A time in milliseconds: 13 digits from 1, or a number between 1992 and 2033."""
    return value.rlike("^1[0-9]{12}$") | F.coalesce(value.try_cast("double").between(7e11, 2e12), F.lit(False))
