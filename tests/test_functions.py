"""Golden cases of scalar functions and morphology."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from lexloom.functions import morphology as M
from lexloom.functions import text as T
from lexloom.functions.model import DEFAULT


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("form, lemma", [("hord'", "hordo"), ("eliru", "eliri"), ("envenis", "enveni"), ("envenas", "enveni"), ("malsupren", "malsupre"), ("Martin", "martin"), ("Komintern", "komintern"), ("kongresojn", "kongreso"), ("kongresoj", "kongreso"), ("kongreson", "kongreso"), ("plu", "plu"), ("minus", "mini")])
def test_citation_form(spark, form, lemma):
    assert one(spark, T.citation_form(F.col("w")), w=form) == lemma


def test_citation_form_of_all_short_words(spark):
    """Against the rules one after another, in plain Python."""
    import itertools

    def plain(raw):
        low = raw.strip("'")
        if raw.endswith("'"):
            return raw[:-1] + "o"
        rules = [("u", 3, 1, "i"), *((t, 3, 2, "i") for t in ("as", "is", "os", "us")), ("ojn", 4, 3, "o"), ("ajn", 4, 3, "a"), *((e, 3, 2, e[0]) for e in ("oj", "aj", "on", "an", "en")), *((e, 2, 1, "") for e in ("oj", "aj", "on", "an", "en", "un"))]
        return next((low[:-cut] + put for end, longer, cut, put in rules if low.endswith(end) and len(low) > longer), low)

    words = ["".join(x) for n in range(5) for x in itertools.product("aoeiujns'", repeat=n)] + ["ĉojn", "ĉĉojn", "ŭas", "𝒳on", "𝒳u", "𝒳𝒳u"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", T.citation_form(F.col("w")).alias("x")).collect()
    assert [r for r in rows if r["x"] != plain(r["w"])] == []


@pytest.mark.parametrize("word, stem", [("vortojn", "vort"), ("estas", "est"), ("granda", "grand"), ("reĝino", "reĝin")])
def test_strip_ending(spark, word, stem):
    assert one(spark, T.strip_ending(F.col("w")), w=word) == stem


@pytest.mark.parametrize("word, pos", [("amanta", "participle"), ("rapide", "adv"), ("iru", "unknown")])
def test_guess_pos(spark, word, pos):
    assert one(spark, T.guess_pos(F.col("w")), w=word) == pos


def test_folding(spark):
    f = T.message_fold(F.col("t"))
    assert one(spark, f, t="cxu gxi sxi") == "ĉu ĝi ŝi"
    assert one(spark, f, t="cxu ĝi") == "cxu ĝi"
    assert one(spark, f, t="cxu gxi sxi ĉ") == "cxu gxi sxi ĉ"
    long = "chu ghi shi laudis neuzebla " * 60
    assert one(spark, T.h_system(F.col("t")), t=long).startswith("ĉu ĝi ŝi laŭdis neuzebla")


def test_small_functions(spark):
    assert one(spark, T.slug(F.col("t")), t="Molière - Don Juan, 1906, Boirac.djvu") == "Molière_Don_Juan_1906_Boirac"
    assert one(spark, T.file_name(F.col("t")), t="AC/DC") == "wp-AC_DC.txt"
    assert one(spark, T.distinct_notes(F.col("t")), t="a; b; a") == "a; b"
    assert one(spark, T.latest_year(F.col("t")), t="1887 kaj 1922") == 1922
    keys = [one(spark, T.collation_key(F.col("w")), w=w) for w in ("cent", "ĉu", "da", "uz", "ŭa", "va", "zo", "qa")]
    assert keys == sorted(keys)
    assert one(spark, T.inflected(F.col("w"), F.col("p")), w="vidi", p="verb") == ["vidi", "vidas", "vidis", "vidos", "vidus", "vidu"]
    assert one(spark, T.inflected(F.col("w"), F.col("p")), w="libro", p="noun") == ["libro", "libroj", "libron", "librojn"]
    assert one(spark, T.snippet(F.col("t"), F.col("w")), t="a" * 100 + " vorto " + "b" * 100, w="vorto").startswith("…")


def test_correlative():
    import re

    assert all(re.match(DEFAULT.correlative, w) for w in ("kiu", "tien", "kies", "kiesjn"))


def test_segmentation():
    assert M.segment("reĝin", {"reĝ": (0, 0), "ĝin": (2, 0)}) == ((), "reĝ", ("in",))
    assert M.segment("filinet", {"fil": (0, 0), "lin": (0, 0)}) == ((), "fil", ("in", "et"))
    assert M.segment("demand", {"demand": (0, 0), "mand": (0, 0)}) is None
    assert M.peel("reĝin", {"reĝ"}) == "reĝ"
    assert M.peel("xyz", {"reĝ"}) is None
    assert M.is_compound("bonord", {"bon", "ord", "nord"})


def test_morphology():
    model = dataclasses.replace(DEFAULT, overrides={"restarigi": (("re",), "star", ("ig",))}, no_split=frozenset({"ekspiri"}))
    shape = M.morphology("restarigi", {}, model)
    assert [x["m"] for x in shape["prefixes"]] == ["re"] and shape["stem"] == "star" and shape["suffixes"][0]["m"] == "ig"
    assert M.morphology("ekspiri", {"spir": (0, 0)}, model)["stem"] == "ekspir"
    assert M.morphology("dumonata", {"dum": (0, 0), "monat": (0, 0), "du": (0, 0)}, model)["suffixes"] == []


def test_analyse():
    roots, words = frozenset({"reĝ", "libr", "vort"}), frozenset({"tre"})
    assert M.analyse("kaj", roots, words) == ("kaj", "grammatical")
    assert M.analyse("kiuj", roots, words)[1] == "correlative"
    assert M.analyse("reĝinoj", roots, words) == ("reĝ", "known")
    assert M.analyse("treege", roots, words)[1] == "known"
    assert M.analyse("vortlibr", roots, words)[1] == "known"
    assert M.analyse("zzz", roots, words) == ("zzz", "unknown")


def test_inflected_participles(spark):
    """The forms that a concordance counts: six of the verb and nine participles."""
    got = one(spark, T.inflected(F.col("w"), F.col("p"), True), w="vidi", p="verb")
    assert got[:6] == ["vidi", "vidas", "vidis", "vidos", "vidus", "vidu"]
    assert sorted(got[6:]) == sorted(["vidante", "vidinte", "vidonte", "vidata", "vidita", "vidota", "vidanta", "vidinta", "vidonta"])
