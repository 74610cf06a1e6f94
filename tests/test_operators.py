"""Golden cases of operators, sources, sinks and streams."""

import json
import tarfile

import pytest
from pyspark.sql import functions as F

from lexloom.operators import corpus as O
from lexloom.operators import curation as C
from lexloom.operators import lexicon as L
from lexloom.operators import mining as N
from lexloom.sources import markup, readers, sinks
from lexloom.streaming import crawl


def test_tier(spark):
    rows = spark.createDataFrame([(5, 3, 0), (5, 1, 10), (5, 2, 9), (5, 0, 50), (5, 0, 49), (4, 9, 99)], "c int, o int, w int")
    assert [r[0] for r in rows.select(C.tier(F.col("c"), F.col("o"), F.col("w"))).collect()] == ["broad", "mixed", None, "wp-only", None, None]


def test_round_robin(spark):
    rows = spark.createDataFrame([("x", "wp-a", 1), ("x", "pg-1", 2), ("x", "pg-1", 3), ("x", "ia-2", 4)], "k string, source string, ord int")
    got = N.round_robin(rows, "k", 5).orderBy("turn").collect()
    assert [(r["source"], r["ord"]) for r in got] == [("pg-1", 2), ("ia-2", 4), ("wp-a", 1), ("pg-1", 3)]


def _records(spark, rows):
    schema = readers.LEMMA + ", shard string"
    return spark.createDataFrame([(l, k, 1, "noun", {l: 1}, [], 0, low, [s], v, None, n, s) for l, k, low, s, v, n in rows], schema)


@pytest.mark.parametrize("kinds, lowers, kind", [(["derived", "unknown"], [1, 1], "unknown"), (["derived", "known"], [1, 1], "known"), (["name", "unknown"], [0, 3], "unknown"), (["name", "derived"], [0, 2], "derived"), (["name", "unknown"], [0, 0], "name")])
def test_kinds_merge(spark, kinds, lowers, kind):
    rows = [("a", k, low, f"s{i}", None, None) for i, (k, low) in enumerate(zip(kinds, lowers, strict=True))]
    assert N.reduce_records(_records(spark, rows)).first()["kind"] == kind


def test_verdict_conflict(spark):
    got = N.reduce_records(_records(spark, [("a", "unknown", 1, "shard-1", "lemma", "x; y"), ("a", "unknown", 1, "shard-2", "foreign", "y; z")])).first()
    assert got["verdict"] == "lemma" and got["notes"] == ["x", "y", "z"]
    assert [c.asDict() for c in got["conflicts"]] == [{"field": "verdict", "shard": "shard-2", "value": "foreign", "kept": "lemma"}]


def test_shards_pack(spark):
    sizes = spark.createDataFrame([(f"f{n}", n) for n in (9, 7, 6, 5, 4)], "name string, size long")
    assert sorted(r[0] for r in O.pack_shards(sizes, 3).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()) == [9, 11, 11]


def test_body_slice(spark):
    lines = ["*** START OF THIS PROJECT GUTENBERG EBOOK", "A", "End of Project Gutenberg's X", "*** END OF THIS PROJECT GUTENBERG"]
    got = spark.createDataFrame([(lines,)], "l array<string>").select(O.body_slice(F.col("l")).alias("x")).first()["x"]
    assert got["body"] == ["A"] and got["head"] == 1 and got["tail"] == 2


def test_normalise(spark):
    raw = spark.createDataFrame([("wp-a.txt", "роv estas\n\n\n\nfino  \n"), ("pg-x.txt", "no markers"), ("x.txt", "Elŝuti kiel\nbookTitolo\nteksto\n")], "source string, text string")
    got = {r["source"]: r for r in O.normalise(raw).collect()}
    assert got["wp-a.txt"]["text"] == "pov estas\n\nfino\n" and got["wp-a.txt"]["homoglyphs"] == "1"
    assert got["pg-x.txt"]["error"] and got["x.txt"]["method"] == "wsrc-marker" and got["x.txt"]["text"] == "teksto\n"


def test_licence(spark):
    got = spark.createDataFrame([(1917, 1934), (1962, 1935), (1959, 1922), (None, None)], "d int, y int").select(O.free_to_use(F.col("d"), F.col("y")).alias("x")).collect()
    assert [r["x"] for r in got] == [["source-country"], [], ["US"], []]


def test_review(spark):
    lines = spark.createDataFrame([("b", 1, "# c"), ("b", 2, "vorto\tlemma\tword"), ("b", 3, "x\tnonsense"), ("b", 4, "")], "file string, line int, value string")
    got = C.parse_review(lines)
    assert got.count() == 2
    with pytest.raises(ValueError, match="b:3: unknown verdict"):
        C.all_or_nothing(got)


def test_lexicon(spark):
    rows = spark.createDataFrame([("a savage", "adj"), ("savage; wild, untamed", "adj"), ("to cripple", "verb"), ("plain", "noun")], "g string, p string")
    assert [r[0] for r in rows.select(L.modern_gloss(F.col("g"), F.col("p"))).collect()] == ["a wild, untamed", "wild, untamed", "to disable", "plain"]
    derived = spark.createDataFrame([("nova", "", "", 1), ("nova", "new", "", 2), ("alia", "other", "3", 3)], "word string, gloss_en string, ofc string, ord int")
    assert [r["source"] for r in L.merge_derivatives(spark.createDataFrame([("x",)], "word string"), derived).collect()] == ["ReVo/OA-3"]
    refs = spark.createDataFrame([("kiu", "pron", "x")], "w string, p string, s string").select(L.grammar_refs(F.col("w"), F.col("p"), F.col("s"), F.lit(0), F.array().cast("array<string>")).alias("r")).first()["r"]
    assert [r["section"] for r in refs] == ["3"]


def test_markup():
    assert markup.template_text("lang|pl|Prus") == "Prus"
    assert markup.template_text("SIC|as-printed|corrected") == "corrected"
    assert markup.template_text("rh|x") == ""
    assert markup.mail_body("Saluton\n> citaĵo\na\nmondo\n-- \nZamenhof") == "Saluton mondo"
    text = "Unu.\n== Notoj ==\nne\n=== sub ===\nne\n== Vivo ==\nDu {{x|y}} [[a|b]]."
    assert markup.prose(text) == "Unu. Du b."
    assert markup.prose("#REDIRECT [[x]]") is None
    assert markup.decoded("ĉ".encode("iso-8859-3"), "iso-8859-3") == "ĉ"


def test_mbox(spark, tmp_path):
    (tmp_path / "a.mbox").write_bytes(b"From a@b Mon Jan  1 00:00:00 1996\nFrom: Ana <a@b>\nSubject: x\nDate: Mon, 1 Jan 1996 00:00:00 +0000\nMessage-ID: <1>\n\nSaluton mondo\nFrom nowhere\n-- \nme\nFrom c@d Tue Jan  2 00:00:00 1996\nFrom: c@d\n\nDua\n")
    spark.dataSource.register(markup.Mbox)
    got = spark.read.format("mbox").load(str(tmp_path)).orderBy("number").collect()
    assert [(r["author"], r["date"], r["text"]) for r in got] == [("Ana", "1996-01-01", "Saluton mondo From nowhere"), ("c", "", "Dua")]


def test_tar_member(spark, tmp_path):
    (tmp_path / "m.csv").write_text("1\t2\n3\t4\n")
    with tarfile.open(tmp_path / "x.tar.bz2", "w:bz2") as t:
        t.add(tmp_path / "m.csv", "m.csv")
    spark.dataSource.register(readers.TarMember)
    got = spark.read.format("tar_member").option("path", str(tmp_path / "x.tar.bz2")).option("member", "m.csv").load()
    assert [r["value"] for r in got.orderBy("line").collect()] == ["1\t2", "3\t4"]


def test_readers_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("ĉu", "x"), ("cent", "y")], "word string, gloss_en string")
    sinks.dictionary(rows, str(tmp_path / "d"))
    got = [json.loads(x)["word"] for f in sorted((tmp_path / "d").glob("part-*")) for x in f.read_text().splitlines()]
    assert got == ["cent", "ĉu"]
    assert readers.json_lines(spark, str(tmp_path / "d"), "word string", "part-*").count() == 2
    sinks.table(rows, str(tmp_path / "t"), ["word"])
    assert readers.table(spark, str(tmp_path / "t")).count() == 2
    with pytest.raises(Exception, match="tab or newline"):
        sinks.table(spark.createDataFrame([("a\tb",)], "x string"), str(tmp_path / "bad"))
    (tmp_path / "s.tsv").write_text("1\tepo\tSaluton\n2\teng\tHello\n")
    with pytest.raises(Exception, match="another language"):
        readers.sentences(spark, str(tmp_path / "s.tsv"), "epo").collect()
    md = spark.createDataFrame([("- `a.txt` — Titolo — sha256:abc — pg — https://x",), ("- ~~`b.txt`~~ — B",), ("| c |",)], "value string")
    got = {r["file"]: r for r in readers.provenance(md).collect()}
    assert got["a.txt"]["sha"] == "abc" and got["a.txt"]["origin"] == "pg" and got["b.txt"]["quarantined"] and len(got) == 2
    pairs = readers.printed_pairs(spark.createDataFrame([("Abaft (naut) = posta parto, poste.",)], "value string"))
    assert sorted((r["word"], r["kind"]) for r in pairs.collect()) == [("posta parto", "phrase"), ("poste", "headword")]
    assert len(readers.article_derivatives("<vortaro><art><kap><rad>am</rad>/o</kap><drv><kap><tld/>o</kap><trd lng='en'>love</trd></drv></art></vortaro>")) == 1
    assert list(readers.messages_in(")]}'\n" + json.dumps([["id1", "me", 1000000000000, "<div>x</div>"]])))[0]["id"] == "id1"


def test_wiki_reader(spark, tmp_path):
    (tmp_path / "d.xml").write_text("<mediawiki><page><title>A</title><ns>0</ns><revision><text bytes='1'>Teksto</text></revision></page><page><title>B</title><ns>0</ns><redirect title='A'/><revision><text>#REDIRECT</text></revision></page></mediawiki>")
    got = readers.articles(readers.wiki_pages(spark, str(tmp_path / "d.xml"))).collect()
    assert [(r["title"], r["text"]) for r in got] == [("A", "Teksto")]


def test_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("1", "1995-05-03 10:00:00"), ("1", "1995-05-03 11:00:00"), ("2", "1995-06-01 00:00:00")], "id string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    for _ in range(2):
        stream = spark.readStream.schema("id string, ts timestamp").parquet(src)
        crawl.append_audited(crawl.once(stream, "id", "ts"), str(tmp_path / "out"), str(tmp_path / "audit"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 2 and sorted(r["month"] for r in crawl.by_month(got, "ts").collect()) == ["1995-05", "1995-06"]


def test_plan(spark):
    from lexloom.plans import dictionary

    text = "La reĝino vidis la reĝon. Kongreso kaj kongresoj, Hutton!\n" * 3
    docs = spark.createDataFrame([("pg-1", text), ("pg-2", text), ("pg-3", text), ("wp-1", "kongreson"), ("skip", "x y z")], "source string, text string")
    entries = spark.createDataFrame([("reĝo", "reĝ", None), ("vidi", "vid", None)], "word string, root string, stem string")
    found = dictionary.mined(docs, entries, without=spark.createDataFrame([("skip",)], "source string"))
    got = {r["lemma"]: r for r in found.collect()}
    assert got["kongreso"]["count"] == 19 and got["kongreso"]["forms"] == {"kongreso": 9, "kongresoj": 9, "kongreson": 1}
    assert got["reĝino"]["kind"] == "derived" and got["hutton"]["kind"] == "name" and "la" not in got
    assert got["reĝ"]["kind"] == "known" and len(got["kongreso"]["citations"]) == 3
    ledger = spark.createDataFrame([("reĝino", "lemma", "queen", None, 1)], "lemma string, verdict string, gloss string, note string, ord int")
    english = C.english_words(spark.createDataFrame([("a congress",)], "english string"))
    buckets = {r["lemma"]: (r["bucket"], r["tier"]) for r in dictionary.review_queue(found, entries, ledger, english).collect()}
    assert buckets["kongreso"] == ("queue", "broad") and buckets["reĝino"][0] == "reviewed" and buckets["hutton"][0] == "closed-class"
    counts = spark.createDataFrame([("reĝino", 9, 3)], "word string, occurrences long, sources long")
    stock = spark.createDataFrame([("reĝ", 0, 0)], "root string, rank int, neg_prod int")
    new = dictionary.promoted(ledger, entries, counts, stock).first()
    assert new["word"] == "reĝino" and new["morphology"]["stem"] == "reĝ" and new["derived"] and new["occurrences"] == 9


def test_reports(spark):
    from lexloom.operators import reports

    out = reports.markdown_html("# 2 Words\n\n| a | b |\n|---|---|\n| *x* | `y` |\n\n- one\n- two\n\nText.")
    assert '<h1 id="section-2">' in out and "<td><em>x</em></td>" in out and "<li>one</li>" in out and "<p>Text.</p>" in out
    rows = spark.createDataFrame([("shard-0-of-3",), ("shard-2-of-3",)], "shard string")
    assert [r["i"] for r in reports.missing_shards(rows, 3).collect()] == [1]
    assert reports.addition_counts(spark.createDataFrame([("ReVo/OA-2",), ("x",)], "source string")).first()["n"] == 1


def test_citations_of_short_words(spark, tmp_path):
    """Both citation queries against brute force: words of any length count."""
    from lexloom.queries import mining

    line = "la hundo vidis ke mi estas tie kaj la kato dormas"
    docs = [(i, f"src{i % 7}", "\n".join([line, "Mi iras al vi", f"ni {'kaj ' * (i % 3)}vidita vidanto"])) for i in range(12)]
    spark.createDataFrame(docs, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, "la mi al vidi iri")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    lines = [(i, s, n, x) for i, s, t in docs for n, x in enumerate(t.split("\n"), 1)]
    want = set()
    for form in {w.lower() for *_, x in lines for w in x.split()}:
        own = {}
        for i, s, n, x in lines:
            if form in x.lower().split():
                own.setdefault(s, []).append((i, n))
        order = sorted((again, s in ("src0", "src1", "src2", "src3", "src4"), min(at), s, *x) for s, at in own.items() for again, x in enumerate(sorted(at)))
        want |= {(form, turn, o[3], o[4], o[5]) for turn, o in enumerate(order[:5], 1)}
    assert set(map(tuple, mining.round_robin_citations(spark, str(tmp_path)).collect())) == want
    got = {r["word"]: r for r in mining.concordance_citations(spark, str(tmp_path)).collect()}
    forms = {"la": ["la", "laj", "lan", "lajn"], "mi": ["mi", "mas", "mis", "mos", "mus", "mu"], "al": ["al"], "vidi": ["vidi", "vidas", "vidis", "vidita"], "iri": ["iri", "iras"]}
    words = [w.lower() for *_, x in lines for w in x.split()]
    assert {w: r["occurrences"] for w, r in got.items()} == {w: sum(words.count(f) for f in own) for w, own in forms.items()}
    assert all(r["sources"] == 7 for r in got.values())
