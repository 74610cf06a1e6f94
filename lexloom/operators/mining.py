"""Mining: tokens to lemma records, records of shards to candidates, attestation, citations.

A record is one row a lemma. Map-side aggregation stands in for shards; what depends on
the first occurrence is ranked by (source, line, position) and never by arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.model import DEFAULT, LanguageModel
from ..sources.steps import spread


def token_rows(docs: DataFrame, model: LanguageModel = DEFAULT, source: str = "source", text: str = "text", by_line: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """source, (line, line_chars,) pos, token, form, and the columns ``keep``. Lines and positions count from 1 and 0. Small
    tables are dealt over all cores first; the lines themselves stay behind, and ``with_lines`` brings back the few that are wanted."""
    narrow = spread(docs.select(*keep, F.col(source).alias("source"), F.col(text).alias("text")))
    if by_line:
        base = narrow.select(*keep, "source", F.posexplode(T.lines(F.col("text"))).alias("line", "line_text"))
        cells = base.select(*keep, "source", (F.col("line") + 1).alias("line"), F.length(F.trim("line_text")).alias("line_chars"), F.posexplode(T.tokens(F.col("line_text"), model)).alias("pos", "token"))
    else:
        cells = narrow.select(*keep, "source", F.posexplode(T.tokens(F.col("text"), model)).alias("pos", "token"))
    return cells.withColumn("form", F.lower("token"))


def line_rows(docs: DataFrame, source: str = "source", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """source, line (from 1), line_text, and the columns ``keep``."""
    narrow = spread(docs.select(*keep, F.col(source).alias("source"), F.col(text).alias("text")))
    return narrow.select(*keep, "source", F.posexplode(T.lines(F.col("text"))).alias("line", "line_text")).withColumn("line", F.col("line") + 1)


def with_lines(places: DataFrame, lines: DataFrame) -> DataFrame:
    """Places with their lines' text; all columns of ``lines`` but the text say which line that is (source, line,
    and a document's id where a source has several). A line that comes twice counts once."""
    at = [c for c in lines.columns if c != "line_text"]
    wanted = lines.join(places.select(*at).distinct(), at, "left_semi")
    return places.join(wanted.groupBy(*at).agg(F.min("line_text").alias("line_text")), at)


def counted(tokens: DataFrame) -> DataFrame:
    """token, form, source, n: one row a spelling and source. What a corpus is asked for by word alone starts here:
    a word that every line holds is one row a source."""
    return tokens.groupBy("token", "form", "source").agg(F.count("*").alias("n"))


def is_capital(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    return first != F.lower(first)


def attestation(tokens: DataFrame, encyclopedia: Column, by: str = "form", per_source: bool = False, sums: tuple[str, ...] = ()) -> DataFrame:
    """Occurrences and distinct sources of each form, sources split by register. One partial
    aggregate by (form, source), then one by form: no distinct expansion. Rows with a count ``n`` stand for so many tokens;
    with ``per_source`` there is one row a form and source already. ``sums``: other counts that are added up."""
    times = F.sum("n") if "n" in tokens.columns else F.count("*")
    rows = tokens.withColumn("wp", encyclopedia) if per_source else tokens.groupBy(by, "source").agg(times.alias("n"), F.max(encyclopedia).alias("wp"), *(F.sum(c).alias(c) for c in sums))
    return rows.groupBy(by).agg(F.sum("n").alias("occurrences"), F.count("*").alias("sources"), F.count_if(~F.col("wp")).alias("sources_lit"), F.count_if("wp").alias("sources_wiki"), *(F.sum(c).alias(c) for c in sums))


def fragments(docs: DataFrame, model: LanguageModel = DEFAULT, text: str = "text") -> DataFrame:
    """form, n, n_fragment: how often a form stands by itself, and how often a hyphen or a letter outside the
    alphabet touches it. Tokens are taken with their neighbours by one pattern."""
    own = model.token_pattern.removesuffix("]+").removeprefix("[")
    beside = rf"([^{own}\P{{L}}]|-)?"
    cells = docs.select(F.explode(F.regexp_extract_all(text, F.lit(f"{beside}({model.token_pattern}){beside}"), F.lit(0))).alias("m"))
    token = F.regexp_extract("m", f"({model.token_pattern})", 1)
    flagged = cells.select(F.lower(token).alias("form"), (F.length("m") > F.length(token)).alias("fragment"))
    return flagged.groupBy("form").agg(F.count("*").alias("n"), F.count_if("fragment").alias("n_fragment"))


def fragment_flag(line: Column, start: Column, token: Column) -> Column:
    """A token is a fragment if a hyphen or a letter outside the alphabet touches it. ``start`` counts from 0."""
    before, after = F.substring(line, start, F.lit(1)), F.substring(line, start + F.length(token) + 1, F.lit(1))
    foreign = rf"^(-|(?![{T.LETTERS.replace('0-9_', '')}])\p{{L}})$"
    return F.when(start > 0, before.rlike(foreign)).otherwise(False) | after.rlike(foreign)


def refine_kind(tokens: DataFrame, lemma: str = "lemma", kind: str = "kind", fragment: Column | None = None) -> DataFrame:
    """What the analysis says, refined: a derivation keeps its own citation form, an unknown word its
    citation form or, capitalised, its surface."""
    low, cited = F.col("form"), T.citation_form(F.col("token"))
    capital = is_capital(F.col("token"))
    derived = (F.col(kind) == "known") & (F.col(lemma) != low) & (T.strip_ending(low) != F.col(lemma))
    unknown = F.col(kind) == "unknown"
    broken = fragment if fragment is not None else F.lit(False)
    return tokens.withColumns({"lemma": F.when(derived | (unknown & ~capital), cited).when(unknown, low).otherwise(F.col(lemma)), "kind": F.when(derived, "derived").when(unknown & broken, "fragment").otherwise(F.col(kind)), "capital": capital})


def mine(cells: DataFrame, kinds: DataFrame, places: DataFrame, lines: DataFrame, min_count: int = 1, citations: int = 3) -> DataFrame:
    """Lemma records. ``cells``: counts (token, form, source, n); ``kinds``: what each token is, refined (token, form, lemma, kind,
    capital); ``places``: the first ``citations`` places of every token (token, rank, source, line, pos); ``lines``: (source,
    line, line_text).

    A lemma's first places are among those of its tokens, so only these meet the kinds, and
    only the places that are left meet their lines."""
    own = kinds.where(~F.col("kind").isin("grammatical", "correlative") & T.minable(F.col("form"))).select("token", "form", "lemma", "kind", "capital")
    base = own.join(cells.groupBy("token").agg(F.sum("n").alias("n")), "token")
    forms = base.groupBy("lemma", "form").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("capital"), F.col("n")).otherwise(0)).alias("caps"))
    totals = forms.groupBy("lemma").agg(F.sum("n").alias("count"), F.sum("caps").alias("caps"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("form", "n")))).alias("forms"))
    files = cells.select("token", "source").join(own.select("token", "lemma"), "token").select("lemma", "source").distinct().groupBy("lemma").agg(F.sort_array(F.collect_list("source")).alias("files"))
    met = places.join(own.select("token", "lemma", "kind"), "token").withColumn("ord", F.struct("source", "line", "pos"))
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("lemma").orderBy("ord"))).where(F.col("rank") <= citations)
    shown = with_lines(ranked.select("lemma", "rank", "source", "line", "token", "kind"), lines).select("lemma", "rank", "source", "line", "kind", T.guess_pos(F.col("token")).alias("pos_guess"), T.snippet(F.col("line_text"), F.col("token")).alias("text"))
    listed = F.sort_array(F.collect_list(F.struct("rank", "source", "line", "text")))
    cites = shown.groupBy("lemma").agg(F.min_by(F.struct("kind", "pos_guess"), "rank").alias("f"), F.transform(listed, lambda c: F.struct(c["source"].alias("source"), c["line"].cast("long").alias("line"), c["text"].alias("text"))).alias("citations"))
    found = totals.join(files, "lemma").join(cites, "lemma").withColumn("lower", F.col("count") - F.col("caps")).where(F.col("count") >= min_count)
    return found.select("lemma", name_rule(F.col("f.kind"), F.col("lower")).alias("kind"), "count", "f.pos_guess", "forms", "citations", "caps", "lower", "files")


def first_places(tokens: DataFrame, k: int, key: str = "token") -> DataFrame:
    """key, rank, source, line, pos, token: the first k places of each key. Spark keeps k a task before the shuffle."""
    w = Window.partitionBy(key).orderBy("source", "line", "pos")
    own = [key] if key == "token" else [key, "token"]
    return tokens.select(*own, "source", "line", "pos").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def first_citations(tokens: DataFrame, lines: DataFrame, k: int, key: str = "lemma") -> DataFrame:
    """key, rank, source, line, text: the first k occurrences, ranked by their places alone; the text is joined to
    those that are left."""
    found = with_lines(first_places(tokens, k, key), lines)
    return found.select(key, "rank", "source", "line", T.snippet(F.col("line_text"), F.col("token")).alias("text"))


def name_rule(kind: Column, lower: Column) -> Column:
    """Open-class words never seen in lower case are names."""
    return F.when(kind.isin("unknown", "derived") & (lower == 0), "name").otherwise(kind)


#: Strictness of a kind; kinds that are not listed come last, together.
KIND_RANK = {"fragment": 0, "unknown": 1, "known": 2}


def kind_rank(kind: Column) -> Column:
    return F.when(kind == "fragment", 0).when(kind == "unknown", 1).when(kind == "known", 2).otherwise(9)


def reduce_records(records: DataFrame, shard: str = "shard", limit: int = 5) -> DataFrame:
    """Candidates from the records of all shards: sums, unions, the strictest kind, names by
    the total of lower-case uses, first verdicts with later ones as conflicts, citations in turn."""
    # One shuffle by lemma serves every aggregate below; a lemma has at most one row a shard.
    rows = records.repartition("lemma")
    said = lambda c: F.nullif(F.col(c), F.lit(""))
    decided = F.sort_array(F.collect_list(F.when(said("verdict").isNotNull() | said("gloss").isNotNull(), F.struct(F.col(shard).alias("shard"), said("verdict").alias("verdict"), said("gloss").alias("gloss")))))
    parts = F.filter(F.flatten(F.transform(F.sort_array(F.collect_list(F.when(F.coalesce("note", F.lit("")) != "", F.struct(shard, "note")))), lambda x: F.split(x["note"], "; "))), lambda x: x != "")
    main = rows.groupBy("lemma").agg(
        F.sum("count").cast("long").alias("count"), F.sum("lower").cast("long").alias("lower"), F.min_by("pos_guess", shard).alias("pos_guess"), F.min(F.struct(kind_rank(F.col("kind")).alias("r"), F.col(shard).alias("s"), "kind")).alias("k"),
        F.min(F.when(F.col("kind") != "name", F.struct(kind_rank(F.col("kind")).alias("r"), "kind"))).alias("other"), F.max(F.col("kind").isin("unknown", "derived")).alias("open"),
        decided.alias("decided"), F.array_distinct(parts).alias("notes"), F.sort_array(F.collect_list(shard)).alias("shards"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("files")))).alias("sources"),
    )
    stands = lambda n: F.try_element_at(F.filter(F.transform("decided", lambda x: x[n]), lambda x: x.isNotNull()), F.lit(1))
    main = main.withColumns({"verdict": stands("verdict"), "gloss": stands("gloss")})
    clash = lambda x, n: F.when(x[n] != F.col(n), F.struct(F.lit(n).alias("field"), x["shard"].alias("shard"), x[n].alias("value"), F.col(n).alias("kept")))
    main = main.withColumn("conflicts", F.flatten(F.transform("decided", lambda x: F.array_compact(F.array(clash(x, "verdict"), clash(x, "gloss"))))))
    forms = rows.select("lemma", F.explode("forms").alias("form", "n")).groupBy("lemma", "form").agg(F.sum("n").cast("long").alias("n"))
    forms = forms.groupBy("lemma").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("form", "n")))).alias("forms"))
    cites = rows.select("lemma", shard, F.posexplode("citations").alias("i", "c")).select("lemma", "c.source", "c.line", "c.text", F.struct(shard, "i").alias("ord"))
    picked = round_robin(cites, "lemma", limit).groupBy("lemma").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "source", "line", "text"))), lambda c: F.struct(c["source"].alias("source"), c["line"].alias("line"), c["text"].alias("text"))).alias("citations"))
    kind = F.when((F.col("lower") == 0) & F.col("open"), "name").when((F.col("k.kind") == "name") & F.col("other").isNotNull(), F.col("other.kind")).otherwise(F.col("k.kind"))
    return main.join(forms, "lemma", "left").join(picked, "lemma", "left").select("lemma", kind.alias("kind"), "count", "lower", "pos_guess", "forms", "citations", "shards", "verdict", "gloss", "notes", "conflicts", "sources")


def round_robin(cites: DataFrame, key: str, limit: int, encyclopedia: Column | None = None) -> DataFrame:
    """Citations in turn by source, other sources before the encyclopedia's: adds ``turn`` from 1."""
    wp = encyclopedia if encyclopedia is not None else T.is_encyclopedia(F.col("source"))
    own = cites.withColumn("wp", wp)
    # Spark keeps the first ranks of a key and source before the shuffle; what opens a source is among them.
    own = own.withColumn("again", F.row_number().over(Window.partitionBy(key, "source").orderBy("ord"))).where(F.col("again") <= limit)
    own = own.withColumn("opened", F.min("ord").over(Window.partitionBy(key, "source")))
    return own.withColumn("turn", F.row_number().over(Window.partitionBy(key).orderBy("again", "wp", "opened", "source"))).where(F.col("turn") <= limit).drop("again", "opened", "wp")


def noise_floor(records: DataFrame, least: int) -> DataFrame:
    """Rare lemmas go unless reviewed."""
    return records.where((F.col("count") >= least) | (F.coalesce("verdict", F.lit("")) != ""))


def concordance(tokens: DataFrame, forms: DataFrame, lines: DataFrame, limit: int = 5, keep: int = 3, shortest: int = 35, longest: int = 180) -> DataFrame:
    """Counts and citations of headwords through one index of inflected forms (word, form): at
    most one citation a source, by source priority, on a line of fitting length. ``forms`` is joined
    by hash; Spark broadcasts it where it is small. Tokens are reduced to counts, and to a form's
    first place in each source, before they meet their headwords."""
    counts = attestation(counted(tokens).join(forms, "form"), T.is_encyclopedia(F.col("source")), "word")
    place = F.struct("line", "pos", *(c for c in lines.columns if c not in ("source", "line", "line_text")))
    fitting = tokens.where(F.col("line_chars").between(shortest, longest)).join(forms.select("form").distinct(), "form", "left_semi")
    places = fitting.groupBy("form", "source").agg(F.min(place).alias("f"))
    once = places.join(forms, "form").groupBy("word", "source").agg(F.min("f").alias("f")).withColumn("priority", T.source_priority(F.col("source")))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("word").orderBy("priority", "source"))).where(F.col("rank") <= min(limit, keep))
    shown = with_lines(ranked.select("word", "rank", "source", "f.*"), lines)
    cites = shown.groupBy("word").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "source", F.trim("line_text").alias("text")))), lambda c: F.struct(c["source"].alias("source"), c["text"].alias("text"))).alias("citations"))
    return counts.join(cites, "word", "left")
