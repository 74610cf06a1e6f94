"""Near duplicates by minhash with tensored banding, every link confirmed on full sets.

Two small collections of half-keys are computed, each half-key a few minhashes of a
document's shingles; every pair of one half-key from either collection is a table
key. So ``tables ** 2`` table keys cost ``2 * tables`` half-keys. Documents that meet
under a table key are candidates.

Equal shingle sets collapse to one class first. A group of classes that share table
keys is then worked off against one of its own, not pair by pair:

* Each class is compared with its hub P, the most central class it meets.
* If x and y are linked but x isn't linked with P, then at most (5|x| - 4|y|) / 9
  elements of x are missing from y, and more than (5|x| - 4|P|) / 9 are missing from P.
  So wherever x \\ P has more than (5|x| - 4|y|) / 9 elements, x and y share one that P
  lacks. Classes therefore only need to meet under (hub, element the hub lacks).
* Pairs for which that reasoning fails (different hubs, or x just short of the link
  while y is smaller than P) meet under their table keys.

Where a bucket's members are in so many components that its pairs would outnumber them
``CROWD`` times (texts filled into one template, say, that share half of it), the
members are banded once more, with more minhashes a key the more such members there are,
and meet under those finer keys. So what is compared stays close to the number of
classes where thousands of variants of one text, or of one template, share every
bucket. No bucket is capped: a finer key compares all pairs that it holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, raw_bytes, saved, scratch, texts, tidy
from .components import components, merged

#: Pairs a member of a bucket that are compared straight away, members of a bucket that one task compares with
#: its few others, chance of a pair at the threshold to miss all finer keys, least and most minhashes of a finer key.
CROWD, SLICE, MISS, FINE = 16, 4096, 2e-4, (10, 20)

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, words: int = 4) -> np.ndarray:
    """Distinct 64-bit hashes of a text's word shingles, sorted; fewer words than that make one shingle."""
    tokens = text.translate(_LOWER).split()
    if not tokens:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    n = max(1, len(tokens) - words + 1)
    out = np.full(n, len(tokens) if len(tokens) < words else words, np.uint64)
    for k in range(min(words, len(tokens))):
        out = scramble(out * np.uint64(_MIX[k % 4]) + hashes[k : k + n])
    return np.unique(out)


class Sketch:
    """Half-keys of the two collections: ``2 * tables`` rows of ``rows`` minhashes each."""

    def __init__(self, tables: int, rows: int, seed: int):
        rng = np.random.default_rng(seed)
        self.tables, self.rows = tables, rows
        self.mul = rng.integers(1, 2**63, 2 * tables * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 2**63, 2 * tables * rows, dtype=np.uint64)

    def half_keys(self, shingles: np.ndarray) -> np.ndarray:
        """(2, tables) keys."""
        least = np.full(len(self.mul), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 4096):
            part = shingles[at : at + 4096]
            # The high bits of a multiply-add order the shingles; a xor-shift first breaks its linearity.
            np.minimum(least, ((part ^ (part >> np.uint64(29)))[None, :] * self.mul[:, None] + self.add[:, None]).min(axis=1), out=least)
        key = np.full(2 * self.tables, 0x51ED27, np.uint64)
        for r in range(self.rows):
            key = scramble(key * np.uint64(_MIX[0]) + least[r :: self.rows])
        return key.reshape(2, self.tables)


def sets(docs: DataFrame, words: int = 4, tables: int = 9, rows: int = 2, seed: int = 11) -> DataFrame:
    """doc_id, n_shingles, the 128-bit digest of the set (hi, lo), and its half-keys ``a`` and ``b``."""
    sketch = Sketch(tables, rows, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hi, lo, a, b = [], [], [], [], []
            for text in raw_bytes(batch.column(1)):
                found = shingle_set(text, words)
                n.append(len(found))
                if not len(found):
                    hi.append(None), lo.append(None), a.append(None), b.append(None)
                    continue
                digest = xxhash.xxh3_128_intdigest(found.tobytes())
                hi.append((digest >> 64) - (1 << 63)), lo.append((digest & (1 << 64) - 1) - (1 << 63))
                left, right = sketch.half_keys(found).view(np.int64)
                a.append(left), b.append(right)
            keys = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(a, keys), pa.array(b, keys)], ["doc_id", "n_shingles", "hi", "lo", "a", "b"])

    return docs.mapInArrow(tidy(run), "doc_id long, n_shingles long, hi long, lo long, a array<long>, b array<long>")


def full_sets(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id and all its shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(x, words).view(np.int64) for x in raw_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    return docs.mapInArrow(tidy(run), "doc_id long, shingles array<long>")


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int, more: bool = False) -> DataFrame:
    """Pairs (u, v) with ``linked``, by the exact sizes of intersection and union, and if asked for ``more``: v without u."""
    left = full.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    right = full.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    joined = pairs.join(left, "u").join(right, "v").withColumn("more", F.array_except("sv", "su"))
    both = F.size("sv") - F.size("more")
    return joined.select("u", "v", (both * 100 >= (F.size("su") + F.size("more")) * percent).alias("linked"), *(["more"] if more else []))


def _classes(held: DataFrame) -> DataFrame:
    """One node a distinct set: the smallest doc_id that has it. Copies meet map-side."""
    some = held.where("n_shingles > 0 AND doc_id IS NOT NULL")
    return some.groupBy("hi", "lo").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.first("a").alias("a"), F.first("b").alias("b"))


def _labels(view: DataFrame, classes: DataFrame, percent: int, words: int, tables: int, seed: int) -> DataFrame:
    """(node, component) of the classes that are linked with another."""
    bucket = saved(_buckets(classes, tables), "minhash-buckets")
    full = _needed_sets(view, bucket, words)
    hubs = saved(_hubs(bucket), "minhash-hubs")
    first = saved(_confirmed(hubs.where("hub != node").select(F.col("hub").alias("u"), F.col("node").alias("v")), full, percent, True), "minhash-first")
    tested = [first.select("u", "v", "linked")]

    linked = lambda t: t.where("linked").select("u", "v")

    def test(pairs: DataFrame) -> None:
        for known in tested:
            same = known.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
            pairs = pairs.join(same, ["u", "v"], "left_anti")
        tested.append(saved(_confirmed(pairs, full, percent), "minhash-tested"))

    label = saved(components(linked(tested[0])), "minhash-components")
    finer = saved(_finer(first, hubs, label, percent), "minhash-finer")
    test(_star_pairs(finer, label, percent))
    label = merged(label, linked(tested[1]))
    near, crowded = _rest_pairs(finer, label, percent)
    odd, crowded_too = _exception_pairs(bucket, hubs, first, label, percent)
    crowd = saved(crowded.unionByName(crowded_too).distinct(), "minhash-crowd")
    pairs = near.unionByName(odd)
    if many := crowd.count():
        pairs = pairs.unionByName(_fine_pairs(_fine_buckets(full.join(crowd, "node"), many, percent, seed), label, percent))
    test(pairs.distinct())
    label = merged(label, linked(tested[2]))
    return label


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 4, tables: int = 9, rows: int = 2, seed: int = 11, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row a row of ``docs``.

    Links documents whose shingle sets have ``100 * intersection >= percent * union``;
    a component's id is the smallest doc_id that can be reached. Null, empty and
    blank texts have an empty set and are linked with nothing, so each stays, as do
    rows without a doc_id, which take no part. Rows that repeat a doc_id count as one
    document, linked by any of its texts; texts that differ only in repeated shingles
    are linked. An empty table gives no rows.

    A pair of similarity s is missed with probability ``1 - (1 - (1 - s**rows)**tables)**2``:
    0.0002 at 0.8 with the defaults, 0.00002 at 0.85; in crowded buckets a pair at the
    threshold is missed with another ``MISS``, a closer one far less. Whatever the hashing
    proposes is decided exactly; no bucket is capped. A very long text is held as one
    array of its distinct shingles.
    """
    view = texts(docs, id_col, text_col)
    with scratch() as keep:
        held = keep(saved(sets(view, words, tables, rows, seed), "minhash-sets"))
        classes = keep(saved(_classes(held), "minhash-classes"))
        label = keep(_labels(view, classes, percent, words, tables, seed))
    by_set = classes.join(label, "node", "left").select("hi", "lo", F.coalesce("component", "node").alias("component"))
    rows_out = held.select("doc_id", "n_shingles", "hi", "lo").join(by_set, ["hi", "lo"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows_out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """``docs`` without the rows that ``near_duplicates`` does not keep; columns stay as they are."""
    gone = near_duplicates(docs, id_col=id_col, text_col=text_col, **kwargs).where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(f"`{id_col}`").cast("long") == F.col("__gone"), "left_anti")


def _buckets(classes: DataFrame, tables: int) -> DataFrame:
    """(key, node, n) for table keys that two classes or more share.

    A table key can only be shared if both of its half-keys are, so half-keys that one
    class alone has are left out before pairs of them are formed."""
    half = classes.select("node", "n", F.posexplode(F.concat("a", "b")).alias("i", "h"))
    common = half.groupBy("i", "h").agg(F.count("*").alias("c")).where("c > 1").select("i", "h")
    live = half.join(common, ["i", "h"]).groupBy("node").agg(F.max("n").alias("n"), F.collect_set(F.struct("i", "h")).alias("k"))
    left, right = F.filter("k", lambda x: x["i"] < tables), F.filter("k", lambda x: x["i"] >= tables)
    key = F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: F.xxhash64(x["i"], x["h"], y["i"], y["h"]))))
    member = live.select("node", "n", F.explode(key).alias("key"))
    shared = member.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    return member.join(shared, "key").select("key", "node", "n")


def _needed_sets(view: DataFrame, bucket: DataFrame, words: int) -> DataFrame:
    """Full sets of the classes that share some bucket, computed anew from their texts and written once."""
    nodes = bucket.select(F.col("node").alias("doc_id")).distinct()
    chosen = view.where("doc_id IS NOT NULL").join(nodes, "doc_id", "left_semi")
    once = chosen.groupBy("doc_id", F.xxhash64("text").alias("x"), F.length("text").alias("l")).agg(F.first("text").alias("text"))
    found = full_sets(once.select("doc_id", "text"), words).where(F.size("shingles") > 0)
    return saved(found.withColumnRenamed("doc_id", "node"), "minhash-full")


def _sized(small: str, large: str, percent: int) -> F.Column:
    """Sets can only be linked if the smaller has ``percent`` of the larger's size."""
    return F.expr(f"least({small}, {large}) * 100 >= greatest({small}, {large}) * {percent}")


def _hubs(bucket: DataFrame) -> DataFrame:
    """node, n, hub: of all classes that a class meets, itself included, the one that meets
    most; then that one's hub, and again, so that the classes about one text have one hub."""
    sizes = bucket.groupBy("key").agg(F.count("*").alias("c"))
    weight = bucket.join(sizes, "key").groupBy("node").agg(F.sum("c").alias("w"))
    central = bucket.join(weight, "node").groupBy("key").agg(F.max(F.struct("w", (-F.col("node")).alias("minus"))).alias("top"))
    own = saved(bucket.join(central, "key").groupBy("node").agg(F.max("n").alias("n"), (-F.max("top")["minus"]).alias("hub")), "minhash-own-hubs")
    further = own
    for _ in range(2):
        step = own.select(F.col("node").alias("hub"), F.col("hub").alias("next"))
        further = further.join(step, "hub").select("node", "n", F.col("next").alias("hub"))
    return further


def _finer(first: DataFrame, hubs: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """(key, node, n): classes of one hub by elements that they have and the hub lacks, where two components meet.

    Of a linked pair's elements at most (100 - percent) % are missing from the other, so it
    is enough that each class offers one more than that, its rarest first: elements that it
    has alone come before those that many variants share."""
    one = first.select(F.col("v").alias("node"), F.col("u").alias("hub"), F.explode("more").alias("e")).join(hubs.select("node", "n"), "node")
    rows = one.select("node", "n", F.xxhash64("hub", "e").alias("key"))
    counted = rows.join(rows.groupBy("key").agg(F.count("*").alias("c")), "key")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("c", "key"))
    offered = counted.withColumn("r", rank).where(f"r <= n * {100 - percent} div 100 + 1 AND c > 1")
    return _open(offered.select("key", "node", "n"), label).select("key", "node", "n")


def _open(bucket: DataFrame, label: DataFrame) -> DataFrame:
    """Buckets whose members are in different components, with the component ``c``."""
    own = bucket.join(label, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    keys = own.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    return own.join(keys, "key")


def _star_pairs(bucket: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Each member with its bucket's smallest, if they are in different components."""
    own = _open(bucket, label)
    tops = own.groupBy("key").agg(F.min_by(F.struct("node", "n", "c"), "node").alias("hub"))
    met = own.join(tops, "key").where("hub.c != c").where(_sized("n", "hub.n", percent))
    return met.select(F.least("node", "hub.node").alias("u"), F.greatest("node", "hub.node").alias("v")).distinct()


def _exception_pairs(bucket: DataFrame, hubs: DataFrame, first: DataFrame, label: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs that need not share an element beyond their hub: members whose hub isn't the one that most of a bucket
    have, with those of other hubs; and members not linked with their hub, but so nearly that
    smaller ones could be linked with them, with those smaller ones. Beside the pairs, the members of
    buckets whose pairs of that kind would outnumber them ``CROWD`` times."""
    extra = first.select(F.col("v").alias("node"), F.size("more").alias("extra"), "linked")
    # |x without y| <= (100 |x| - percent |y|) / (100 + percent), so a partner y is at most this large.
    most = F.when(~F.col("linked"), F.floor((F.col("n") * 100 - F.col("extra") * (100 + percent)) / percent)).otherwise(0)
    marked = hubs.join(extra, "node", "left").select("node", "hub", F.coalesce(most, F.lit(0)).alias("most"))
    rows = saved(_open(bucket, label).join(marked, "node"), "minhash-open")
    counted = rows.groupBy("key", "hub").agg(F.count("*").alias("c"), F.min("n").alias("least"))
    usual = counted.groupBy("key").agg(F.max(F.struct("c", "hub")).alias("m"), F.min("least").alias("least"), F.sum("c").alias("all"))
    minor = F.col("hub") != F.col("m.hub")
    short = (F.col("most") >= F.col("least")) & (F.col("most") * 100 >= F.col("n") * percent)
    some = rows.join(usual, "key").withColumn("minor", minor).where(minor | short).select("key", "all", F.col("node").alias("x"), F.col("n").alias("xn"), F.col("c").alias("xc"), F.col("hub").alias("xhub"), F.col("most").alias("xmost"), "minor")
    due = (F.col("minor") & (F.col("xhub") != F.col("hub"))) | ((F.col("xhub") == F.col("hub")) & (F.col("n") <= F.col("xmost")))
    # Members of one hub and size are asked for together, so only pairs that are due are ever formed.
    cells = rows.groupBy("key", "hub", "n").agg(F.count("*").alias("members"))
    asked = saved(some.join(cells, "key").where(due).where(_sized("n", "xn", percent)).select("key", "all", "x", "xc", "hub", "n", "members"), "minhash-odd")
    crowds = asked.groupBy("key").agg(F.sum("members").alias("pairs"), F.max("all").alias("all")).where(f"pairs > all * {CROWD}").select("key")
    met = asked.join(crowds, "key", "left_anti").join(rows, ["key", "hub", "n"]).where("x != node AND xc != c")
    return met.select(F.least("x", "node").alias("u"), F.greatest("x", "node").alias("v")).distinct(), rows.join(crowds, "key", "left_semi").select("node").distinct()


def _met(some: DataFrame, rows: DataFrame) -> DataFrame:
    """Chosen members (key, all: members of the key, ...) with all members of their key, a large key's in slices."""
    slices = lambda c: F.expr(f"({c} + {SLICE - 1}) div {SLICE}")
    size = some.select("key", slices("all").alias("slices")).distinct()
    left = some.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), slices("all") - 1))).drop("all")
    right = rows.join(size, "key").withColumn("slice", F.pmod(F.xxhash64("node"), "slices"))
    return left.join(right.drop("slices"), ["key", "slice"])


def _cross(own: DataFrame) -> DataFrame:
    """key, all, main, pairs: members, the component that most are in, and the pairs of different components."""
    counted = own.groupBy("key", "c").agg(F.count("*").alias("m"))
    found = counted.groupBy("key").agg(F.sum("m").alias("all"), F.sum(F.col("m") * F.col("m")).alias("same"), F.max(F.struct("m", "c"))["c"].alias("main"))
    return found.select("key", "all", "main", F.expr("(all * all - same) div 2").alias("pairs"))


def _pairs_of(own: DataFrame, keys: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components under the given keys: those outside a key's main component with all."""
    some = own.join(keys, "key").where("c != main").select("key", "all", F.col("node").alias("x"), F.col("n").alias("xn"), F.col("c").alias("xc"))
    met = _met(some, own).where("xc != c").where(_sized("n", "xn", percent))
    return met.select(F.least("x", "node").alias("u"), F.greatest("x", "node").alias("v")).distinct()


def _rest_pairs(bucket: DataFrame, label: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Members of one bucket that are in different components, and, beside them, the members of crowded buckets."""
    own = saved(_open(bucket, label).select("key", "node", "n", "c"), "minhash-rest")
    sizes = saved(_cross(own), "minhash-crossed")
    few, many = sizes.where(f"pairs <= all * {CROWD}"), sizes.where(f"pairs > all * {CROWD}")
    return _pairs_of(own, few, percent), own.join(many.select("key"), "key", "left_semi").select("node").distinct()


def _fine_buckets(full: DataFrame, many: int, percent: int, seed: int) -> DataFrame:
    """(key, node, n) of crowded classes under finer keys, for keys that two share. Texts that share half of their
    shingles meet under a few keys a class, however many they are; pairs at the threshold miss all with ``MISS``."""
    near = percent / 100
    rows = min(FINE[1], max(FINE[0], math.ceil(math.log(max(2, many)) / math.log(2 * near)))) if near > 0.5 else FINE[0]
    tables = math.ceil(math.log(MISS) / math.log1p(-(near**rows))) if near < 1 else 1
    sketch = Sketch(-(-tables // 2), rows, seed + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, shingles in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = shingles.values.to_numpy().view(np.uint64)
                keys = sketch.half_keys(own).ravel()
                keys = scramble(keys + np.arange(len(keys), dtype=np.uint64) * np.uint64(_MIX[1])).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), node)), pa.array(np.full(len(keys), len(own)))], ["key", "node", "n"])

    member = saved(full.select("node", "shingles").mapInArrow(tidy(run), "key long, node long, n long"), "minhash-fine")
    return member.join(member.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key"), "key")


def _fine_pairs(bucket: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components under finer keys."""
    own = saved(_open(bucket, label).select("key", "node", "n", "c"), "minhash-fine-open")
    return _pairs_of(own, _cross(own), percent)


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at 4-word shingles and 0.8."""
    return near_duplicates(documents(spark, sf_dir))
