"""Texts in compressed blocks, the keys that blocks share, and the cutting of ranges.

Passages that repeat are found in two steps. Each block reports its distinct keys, and
gets back those that a second document reaches; only what lies under such keys is then
looked at closely. So keys that one document alone has, most of them, cross the
network once and as bare numbers. Which document has a key first is settled the same way:
a block reports each key once with its own smallest document, however many of its
documents share it, and gets the smallest of all back. No row a passage is ever joined,
so a passage that very many documents hold costs one entry a block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_bytes, saved, tidy, tidy_group

#: Bytes that are worked on at once; a block holds eight times as many, and a part of the keys stands for so much text.
PART, KEYS_OF = 1 << 19, 64 << 20

#: (ids, lengths, texts laid end to end) to (text index, key) of whatever may repeat, texts without an id left out.
Keys = Callable[[list, np.ndarray, bytes], tuple[np.ndarray, np.ndarray]]


def parts(lengths: np.ndarray, overlap: int = 0) -> Iterator[tuple[int, np.ndarray, int, int]]:
    """Pieces of a block of about ``PART`` bytes: first text, lengths of its texts, begin in the block, begin in
    the first text. A text longer than that comes in pieces of its own, each with ``overlap`` bytes of the next."""
    at, total, edge = 0, 0, 0
    for i, n in enumerate(lengths.tolist()):
        if n > 2 * PART:
            if i > at:
                yield at, lengths[at:i], edge - total, 0
            for lo in range(0, n - overlap, PART):
                yield i, np.array([min(PART + overlap, n - lo)]), edge + lo, lo
            at, total = i + 1, 0
        else:
            total += n
            if total >= PART:
                yield at, lengths[at : i + 1], edge + n - total, 0
                at, total = i + 1, 0
        edge += n
    if at < len(lengths):
        yield at, lengths[at:], edge - total, 0


def text_blocks(docs: DataFrame) -> DataFrame:
    """Documents as compressed blocks: block, nbytes, doc_ids, lengths, 128-bit digests, texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, part, k = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, ids = raw_bytes(batch.column(1)), batch.column(0).to_pylist()
            at, total = 0, 0
            for i in range(len(rows)):
                total += len(rows[i])
                if i + 1 == len(rows) or total >= 8 * PART or i - at >= 4000:
                    own, total = rows[at : i + 1], 0
                    yield pa.RecordBatch.from_arrays([pa.array([part << 32 | k], pa.int64()), pa.array([sum(map(len, own))], pa.int64()), pa.array([ids[at : i + 1]], pa.list_(pa.int64())), pa.array([[len(x) for x in own]], pa.list_(pa.int64())), pa.array([[xxhash.xxh3_128_digest(x) for x in own]], pa.list_(pa.binary())), pa.array([pack.compress(b"".join(own))], pa.binary())], ["block", "nbytes", "ids", "lengths", "digests", "texts"])
                    at, k = i + 1, k + 1

    return docs.mapInArrow(tidy(run), "block long, nbytes long, ids array<long>, lengths array<long>, digests array<binary>, texts binary")


def opened(row: dict) -> tuple[list, np.ndarray, bytes]:
    return row["ids"], np.array(row["lengths"], np.int64), zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=max(1, row["nbytes"]))


KEY_ROWS = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("h", pa.binary()), ("many", pa.binary())])
KEY_SCHEMA = "part long, block long, h binary, many binary"


def key_rows(block: int, doc: np.ndarray, h: np.ndarray, spread: int) -> pa.Table:
    """A block's distinct keys by a part of their hash: part, block, keys, and which of them two documents of the block share."""
    if not len(h):
        return KEY_ROWS.empty_table()
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    many, h = doc[first] != doc[np.append(first[1:], len(h)) - 1], h[first]
    part = (h >> np.uint64(24)) % np.uint64(spread)
    order = np.argsort(part, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(part[order].view(np.int64))) + 1)
    return pa.table([[int(part[g[0]]) for g in groups], [block] * len(groups), [h[g].tobytes() for g in groups], [np.packbits(many[g]).tobytes() for g in groups]], schema=KEY_ROWS)


def _block_keys(held: DataFrame, spread: int, keys: Keys) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths, data = opened(row)
                which, h = keys(ids, lengths, data)
                yield from key_rows(row["block"], np.array([x or 0 for x in ids], np.int64)[which], h, spread).to_batches()

    return held.mapInArrow(tidy(run), KEY_SCHEMA)


def _shared(part: pa.Table) -> pa.Table:
    """Of one part's keys, for each block those that a second document reaches."""
    blocks, blobs, flags = (part.column(c).to_pylist() for c in ("block", "h", "many"))
    own = [np.frombuffer(x, np.uint64) for x in blobs]
    every = np.sort(np.concatenate(own))
    twice = every[1:][every[1:] == every[:-1]]
    multi = np.concatenate([x[np.unpackbits(np.frombuffer(f, np.uint8), count=len(x)).astype(bool)] for x, f in zip(own, flags, strict=True)])
    keep = np.unique(np.concatenate([twice, multi]))
    found = [(b, x[np.isin(x, keep, assume_unique=True)]) for b, x in zip(blocks, own, strict=True)]
    found = [(b, x) for b, x in found if len(x)]
    return pa.table({"block": pa.array([b for b, _ in found], pa.int64()), "h": pa.array([x.tobytes() for _, x in found], pa.binary())})


def key_parts(held: DataFrame) -> int:
    """Into how many parts the keys of these blocks are dealt: as many as keep a part small."""
    return max(256, math.ceil((held.agg(F.sum("nbytes")).first()[0] or 0) / KEYS_OF))


FIRST_ROWS = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary()), ("many", pa.binary())])
FIRST_SCHEMA = "part long, block long, keys binary, docs binary, many binary"


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows of the columns change."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def first_rows(block: int, doc: np.ndarray, h: np.ndarray, k: np.ndarray, spread: int) -> pa.Table:
    """A block's distinct 128-bit keys (h, k) by a part of h, each with the block's smallest document that
    has it and whether a second one does."""
    if not len(h):
        return FIRST_ROWS.empty_table()
    order = np.lexsort((doc, k, h))
    h, k, doc = h[order], k[order], doc[order]
    first = _starts(h, k)
    many = doc[first] != doc[np.append(first[1:], len(h)) - 1]
    h, k, doc = h[first], k[first], doc[first]
    part = (h >> np.uint64(24)) % np.uint64(spread)
    order = np.argsort(part, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(part[order].view(np.int64))) + 1)
    both = np.stack([h, k], axis=1)
    return pa.table([[int(part[g[0]]) for g in groups], [block] * len(groups), [both[g].tobytes() for g in groups], [doc[g].tobytes() for g in groups], [np.packbits(many[g]).tobytes() for g in groups]], schema=FIRST_ROWS)


def _firsts(part: pa.Table) -> pa.Table:
    """Of one part's keys, for each block those that a second document has, or under whose h two documents are
    first with different k (``split``), with the smallest document of all."""
    blocks, blobs, docs, flags = (part.column(c).to_pylist() for c in ("block", "keys", "docs", "many"))
    sizes = np.array([len(x) // 8 for x in docs], np.int64)
    keys = np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, 2)
    doc = np.frombuffer(b"".join(docs), np.int64)
    many = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=n) for f, n in zip(flags, sizes, strict=True)]).astype(bool)
    order = np.lexsort((doc, keys[:, 1], keys[:, 0]))
    h, k, d = keys[order, 0], keys[order, 1], doc[order]
    start = _starts(h, k)
    first = d[start]
    repeated = (first < d[np.append(start[1:], len(d)) - 1]) | np.logical_or.reduceat(many[order], start)
    bucket = _starts(h[start])
    width = np.diff(np.append(bucket, len(start)))
    split = np.repeat(np.minimum.reduceat(first, bucket) < np.maximum.reduceat(first, bucket), width)
    group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(d))))
    back = np.empty(len(order), np.int64)
    back[order] = group
    keep = (repeated | split)[back]
    out = []
    for block, i, j in zip(blocks, (np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist(), strict=True):
        use = np.flatnonzero(keep[i:j]) + i
        if len(use):
            out.append((block, keys[use].tobytes(), first[back[use]].tobytes(), np.packbits(split[back[use]]).tobytes()))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["block", "keys", "docs", "split"])


def reduce_firsts(rows: DataFrame, name: str) -> DataFrame:
    return saved(rows.groupBy("part").applyInArrow(tidy_group(_firsts), "block long, keys binary, docs binary, split binary"), name, "uncompressed")


class Firsts:
    """What a block got back from ``reduce_firsts``: for a key its first document, and whether its h is split."""

    def __init__(self, rows: pa.Table):
        keys, docs, split = (rows.column(c).to_pylist() for c in ("keys", "docs", "split"))
        self.keys = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
        self.docs = np.frombuffer(b"".join(docs), np.int64)
        self.split = np.concatenate([np.zeros(0, np.uint8), *(np.unpackbits(np.frombuffer(f, np.uint8), count=len(x) // 8) for f, x in zip(split, docs, strict=True))]).astype(bool)
        self.sorted = np.argsort(_joint(self.keys[:, 0], self.keys[:, 1]), kind="stable")
        self.joint = _joint(self.keys[:, 0], self.keys[:, 1])[self.sorted]

    def of(self, h: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document (the largest number where a key isn't known) and split flag of every key."""
        first, split = np.full(len(h), np.iinfo(np.int64).max), np.zeros(len(h), bool)
        if len(self.joint) and len(h):
            at = np.searchsorted(self.joint, _joint(h, k))
            for step in (0, 1):  # two keys may share a joint hash
                place = self.sorted[np.minimum(at + step, len(self.joint) - 1)]
                same = (self.keys[place, 0] == h) & (self.keys[place, 1] == k)
                first[same], split[same] = self.docs[place[same]], self.split[place[same]]
        return first, split


def _joint(h: np.ndarray, k: np.ndarray) -> np.ndarray:
    return h * np.uint64(0x9E3779B97F4A7C15) ^ k


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def copies(held: DataFrame, least: int, spread: int) -> DataFrame:
    """First documents of texts of ``least`` bytes or more that two documents have whole, by 128-bit digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                use = [i for i, (doc, n) in enumerate(zip(row["ids"], row["lengths"], strict=True)) if doc is not None and n >= least]
                yield from first_rows(row["block"], np.array([row["ids"][i] for i in use], np.int64), *_halves([row["digests"][i] for i in use]), spread).to_batches()

    return reduce_firsts(held.select("block", "ids", "lengths", "digests").mapInArrow(tidy(run), FIRST_SCHEMA), "copies")


def copied(row: dict, known: Firsts, least: int) -> np.ndarray:
    """Rows of a block whose whole text a document with a smaller id has."""
    doc = np.array([np.iinfo(np.int64).min if x is None else x for x in row["ids"]], np.int64)
    first, _ = known.of(*_halves(row["digests"]))
    return np.flatnonzero((first < doc) & (np.array(row["lengths"]) >= least))


def reduce_keys(rows: DataFrame, name: str) -> DataFrame:
    return saved(rows.groupBy("part").applyInArrow(tidy_group(_shared), "block long, h binary"), name, "uncompressed")


def shared_keys(held: DataFrame, keys: Keys, name: str, spread: int) -> DataFrame:
    """block and its keys (unsigned 64-bit, several rows a block) that two documents have, anywhere."""
    return reduce_keys(_block_keys(held, spread, keys), name)


def known_keys(right: pa.Table) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(right.column("h").to_pylist()), np.uint64))


def is_known(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys if len(known) else np.zeros(len(keys), bool)


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def merged(begin: np.ndarray, end: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of a set of half-open ranges."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, top = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > top[:-1])
    begin, end = begin[new], top[np.append(np.flatnonzero(new)[1:], len(begin)) - 1]
    long = end - begin >= least
    return begin[long], end[long]


RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"


def cut(row: dict, which: np.ndarray, a: np.ndarray, z: np.ndarray, least: int = 1) -> list[tuple]:
    """Results of a block's documents without the ranges [a, z) of the texts ``which``; ranges that touch are
    taken as one and those under ``least`` bytes left."""
    ids, lengths, data = opened(row)
    edges, out = np.concatenate([[0], np.cumsum(lengths)]).tolist(), []
    order = np.argsort(which, kind="stable")
    which, a, z = which[order], a[order], z[order]
    bounds = np.searchsorted(which, np.arange(len(ids) + 1))
    for i, doc in enumerate(ids):
        text = data[edges[i] : edges[i + 1]]
        own = slice(bounds[i], bounds[i + 1])
        begin, end = (x.tolist() for x in merged(a[own], z[own], least))
        kept = b"".join(text[x:y] for x, y in zip([0, *end], [*begin, len(text)], strict=True))
        out.append((doc, len(text), len(text) - len(kept), len(begin), hashlib.sha256(kept).hexdigest(), [{"start": x, "end": y} for x, y in zip(begin, end, strict=True)]))
    return out


def results(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RESULT, strict=True)], schema=RESULT) if rows else RESULT.empty_table()


SIDE = ("x", "y", "z")


def side(table: DataFrame, kind: int, *columns: str) -> DataFrame:
    """A table that blocks get back, as rows of one common shape: block, kind, and up to three binary columns."""
    own = [F.col(c).alias(n) for c, n in zip(columns, SIDE, strict=False)]
    return table.select("block", F.lit(kind).alias("kind"), *own, *(F.lit(None).cast("binary").alias(n) for n in SIDE[len(columns) :]))


def of_kind(right: pa.Table, kind: int, *columns: str) -> pa.Table:
    """The rows of one kind under their own column names."""
    own = right.filter(pc.equal(right.column("kind"), kind)) if right.num_rows else right
    return pa.table([own.column(n) if own.num_rows else pa.array([], pa.binary()) for n in SIDE[: len(columns)]], list(columns))


def with_blocks(held: DataFrame, side: DataFrame, f, schema: str) -> DataFrame:
    return held.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(tidy_group(f), schema)
