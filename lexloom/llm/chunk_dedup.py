"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text; where it falls under a threshold, a chunk
may end. The hash at a place depends on the 16 bytes before it alone, and a place
counts only if no other lies closely before it, so an insertion moves no chunk end
further than that. Chunks are known by 128-bit digests.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from .common import documents, forget, saved, texts
from .text_blocks import FIRST_ROWS, FIRST_SCHEMA, RESULT_SCHEMA, Firsts, cut, first_rows, is_known, key_parts, known_keys, opened, parts, reduce_firsts, results, shared_keys, text_blocks, with_blocks

_GEAR = np.random.default_rng(3).integers(0, 2**32, 256, dtype=np.uint32)
#: Bytes that the hash covers, mean distance of its marks, least distance between two that count, longest chunk.
WINDOW, MEAN, APART, LONGEST = 16, 12, 12, 256


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash behind every byte: ``h = (h << 1) + gear[byte]`` over the last ``WINDOW`` bytes."""
    x = _GEAR[data]
    for k in (1, 2, 4, 8):
        y = x.copy()
        y[k:] += x[:-k] << np.uint32(k)
        x = y
    return x


def marks(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where chunks of texts laid end to end may end: a mark lies ``WINDOW`` bytes into its text at least,
    and none other closely before it."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    mixed = gear(data) * np.uint32(0x9E3779B1)
    mark = np.flatnonzero(mixed < np.uint32(2**32 // MEAN)) + 1  # a chunk ends before this byte
    text = np.searchsorted(ends, mark - 1, "right")
    mark = mark[mark - begins[text] >= WINDOW]
    text = np.searchsorted(ends, mark - 1, "right")
    alone = np.ones(len(mark), bool)
    alone[1:] = (np.diff(mark) >= APART) | (text[1:] != text[:-1])
    return mark[alone]


def tiles(stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of chunks up to each stop, the longest ones cut."""
    starts = np.concatenate([[0], stops[:-1]])
    pieces = -(-(stops - starts) // LONGEST)
    if len(pieces) and pieces.max() > 1:
        at = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, stops = np.repeat(starts, pieces) + at * LONGEST, np.repeat(stops, pieces)
        stops = np.minimum(stops, starts + LONGEST)
    return starts, stops


def chunks(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of texts laid end to end: text index, begin and end (in ``data``). They tile every text."""
    ends = np.cumsum(lengths)
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    starts, stops = tiles(np.unique(np.concatenate([marks(data, lengths), ends[lengths > 0]])))
    return np.searchsorted(ends, starts, "right"), starts, stops


def _block_chunks(ids: list, lengths: np.ndarray, data: bytes) -> tuple[np.ndarray, ...]:
    """Text index, begin, end (in its text) and both halves of the digest, for texts with an id."""
    known = np.array([x is not None for x in ids], bool)
    found, stops = [(np.zeros(0, np.int64),) * 3], [np.zeros(0, np.int64)]
    begins = np.cumsum(lengths) - lengths
    for i, sizes, at, base in parts(lengths):
        if base or sizes[0] < lengths[i]:  # a piece of a long text: only where its chunks end
            lead = min(base, WINDOW + APART)
            piece = np.frombuffer(data, np.uint8, sizes[0] + lead, at - lead)
            end = marks(piece, np.array([len(piece)])) + base - lead
            stops.append(end[(end > base) & (end <= base + sizes[0])])
            if base + sizes[0] == lengths[i]:
                a, z = tiles(np.unique(np.append(np.concatenate(stops), lengths[i])))
                found.append((np.full(len(a), i), a, z))
                stops = stops[:1]
            continue
        which, a, z = chunks(np.frombuffer(data, np.uint8, sizes.sum(), at), sizes)
        found.append((which + i, a + at - begins[which + i], z + at - begins[which + i]))
    which, a, z = (np.concatenate(x) for x in zip(*found, strict=True))
    use = known[which]
    which, a, z = which[use], a[use], z[use]
    view, digest, start = memoryview(data), xxhash.xxh3_128_digest, begins[which]
    both = np.frombuffer(b"".join([digest(view[x:y]) for x, y in zip((a + start).tolist(), (z + start).tolist(), strict=True)]), np.uint64).reshape(-1, 2)
    return which, a, z, both[:, 0].copy(), both[:, 1].copy()


def _digests(ids: list, lengths: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = _block_chunks(ids, lengths, data)
    return found[0], found[3]


def _repeated(left: pa.Table, right: pa.Table, spread: int) -> pa.Table:
    """A block's chunks whose digest may be found in another document, each digest once."""
    out = [FIRST_ROWS.empty_table()]
    if right.num_rows:
        known = known_keys(right)
        for row in left.to_pylist():
            ids, lengths, data = opened(row)
            which, _, _, h, k = _block_chunks(ids, lengths, data)
            use = is_known(h, known)
            out.append(first_rows(row["block"], np.array([x or 0 for x in ids], np.int64)[which[use]], h[use], k[use], spread))
    return pa.concat_tables(out)


def _without_late(left: pa.Table, right: pa.Table, least: int) -> pa.Table:
    """A block's documents without the chunks that a document with a smaller id has."""
    known, out = Firsts(right), []
    for row in left.to_pylist():
        ids, lengths, data = opened(row)
        which, a, z, h, k = _block_chunks(ids, lengths, data)
        late = known.of(h, k)[0] < np.array([x or 0 for x in ids], np.int64)[which]
        out += cut(row, which[late], a[late], z[late], least)
    return results(out)


def chunk_dedup(docs: DataFrame, least: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans: one row a row of ``docs``.

    A chunk is repeated if a document with a smaller doc_id has one of the same digest;
    repeated chunks side by side that make up ``least`` bytes or more are removed, as
    ranges of UTF-8 bytes. Null texts count as empty; rows without a doc_id lose nothing
    and take nothing; rows that repeat a doc_id take nothing from each other; chunks
    never cross documents. Texts of any length are worked on in pieces that give the same
    chunks. An empty table gives no rows.
    """
    held = saved(text_blocks(texts(docs, id_col, text_col)), "chunk-blocks", "uncompressed")
    spread = key_parts(held)
    shared = shared_keys(held, _digests, "chunk-shared", spread)
    firsts = reduce_firsts(with_blocks(held, shared, lambda left, right: _repeated(left, right, spread), FIRST_SCHEMA), "chunk-firsts")
    forget(shared)
    return with_blocks(held, firsts, lambda left, right: _without_late(left, right, least), RESULT_SCHEMA)


def op3_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the chunks that earlier ones hold."""
    return chunk_dedup(documents(spark, sf_dir)).drop("spans")
