"""Substring dedup over suffixes by bucket-pointer refinement.

A suffix starts out in the bucket of its first 24 bytes. A bucket that one document
alone reaches is finished. The others are refined by the bucket identifiers found at
later offsets of the same text: 24 bytes refined at offset 24 give buckets of 48,
those refined at offset 2 give buckets of 50, and the identifiers of one level are
reused by the next. Identifiers are 64-bit (two of them where they decide), so that
no global ranks have to be agreed upon.

Not every suffix has to be followed alone. Any 50 bytes hold one 24-byte string that
is least under a fixed order, and neighbouring suffixes mostly share it: a *run* is a
stretch of suffixes with the same least string. All suffixes of a run whose whole
stretch of bytes occurs in an earlier document are decided at once; only runs that
stay open in a bucket which another document reaches too are taken apart.

Texts are held in compressed blocks; what crosses the network are bucket
identifiers, never pairs of documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, forget, saved, texts
from .minhash import scramble
from .text_blocks import FIRST_ROWS, FIRST_SCHEMA, KEY_ROWS, KEY_SCHEMA, PART, RESULT_SCHEMA, Firsts, copied, copies, cut, first_rows, is_known, key_parts, key_rows, known_keys, of_kind, opened, parts, reduce_firsts, reduce_keys, results, side, text_blocks, with_blocks

#: Columns of what blocks get back about firsts.
FIRSTS = ("keys", "docs", "split")
#: Bytes of the first bucket and of a match; a run has at most as many suffixes as a match has first buckets.
GRAM, MATCH = 24, 50
RUN = MATCH - GRAM + 1
_RNG = np.random.default_rng(50)
_BYTES = _RNG.integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULS = _RNG.integers(0, 2**63, (2, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _refined(x: np.ndarray, family: int, level: int, offset: int) -> np.ndarray:
    """Bucket identifiers refined by those at a later offset (the tail has none and is not used)."""
    out = x * _MULS[family, level]
    out[: len(x) - offset] += x[offset:]
    return out


def _grams(data: np.ndarray, family: int) -> np.ndarray:
    x = _BYTES[family][data]
    for level, offset in enumerate((1, 2, 4, 8, 8)):  # 2, 4, 8, 16, 24 bytes
        x = _refined(x, family, level, offset) if len(x) > offset else x
    return x


def runs(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of texts laid end to end: text index, first suffix (in its text), suffixes,
    bucket of the least string, identifier of the run's bytes."""
    n = len(data)
    ends = np.cumsum(lengths)
    if n < MATCH:
        return tuple(np.zeros(0, t) for t in (np.int32, np.int64, np.int64, np.uint64, np.uint64))
    order = scramble(_grams(data, 0))
    least = order
    for offset in (1, 2, 4, 8, RUN - 16):  # over 2, 4, 8, 16, RUN starts
        least = np.minimum(least[:-offset], least[offset:])
    m = n - MATCH + 1
    least = least[:m]
    text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)[:m]
    whole = np.arange(m) + MATCH <= ends[text]
    new = np.ones(m, bool)
    new[1:] = (least[1:] != least[:-1]) | ~whole[:-1]
    start = np.flatnonzero(new & whole)
    stop = np.append(np.flatnonzero(new | ~whole), m)
    stop = stop[np.searchsorted(stop, start, "right")]
    size = stop - start
    pieces = -(-size // RUN)
    if len(pieces) and pieces.max() > 1:  # texts that repeat themselves
        at = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start, size = np.repeat(start, pieces) + at * RUN, np.minimum(RUN, np.repeat(size, pieces) - at * RUN)
    ids = _grams(data, 1)
    two = lambda x: scramble(ids[x] * _MULS[1, 5] + ids[x + 32 - GRAM])
    span = size + MATCH - 1  # 50 to 76 bytes: three buckets of 32 cover them
    key = scramble((two(start) * _MULS[1, 6] + two(start + (span - 32) // 2)) * _MULS[1, 6] + two(start + span - 32) + span.astype(np.uint64))
    which = text[start]
    return which, start - (ends - lengths)[which], size, least[start], key


def suffix_keys(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both identifiers of the 50-byte buckets at the given (rising) suffixes of a text, worked out piece by piece."""
    out = np.empty((2, len(starts)), np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = int(np.searchsorted(starts, lo + PART))
        piece = data[lo : int(starts[j - 1]) + MATCH]
        for family in (0, 1):
            x = _refined(_grams(piece, family), family, 6, GRAM)
            at = starts[i:j] - lo
            out[family, i:j] = scramble(x[at] * _MULS[family, 7] + x[at + MATCH - 2 * GRAM])
        i = j
    return out[0], out[1]


def _block_runs(row: dict, copies_: Firsts) -> tuple[np.ndarray, ...]:
    """``runs`` over a block, piece by piece, with the document of each, without the texts that have no id and
    whole copies of earlier ones. A run that a piece's end cuts becomes two, which changes no result: what is
    first in a bucket that another document reaches is looked at suffix by suffix."""
    ids, lengths, data = opened(row)
    use = np.array([x is not None for x in ids], bool)
    use[copied(row, copies_, MATCH)] = False
    found = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2]
    for i, sizes, at, base in parts(lengths, MATCH - 1):
        part = runs(np.frombuffer(data, np.uint8, sizes.sum(), at), sizes)
        own = use[part[0] + i]
        found.append([part[0][own] + i, part[1][own] + base, *(x[own] for x in part[2:])])
    which, a, n, h, k = (np.concatenate(x) for x in zip(*found, strict=True))
    return np.array([x or 0 for x in ids], np.int64)[which], which, a, n, h, k


def _least(left: pa.Table, right: pa.Table, spread: int) -> pa.Table:
    """The least strings of a block's runs, copies left out."""
    out, known = [KEY_ROWS.empty_table()], Firsts(of_kind(right, 0, *FIRSTS))
    for row in left.to_pylist():
        doc, _, _, _, h, _ = _block_runs(row, known)
        out.append(key_rows(row["block"], doc, h, spread))
    return pa.concat_tables(out)


def _run_firsts(left: pa.Table, right: pa.Table, spread: int) -> pa.Table:
    """Runs of a block in shared buckets, each bucket and stretch of bytes once."""
    out, known, shared = [FIRST_ROWS.empty_table()], Firsts(of_kind(right, 0, *FIRSTS)), known_keys(of_kind(right, 1, "h"))
    for row in left.to_pylist() if len(shared) else []:
        doc, _, _, _, h, k = _block_runs(row, known)
        use = is_known(h, shared)
        out.append(first_rows(row["block"], doc[use], h[use], k[use], spread))
    return pa.concat_tables(out)


_JUDGED = "block long, gone binary, open binary"


def _packed(*columns: np.ndarray) -> bytes:
    return np.stack([c.astype(np.int64) for c in columns], axis=1).tobytes()


def _unpacked(blobs: list[bytes]) -> np.ndarray:
    """Text index, first suffix and number of suffixes of runs."""
    return np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 3)


def _judged(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's runs that an earlier document has, and those that are first with their bytes while another document
    is first with other bytes of the same bucket: these stay open."""
    out, known, firsts = [], Firsts(of_kind(right, 0, *FIRSTS)), Firsts(of_kind(right, 2, *FIRSTS))
    for row in left.to_pylist() if len(firsts.docs) else []:
        doc, which, a, n, h, k = _block_runs(row, known)
        first, split = firsts.of(h, k)
        gone, open_ = first < doc, (first == doc) & split
        if gone.any() or open_.any():
            out.append((row["block"], _packed(which[gone], a[gone], n[gone]), _packed(which[open_], a[open_], n[open_])))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 3, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["block", "gone", "open"])


def _open_suffixes(row: dict, open_: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the open runs' suffixes: document, text index, begin and both identifiers of their 50 bytes."""
    ids, lengths, data = opened(row)
    edges, found = np.concatenate([[0], np.cumsum(lengths)]), [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2]
    open_ = open_[np.lexsort((open_[:, 1], open_[:, 0]))]
    whole = np.frombuffer(data, np.uint8)
    for i in np.unique(open_[:, 0]).tolist():
        a, n = open_[open_[:, 0] == i, 1:].T
        starts = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        same = np.full(len(starts), i)
        found.append([np.full(len(starts), ids[i]), same, starts, *suffix_keys(whole[edges[i] : edges[i + 1]], starts)])
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _suffix_firsts(left: pa.Table, right: pa.Table, spread: int) -> pa.Table:
    """The open suffixes' buckets of a block, each once."""
    out, open_ = [FIRST_ROWS.empty_table()], _unpacked(of_kind(right, 3, "open").column("open").to_pylist())
    for row in left.to_pylist() if len(open_) else []:
        doc, _, _, k1, k2 = _open_suffixes(row, open_)
        out.append(first_rows(row["block"], doc, k1, k2, spread))
    return pa.concat_tables(out)


def _without_repeats(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's documents without whole copies, repeated runs and repeated single suffixes."""
    known, firsts = Firsts(of_kind(right, 0, *FIRSTS)), Firsts(of_kind(right, 2, *FIRSTS))
    judged = of_kind(right, 3, "open", "gone")
    gone, open_ = (_unpacked(judged.column(c).to_pylist()) for c in ("gone", "open"))
    out = []
    for row in left.to_pylist():
        whole = copied(row, known, MATCH)
        doc, which, a, k1, k2 = _open_suffixes(row, open_)
        late = firsts.of(k1, k2)[0] < doc
        ranges = [(whole, np.zeros(len(whole), np.int64), np.array(row["lengths"], np.int64)[whole]), (gone[:, 0], gone[:, 1], gone[:, 1] + gone[:, 2] + MATCH - 1), (which[late], a[late], a[late] + MATCH)]
        out += cut(row, *(np.concatenate(x) for x in zip(*ranges, strict=True)))
    return results(out)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans: one row a row of ``docs``.

    Every byte goes that is covered by a 50-byte string which also starts in a document
    with a smaller doc_id; spans are the maximal removed ranges of UTF-8 bytes. Strings
    are judged on the input and never cross documents. Null texts count as empty, texts
    under 50 bytes lose nothing, rows without a doc_id lose nothing and take nothing,
    rows that repeat a doc_id take nothing from each other. Texts of any length are worked
    on in pieces that overlap by 49 bytes. An empty table gives no rows.
    """
    held = saved(text_blocks(texts(docs, id_col, text_col)), "suffix-blocks", "uncompressed")
    spread = key_parts(held)
    # A whole copy of an earlier document loses all and gives nothing that the earlier one doesn't.
    whole = copies(held, MATCH, spread)
    copies_ = side(whole, 0, *FIRSTS)
    shared = reduce_keys(with_blocks(held, copies_, lambda left, right: _least(left, right, spread), KEY_SCHEMA), "suffix-shared")
    firsts = reduce_firsts(with_blocks(held, copies_.unionByName(side(shared, 1, "h")), lambda left, right: _run_firsts(left, right, spread), FIRST_SCHEMA), "suffix-runs")
    forget(shared)
    judged = saved(with_blocks(held, copies_.unionByName(side(firsts, 2, *FIRSTS)), _judged, _JUDGED), "suffix-judged")
    forget(firsts)
    single = reduce_firsts(with_blocks(held, side(judged, 3, "open"), lambda left, right: _suffix_firsts(left, right, spread), FIRST_SCHEMA), "suffix-single")
    return with_blocks(held, copies_.unionByName(side(single, 2, *FIRSTS)).unionByName(side(judged, 3, "open", "gone")), _without_repeats, RESULT_SCHEMA)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-byte strings that earlier ones hold."""
    return suffix_dedup(documents(spark, sf_dir)).drop("spans")
