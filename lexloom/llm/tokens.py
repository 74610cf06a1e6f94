"""Token ids of a public byte-level BPE vocabulary, a batch of texts at a time.

A blank with a character that isn't white space on either side always starts a
new pre-token, so a text falls apart there into pieces that can be encoded one
by one. The pieces of a batch are dictionary-encoded, each distinct piece is
encoded once, and the ids are gathered back by code. Texts in which some blank
stands beside other white space, and texts that hold a special token's string,
are encoded whole.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer


def _joined(words: pa.Array) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()


class Encoder:
    """``encode(column)`` gives, for each text, the ids (unsigned 32-bit) that
    ``tokenizers`` gives with ``add_special_tokens=False``. ``tiktoken`` holds the
    same vocabulary as ranks and does the merging; the JSON file decides on texts
    with special strings. Null counts as empty."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str, special: str = "<|endoftext|>"):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.whole = Tokenizer.from_file(json_path)
        self.special = special
        self.core = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def _plain(self, text: str) -> np.ndarray:
        return np.frombuffer(bytes(self.core.encode_to_tiktoken_buffer(text, set())), "<u4")

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        column = pc.fill_null(column, "")
        lists = pc.split_pattern(column, " ")
        codes = lists.flatten().dictionary_encode()
        words, codes = codes.dictionary, codes.indices.to_numpy(zero_copy_only=False)
        edges = lists.offsets.to_numpy()
        edges = edges - edges[0]
        # White space beside a blank: a text with such a piece isn't cut at its blanks.
        odd = pc.or_(pc.equal(pc.binary_length(words), 0), pc.not_equal(pc.utf8_trim_whitespace(words), words)).to_numpy(zero_copy_only=False)
        good = words.filter(pa.array(~odd))
        ids = self._plain(" " + _joined(good)) if len(good) else np.zeros(0, "<u4")
        ends = 1 + np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(pc.binary_length(good).to_numpy(zero_copy_only=False).astype(np.int64) + 1))
        place = np.cumsum(~odd) - 1
        starts = np.concatenate([[0], ends])
        begin, size = starts[place], np.where(odd, 0, starts[np.minimum(place + 1, len(ends))] - starts[place]) if len(ends) else np.zeros(len(words), np.int64)
        length = size[codes]
        length[edges[:-1][edges[:-1] < edges[1:]]] = 0  # the first piece has no blank before it
        until = np.cumsum(length)
        total = int(until[-1]) if len(until) else 0
        gathered = ids[np.repeat(begin[codes] - (until - length), length) + np.arange(total)]
        bounds = np.concatenate([[0], until])[edges]
        per_text = np.concatenate([[0], np.cumsum(odd[codes])])
        strange = per_text[edges[1:]] > per_text[edges[:-1]]
        special = pc.match_substring(column, self.special).to_numpy(zero_copy_only=False)
        out = []
        for i in range(len(column)):
            if special[i]:
                out.append(np.array(self.whole.encode(column[i].as_py(), add_special_tokens=False).ids, "<u4"))
            elif strange[i]:
                out.append(self._plain(column[i].as_py()))
            else:
                first = self._plain(words[int(codes[edges[i]])].as_py()) if edges[i] < edges[i + 1] else ids[:0]
                out.append(np.concatenate([first, gathered[bounds[i] : bounds[i + 1]]]))
        return out


@lru_cache(maxsize=4)
def encoder(vocabulary: str = "byte_bpe_50k") -> Encoder:
    """One per worker process. ``vocabulary``: a name of the public files, or a path without its suffix."""
    import public_tokenizers as public

    where = (lambda x: vocabulary + x) if "/" in vocabulary else (lambda x: public.path(vocabulary + x))
    return Encoder(where(".json"), where(".tiktoken"), public.PATTERN)
