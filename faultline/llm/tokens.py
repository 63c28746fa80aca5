"""Byte-level BPE ids of whole Arrow columns.

A text is cut before each single space that a non-space follows: the
pre-tokeniser always starts a new piece there, so the ids of a text are those
of its cuts, one after the other.  Each distinct cut is encoded once and kept
in a bounded table; texts are put together from it with numpy.  Texts that
hold a special token's string are encoded whole by the tokenizer itself.
"""

from __future__ import annotations

import base64
import json
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from faultline.llm import text

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Distinct cuts that a worker keeps.
KEPT = 250_000

#: A byte after a space that leaves open whether white space goes on: ASCII
#: white space and controls, and the lead bytes of other Unicode spaces.
_unsure = np.zeros(256, bool)
_unsure[:33] = True
_unsure[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs ``values[start:start + length]``, one after the other."""
    end = np.cumsum(length)
    at = np.repeat(start - (end - length), length)
    at += np.arange(len(at))
    return values[at]


class Encoder:
    def __init__(self, vocabulary: str, ranks: str):
        self.vocabulary = vocabulary
        with open(vocabulary) as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        with open(ranks, "rb") as f:
            by_bytes = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=by_bytes,
                                      special_tokens={})
        self.size = np.zeros(max(by_bytes.values()) + 1, np.int64)
        for b, i in by_bytes.items():
            self.size[i] = len(b)
        self.clear()

    @cached_property
    def whole(self) -> Tokenizer:
        return Tokenizer.from_file(self.vocabulary)

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, data: np.ndarray, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Encode cuts that are not kept yet."""
        spaced = data[start] == 32
        order = np.argsort(~spaced, kind="stable")
        keys, start, end, k = keys[order], start[order], end[order], int(spaced.sum())
        size = end - start
        got = np.array(self.fast.encode_ordinary(gather(data, start[:k], size[:k]).tobytes().decode()), np.uint32)
        upto, stops = np.cumsum(self.size[got]), np.cumsum(size[:k])
        last = np.searchsorted(upto, stops)
        if k and not (last[-1] < len(upto) and (upto[last] == stops).all()):
            raise ValueError("a cut is not a boundary of the pre-tokeniser")
        counts = np.diff(last + 1, prepend=0)
        rest = [np.array(self.fast.encode_ordinary(data[a:b].tobytes().decode()), np.uint32)
                for a, b in zip(start[k:], end[k:])]
        counts = np.concatenate((counts, [len(x) for x in rest])).astype(np.int64)
        first = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate((self.ids, got, *rest))
        keys = np.concatenate((self.keys, keys))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.start = np.concatenate((self.start, first))[order]
        self.count = np.concatenate((self.count, counts))[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        at = np.minimum(at, max(len(self.keys) - 1, 0))
        return at, self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in one chunk and the n + 1 offsets of each text's ids."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if any(s.encode() in data.tobytes() for s in self.special):
            ids = [np.array(self.whole.encode(data[a:b].tobytes().decode(), add_special_tokens=False).ids, np.uint32)
                   for a, b in zip(off[:-1], off[1:])]
            return np.concatenate(ids), np.concatenate(([0], np.cumsum([len(x) for x in ids])))
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        cut = data == 32
        cut[:-1] &= ~_unsure[data[1:]] & ~edge[1:n]
        cut[-1] = False
        cut |= edge[:n]
        start = np.flatnonzero(cut)
        end = np.append(start[1:], n)
        keys, first, own = np.unique(text.span_hashes(data, start, end), return_index=True, return_inverse=True)
        at, known = self.find(keys)
        if not known.all():
            if len(self.keys) + int((~known).sum()) > KEPT:
                self.clear()
                known[:] = False
            new = first[~known]
            self.learn(data, keys[~known], start[new], end[new])
            at, _ = self.find(keys)
        count = self.count[at][own]
        ids = gather(self.ids, self.start[at][own], count)
        ends = np.concatenate(([0], np.cumsum(count)))
        return ids, ends[np.searchsorted(start, off)]


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str | None = None, ranks: str | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file and the same vocabulary as ranks."""
    paths = vocabulary or public_tokenizers.path(VOCABULARY), ranks or public_tokenizers.path(RANKS)
    if paths not in _encoders:
        _encoders[paths] = Encoder(*paths)
    return _encoders[paths]


def encode_column(column: pa.Array, enc: Encoder):
    """(first row, end row, ids, offsets) of runs of rows."""
    for i, j, data, off in text.chunks(column):
        ids, ends = enc.encode(data, off)
        yield i, j, ids, ends
