"""Byte-level BPE encoding and decoding.

A piece of text (one match of the split pattern) is a row of byte positions. Over the positions
stands a segment tree whose leaves hold the rank of the pair that starts there and whose root holds
the leftmost minimum rank. A merge changes three leaves (the pair itself, its right half, its left
neighbour), each a logarithmic point update. Trees of equal width are kept as rows of one numpy
array, so that one step merges the best pair of every piece of a batch.

Cases: null text counts as empty and gives no ids; a text of any length is taken whole; equal rows
give equal results; an empty table gives an empty table; further columns pass through untouched.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: Entries of the piece cache of a worker; it is emptied when full, results do not depend on it.
CACHE_PIECES = 600_000
#: Leaves of the trees that are built at once.
FOREST_LEAVES = 1 << 19

_NONE = np.iinfo(np.int64).max


class Vocabulary:
    """Ranks of a byte-level vocabulary and its pair table."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.names = [str(i) for i in range(size)]
        #: one object per id, as caches hold many
        self.ids = list(range(size))
        self.bytes_to_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        found: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        # open addressing at a quarter full; `probes` is the longest search
        self.slots = 1 << (4 * len(found)).bit_length()
        self.pair_keys = np.full(self.slots, -1, dtype=np.int64)
        self.pair_ranks = np.full(self.slots, _NONE, dtype=np.int64)
        keys = np.fromiter(found, dtype=np.int64, count=len(found))
        ranks = np.fromiter(found.values(), dtype=np.int64, count=len(found))
        slot, self.probes = self._slot(keys), 0
        while len(keys):
            self.probes += 1
            free = self.pair_keys[slot] == -1
            self.pair_keys[slot[free]] = keys[free]
            self.pair_ranks[slot[free]] = ranks[free]
            left = self.pair_keys[slot] != keys
            # of keys that met in a free slot the last one written stays; its rank goes with it
            self.pair_ranks[slot[~left]] = ranks[~left]
            keys, ranks, slot = keys[left], ranks[left], (slot[left] + 1) & (self.slots - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * 0x9E3779B97F4A7C1 & (1 << 62) - 1) >> 35) & (self.slots - 1)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's concatenation, ``_NONE`` where the vocabulary has none."""
        keys = left << 32 | right
        slot = self._slot(keys)
        found = np.full(len(keys), _NONE)
        open_ = np.arange(len(keys))
        for _ in range(self.probes):
            there = self.pair_keys[slot]
            hit = there == keys
            found[open_[hit]] = self.pair_ranks[slot[hit]]
            go = ~hit & (there != -1)
            if not go.any():
                break
            open_, keys, slot = open_[go], keys[go], (slot[go] + 1) & (self.slots - 1)
        return found


@functools.lru_cache(maxsize=4)
def vocabulary(ranks_path: str) -> Vocabulary:
    return Vocabulary(ranks_path)


@functools.lru_cache(maxsize=4)
def splitter(pattern: str) -> regex.Pattern:
    # white space as the Unicode property; the regex module's own \s also takes four separators
    return regex.compile(
        pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    )


class Forest:
    """Segment trees of equal width over the byte positions of several pieces, in flat arrays."""

    def __init__(self, vocab: Vocabulary, pieces: list[bytes], width: int):
        n = len(pieces)
        self.vocab, self.width, self.n = vocab, width, n
        self.shift = width.bit_length() - 1
        length = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)
        self.token = vocab.bytes_to_id[flat]
        where = np.arange(width)
        live = where < length[:, None]
        self.live = live.reshape(-1)
        self.after = np.tile(where + 1, n)
        self.before = np.tile(where - 1, n)
        self.length = length
        ranks = np.full(n * width, _NONE)
        pair = np.flatnonzero(self.live[1:])
        pair = pair[(pair + 1) & (width - 1) != 0]  # position `pair + 1` lives in the same piece
        ranks[pair] = vocab.pair_rank(self.token[pair], self.token[pair + 1])
        tree = np.full((n, 2 * width), _NONE)
        tree[:, width:] = self._leaf(ranks, np.tile(where, n)).reshape(n, width)
        step = width
        while step > 1:
            level = tree[:, step : 2 * step]
            step //= 2
            tree[:, step : 2 * step] = np.minimum(level[:, 0::2], level[:, 1::2])
        self.tree = tree.reshape(-1)

    def _leaf(self, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank and position in one number, so that the minimum is the leftmost minimum."""
        return np.where(ranks == _NONE, _NONE, (ranks << self.shift) | at)

    def _put(self, row: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        """Point updates of leaves (rows may repeat), with all nodes above them."""
        tree, base = self.tree, row * (2 * self.width)
        node = at + self.width
        tree[base + node] = value
        for _ in range(self.shift):
            child = base + (node & ~1)
            node >>= 1
            tree[base + node] = np.minimum(tree[child], tree[child + 1])

    def merge(self) -> list[list[int]]:
        """Merge until no pair is left; the ids of every piece."""
        width, token, after, before = self.width, self.token, self.after, self.before
        row = np.arange(self.n)
        while True:
            root = self.tree[row * (2 * width) + 1]
            more = root != _NONE
            row, root = row[more], root[more]
            if not len(row):
                break
            base, end = row * width, self.length[row]
            at, rank = root & (width - 1), root >> self.shift
            right = after[base + at]
            beyond = after[base + right]
            token[base + at] = rank
            self.live[base + right] = False
            after[base + at] = beyond
            left = before[base + at]
            ranks = np.full(len(row), _NONE)
            has = beyond < end
            next_at = (base + beyond)[has]
            before[next_at] = at[has]
            ranks[has] = self.vocab.pair_rank(rank[has], token[next_at])
            led = left >= 0
            led_ranks = self.vocab.pair_rank(token[(base + left)[led]], rank[led])
            self._put(
                np.concatenate([row, row, row[led]]),
                np.concatenate([right, at, left[led]]),
                np.concatenate(
                    [np.full(len(row), _NONE), self._leaf(ranks, at), self._leaf(led_ranks, left[led])]
                ),
            )
        ids = token[self.live].tolist()
        ends = np.cumsum(self.live.reshape(self.n, width).sum(axis=1)).tolist()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def encode_pieces(vocab: Vocabulary, pieces: list[bytes]) -> list[tuple[int, ...]]:
    """Ids of each piece, in the order given."""
    out: list[tuple[int, ...]] = [()] * len(pieces)
    by_width: dict[int, list[int]] = {}
    for i, piece in enumerate(pieces):
        whole = vocab.ranks.get(piece)
        if whole is not None:
            out[i] = (whole,)
        elif piece:
            by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
    for width, members in by_width.items():
        step = max(1, FOREST_LEAVES // width)
        for start in range(0, len(members), step):
            some = members[start : start + step]
            for i, ids in zip(some, Forest(vocab, [pieces[i] for i in some], width).merge(), strict=True):
                out[i] = tuple(map(vocab.ids.__getitem__, ids))
    return out


class Encoder:
    """Encodes texts, keeping the ids of what it has met.

    A space that a non-space follows always begins a piece, so a text in which each space is of that
    kind falls apart before its spaces, and what lies between them is looked up as a whole. Other
    texts go through the pattern from end to end.
    """

    def __init__(self, ranks_path: str, pattern: str):
        self.vocab, self.split = vocabulary(ranks_path), splitter(pattern)
        self.known: dict[str, tuple[int, ...]] = {}
        #: ids of parts that a space stands before
        self.spaced: dict[str, tuple[int, ...]] = {}
        self.run = regex.compile(r" (?:\p{White_Space}|$)")

    def encode(self, texts: list[str]) -> list[list[int]]:
        if len(self.known) + len(self.spaced) > CACHE_PIECES:
            self.known.clear()
            self.spaced.clear()
        split, new, new_spaced = [], set(), set()
        for text in texts:
            if self.run.search(text):
                first, rest = self.split.findall(text), []
            else:
                start, *rest = text.split(" ")
                first = [start]
            new.update(p for p in first if p not in self.known)
            new_spaced.update(itertools.filterfalse(self.spaced.__contains__, rest))
            split.append((first, rest))
        self._learn(new, new_spaced)
        flat = chain.from_iterable
        return [
            list(chain(flat(map(self.known.__getitem__, a)), flat(map(self.spaced.__getitem__, b))))
            for a, b in split
        ]

    def _learn(self, new: set[str], new_spaced: set[str]) -> None:
        find = self.split.findall
        for store, parts, lead in ((self.known, list(new), ""), (self.spaced, list(new_spaced), " ")):
            pieces = [find(lead + p) for p in parts]
            each = list(set(chain.from_iterable(pieces)))
            ids = dict(zip(each, encode_pieces(self.vocab, [p.encode() for p in each]), strict=True))
            for part, own in zip(parts, pieces, strict=True):
                store[part] = ids[own[0]] if len(own) == 1 else tuple(chain.from_iterable(map(ids.__getitem__, own)))


@functools.lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> Encoder:
    return Encoder(ranks_path, pattern)


def decode(vocab: Vocabulary, ids: list[int]) -> bytes:
    return b"".join(map(vocab.tokens.__getitem__, ids))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``ids`` array<int>."""
    return map_texts(
        docs, "ids array<int>", lambda t: {"ids": encoder(ranks_path, pattern).encode(t)}, text
    )


def decode_documents(docs: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded`` binary: the bytes of the column ``ids``; null ids give no bytes."""

    @F.pandas_udf("binary")
    def joined(column):
        vocab = vocabulary(ranks_path)
        return column.map(lambda x: decode(vocab, x.tolist() if x is not None else []))

    return docs.withColumn("decoded", joined(F.col(ids)))


def encoding_digests(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Number of ids, and SHA-256 of the ids and of the bytes they decode to.

    Encodes, decodes and digests in the worker, so that ids and bytes need not travel.
    """

    def make(texts: list[str]) -> dict[str, list]:
        own = encoder(ranks_path, pattern)
        names = own.vocab.names
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for ids in own.encode(texts):
            out["n_tokens"].append(len(ids))
            listed = " ".join(map(names.__getitem__, ids)).encode()
            out["ids_sha256"].append(hashlib.sha256(listed).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decode(own.vocab, ids)).hexdigest())
        return out

    return map_texts(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string", make, text)
