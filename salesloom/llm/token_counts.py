"""Token counts under a word-level BPE vocabulary, by rank-synchronous array merging.

Texts are split at the vocabulary's special strings (one token each), normalised (NFC, lower case)
and cut into pre-tokens. The distinct pre-tokens of a chunk that are not known yet lie as symbols in
one ragged numpy array. In each round every sequence applies its lowest-ranked pair at all places at
once, left to right; when no sequence has a ranked pair left, the surviving symbols are counted.
Applying all places at once equals merging one by one as long as every merge that uses a symbol comes
after the merge that makes it; ``Merges`` refuses a vocabulary where that does not hold.

Cases: null text counts as empty and has 0 tokens; texts are taken whole; equal rows give equal
results; an empty table gives an empty table; further columns pass through untouched.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_texts

#: Entries of the count cache of a worker; it is emptied when full, results do not depend on it.
CACHE_PIECES = 1_000_000
#: Symbols merged together at a time; a longer pre-token is merged alone.
BATCH_SYMBOLS = 1 << 19

_NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class Merges:
    """Merge ranks of a tokenizer file whose words end in a suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], dtype=np.int64)
        self.final = np.array([ids[s + suffix] for s in symbols], dtype=np.int64)
        left = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        rank = np.arange(len(pairs))
        first_use = np.full(max(ids.values()) + 1, len(pairs))
        np.minimum.at(first_use, np.concatenate([left, right]), np.tile(rank, 2))
        if (first_use[self.made] < rank).any():
            raise ValueError("a merge uses a symbol that a later merge makes")
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], rank[order]
        added = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        split = next(
            p["pattern"]["Regex"]
            for p in spec["pre_tokenizer"]["pretokenizers"]
            if p["type"] == "Split"
        )
        self.split = regex.compile(split.replace(r"\s", r"\p{White_Space}"))

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols that survive in each piece, none of them empty."""
        out = np.zeros(len(pieces), dtype=np.int64)
        start = 0
        while start < len(pieces):
            end, held = start, 0
            while end < len(pieces) and (end == start or held + len(pieces[end]) <= BATCH_SYMBOLS):
                held += len(pieces[end])
                end += 1
            out[start:end] = self._count_batch(pieces[start:end])
            start = end
        return out

    def _count_batch(self, pieces: list[bytes]) -> np.ndarray:
        length = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        symbol = self.inner[flat]
        last = np.cumsum(length) - 1
        symbol[last] = self.final[flat[last]]
        out = length.copy()
        member = np.arange(len(pieces))  # the piece each open sequence stands for
        while len(member):
            first = np.cumsum(length) - length
            rank = np.full(len(symbol), _NONE)
            rank[:-1] = self.pair_rank(symbol[:-1], symbol[1:])
            rank[first + length - 1] = _NONE  # no pair reaches into the next sequence
            lowest = np.minimum.reduceat(rank, first)
            more = lowest != _NONE
            if not more.all():
                out[member[~more]] = length[~more]
                keep = np.repeat(more, length)
                symbol, rank = symbol[keep], rank[keep]
                member, length, lowest = member[more], length[more], lowest[more]
                if not len(member):
                    break
            hit = rank == np.repeat(lowest, length)
            at = np.flatnonzero(hit)
            # in a run of overlapping places (a a a) every second one, from the left, merges
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            run = np.maximum.accumulate(np.where(fresh, at, 0))
            at = at[(at - run) % 2 == 0]
            symbol[at] = self.made[rank[at]]
            stays = np.ones(len(symbol), dtype=bool)
            stays[at + 1] = False
            first = np.cumsum(length) - length
            length = np.add.reduceat(stays, first, dtype=np.int64)
            symbol = symbol[stays]
        return out


class Counter:
    """Counts tokens of texts, keeping the counts of pre-tokens it has met."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of special strings."""
        special = self.merges.special
        parts = special.split(text) if special else [text]
        out: list[str] = []
        for part in parts:
            # the one-to-one mapping of capital sigma; str.lower() has a second one at word ends
            lower = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3").lower()
            out += self.merges.split.findall(lower)
        return out, len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        known = self.known
        split = [self.pieces(t) for t in texts]
        new: set[str] = set()
        for pieces, _ in split:
            new.update(pieces)
        fresh = [p for p in new if p not in known]
        known.update(zip(fresh, self.merges.count([p.encode() for p in fresh]).tolist(), strict=True))
        return [sum(map(known.__getitem__, pieces)) + n for pieces, n in split]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``."""

    def make(texts: list[str]) -> dict[str, list]:
        tokens = counter(path).count(texts)
        return {
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": tokens,
            "over_limit": [n > limit for n in tokens],
        }

    return map_texts(docs, "n_bytes long, n_tokens long, over_limit boolean", make, text)
