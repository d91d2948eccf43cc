"""Alignment of two tokenizers, weighted by how many documents hold each linked pair of ids.

A task tokenises documents in segments of bounded size and inverts a segment's links: for each pair of ids a compressed
bitmap of the documents that hold it, and bit planes of how often each does. Segments hold different
documents, so the union of a pair's bitmaps counts as the sum of their bits. The counts then return to the
postings, and each segment adds them up per document.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from functools import cache
from hashlib import sha256
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.session import stage

from .common import chunks

#: Documents of a segment at most; their places in it fit in two bytes.
SEGMENT_DOCS = 4096
#: Code points of text after which a segment ends; one longer text is a segment alone.
SEGMENT_CHARS = 500_000

#: Code points below this have long had their letter and digit classes, so every library splits them alike.
PLAIN_BELOW = "\u0250"
#: Characters of a cached word at most, and characters after which room is made in the cache.
CACHED_WORD, CACHE_CHARS = 32, 3_000_000


class _Words:
    """Ids of words by an encoder of word lists, keeping those of short words.

    The ids of all words lie in a row; a word is known by its place in the order of learning. When the words held
    are too many, those met again since the last time stay, unless they are most of them.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]) -> None:
        self._encode = encode
        self._hold([], np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _hold(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self._places = dict(zip(words, range(len(words))))
        self._ids, self._ends, self._held = ids, np.cumsum(sizes), sum(map(len, words))
        self._again = np.zeros(len(words), bool)

    def _make_room(self) -> None:
        stay = np.flatnonzero(self._again)
        held = list(self._places)
        words = [held[i] for i in stay.tolist()]
        if 2 * sum(map(len, words)) > CACHE_CHARS:
            stay, words = stay[:0], []
        sizes = np.diff(self._ends, prepend=0)
        self._hold(words, self._ids[np.repeat(np.isin(np.arange(len(sizes)), stay), sizes)], sizes[stay])

    def __call__(self, words: list[list[str]]) -> list[np.ndarray]:
        """The ids of each list of words."""
        if not words:
            return []
        if self._held > CACHE_CHARS:
            self._make_room()
        flat = list(chain.from_iterable(words))
        place = np.fromiter(map(self._places.get, flat, repeat(-1)), np.int64, len(flat))
        self._again[place[place >= 0]] = True
        missing = np.flatnonzero(place < 0)
        unknown = [flat[i] for i in missing.tolist()]
        new = list(dict.fromkeys(unknown))
        # long words come last, so that they can be forgotten
        long = [w for w in new if len(w) > CACHED_WORD]
        if long:
            new = [w for w in new if len(w) <= CACHED_WORD] + long
        self._places.update(zip(new, range(len(self._ends), len(self._ends) + len(new))))
        place[missing] = np.fromiter(map(self._places.__getitem__, unknown), np.int64, len(unknown))
        encoded = self._encode(new)
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        added = np.fromiter(chain.from_iterable(encoded), np.int32, int(sizes.sum()))
        ids, ends = np.concatenate([self._ids, added]), np.concatenate([self._ends, len(self._ids) + np.cumsum(sizes)])
        starts = np.concatenate([[0], ends])
        size = ends[place] - starts[place]
        at = np.repeat(starts[place] - _starts(size), size)
        found = ids[at + np.arange(len(at))].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(size)])[np.cumsum([len(parts) for parts in words])]
        for word in long:
            del self._places[word]
        kept = len(ends) - len(long)
        self._ends, self._ids = ends[:kept].copy(), ids[: int(starts[kept])].copy()
        self._again = np.concatenate([self._again, np.zeros(kept - len(self._again), bool)])
        self._held += sum(map(len, new)) - sum(map(len, long))
        return np.split(found, upto[:-1])


def _plain(text: str) -> bool:
    return text.isascii() or max(text) < PLAIN_BELOW


def _encoded_parts(
    texts: list[str], words: list[list[str] | None], encode: Callable[[list[str]], list[list[int]]], of_words: _Words
) -> list[np.ndarray]:
    """Ids of each text, from its words where they are given, else by ``encode``."""
    whole = iter(encode([t for t, w in zip(texts, words) if w is None]))
    parted = iter(of_words([w for w in words if w is not None]))
    return [np.array(next(whole), np.int64) if w is None else next(parted) for w in words]


class _ByteLevel:
    """Encoder of a byte-level vocabulary file, with a cache of words for texts of plain letters."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._split = regex.compile(public_tokenizers.PATTERN).findall
        self._of_words = _Words(self._encoded)
        # printable bytes stand for themselves, the others for code points from 256 on
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        tokens = [self._tokenizer.id_to_token(i) or "" for i in range(size)]
        self.known = np.array([bytes(byte_of[c] for c in t) if set(t) <= byte_of.keys() else b"" for t in tokens], object)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        words = [self._split(t) if _plain(t) else None for t in texts]
        return _encoded_parts(texts, words, self._encoded, self._of_words)


class _Pieces:
    """Encoder of a piece vocabulary with byte fallback, with a cache of words for texts of plain letters.

    Where no piece goes on with a space after another character, none reaches over the start of a word. So a
    text with single spaces only inside is the words between them, each with the space that the encoder adds.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        apart = model.encode("a b") == model.encode("a") + model.encode("b")
        self._by_word = apart and not any("▁" in piece.lstrip("▁") for piece in pieces)
        self._of_words = _Words(self._encoded)
        self.known = np.array(
            [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)], object
        )

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)

    def _falls_apart(self, text: str) -> bool:
        return self._by_word and "  " not in text and text.strip(" ") == text != "" and _plain(text)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        words = [t.split(" ") if self._falls_apart(t) else None for t in texts]
        return _encoded_parts(texts, words, self._encoded, self._of_words)


@cache
def _byte_level(path: str) -> tuple[Callable[[list[str]], list[np.ndarray]], np.ndarray]:
    """Encoder of a byte-level vocabulary and the bytes of each id."""
    encoder = _ByteLevel(path)
    return lambda texts: encoder([" " + t for t in texts]), encoder.known


@cache
def _pieces(path: str) -> tuple[Callable[[list[str]], list[np.ndarray]], np.ndarray]:
    """Encoder of a piece vocabulary with byte fallback and the bytes of each id."""
    encoder = _Pieces(path)
    return encoder, encoder.known


def _same_bytes(ids: list[np.ndarray], known: np.ndarray, texts: list[bytes]) -> list[bool]:
    """Whether the bytes of the ids give the texts back."""
    return [b"".join(known[a].tolist()) == t for a, t in zip(ids, texts)]


class Alignment:
    """Links of a segment's documents, from two lists of token ids over the same bytes."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], size_a: np.ndarray, size_b: np.ndarray) -> None:
        self.n_a = np.array([len(x) for x in a], np.int64)
        self.n_b = np.array([len(x) for x in b], np.int64)
        self.ids_a, self.ids_b = _together(a), _together(b)
        # the bytes of all documents in a row: both tokenizers end at each document's end
        self.ends_a, self.ends_b = np.cumsum(size_a[self.ids_a]), np.cumsum(size_b[self.ids_b])
        length = int(self.ends_a[-1]) + 1 if len(self.ends_a) else 0
        at_a, at_b = np.zeros(length, bool), np.zeros(length, bool)
        at_a[self.ends_a], at_b[self.ends_b] = True, True
        self.last_a, self.last_b = at_b[self.ends_a], at_a[self.ends_b]
        # between two neighbouring ends lies one token of each side: a link
        ends = np.flatnonzero(at_a | at_b)
        self.link_a = np.cumsum(at_a)[ends] - at_a[ends]
        self.link_b = np.cumsum(at_b)[ends] - at_b[ends]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Groups and links per document."""
        doc = np.repeat(np.arange(len(self.n_a)), self.n_a)
        groups = np.bincount(doc[self.last_a], minlength=len(self.n_a))
        return groups, np.bincount(doc[self.link_a], minlength=len(self.n_a))

    def group_digests(self) -> list[str]:
        """sha256 of the groups as ``a1,a2|b1;a3|b2``, empty for documents without tokens."""
        group_a, group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        ids = np.concatenate([self.ids_a, self.ids_b])
        # what follows an id: a comma, a bar after a group's last A, a semicolon after its last B
        sign = np.concatenate([self.last_a.astype(np.int64), 2 * self.last_b.astype(np.int64)])
        # two sorted runs, which a stable sort merges
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        texts = _signed_ids(int(ids.max(initial=0)) + 1)
        shown = [texts[i] for i in (3 * ids + sign)[order].tolist()]
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        out, start = [], 0
        for end in ends:
            out.append(sha256("".join(shown[start:end])[:-1].encode()).hexdigest() if end > start else "")
            start = end
        return out

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair key (A id above, B id below 32 bits), document place and multiplicity, sorted by key, then place."""
        doc = np.repeat(np.arange(len(self.n_a)), self.n_a)[self.link_a]
        pair = (self.ids_a[self.link_a] << 32) | self.ids_b[self.link_b]
        # links lie by document, an order that a stable sort keeps
        order = np.argsort(pair, kind="stable")
        pair, doc = pair[order], doc[order]
        if not len(pair):
            return pair, doc, doc
        starts = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])]))
        return pair[starts], doc[starts], np.diff(np.append(starts, len(pair)))


_SIGNED: list[str] = []


def _signed_ids(count: int) -> list[str]:
    """Each id with a comma, a bar and a semicolon, in turn."""
    _SIGNED.extend(f"{i}{sign}" for i in range(len(_SIGNED) // 3, count) for sign in ",|;")
    return _SIGNED


def _together(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, np.int64)


def pack_bitmap(places: np.ndarray) -> tuple[bytes, bool]:
    """Sorted places as two bytes each, or as bits up to the last place (true), whichever is shorter."""
    if 2 * len(places) <= int(places[-1]) // 8 + 1:
        return places.astype("<u2").tobytes(), False
    bits = np.zeros(int(places[-1]) + 1, np.uint8)
    bits[places] = 1
    return np.packbits(bits, bitorder="little").tobytes(), True


def pack_planes(counts: np.ndarray) -> bytes:
    """Bit planes of ``counts - 1`` over a bitmap's places, lowest first; empty where each count is 1."""
    left, planes = counts - 1, []
    while left.any():
        planes.append(np.packbits((left & 1).astype(np.uint8), bitorder="little").tobytes())
        left = left >> 1
    return b"".join(planes)


def _slices(data: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths)
    return [data[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist())]


def pack_postings(
    docs: np.ndarray, counts: np.ndarray, starts: np.ndarray
) -> tuple[list[bytes], np.ndarray, list[bytes]]:
    """:func:`pack_bitmap` and :func:`pack_planes` of every run of postings that begins at ``starts``."""
    sizes = np.diff(np.append(starts, len(docs)))
    run = np.repeat(np.arange(len(starts)), sizes)
    spans = docs[starts + sizes - 1] // 8 + 1
    is_bits = 2 * sizes > spans
    lengths = np.where(is_bits, spans, 2 * sizes)
    at = _starts(lengths)
    packed = np.zeros(int(lengths.sum()), np.uint8)
    of_bits = is_bits[run]
    bits = np.zeros(8 * len(packed), np.uint8)
    bits[(8 * at[run] + docs)[of_bits]] = 1
    packed = np.packbits(bits, bitorder="little")
    rank = np.arange(len(docs)) - starts[run]
    low = (at[run] + 2 * rank)[~of_bits]
    packed[low], packed[low + 1] = docs[~of_bits] & 0xFF, docs[~of_bits] >> 8
    # planes are as many as the greatest count less one has bits
    levels = np.frexp(np.maximum.reduceat(counts, starts) - 1)[1]
    width = (sizes + 7) // 8
    plane_lengths = levels * width
    plane_at = _starts(plane_lengths)
    bits = np.zeros(8 * int(plane_lengths.sum()), np.uint8)
    for level in range(int(levels.max(initial=0))):
        one = np.flatnonzero((counts - 1) >> level & 1)
        bits[8 * (plane_at + level * width)[run[one]] + rank[one]] = 1
    planes = np.packbits(bits, bitorder="little")
    return _slices(packed.tobytes(), lengths), is_bits, _slices(planes.tobytes(), plane_lengths)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column side by side, and the length of each row."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[ends[0] : ends[-1]], np.diff(ends).astype(np.int64)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def unpack_postings(docs: pa.Array, bits: pa.Array, planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, document place and multiplicity of every posting of some pairs."""
    is_bits = bits.to_numpy(zero_copy_only=False).astype(bool)
    data, lengths = _bytes_of(docs)
    row, place = np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = np.repeat(is_bits, lengths)
    listed = np.flatnonzero(~is_bits)
    row = np.repeat(listed, lengths[listed] // 2)
    place = data[~own].view("<u2").astype(np.int64)
    if is_bits.any():
        marked = np.flatnonzero(is_bits)
        set_bits = np.flatnonzero(np.unpackbits(data[own], bitorder="little"))
        ends = 8 * np.cumsum(lengths[marked])
        of = np.searchsorted(ends, set_bits, side="right")
        row = np.concatenate([row, marked[of]])
        place = np.concatenate([place, set_bits - 8 * _starts(lengths[marked])[of]])
        order = np.argsort(row, kind="stable")
        row, place = row[order], place[order]
    n = np.bincount(row, minlength=len(docs))
    rank = np.arange(len(row)) - _starts(n)[row]
    packed, lengths = _bytes_of(planes)
    width = (n + 7) // 8
    levels = lengths // np.maximum(width, 1)
    plane_bits = np.unpackbits(packed, bitorder="little")
    links = np.ones(len(row), np.int64)
    for level in range(int(levels.max(initial=0))):
        at = np.flatnonzero(levels[row] > level)
        bit = 8 * (_starts(lengths) + level * width)[row[at]] + rank[at]
        links[at] += plane_bits[bit].astype(np.int64) << level
    return row, place, links


POSTING_SCHEMA = (
    "doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "segment long, place int, a int, b int, n_docs int, docs binary, bits boolean, planes binary"
)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of bounded segments, whatever batches and chunks they come in."""
    ids: list[pa.Array] = []
    texts: list[str] = []
    held = 0
    for batch in batches:
        for part, found in chunks(batch, 1):
            start = 0
            for i, text in enumerate(found):
                if texts and (held + len(text) > SEGMENT_CHARS or len(texts) == SEGMENT_DOCS):
                    yield pa.concat_arrays([*ids, part.column(0).slice(start, i - start)]), texts
                    ids, texts, held, start = [], [], 0, i
                texts.append(text)
                held += len(text)
            ids.append(part.column(0).slice(start))
    if texts:
        yield pa.concat_arrays(ids), texts


def pair_postings(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of two kinds by segment: a document's own counts (``a`` null), and a pair's postings (``place`` null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, bytes_a = _byte_level(path_a)
        encode_b, bytes_b = _pieces(path_b)
        size_a = np.array([len(t) for t in bytes_a], np.int64)
        size_b = np.array([len(t) for t in bytes_b], np.int64)
        none = np.zeros(0, np.int64)
        # lists of many small integers, none of them in a cycle, would be walked again and again
        gc.disable()
        for number, (ids, texts) in enumerate(_segments(batches)):
            segment = (TaskContext.get().partitionId() << 32) + number
            spaced = [(" " + t).encode() for t in texts]
            a, b = encode_a(texts), encode_b(texts)
            same = zip(_same_bytes(a, bytes_a, spaced), _same_bytes(b, bytes_b, spaced))
            valid = [bool(t) and x and y for t, (x, y) in zip(texts, same)]
            found = Alignment(
                [x if ok else none for x, ok in zip(a, valid)], [x if ok else none for x, ok in zip(b, valid)], size_a, size_b
            )
            groups, links = found.counts()
            n = len(texts)
            yield _rows(
                ids.type,
                n,
                doc_id=ids,
                n_a=found.n_a,
                n_b=found.n_b,
                n_groups=groups,
                n_links=links,
                groups_sha256=found.group_digests(),
                segment=np.full(n, segment),
                place=np.arange(n),
            )
            pair, doc, count = found.postings()
            if not len(pair):
                continue
            starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            packed, is_bits, planes = pack_postings(doc, count, starts)
            yield _rows(
                ids.type,
                len(starts),
                segment=np.full(len(starts), segment),
                a=pair[starts] >> 32,
                b=pair[starts] & 0xFFFFFFFF,
                n_docs=np.diff(np.append(starts, len(pair))),
                docs=packed,
                bits=is_bits,
                planes=planes,
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, POSTING_SCHEMA.format(id=kind))


TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _rows(id_type: pa.DataType, n: int, **columns) -> pa.RecordBatch:
    fields = [f.split() for f in POSTING_SCHEMA.split(", ")]
    types = {name: TYPES.get(kind, id_type) for name, kind in fields}
    arrays = [
        columns[name] if isinstance(columns.get(name), pa.Array)
        else pa.array(columns[name], t) if name in columns else pa.nulls(n, t)
        for name, t in types.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(types))


def pair_counts(postings: DataFrame) -> DataFrame:
    """Documents that hold each pair of ids linked, and whether no partner of the A id has more."""
    counts = postings.filter("a is not null").groupBy("a", "b").agg(F.sum("n_docs").alias("count"))
    counts = stage(counts, "pair-counts")
    most = counts.groupBy(F.col("a").alias("of")).agg(F.max("count").alias("most"))
    return counts.join(most, counts["a"] == most["of"]).select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment_scores(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document its own counts, the links that are their A id's best, and the sum of the links' pair counts."""
    pairs = postings.filter("a is not null").select("segment", "a", "b", "docs", "bits", "planes")
    # merged at any size, as the pairs grow with the documents
    scored = pairs.join(counts.hint("merge"), ["a", "b"]).select("segment", "docs", "bits", "planes", "count", "best")
    own = postings.filter("place is not null").select(
        "segment", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"
    )
    both = own.unionByName(scored, allowMissingColumns=True)
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def add_up(rows: pa.Table) -> pa.Table:
        is_doc = rows.column("place").is_valid()
        docs, postings = rows.filter(is_doc), rows.filter(rows.column("docs").is_valid())
        places = docs.column("place").to_numpy()
        best_of = np.zeros(len(places), np.int64)
        sum_of = np.zeros(len(places), np.int64)
        for batch in postings.to_batches():
            row, at, links = unpack_postings(*(batch[name] for name in ("docs", "bits", "planes")))
            count, best = (batch[name].to_numpy(zero_copy_only=False) for name in ("count", "best"))
            sum_of += np.bincount(at, links * count[row], minlength=len(places)).astype(np.int64)
            best_of += np.bincount(at, links * best[row], minlength=len(places)).astype(np.int64)
        added = [pa.array(best_of[places], pa.int64()), pa.array(sum_of[places], pa.int64())]
        return pa.table([*(docs.column(c) for c in kept), *added], names=[*kept, "n_best", "count_sum"])

    kind = both.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return both.groupBy("segment").applyInArrow(add_up, schema)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Alignment of every document of (doc_id, text) between a byte-level and a piece vocabulary.

    Null and empty texts, and texts that one of the tokenizers does not give back whole, have no tokens: zeros.
    Repeated rows, also of one doc_id, are documents of their own with a row each. Other columns are ignored; no rows
    give no rows.
    """
    postings = stage(pair_postings(docs, path_a, path_b), "pair-postings")
    return alignment_scores(postings, pair_counts(postings))
