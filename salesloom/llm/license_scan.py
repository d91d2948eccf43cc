"""License notices: phrases that stand in a text, and blocks that hold most of a notice's words.

The second part is an exact set-similarity join of text blocks with templates. Words of the templates are
ordered by the number of documents that hold them, rarest first. A block can contain enough of a template only if it
holds one of the template's first words in that order (prefix filter), has enough words itself (length filter), and
enough words are left on both sides after the first common one (positional filter); what passes is counted.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_texts

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

# --- fixed values: phrases of the base report and their labels ---
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
# --- fixed values: wording of common notices, and their labels ---
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("distributed under the bsd license", "bsd"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("dedicated to the public domain under cc0 1 0 universal", "cc0"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("no part of this publication may be reproduced without the prior permission of the publisher", "reserved"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
# -----------------------------------------------------------------

#: Share of a template's distinct words that a block must hold.
THRESHOLD = Fraction(9, 10)
#: Templates travel to every task; more words than this are refused.
MOST_TEMPLATE_WORDS = 2_000_000


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower() if text.isascii() else text.translate(LOWER))


@dataclass(frozen=True)
class Template:
    """Distinct words as ranks, rarest first, and how many of them a block must hold."""

    number: int
    label: str
    stride: int
    ranks: tuple[int, ...]
    need: int


@dataclass
class Index:
    """Templates by the words of their prefixes."""

    rank: dict[str, int]
    templates: list[Template]
    prefixes: dict[int, list[Template]] = field(default_factory=lambda: defaultdict(list))

    @classmethod
    def build(cls, templates: Sequence[tuple[str, str]], frequency: dict[str, int], threshold: Fraction) -> Index:
        split = [(words_of(text), label) for text, label in templates]
        if sum(len(words) for words, _ in split) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"templates have more than {MOST_TEMPLATE_WORDS} words")
        vocabulary = sorted({w for words, _ in split for w in words}, key=lambda w: (frequency.get(w, 0), w))
        rank = {w: i for i, w in enumerate(vocabulary)}
        index = cls(rank, [])
        for number, (words, label) in enumerate(split):
            ranks = tuple(sorted({rank[w] for w in words}))
            if not ranks:
                continue
            need = -(-len(ranks) * threshold.numerator // threshold.denominator)
            template = Template(number, label, len(words), ranks, need)
            index.templates.append(template)
            for r in ranks[: len(ranks) - need + 1]:
                index.prefixes[r].append(template)
        return index

    def blocks(self, words: Sequence[str]) -> list[tuple[Template, int, int, int]]:
        """Template, first word, word after the last, and common words of every block above the threshold.

        A template's blocks are twice as long as its text and begin at every multiple of its length, so that any
        stretch of its length lies whole in one.
        """
        rank, prefixes = self.rank, self.prefixes
        ranks = [rank.get(w, -1) for w in words]
        candidates = set()
        for at, r in enumerate(ranks):
            if r in prefixes:
                for template in prefixes[r]:
                    block = at // template.stride
                    candidates.add((template.number, block))
                    if block:
                        candidates.add((template.number, block - 1))
        if not candidates:
            return []
        by_number = {t.number: t for t in self.templates}
        found = []
        for number, block in sorted(candidates):
            template = by_number[number]
            start = block * template.stride
            end = min(start + 2 * template.stride, len(words))
            held = sorted(set(ranks[start:end]) - {-1})
            if len(held) < template.need:
                continue
            inside = set(held)
            first = next(i for i, r in enumerate(template.ranks) if r in inside)
            place = held.index(template.ranks[first])
            if min(len(template.ranks) - first, len(held) - place) < template.need:
                continue
            common = sum(r in inside for r in template.ranks)
            if common >= template.need:
                found.append((template, start, end, common))
        return found


def word_frequencies(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> dict[str, int]:
    """Number of documents that hold each word of the templates; no more entries than those words."""
    vocabulary = frozenset(w for text, _ in templates for w in words_of(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for _, texts in chunks(batch, 0):
                for text in texts:
                    counts.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    counted = docs.select("text").mapInArrow(run, "word string, n long")
    return {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def phrase_places(words: list[str], phrases: Sequence[tuple[list[str], str]]) -> list[tuple[int, str]]:
    """First word and label of every place where a phrase's words stand side by side."""
    found = []
    for phrase, label in phrases:
        at = -1
        for _ in range(words.count(phrase[0])):
            at = words.index(phrase[0], at + 1)
            if words[at : at + len(phrase)] == phrase:
                found.append((at, label))
    return found


def license_blocks(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: Fraction = THRESHOLD,
    columns: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """One row per block that holds ``threshold`` of a template: ``columns``, label, template, span of words, share."""
    scanned = scan(docs.select(*columns, "text"), templates, threshold)
    blocks = scanned.select(*columns, F.explode(F.split("blocks", " ")).alias("block")).filter("block <> ''")
    parts = F.split("block", ":")
    numbered = F.array(*(F.lit(label) for _, label in templates))
    return blocks.select(
        *columns,
        F.element_at(numbered, parts[0].cast("int") + 1).alias("label"),
        F.element_at(F.array(*(F.lit(text) for text, _ in templates)), parts[0].cast("int") + 1).alias("template"),
        parts[1].cast("long").alias("first_word"),
        parts[2].cast("long").alias("end_word"),
        (parts[3].cast("double") / parts[4].cast("double")).alias("containment"),
    )


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: Fraction = THRESHOLD,
    phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """``docs`` with counts, labels, score and the blocks found in place of the text.

    ``blocks`` lists template:start:end:common:size, parted by spaces. ``score`` is 1 where a phrase stands, else
    the largest share of a template that a block holds, else 0. Null and empty texts hold nothing; repeated rows
    keep a result each; other columns stay, but for those named as the added ones, which are replaced.
    """
    index = Index.build(templates, word_frequencies(docs, templates), threshold)
    split = [(words_of(phrase), label) for phrase, label in phrases]

    def make(texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in NAMES}
        for text in texts:
            words = words_of(text)
            places = phrase_places(words, split)
            blocks = index.blocks(words)
            starts = [at for at, _ in places]
            base = {label for _, label in places}
            shares = [common / len(t.ranks) for t, _, _, common in blocks]
            out["n_words"].append(len(words))
            out["n_base"].append(len(places))
            out["first_word"].append(min(starts, default=None))
            out["last_word"].append(max(starts, default=None))
            out["base_labels"].append(",".join(sorted(base)))
            out["labels"].append(",".join(sorted(base | {t.label for t, *_ in blocks})))
            out["score"].append(1.0 if places else max(shares, default=0.0))
            out["blocks"].append(" ".join(f"{t.number}:{a}:{b}:{n}:{len(t.ranks)}" for t, a, b, n in blocks))
        return out

    return map_texts(docs, SCHEMA, make)


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, blocks string"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def license_report(docs: DataFrame) -> DataFrame:
    """Phrases and labels of every document, by doc_id; nulls and repeats as in :func:`scan`."""
    return scan(docs.select("doc_id", "text")).select("doc_id", *NAMES)
