"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has the logit bias + sum of the weights of its words'
features (the word and its first 4 to 8 letters), and a document is toxic if any of its sentences
is: score = 1 - product of (1 - p) over sentences, the noisy-or. Only document labels are known; the
gradient of the document likelihood shares the blame among sentences, and in the end sentences with a
probability of one half or more are the offending ones.

The model is fitted in the driver on a bounded sample of labelled rows: at most ``TOXIC_ROWS`` and
``CLEAN_ROWS`` rows, those with the smallest hashes of their ids. Scoring goes over all rows.

Cases: null text counts as empty; a text without words scores 0; texts are scored whole; equal texts
score alike; rows of a label table that repeat a doc_id count once, as toxic if any says so; without
labels of both kinds all scores are near 0; an empty table gives an empty result; columns other than
doc_id and the text are not read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: Bounds of the fitting sample.
TOXIC_ROWS, CLEAN_ROWS = 3000, 6000
#: A feature is used if this many toxic documents of the sample have it, and this share of them.
LEAST_DOCUMENTS, LEAST_SHARE = 3, 0.02
#: ... and if its share among them is this many times its share among the clean ones.
LEAST_RATIO = 2.0
PREFIXES = (4, 5, 6, 7, 8)
STEPS, RATE, PENALTY, START = 200, 0.15, 1e-2, -8.0
THRESHOLD = 0.7
#: Features that a fitting step goes through at a time.
BLOCK_FEATURES = 1_000_000
#: Words whose weights a worker keeps; emptied when full, results do not depend on it.
CACHE_WORDS = 500_000

_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
_ENDS = frozenset(".!?\n")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are kept from fitting."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def __post_init__(self):
        self.words: dict[str, float] = {}

    def weight(self, word: str) -> float:
        """A word's share of its sentence's logit; NaN for what ends a sentence."""
        if word in _ENDS:
            return float("nan")
        return sum(self.weights.get(f, 0.0) for f in features(word))

    def score(self, text: str) -> tuple[float, str, int]:
        """Noisy-or score, places start:end of the offending sentences, their number."""
        tokens = _TOKEN.findall(text.lower())
        known = self.words
        if len(known) > CACHE_WORDS:
            known.clear()
        for t in set(tokens).difference(known):
            known[t] = self.weight(t)
        values = np.fromiter(map(known.__getitem__, tokens), dtype=np.float64, count=len(tokens))
        ends = np.isnan(values)
        values[ends] = 0.0
        # sentences that have words: number them by the ends before each word
        sentence = np.cumsum(ends)[~ends]
        if not len(sentence):
            return 0.0, "", 0
        first = np.flatnonzero(np.diff(sentence, prepend=-1))
        logit = np.add.reduceat(values[~ends], first) + self.bias
        score = -np.expm1(-np.logaddexp(0.0, logit).sum())
        offending = set(sentence[first][logit >= 0].tolist())
        return float(score), self.places(text, offending), len(offending)

    @staticmethod
    def places(text: str, sentences: set[int]) -> str:
        """Code points from the first word of each sentence to the end of its last."""
        if not sentences:
            return ""
        spans: dict[int, list[int]] = {}
        number = 0
        for m in _TOKEN.finditer(text):
            if m[0] in _ENDS:
                number += 1
            elif number in sentences:
                spans.setdefault(number, [m.start(), 0])[1] = m.end()
        return ",".join(f"{a}:{b}" for a, b in spans.values())


def _sentences(text: str) -> Iterator[list[str]]:
    words: list[str] = []
    for token in _TOKEN.findall(text.lower()):
        if token not in _ENDS:
            words.append(token)
        elif words:
            yield words
            words = []
    if words:
        yield words


def used_features(texts: list[str], toxic: list[bool]) -> dict[str, int]:
    """Numbers of the features that enough toxic texts have, and clearly more of them than of the others."""
    seen: Counter[str] = Counter()
    for text, bad in zip(texts, toxic, strict=True):
        if bad:
            words = {w for s in _sentences(text) for w in s}
            seen.update({f for w in words for f in features(w)})
    least = max(LEAST_DOCUMENTS, LEAST_SHARE * sum(toxic))
    often = {f for f, n in seen.items() if n >= least}
    clean: Counter[str] = Counter()
    of_word: dict[str, tuple[str, ...]] = {}
    for text, bad in zip(texts, toxic, strict=True):
        if not bad:
            has: set[str] = set()
            for w in {w for s in _sentences(text) for w in s}:
                if w not in of_word:
                    of_word[w] = tuple(f for f in features(w) if f in often)
                has.update(of_word[w])
            clean.update(has)
    rate = LEAST_RATIO * sum(toxic) / max(1, len(toxic) - sum(toxic))
    return {f: i for i, f in enumerate(sorted(f for f in often if seen[f] > rate * clean[f]))}


def fit(texts: list[str], toxic: list[bool]) -> Model:
    """Maximise the penalised likelihood of the document labels by gradient steps (Adam).

    Features of all sentences lie in one flat array, which each step goes through in blocks.
    """
    number = used_features(texts, toxic)
    of_word: dict[str, tuple[int, ...]] = {}
    feature, length, document = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for words in _sentences(text):
            before = len(feature)
            for w in words:
                ids = of_word.get(w)
                if ids is None:
                    ids = of_word[w] = tuple(number[f] for f in features(w) if f in number)
                feature.extend(ids)
            length.append(len(feature) - before)
            document.append(d)
    del of_word
    if not document or not number:
        return Model({}, START)
    feature, length = np.frombuffer(feature, dtype=np.int32), np.frombuffer(length, dtype=np.int32)
    document = np.frombuffer(document, dtype=np.int32)
    filled = np.flatnonzero(length)  # sentences that have features
    ends = np.cumsum(length[filled], dtype=np.int64)
    cuts = np.searchsorted(ends, np.arange(BLOCK_FEATURES, ends[-1] + BLOCK_FEATURES, BLOCK_FEATURES))
    blocks = [(a, b) for a, b in zip([0, *(cuts[:-1] + 1)], [*(cuts[:-1] + 1), len(filled)], strict=True) if a < b]
    label = np.array(toxic, dtype=bool)[document]
    weights, bias = np.zeros(len(number)), START
    moments = np.zeros((2, len(number) + 1))
    for step in range(1, STEPS + 1):
        logit = np.full(len(document), bias)
        for a, b in blocks:
            at = ends[a:b] - length[filled[a:b]]
            own = weights[feature[at[0] : ends[b - 1]]]
            logit[filled[a:b]] += np.add.reduceat(own, at - at[0])
        lack = np.bincount(document, np.logaddexp(0.0, logit), minlength=len(texts))[document]
        p = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        # d(-log likelihood)/d(logit): p for clean documents, -p (1 - P) / P for toxic ones
        slope = np.where(label, -p / np.expm1(np.clip(lack, 1e-9, 50)), p)
        gradient = PENALTY * len(texts) * weights / len(number)
        for a, b in blocks:
            own = feature[ends[a] - length[filled[a]] : ends[b - 1]]
            gradient += np.bincount(own, np.repeat(slope[filled[a:b]], length[filled[a:b]]), minlength=len(number))
        gradient = np.append(gradient, slope.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights -= move[:-1]
        bias = min(bias - move[-1], -3.0)
    kept = np.flatnonzero(np.abs(weights) > 1e-6)
    names = list(number)
    return Model({names[i]: float(weights[i]) for i in kept}, float(bias))


def fitting_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the sampled rows; ids with a label and not held out, in hash order."""
    ids = (
        labels.filter("toxic is not null and doc_id is not null")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg((F.max("toxic") == 1).alias("toxic"))
    )
    order = F.xxhash64("doc_id"), F.col("doc_id")
    some = (
        ids.filter("toxic")
        .orderBy(*order)
        .limit(TOXIC_ROWS)
        .union(ids.filter("not toxic").orderBy(*order).limit(CLEAN_ROWS))
    )
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = fitting_sample(docs, labels).toArrow().sort_by("doc_id")
    return fit([t or "" for t in rows["text"].to_pylist()], rows["toxic"].to_pylist())


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, number and places of the offending sentences."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: list[str]) -> dict[str, list]:
        scored = [shared.value.score(t) for t in texts]
        return {
            "score": [s for s, _, _ in scored],
            "predicted": [int(s >= THRESHOLD) for s, _, _ in scored],
            "n_offending": [n for _, _, n in scored],
            "offending": [p for _, p, _ in scored],
        }

    added = "score double, predicted int, n_offending long, offending string"
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return map_texts(rows, added, make)
