"""Quality rules: word statistics and n-gram perplexity with language-specific bands.

The language model is a modified Kneser-Ney model of characters, two per language: a hash of the text
puts each document into one of two folds, and the model counted on one fold scores the other. So no
document and no copy of it counts in what scores it. Spark counts the n-grams of all documents and derives continuation counts, discounts, back-off weights and
interpolated probabilities with grouped aggregates and joins. For scoring, the probabilities lie in
sorted arrays of 64-bit hashes. These arrays grow with the corpus, so they are broadcast in shards of
at most ``SHARD_GRAMS`` entries, one shard per pass over the documents; a document's log
probability is the sum over the shards.

An n-gram is packed into one long, 12 bits a character, first character highest. Characters from
U+0FFF on share symbols (code point modulo 4093). Documents begin after order - 1 zero symbols.

Cases: null text counts as empty: no words, no perplexity, base_failed; a null language is a language
of its own; a text whose language has no text in the other fold has no perplexity and is judged by the
base rules alone; texts are scored whole; equal rows get equal scores; rows that repeat a doc_id or have
none are scored, and kept or dropped, each by itself; a table without text has no bands and an empty
result if it has no rows; other columns are kept by ``drop_low_quality`` and not read otherwise.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.session import stage

from .common import chunks

ORDER = 5
BITS = 12
#: Entries of one broadcast shard: 8 bytes of hash and 4 of log probability each, 48 MB.
SHARD_GRAMS = 4_000_000
#: Bytes of text scored at a time; hashes, places and values of its n-grams take some forty times as much.
SCORED_CHARS = 250_000
#: Distinct n-grams a counting task holds before it passes them on.
HELD_GRAMS = 2_000_000

#: Band limits: this many robust standard deviations (1.4826 times the median absolute deviation)
#: below and above the language's median log perplexity. As the mean over n characters spreads with
#: 1 / sqrt(n), deviations are taken times sqrt(n), so the band of a short text is the wider one.
BELOW, ABOVE = 2.5, 2.5
#: Least standard deviation of a language, where many copies make it small: about that of prose.
LEAST_SD = 1.0
#: Log perplexities and scaled deviations are compared at these resolutions.
STEP = 0.001
SCALED_STEP = 0.01

MIN_WORDS = 50
SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(points < 4094, points + 1, points % 4093 + 1).astype(np.uint64)


def grams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of the texts one after another, and how many each text has (its length)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    padded = symbols(("\0" * (order - 1)).join(["", *texts]))
    # the padding's symbols must be zero, the texts' own zero characters keep symbol 1
    starts = np.cumsum(sizes + order - 1) - sizes - (order - 1)
    pad = (starts[:, None] + np.arange(order - 1)).reshape(-1)
    padded[pad] = 0
    packed = np.zeros(max(0, len(padded) - order + 1), dtype=np.uint64)
    for k in range(order):
        packed = packed << np.uint64(BITS) | padded[k : k + len(packed)]
    keep = np.ones(len(packed), dtype=bool)
    # windows that would end inside the padding of the next text
    skip = (np.cumsum(sizes + order - 1)[:-1, None] - (order - 1) + np.arange(order - 1)).reshape(-1)
    keep[skip[skip < len(packed)]] = False
    return packed[keep], sizes


def _by_language(langs: pa.Array, texts: list[str]) -> Iterator[tuple[str, list[int]]]:
    members: dict[str, list[int]] = {}
    for i, lang in enumerate(langs.to_pylist()):
        if texts[i]:
            members.setdefault(lang or "", []).append(i)
    yield from members.items()


def with_fold(docs: DataFrame) -> DataFrame:
    """``docs`` with ``lang`` set to the language, a zero character and the fold of the text, 0 or 1."""
    return docs.withColumn("lang", fold_label(docs))


def fold_label(docs: DataFrame):
    fold = F.pmod(F.xxhash64(F.coalesce(docs["text"], F.lit(""))), F.lit(2)).cast("string")
    return F.concat(F.coalesce(docs["lang"], F.lit("")), F.lit("\0"), fold)


def text_key(docs: DataFrame):
    return F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))


def of_fold(label: str = "lang"):
    """The language of a label that ``with_fold`` gives."""
    return F.col(label).substr(F.lit(1), F.length(label) - 2)


def other_fold(counts: DataFrame) -> DataFrame:
    """``counts`` under the label of the fold they score."""
    swapped = F.when(F.endswith(F.col("lang"), F.lit("0")), F.lit("1")).otherwise(F.lit("0"))
    return counts.withColumn("lang", F.concat(of_fold(), F.lit("\0"), swapped))


def fold_model(docs: DataFrame) -> DataFrame:
    """lang, gram, log_p of the n-grams of each fold of ``docs`` (see ``with_fold``) by the other fold's counts."""
    counts = stage(count_grams(docs), "grams")
    others = other_fold(counts)
    wanted = counts.join(F.broadcast(others.select("lang").distinct()), "lang", "left_semi")
    return probabilities(others, wanted)


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, n over all documents (columns lang, text); each task combines before it sends."""
    source = docs.select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, (keys, counts) in held.items():
                for a in range(0, len(keys), 100_000):
                    k, c = keys[a : a + 100_000], counts[a : a + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(k)), pa.array(k.astype(np.int64)), pa.array(c)],
                        names=["lang", "gram", "n"],
                    )
            held.clear()

        for batch in batches:
            for part, texts in chunks(batch, 1):
                for lang, members in _by_language(part.column(0), texts):
                    keys, counts = np.unique(
                        grams([texts[i] for i in members], order)[0], return_counts=True
                    )
                    if lang in held:
                        keys = np.concatenate([held[lang][0], keys])
                        counts = np.concatenate([held[lang][1], counts])
                        at = np.argsort(keys, kind="stable")
                        keys, counts = keys[at], counts[at]
                        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
                        keys, counts = keys[first], np.add.reduceat(counts, first)
                    held[lang] = keys, counts
                if sum(len(k) for k, _ in held.values()) > HELD_GRAMS:
                    yield from passed_on()
        yield from passed_on()

    counted = source.mapInArrow(run, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts d1, d2, d3 of one order, per language."""
    of = {i: F.sum((F.col("n") == i).cast("double")) for i in (1, 2, 3, 4)}
    t = level.groupBy("lang").agg(
        *(c.alias(f"t{i}") for i, c in of.items()), F.count("*").alias("types")
    )
    y = F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2"))

    def d(i: int):
        raw = F.try_divide(F.col(f"t{i + 1}"), F.col(f"t{i}"))
        return F.greatest(F.lit(0.05 * i), F.least(F.lit(0.95 * i), F.coalesce(i - (i + 1) * y * raw, F.lit(0.5 * i))))

    return t.select("lang", "types", *(d(i).alias(f"d{i}") for i in (1, 2, 3)))


def _discount(n: str = "n"):
    return F.when(F.col(n) == 1, F.col("d1")).when(F.col(n) == 2, F.col("d2")).otherwise(F.col("d3"))


def levels(counts: DataFrame, order: int = ORDER) -> dict[int, DataFrame]:
    """Counts of the highest order and continuation counts of the lower ones."""
    out = {order: counts}
    for k in range(order - 1, 0, -1):
        gram = F.col("gram").bitwiseAND((1 << BITS * k) - 1)
        out[k] = stage(
            out[k + 1].groupBy("lang", gram.alias("gram")).agg(F.count("*").alias("n")), f"order{k}"
        )
    return out


def probabilities(counts: DataFrame, wanted: DataFrame | None = None, order: int = ORDER) -> DataFrame:
    """lang, gram, log_p for the n-grams of ``wanted`` (those counted, if not given).

    A wanted n-gram that was not counted gets its probability from the shorter ones.
    """
    level = levels(counts, order)
    need = dict(level)
    if wanted is not None:
        need[order] = wanted.select("lang", "gram")
        for k in range(order - 1, 0, -1):
            gram = F.col("gram").bitwiseAND((1 << BITS * k) - 1)
            need[k] = need[k + 1].select("lang", gram.alias("gram")).distinct()
    lower = None
    for k in range(1, order + 1):
        discounts = _discounts(level[k])
        context = F.shiftright("gram", BITS)
        contexts = (
            level[k]
            .join(F.broadcast(discounts), "lang")
            .groupBy("lang", context.alias("context"))
            .agg(F.sum("n").alias("total"), F.sum(_discount()).alias("freed"))
        )
        rows = need[k].drop("n") if wanted is not None else need[k]
        if wanted is not None:
            rows = rows.join(level[k], ["lang", "gram"], "left")
        rows = (
            rows.withColumn("context", context)
            .join(contexts, ["lang", "context"], "left")
            .join(F.broadcast(discounts), "lang", "left")
        )
        if lower is None:
            # below the single characters: evenly over those met and one unmet
            below = F.lit(1.0) / (F.coalesce(F.col("types"), F.lit(0)) + 1)
        else:
            rows = rows.withColumn(
                "shorter", F.col("gram").bitwiseAND((1 << BITS * (k - 1)) - 1)
            ).join(lower.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("below")), ["lang", "shorter"])
            below = F.col("below")
        own = F.coalesce((F.col("n") - _discount()) / F.col("total"), F.lit(0.0))
        weight = F.coalesce(F.col("freed") / F.col("total"), F.lit(1.0))
        # staged per order: one plan over all orders would be large for the driver
        lower = stage(rows.select("lang", "gram", (own + weight * below).alias("p")), f"smoothed{k}")
    return lower.select("lang", "gram", F.log("p").cast("float").alias("log_p"))


def _hash(packed: np.ndarray, lang: str) -> np.ndarray:
    """Well spread 64-bit hashes of packed n-grams of one language."""
    seed = np.uint64(zlib.crc32(lang.encode()) | zlib.adler32(lang.encode()) << 32)
    x = packed ^ seed
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def hashed_model(model: DataFrame) -> DataFrame:
    """hash and log_p of each row of ``model`` (lang, gram, log_p)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            packed = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)
            code = langs.indices.to_numpy(zero_copy_only=False)
            hashes = np.zeros(len(packed), dtype=np.uint64)
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                hashes[code == i] = _hash(packed[code == i], lang)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.astype(np.int64)), batch.column(2)], names=["hash", "log_p"]
            )

    return model.select("lang", "gram", "log_p").mapInArrow(run, "hash bigint, log_p float")


#: Places looked up at a time when arrays are made, as the driver has little memory to spare.
HEADS = 1 << 16


class HashArrays:
    """Sorted hashes with their values; the upper bits of a hash lead to its place."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        # behind the last one a key that is above all others
        self.keys, self.values = np.full(len(keys) + 1, 0xFFFFFFFFFFFFFFFF, np.uint64), np.zeros(len(keys) + 1, np.float32)
        np.take(keys, order, out=self.keys[:-1])
        np.take(values, order, out=self.values[:-1])
        del order
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.start = np.empty(1 << bits, np.int32)
        for at in range(0, len(self.start), HEADS):
            heads = np.arange(at, min(at + HEADS, len(self.start)), dtype=np.uint64) << self.shift
            self.start[at : at + HEADS] = np.searchsorted(self.keys[:-1], heads)

    def sums(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each hash (0 where absent) and whether it was found."""
        at = self.start[hashes >> self.shift]
        there = self.keys[at]
        value = self.values[at]
        found = there == hashes
        behind = np.flatnonzero(there < hashes)
        where, wanted = at[behind], hashes[behind]
        while len(behind):
            where = where + 1
            there = self.keys[where]
            hit = there == wanted
            value[behind[hit]] = self.values[where[hit]]
            found[behind[hit]] = True
            on = there < wanted
            behind, where, wanted = behind[on], where[on], wanted[on]
        value[~found] = 0
        return value, found


def word_statistics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    spaces = len(data) - len(data.translate(None, SPACES))
    marks = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeats = len(lines) - len(set(lines))
    return len(words), len(text) - spaces, marks, repeats, repeated_words(words)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found at least twice in the text."""
    if len(words) <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter(
        (number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words)
    )
    windows = len(words) - width + 1
    key = ids[:windows]
    for k in range(1, width):
        if len(number) ** 2 > 1 << 62 or int(key.max()) + 1 > (1 << 62) // len(number):
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(number) + ids[k : k + windows]
    order = np.argsort(key)
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(windows, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marked = np.zeros(len(words), dtype=bool)
    for k in range(width):
        marked[k : k + windows] |= twice
    return int(marked.sum())


#: What a row's sums and verdict hang on, and its id, so that copies don't meet in one task.
ROW = ("doc_id", "lang", "text_key")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _log_sums(langs: pa.Array, texts: list[str], arrays: HashArrays) -> tuple[np.ndarray, np.ndarray]:
    total, found = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
    for lang, members in _by_language(langs, texts):
        packed, sizes = grams([texts[i] for i in members])
        value, hit = arrays.sums(_hash(packed, lang))
        starts = np.cumsum(sizes) - sizes
        total[members] = np.add.reduceat(value, starts, dtype=np.float64)
        found[members] = np.add.reduceat(hit, starts, dtype=np.int64)
    return total, found


def scored_batches(batches: Iterator[pa.RecordBatch], arrays: HashArrays, first: bool) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, lang, text, text_key) with their sums over a shard, on the first one also the word statistics."""
    for batch in batches:
        for part, texts in chunks(batch, 2, SCORED_CHARS):
            total, found = _log_sums(part.column(1), texts, arrays)
            columns = [part.column(0), part.column(1), part.column(3), pa.array(total), pa.array(found)]
            names = [*ROW, "log_sum", "found"]
            if first:
                stats = np.array([word_statistics(t) for t in texts], dtype=np.int64)
                columns += [pa.array(stats[:, i]) for i in range(len(BASE))]
                names += BASE
            yield pa.RecordBatch.from_arrays(columns, names=names)


def score_documents(docs: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, lang, text_key, the word statistics, ``found`` (characters scored) and ``log_ppl`` of every row.

    ``log_ppl`` is null without text and without a model of the label.

    ``model``: lang, gram, log_p of all n-grams of the documents, as ``probabilities`` gives.
    """
    spark = docs.sparkSession
    hashed = stage(hashed_model(model), "model")
    shards = -(-hashed.count() // SHARD_GRAMS) or 1
    source = docs.select("doc_id", "lang", "text", text_key(docs).alias("text_key"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = None
    for shard in range(shards):
        rows = hashed.filter(F.pmod("hash", F.lit(shards)) == shard).toArrow()
        keys = rows["hash"].to_numpy().astype(np.uint64)
        arrays = spark.sparkContext.broadcast(HashArrays(keys, rows["log_p"].to_numpy()))
        del rows, keys
        first = shard == 0

        def run(batches, arrays=arrays, first=first) -> Iterator[pa.RecordBatch]:
            return scored_batches(batches, arrays.value, first)

        out = f"doc_id {kind}, lang string, text_key binary, log_sum double, found bigint"
        out += "".join(f", {n} bigint" for n in BASE) * first
        part = stage(source.mapInArrow(run, out), f"scores{shard}")
        arrays.destroy()
        if scored is None:
            scored = part
        else:
            # rows alike in all three have the same sum
            one = part.groupBy(*ROW).agg(
                F.max("log_sum").alias("more"), F.max("found").alias("more_found")
            )
            on = same_row(scored, one)
            scored = stage(
                scored.join(one, on, "left")
                .select(
                    *(scored[c] for c in ROW),
                    (F.col("log_sum") + F.coalesce("more", F.lit(0.0))).alias("log_sum"),
                    (F.col("found") + F.coalesce("more_found", F.lit(0))).alias("found"),
                    *BASE,
                ),
                f"sum{shard}",
            )
    return scored.select(
        *ROW,
        *BASE,
        "found",
        F.when(F.col("found") > 0, -F.col("log_sum") / F.col("found")).alias("log_ppl"),
    )


def same_row(a: DataFrame, b: DataFrame):
    return reduce(and_, (a[c].eqNullSafe(b[c]) for c in ROW))


def scaled(middle: str = "middle"):
    """Steps of a row's deviation from the language's median, scaled by its length."""
    apart = F.col("log_ppl") - F.col(middle) * STEP
    return F.round(apart * F.sqrt("found") / SCALED_STEP).cast("long")


def bands(scored: DataFrame) -> DataFrame:
    """Median step of the log perplexity per language, and the lowest and highest scaled deviation.

    Medians are taken over counts per step, so no task gathers the rows of a language.
    """

    def median(counted: DataFrame, name: str) -> DataFrame:
        w = Window.partitionBy("lang").orderBy("step")
        whole = Window.partitionBy("lang")
        return (
            counted.withColumn("upto", F.sum("rows").over(w))
            .withColumn("all", F.sum("rows").over(whole))
            .filter("2 * upto >= all")
            .groupBy("lang")
            .agg(F.min("step").alias(name))
        )

    def steps(rows: DataFrame, step, name: str) -> DataFrame:
        return stage(rows.groupBy("lang", step.alias("step")).agg(F.count("*").alias("rows")), name)

    judged = scored.filter("log_ppl is not null and not base_failed").select(
        of_fold().alias("lang"), "log_ppl", "found"
    )
    middle = stage(median(steps(judged, F.round(F.col("log_ppl") / STEP).cast("long"), "steps"), "middle"), "middle")
    apart = steps(judged.join(F.broadcast(middle), "lang"), F.abs(scaled()), "apart")
    sd = F.greatest(1.4826 * F.col("mad"), F.lit(LEAST_SD / SCALED_STEP))
    return middle.join(median(apart, "mad"), "lang").select(
        "lang", "middle", (-BELOW * sd).alias("low"), (ABOVE * sd).alias("high")
    )


def judged(docs: DataFrame) -> DataFrame:
    """The scored rows with base_failed and kept; ``docs`` with folds."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = score_documents(docs, fold_model(docs)).withColumn("base_failed", failed)
    limits = bands(scored).select(F.col("lang").alias("of"), "middle", "low", "high")
    # without a perplexity there is nothing to judge by but the base rules
    inside = F.coalesce(scaled().between(F.col("low"), F.col("high")), F.lit(True))
    found = scored.join(F.broadcast(limits), of_fold() == F.col("of"), "left")
    return found.withColumn("kept", ~F.col("base_failed") & inside)


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, lang, text): statistics, perplexity, base_failed, kept."""
    return judged(with_fold(docs.select("doc_id", "lang", "text"))).select(
        "doc_id", *BASE, "base_failed", "kept", F.round(F.exp("log_ppl"), 4).alias("perplexity")
    )


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``quality_rules`` rejects, with or without a doc_id.

    Merged at any size, as what is rejected grows with the documents.
    """
    rejected = judged(with_fold(docs.select("doc_id", "lang", "text"))).filter("not kept")
    names = [f"rejected_{c}" for c in ROW]
    gone = rejected.select(*(F.col(c).alias(n) for c, n in zip(ROW, names, strict=True))).distinct().hint("merge")
    of = (docs["doc_id"], fold_label(docs), text_key(docs))
    on = reduce(and_, (c.eqNullSafe(gone[n]) for c, n in zip(of, names, strict=True)))
    return docs.join(gone, on, "left_anti")
