"""Mixing sources to target weights by entropy balancing.

Rates are the ones nearest to 1 in relative entropy that give each source its target of words: minimise
the sum of r ln r - r + 1 over documents, with 0 <= r <= 2 and the rates times the sizes of a source
summing to its target. The solution tilts exponentially by size, r = min(2, exp(lambda * size)), with
one multiplier per source; the convex dual in lambda is solved by Newton iterations. Rates depend on
source and size only, so an iteration is one grouped aggregate over distinct (source, size) pairs.
Rates are then rounded into copies: the whole part is taken, and one more copy where the fraction beats
a hash of the doc_id plus a shift that is fitted per source, so that the words taken come as near to
the target as whole documents can without passing it.

Cases: null texts have size 0, as have texts without words; such rows are in the result and take
nothing; a null source is a source of its own, last in order; a source without words has target 0;
rows that repeat a doc_id are rounded alike; an empty table gives an empty result; other columns are
kept by ``apply_mix`` and not read otherwise. Sums over words are of integers or of values in a fixed
grid, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.session import stage

from .common import text_or_empty

WEIGHTS = (3, 1, 2)
#: Words of the mix as a share of all words, and the most of a source or document that is taken.
SHARE, CAP = 1.5, 2.0
#: Newton steps end when every source is this near its target, relative to it.
TOLERANCE = 1e-9
MOST_STEPS = 200
#: Bits of the rounding hash, and bits by which one pass narrows a source's shift down.
HASH_BITS, PASS_BITS = 36, 12
#: Documents of a source whose places are ordered as they are, in one task; more are narrowed down first.
DIRECT_ROWS = 1 << 16
#: Rounds of the rounding: each takes documents of at most this share of the words that are left, so
#: that short ones fill closely what longer ones leave open.
ROUNDS = (1.0, 0.25, 0.25, 1.0)

EXACT = "decimal(38,6)"


def _key() -> Column:
    """A source's name as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key")


def _size(text: str) -> Column:
    """Words of a text."""
    spaced = F.trim(F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " "))
    return F.when(spaced == "", 0).otherwise(F.size(F.split(spaced, " "))).cast("long")


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, key, size (words of the text) of every row."""
    return docs.select("doc_id", "source", _key(), _size(text).alias("size"))


def targets(totals: DataFrame) -> DataFrame:
    """key, source_size, target from (source, key, source_size), one row per source; staged.

    Sources are numbered in code point order over range partitions, so no task orders all of them.
    Each round shares what is left among the sources below their limit; those that would pass it
    stop there, until none does.
    """
    ordered = totals.orderBy(F.col("source").asc_nulls_last())
    numbered = totals.sparkSession.createDataFrame(
        ordered.rdd.zipWithIndex().map(lambda r: (r[0]["key"], r[0]["source_size"], r[1])),
        "key string, source_size long, number long",
    )
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int")
    )
    rows = stage(numbered.withColumn("weight", weight.cast("double")), "sources")
    all_words = SHARE * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    # the level (words per unit of weight) only rises, so a source that stopped stays stopped
    while True:
        full = F.col("weight") * level > CAP * F.col("source_size")
        got = rows.agg(
            F.sum(full.cast("long")).alias("n"),
            F.sum(F.when(full, F.col("source_size"))).alias("words"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if got["n"] is None or got["n"] == stopped or not got["weight"]:
            break
        stopped, level = got["n"], (all_words - CAP * (got["words"] or 0)) / got["weight"]
    target = F.least(F.col("weight") * level, CAP * F.col("source_size"))
    return stage(rows.select("key", "source_size", target.alias("target")), "targets")


def _rate(multiplier: str = "multiplier") -> Column:
    tilt = F.col(multiplier) * F.col("size") / F.col("unit")
    return F.least(F.lit(CAP), F.exp(F.least(tilt, F.lit(1.0))))


def balance(counted: DataFrame, goals: DataFrame) -> DataFrame:
    """key, unit, multiplier: rates are min(2, exp(multiplier * size / unit)); staged.

    ``counted``: key, size, docs. The dual's slope is the words taken less the target, its curvature
    the words of documents below the limit times their sizes. A step that leaves the bracket of known
    signs is replaced by the bracket's middle. Sources at their limit take all documents twice.
    """
    unit = counted.groupBy("key").agg(
        (
            F.sum(F.col("size") * F.col("size") * F.col("docs"))
            / F.sum(F.col("size") * F.col("docs"))
        ).alias("unit")
    )
    at_limit = F.col("target") >= CAP * F.col("source_size")
    state = goals.filter("source_size > 0").join(unit, "key").select(
        "key",
        "unit",
        "target",
        F.when(at_limit, float("inf")).otherwise(0.0).alias("multiplier"),
        F.lit(-1e6).alias("low"),
        F.lit(1e6).alias("high"),
        at_limit.alias("done"),
    )
    words = F.col("docs") * F.col("size") * _rate()
    for _ in range(MOST_STEPS):
        state = stage(state, "multipliers")
        if state.filter("not done").isEmpty():
            break
        bends = F.when(_rate() < CAP, words * F.col("size") / F.col("unit")).otherwise(0.0)
        sums = (
            counted.join(state.filter("not done").select("key", "unit", "multiplier"), "key")
            .groupBy("key")
            .agg(
                F.sum(words.cast(EXACT)).cast("double").alias("taken"),
                F.sum(bends.cast(EXACT)).cast("double").alias("curvature"),
            )
        )
        over = F.col("taken") - F.col("target")
        near = F.abs(over) <= TOLERANCE * F.greatest("target", F.lit(1.0))
        low = F.when(over < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(over < 0, F.col("high")).otherwise(F.col("multiplier"))
        newton = F.col("multiplier") - F.try_divide(over, "curvature")
        inside = F.coalesce((newton > low) & (newton < high), F.lit(False))
        step = F.when(inside, newton).otherwise((low + high) / 2)
        tight = high - low <= 1e-12 * F.greatest(F.abs(low), F.lit(1.0))
        state = state.join(sums, "key", "left").select(
            "key",
            "unit",
            "target",
            F.when(F.col("done") | near | tight, F.col("multiplier")).otherwise(step).alias("multiplier"),
            F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
            (F.col("done") | near | tight).alias("done"),
        )
    return state.select("key", "unit", "multiplier")


def _first_fitting(eligible: Callable[[DataFrame], DataFrame], sources: DataFrame, most: int) -> DataFrame:
    """``sources`` with shift and words: documents below the shift have ``words`` together, at most ``left``; staged.

    ``eligible`` gives the documents (size, place) with the columns of their source. Each pass counts the words per
    part of every source's open interval of places and goes on in the part where the words run out. Once no
    source has more than ``DIRECT_ROWS`` documents in its interval (``most`` at the start), the parts are the single places.
    """
    one = 1 << HASH_BITS
    state = sources.select("*", F.lit(-one).cast("long").alias("shift"), F.lit(0).cast("long").alias("words"))
    width = 2 * one
    while width > 1:
        parts = width if most <= DIRECT_ROWS else min(width, 1 << PASS_BITS)
        width //= parts
        part = F.floor((F.col("place") - F.col("shift")) / width).cast("long")
        counted = (
            eligible(state)
            .withColumn("part", part)
            .filter(F.col("part").between(0, parts - 1))
            .groupBy("key", "part")
            .agg(F.sum("size").alias("sizes"), F.count("*").alias("docs"), F.first(F.col("left") - F.col("words")).alias("left"))
        )
        upto = F.sum("sizes").over(Window.partitionBy("key").orderBy("part"))
        # without a part in which the words run out, all of the interval fits
        last = parts if width == 1 else parts - 1
        over = F.col("upto") > F.col("left")
        passed = (
            counted.withColumn("upto", upto)
            .groupBy("key")
            .agg(
                F.min(F.when(over, F.col("part"))).alias("part"),
                F.max(F.when(~over & (F.col("part") < last), F.col("upto"))).alias("upto"),
                F.max("docs").alias("most"),
            )
        )
        shift = F.col("shift") + F.coalesce("part", F.lit(last)) * width
        words = (F.col("words") + F.coalesce("upto", F.lit(0))).cast("long")
        found = stage(
            state.join(passed, "key", "left").select(
                *(F.col(c) for c in sources.columns), shift.alias("shift"), words.alias("words"), "most"
            ),
            "shifts",
        )
        state = found.drop("most")
        if width > 1:
            most = found.agg(F.max("most")).first()[0] or 0
    return state


def rounded(rated: DataFrame, goals: DataFrame) -> DataFrame:
    """``rated`` (doc_id, key, size, rate) with ``copies``.

    A document's place is its hash less the fraction of its rate; those first in place get one more
    copy while words are left for their source. Where the next document is too long for what is left,
    further rounds go on with the shorter ones. A round leaves two numbers per source, from which the
    copies follow, so the documents are written once.
    """
    one = 1 << HASH_BITS
    whole = F.floor("rate").cast("long")
    hashed = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - HASH_BITS)
    placed = stage(
        rated.select(
            "doc_id",
            "key",
            "size",
            whole.alias("copies"),
            (hashed - F.round((F.col("rate") - whole) * one).cast("long")).alias("place"),
        ),
        "placed",
    )
    open_docs = F.count(F.when((F.col("copies") < CAP) & (F.col("size") > 0), 1))
    taken = placed.groupBy("key").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), open_docs.alias("docs"))
    sources = stage(goals.join(taken, "key").select("key", "target", "taken", "docs"), "left")
    most = sources.agg(F.max("docs")).first()[0] or 0
    sources = sources.drop("docs")
    for number, share in enumerate(ROUNDS):
        given = sources.withColumn("left", F.col("target") - F.col("taken"))

        def eligible(state: DataFrame, number=number, share=share) -> DataFrame:
            return _given(placed, state, number).filter(_fits(share, "left"))

        # what a round leaves and where it ends, by the number of the round
        sources = _first_fitting(eligible, given, most).select(
            *(c for c in sources.columns if c != "taken"),
            (F.col("taken") + F.col("words")).alias("taken"),
            F.col("left").alias(f"left{number}"),
            F.col("shift").alias(f"shift{number}"),
        )
    return _given(placed, sources, len(ROUNDS)).select("doc_id", "key", "size", "copies", "place")


def _fits(share: float, left: str) -> Column:
    return (F.col("copies") < CAP) & F.col("size").between(1, share * F.col(left))


def _given(placed: DataFrame, sources: DataFrame, rounds: int) -> DataFrame:
    """``placed`` with the copies that its documents have after some rounds, and the columns of their source."""
    found = placed.join(sources, "key")
    for number, share in enumerate(ROUNDS[:rounds]):
        more = _fits(share, f"left{number}") & (F.col("place") < F.col(f"shift{number}"))
        found = found.withColumn("copies", F.col("copies") + more.cast("long"))
    return found


def mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, copies."""
    return _mixed(docs, text).drop("key")


def _mixed(docs: DataFrame, text: str) -> DataFrame:
    sized = stage(sizes(docs, text), "sizes")
    totals = sized.groupBy("source", "key").agg(F.sum("size").alias("source_size"))
    goals = targets(totals)
    counted = stage(
        sized.filter("size > 0").groupBy("key", "size").agg(F.count("*").alias("docs")), "counted"
    )
    multipliers = balance(counted, goals)
    rated = sized.join(multipliers, "key", "left").select(
        "doc_id", "key", "size", F.coalesce(F.when(F.col("size") > 0, _rate()), F.lit(0.0)).alias("rate")
    )
    return rounded(rated, goals).join(goals, "key").select(
        "doc_id",
        "key",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


def apply_mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each row as often as the mix takes it; rows it does not take are gone.

    Rows alike in doc_id, source and size are rounded alike, so these three find a row's copies.
    """
    copies = _mixed(docs, text).filter("copies > 0").groupBy("doc_id", "key", "size").agg(F.max("copies").alias("n"))
    # names that no column of the documents has
    name = "mixed_row" + "_" * max(len(c) for c in docs.columns)
    each = copies.select(
        F.struct("doc_id", "key", "size").alias(f"{name}_"), F.explode(F.sequence(F.lit(1).cast("long"), "n"))
    ).drop("col")
    row = F.struct(F.col("doc_id"), _key(), _size(text).alias("size"))
    taken = docs.withColumn(name, row).join(each.hint("merge"), F.col(name).eqNullSafe(F.col(f"{name}_")))
    return taken.select(*(F.col(f"`{c}`") for c in docs.columns))
