"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every row gets a fingerprint of its normalised text, only as long as the row count calls for.
2. Each input partition sends its sorted distinct fingerprints, Golomb-coded, to their owners; an owner
   holds one range of fingerprints.
3. An owner answers each partition with a bitmap of those that another partition has too.
4. Only rows with a bit set, or with a fingerprint twice in their own partition, are suspects. Their
   texts are grouped byte by byte; partial aggregation meets copies before the shuffle, so a group of
   any size arrives as one row per task.

Cases: null text counts as empty, and empty texts are copies of each other; texts are compared whole;
rows that repeat a doc_id are one document and share its fate; a null doc_id is the largest, and
such a row is dropped if a row with an id has the same text; an empty table gives an empty result;
further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.session import stage

from .common import text_or_empty

#: Fingerprint bits beyond those that number the rows: a row without a copy is a suspect
#: with probability 2 to the minus this.
SPARE_BITS = 12
#: Rows whose fingerprints one owner holds, and the least number of owners.
OWNER_ROWS = 250_000
LEAST_OWNERS = 16

SENT = "part int, owner int, n int, low_bits int, quotients binary, remainders binary"


def golomb_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct non-negative integers as gaps: unary quotients and fixed-length remainders.

    The divisor is the power of two next to ln 2 times the mean gap, best for evenly spread values.
    """
    if not len(values):
        return 0, b"", b""
    gaps = np.diff(values, prepend=-1).astype(np.int64) - 1
    mean = max(1.0, float(gaps.mean()) * np.log(2))
    low = int(np.log2(mean))
    ends = np.cumsum((gaps >> low) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
    unary[ends] = 1
    rest = (gaps[:, None] >> np.arange(low - 1, -1, -1)) & 1
    return low, np.packbits(unary).tobytes(), np.packbits(rest.astype(np.uint8)).tobytes()


def golomb_decode(n: int, low: int, quotients: bytes, remainders: bytes) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(quotients, dtype=np.uint8)))[:n]
    high = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(remainders, dtype=np.uint8))[: n * low].reshape(n, low)
    rest = bits.astype(np.int64) @ (1 << np.arange(low - 1, -1, -1, dtype=np.int64))
    return np.cumsum((high.astype(np.int64) << low | rest) + 1) - 1


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """One staged row per document: part, doc_id, text_sha256, fp (64 bits)."""
    norm = normalised(text)
    return stage(
        docs.select(
            F.spark_partition_id().alias("part"),
            "doc_id",
            F.sha2(norm, 256).alias("text_sha256"),
            F.xxhash64(norm).alias("fp"),
        ),
        "fingerprints",
    )


def _by_owner(fps: np.ndarray, bits: int, owners: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sorted distinct fingerprints of each owner's range."""
    distinct = np.unique(fps)
    if not len(distinct):
        return
    starts = np.array([(o << bits) // owners for o in range(owners + 1)], dtype=np.int64)
    cuts = np.searchsorted(distinct, starts)
    for owner in range(owners):
        if cuts[owner] < cuts[owner + 1]:
            yield owner, distinct[cuts[owner] : cuts[owner + 1]]


def suspects(marks: DataFrame) -> DataFrame:
    """``marks`` (part, doc_id, text_sha256, fp) with a boolean ``suspect`` in place of ``fp``."""
    rows = marks.count()
    bits = min(62, max(1, rows).bit_length() + SPARE_BITS)
    owners = max(LEAST_OWNERS, rows // OWNER_ROWS)
    short = marks.withColumn("fp", F.shiftrightunsigned("fp", 64 - bits))

    def send(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for owner, mine in _by_owner(part["fp"].to_numpy(), bits, owners):
            low, quotients, remainders = golomb_encode(mine - (owner << bits) // owners)
            out.append((part["part"].iloc[0], owner, len(mine), low, quotients, remainders))
        return pd.DataFrame(out, columns=["part", "owner", "n", "low_bits", "quotients", "remainders"])

    def answer(sent: pd.DataFrame) -> pd.DataFrame:
        lists = [
            golomb_decode(n, low, q, r)
            for n, low, q, r in zip(
                sent["n"], sent["low_bits"], sent["quotients"], sent["remainders"], strict=True
            )
        ]
        values, times = np.unique(np.concatenate(lists), return_counts=True)
        twice = values[times > 1]
        bitmaps = [np.packbits(np.isin(x, twice, assume_unique=True)).tobytes() for x in lists]
        return pd.DataFrame({"part": sent["part"], "owner": sent["owner"], "bitmap": bitmaps})

    def read(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        fps = part["fp"].to_numpy()
        bitmap = dict(zip(answers["owner"], answers["bitmap"], strict=True))
        values, times = np.unique(fps, return_counts=True)
        found = [values[times > 1]]
        for owner, mine in _by_owner(fps, bits, owners):
            bit = np.unpackbits(np.frombuffer(bitmap[owner], dtype=np.uint8))[: len(mine)]
            found.append(mine[bit == 1])
        part["suspect"] = np.isin(fps, np.concatenate(found))
        return part[["doc_id", "text_sha256", "suspect"]]

    kind = marks.schema["doc_id"].dataType.simpleString()
    sent = short.select("part", "fp").groupBy("part").applyInPandas(send, SENT)
    answers = sent.groupBy("owner").applyInPandas(answer, "part int, owner int, bitmap binary")
    return (
        short.groupBy("part")
        .cogroup(answers.groupBy("part"))
        .applyInPandas(read, f"doc_id {kind}, text_sha256 string, suspect boolean")
    )


def exact_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    marked = stage(suspects(fingerprints(docs, text)), "suspects")
    suspected = marked.filter("suspect").select(F.col("doc_id").alias("id"), "text_sha256").distinct()
    texts = docs.select("doc_id", normalised(text).alias("norm"))
    suspect_texts = texts.join(
        suspected.select("id").distinct(), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi"
    )
    # grouping by the text itself is the byte verification
    groups = suspect_texts.groupBy("norm").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    groups = (
        groups.groupBy(F.sha2("norm", 256).alias("text_sha256"))
        .agg(
            F.min("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
            F.count("*").alias("texts"),
        )
        .select(
            "text_sha256",
            F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts have one SHA-256")))
            .otherwise(F.col("keep_id"))
            .alias("keep_id"),
            "group_size",
        )
    )
    alone = marked.filter("not suspect").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    grouped = (
        marked.filter("suspect")
        .join(groups, "text_sha256", "left")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )
    return alone.unionByName(grouped)


def drop_exact_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that repeat an earlier text."""
    dropped = (
        exact_duplicates(docs.select("doc_id", F.col(text).alias("text")))
        .filter("not kept")
        .select(F.col("doc_id").alias("a"), F.col("text_sha256").alias("b"))
        .distinct()
        # merged at any size, as what is dropped grows with the documents
        .hint("merge")
    )
    # the text counts too: rows without a doc_id differ by it
    same = docs["doc_id"].eqNullSafe(dropped["a"]) & (F.sha2(normalised(docs[text]), 256) == dropped["b"])
    return docs.join(dropped, same, "left_anti")
