"""Helpers the operators share: reading a table, working through texts in bounded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text a Python worker holds decoded at a time; one longer text is held alone.
CHUNK_CHARS = 2_000_000

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def chunks(batch: pa.RecordBatch, text_at: int, most: int = CHUNK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of ``batch`` with their texts as Python strings, null as empty; ``most`` bytes of text in each, or one text."""
    texts = batch.column(text_at)
    start = held = 0
    for i in range(batch.num_rows):
        size = len(texts[i].as_buffer() or b"") if texts[i].is_valid else 0
        if i > start and held + size > most:
            yield batch.slice(start, i - start), _strings(texts.slice(start, i - start))
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start), _strings(texts.slice(start))


def _strings(texts: pa.Array) -> list[str]:
    return [t or "" for t in texts.to_pylist()]


def map_texts(
    df: DataFrame,
    schema: str,
    make: Callable[[list[str]], dict[str, list]],
    text: str = "text",
) -> DataFrame:
    """Add the columns ``make`` derives from the texts; the text column itself is dropped.

    ``schema`` names the added columns and their types; they replace columns of the same name. Works
    on one bounded chunk at a time.
    """
    added = arrow_fields(schema)
    kept = [c for c in df.columns if c not in (text, *(n for n, _ in added))]
    source = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`"))
    out = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, len(kept)):
                columns = make(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(kept))]
                    + [pa.array(columns[n], type=t) for n, t in added],
                    names=kept + [n for n, _ in added],
                )

    return source.mapInArrow(run, out)


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` less the rows whose doc_id (null included) is in ``dropped``.

    Merged at any size, as what is dropped grows with the documents.
    """
    ids = dropped.select(F.col("doc_id").alias("without_id")).distinct().hint("merge")
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["without_id"]), "left_anti")


ARROW_TYPES = {
    "long": pa.int64(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def arrow_fields(schema: str) -> list[tuple[str, pa.DataType]]:
    """Names and Arrow types of a simple "name type, name type" list."""
    pairs = [p.strip().split(" ", 1) for p in schema.split(",")]
    return [(name, ARROW_TYPES[kind.strip()]) for name, kind in pairs]
