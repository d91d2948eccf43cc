"""Merkle manifest of a dataset: every document's inclusion proof, from one streaming append per block.

Leaves of a tree are dealt in aligned blocks. A block is appended to leaf by leaf: a leaf joins an open run
and takes the digests that stand before it as the start of its witness, and whenever a sibling subtree
completes, the witnesses of the leaves beside it are extended. The digests of the finished blocks are appended in
the same way, in blocks of their own, until each tree has one node; the trees' nodes then form the last
tree. A leaf's witness is its block's part followed by those of the blocks above.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.session import stage

#: Consecutive nodes that become one node of the next level.
FAN = 3
#: Levels a block completes; a block has FAN ** BLOCK_LEVELS leaves at most, which is what a task holds.
BLOCK_LEVELS = 7
BLOCK = FAN**BLOCK_LEVELS

# in a witness a sibling is this byte and its digest; any other byte is a place in a run and begins a level
SIBLING = b"\xff"
DIGEST_BYTES = 32


def joined_digest(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def levels_of(size: int) -> int:
    """Levels between ``size`` nodes and the one that remains."""
    levels = 0
    while size > 1:
        size = -(-size // FAN)
        levels += 1
    return levels


class OpenBlock:
    """Append-only block of leaves whose witnesses grow as sibling subtrees complete."""

    def __init__(self, levels: int) -> None:
        self.levels = levels
        self.witnesses: list[bytearray] = []
        self.digest: str | None = None
        # per level the subtrees of the open run: digest, first leaf, leaf after the last
        self._open: list[list[tuple[str, int, int]]] = [[] for _ in range(levels)]

    def append(self, digest: str) -> None:
        leaf = len(self.witnesses)
        self.witnesses.append(bytearray())
        self._complete(0, (digest, leaf, leaf + 1))

    def _complete(self, level: int, subtree: tuple[str, int, int]) -> None:
        if level == self.levels:
            self.digest = subtree[0]
            return
        run = self._open[level]
        before = bytes([len(run)]) + b"".join(SIBLING + bytes.fromhex(digest) for digest, _, _ in run)
        for leaf in range(subtree[1], subtree[2]):
            self.witnesses[leaf] += before
        after = SIBLING + bytes.fromhex(subtree[0])
        for _, first, end in run:
            for leaf in range(first, end):
                self.witnesses[leaf] += after
        run.append(subtree)
        if len(run) == FAN:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self._open[level] = self._open[level], []
        self._complete(level + 1, (joined_digest([d for d, _, _ in run]), run[0][1], run[-1][2]))

    def finish(self) -> str:
        """Close the runs that no further leaf will fill; the block's digest."""
        for level in range(self.levels):
            if self._open[level]:
                self._close(level)
        return self.digest


def witness_levels(witness: bytes) -> list[tuple[int, list[str]]]:
    """Place in the run and the run's other digests, level by level from the leaf up."""
    levels: list[tuple[int, list[str]]] = []
    at = 0
    while at < len(witness):
        if witness[at : at + 1] == SIBLING:
            levels[-1][1].append(witness[at + 1 : at + 1 + DIGEST_BYTES].hex())
            at += 1 + DIGEST_BYTES
        else:
            levels.append((witness[at], []))
            at += 1
    return levels


def fold(leaf: str, witness: bytes) -> tuple[str, str]:
    """Root that ``leaf`` leads to with a witness, and the digest of the witness's siblings."""
    siblings: list[str] = []
    for place, others in witness_levels(witness):
        leaf = joined_digest([*others[:place], leaf, *others[place:]])
        siblings += others
    return leaf, joined_digest(siblings)


def leaf_digest(text: Column | None = None) -> Column:
    """Digest of a document row: each column as ``-`` if null, else its UTF-8 length, a colon and its value."""
    given = {"doc_id": F.col("doc_id"), "source": F.col("source"), "lang": F.col("lang"), "n_chars": F.col("n_chars")}
    values = [*given.values(), F.col("text") if text is None else text]
    parts = []
    for value in values:
        shown = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _ranked(nodes: DataFrame, name: str, *order: str) -> DataFrame:
    """``place`` of each node in its tree and the tree's ``size``; sorted in ranges, so a tree may be of any size."""
    by = [F.col("tree"), *(F.col(c).asc_nulls_first() for c in order)]
    rows = nodes.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("part", F.shiftright("at", 33))
    # a row for each range and tree in it
    counts = rows.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("offset"),
        F.sum("n").over(tree).alias("size"),
    )
    placed = rows.join(offsets, ["tree", "part"]).withColumn("place", F.col("at") + F.col("offset"))
    return placed.drop("at", "part", "offset")


def _append(nodes: DataFrame, name: str) -> DataFrame:
    """Witness of each node within its block, and on the block's last node the block's digest."""
    nodes = nodes.withColumn("block", F.expr(f"place div {BLOCK}"))
    names = nodes.columns
    at = {c: names.index(c) for c in ("tree", "block", "size", "digest")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        witnesses: list[bytes] = []
        digests: list[str | None] = []
        block, key = None, None

        def close() -> None:
            if block is not None:
                digests.extend([None] * (len(block.witnesses) - 1) + [block.finish()])
                witnesses.extend(bytes(w) for w in block.witnesses)

        def out(rows: pa.Table, n: int) -> Iterator[pa.RecordBatch]:
            columns = [rows.column(i).slice(0, n) for i in range(len(names))]
            columns += [pa.array(witnesses, pa.binary()), pa.array(digests, pa.string())]
            yield from pa.table(columns, names=[*names, "witness", "block_digest"]).combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            keys = zip(batch.column(at["tree"]).to_pylist(), batch.column(at["block"]).to_pylist())
            sizes, leaves = batch.column(at["size"]), batch.column(at["digest"]).to_pylist()
            for i, found in enumerate(keys):
                if found != key:
                    close()
                    size = sizes[i].as_py()
                    block, key = OpenBlock(levels_of(size) if size <= BLOCK else BLOCK_LEVELS), found
                block.append(leaves[i])
            done = len(witnesses)
            if done:
                rows = pa.Table.from_batches(held)
                yield from out(rows, done)
                held = rows.slice(done).to_batches()
                witnesses.clear()
                digests.clear()
        close()
        if witnesses:
            yield from out(pa.Table.from_batches(held), len(witnesses))

    schema = ", ".join(f"`{c}` {nodes.schema[c].dataType.simpleString()}" for c in names)
    rows = nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
    return stage(rows.mapInArrow(run, f"{schema}, witness binary, block_digest string"), name)


def _grown(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The nodes with their witness inside their block, and what stands above each block.

    Blocks' digests are appended round by round, each round having a ``BLOCK``-th of the rows.
    """
    rounds, finished = [], []
    while True:
        rows = _append(nodes, f"{name}-{len(rounds)}")
        rounds.append(rows)
        nodes = rows.filter("block_digest is not null").select(
            "tree",
            F.col("block").alias("place"),
            F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias("size"),
            F.col("block_digest").alias("digest"),
        )
        finished.append(
            nodes.filter("size = 1").select(
                "tree", F.col("place").alias("block"), F.lit(b"").alias("above"), F.col("digest").alias("subroot")
            )
        )
        nodes = nodes.filter("size > 1")
        if nodes.isEmpty():
            break
    above = finished[-1]
    for rows, done in zip(reversed(rounds[1:]), reversed(finished[:-1])):
        inner = rows.join(above, ["tree", "block"]).select(
            "tree", F.col("place").alias("block"), F.concat("witness", "above").alias("above"), "subroot"
        )
        above = done.unionByName(inner)
    return rounds[0], above


def manifest(leaves: DataFrame) -> DataFrame:
    """Add ``subroot``, ``root`` and the ``witness`` of each leaf to rows of (source, doc_id, leaf, ...).

    A source is a tree whose leaves ascend by doc_id (null first, then by leaf digest); its last node is the
    subroot. Subroots, ordered by source (null first), are the leaves of the tree that gives the root. Other
    columns are kept if their names are none of tree, at, part, place, size, digest, block, block_digest, above.
    """
    # a letter before the name keeps null apart from every name and first in order
    tree = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    nodes = stage(leaves.withColumns({"tree": tree, "digest": F.col("leaf")}), "merkle-leaves")
    rows, above = _grown(_ranked(nodes, "merkle-sorted", "doc_id", "digest"), "merkle")
    above = stage(above, "merkle-above")
    # the one block of a tree that none stands above, or any other, has the tree's subroot
    subroots = above.filter("block = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest")
    )
    tops, over = _grown(_ranked(subroots, "merkle-subroots", "name"), "merkle-top")
    tops = tops.join(over, ["tree", "block"]).select(
        F.col("name").alias("tree"), F.concat("witness", "above").alias("top"), F.col("subroot").alias("root")
    )
    paths = above.join(tops, "tree").select("tree", "block", "subroot", "root", F.concat("above", "top").alias("above"))
    found = rows.join(paths, ["tree", "block"])
    kept = [F.col(f"`{c}`") for c in leaves.columns]
    return found.select(*kept, "subroot", "root", F.concat("witness", "above").alias("witness"))


def folded(rows: DataFrame, leaf: str = "leaf") -> DataFrame:
    """Add the root that column ``leaf`` leads to with the row's witness, and the digest of its siblings."""
    names = [c for c in rows.columns if c != "witness"]
    rows = rows.select(*(F.col(f"`{c}`") for c in names), "witness")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, witnesses = batch.column(names.index(leaf)).to_pylist(), batch.column(len(names)).to_pylist()
            pairs = [fold(a, w) for a, w in zip(leaves, witnesses)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names))]
                + [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())],
                names=[*names, "folded_root", "proof_sha256"],
            )

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(run, f"{schema}, folded_root string, proof_sha256 string")


def tamper_report(docs: DataFrame) -> DataFrame:
    """Proof of every row of (doc_id, source, lang, n_chars, text), tried on a tampered text.

    Where the crc32 of the decimal doc_id is even, the text has lost its newlines; a row then verifies only if it
    had none. Rows of a null doc_id, and null texts, are not tampered with. Null columns and empty texts have
    digests of their own; repeated rows are leaves of their own, side by side. Other columns are ignored. No rows
    give no rows.
    """
    altered = F.translate("text", "\n", "")
    tampers = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    leaves = docs.select(
        "doc_id", "source", leaf_digest().alias("leaf"), F.when(tampers, leaf_digest(altered)).alias("tampered")
    )
    rows = manifest(leaves).withColumn("tried", F.coalesce("tampered", "leaf"))
    return folded(rows, "tried").select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
