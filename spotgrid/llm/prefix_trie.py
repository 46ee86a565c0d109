"""Prefix trie of conversations, exact, with a count-min screen before anything is grouped.

A node is a distinct sequence of first turns. Most conversations share a few first turns with others, and then go on
alone; every node of such a tail has one member, and all that is reported of it can be said by its own row.

1. Turns become slim rows: two digests of (role, text) and the code points of the text. Texts are never shuffled.
2. Places within a conversation come from range parts and their counts, prefix digests from blocks of ``BLOCK`` turns
   (the exclusive or of digests of place and turn), so that a conversation that holds much of the table is spread too.
3. Every task counts its prefix digests in a count-min sketch of two rows, in cells of 0, 1 and "more". The merged
   sketch never counts too little: a prefix estimated at one has one member, and what lies below it is given out as
   it is. The sketch has four cells a prefix and row, up to ``MOST_CELLS``; with more prefixes than that more of them
   pass the screen, the result is the same.
4. Prefixes that may be shared, and the first of each tail, are grouped exactly: members, smallest member, children.
5. Sums over subtrees need no recursion. A leaf counts for all prefixes of its smallest member. And of a node's
   members every one but the smallest saves the text that it shares with a smaller member from that node on, so
   one number per conversation, the length ``most_shared`` of its longest prefix that a smaller one has too, is enough.

Defined cases: rows without a conversation id belong to none and are ignored; null role and text are empty; a null turn
comes first; turns of one number, and repeated rows, are turns of their own, ordered by their digest; an empty table
gives no node; other columns are ignored. Very long texts are hashed where they are read. Digests have 120 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotgrid.llm.batches import map_batches
from spotgrid.llm.shingles import mix
from spotgrid.sources.shared import stage

#: Turns of a conversation whose digests are summed up at a time.
BLOCK = 4096
#: Cells of a sketch's row, at most; a merged sketch of two rows then takes 4 MB.
MOST_CELLS = 1 << 24
#: Cells that are sent and merged together.
CELLS = 1 << 14
#: Ids in a row on their way to a hash.
IDS = 4096
NODE = ("depth", "x1", "x2")


def slim_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, h1, h2, chars) of every turn that has a conversation."""
    body = lambda c: F.coalesce(F.col(c), F.lit(""))
    name = F.md5(F.concat(F.length(body(role)).cast("string"), F.lit(":"), body(role), body(text)))
    part = lambda at: F.conv(F.substring("name", at, 15), 16, 10).cast("long")
    rows = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), name.alias("name"),
                                                       F.length(body(text)).cast("long").alias("chars"))
    return rows.select("conv", "turn", part(1).alias("h1"), part(16).alias("h2"), "chars")


def placed_turns(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(conv, pos, h1, h2, chars): places from 1, however many rows a conversation has."""
    order = [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2"), F.col("uid")]
    told = stage(spark, rows, "trie_turns").withColumn("uid", F.monotonically_increasing_id())
    parts = stage(spark, told.repartitionByRange(F.col("conv"), *order).withColumn("part", F.spark_partition_id()), "trie_parts")
    sizes = parts.groupBy("part", "conv").agg(F.count("*").alias("n"))
    before = sizes.select("part", "conv", (F.sum("n").over(Window.partitionBy("conv").orderBy("part")) - F.col("n")).alias("before"))
    at = F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order))
    return parts.withColumn("at", at).join(before, ["part", "conv"]).select("conv", (F.col("before") + F.col("at")).alias("pos"), "h1", "h2", "chars")


def prefixes(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """A row per conversation and depth: its node (depth, x1, x2), the parent's (p1, p2), chars, upto (of all turns so far) and whether it is the last."""
    rows = rows.withColumns({"g1": F.xxhash64("pos", "h1", "h2"), "g2": F.xxhash64("h2", "pos", "h1"), "block": F.floor((F.col("pos") - 1) / BLOCK)})
    sums = rows.groupBy("conv", "block").agg(F.bit_xor("g1").alias("s1"), F.bit_xor("g2").alias("s2"), F.sum("chars").alias("s"), F.max("pos").alias("top"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda total: F.coalesce(total.over(earlier), F.lit(0).cast("long"))
    before = sums.select("conv", "block", so_far(F.bit_xor("s1")).alias("b1"), so_far(F.bit_xor("s2")).alias("b2"), so_far(F.sum("s")).alias("b"),
                         F.max("top").over(Window.partitionBy("conv")).alias("length"))
    upto = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({"r1": F.bit_xor("g1").over(upto), "r2": F.bit_xor("g2").over(upto), "r": F.sum("chars").over(upto)}).join(before, ["conv", "block"])
    both = summed.withColumns({"x1": F.col("r1").bitwiseXOR(F.col("b1")), "x2": F.col("r2").bitwiseXOR(F.col("b2"))})
    return both.select("conv", F.col("pos").alias("depth"), "x1", "x2", F.col("x1").bitwiseXOR(F.col("g1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("g2")).alias("p2"),
                       "chars", (F.col("r") + F.col("b")).alias("upto"), (F.col("pos") == F.col("length")).alias("last"))


def _cells(digests: pa.Array, width: int) -> np.ndarray:
    return (mix(digests.to_numpy().view(np.uint64)) & np.uint64(width - 1)).astype(np.int64)


def sketch(spark: SparkSession, rows: DataFrame, most_cells: int = MOST_CELLS) -> np.ndarray:
    """Bits of two sketch rows: cells that count more than one prefix. ``rows`` is a written table of prefixes."""
    width = min(most_cells, max(1 << 10, 1 << (4 * rows.count()).bit_length()))
    size = min(CELLS, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, width), np.uint8)
        for batch in batches:
            for row, digests in zip(seen, batch.columns, strict=True):
                cells, often = np.unique(_cells(digests, width), return_counts=True)
                row[cells] = np.minimum(row[cells] + often, 2)
        for block, cells in enumerate(seen.reshape(-1, size)):
            if cells.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([cells.tobytes()])], names=["block", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([np.packbits(seen > 1).tobytes()])], names=["block", "cells"])

        at, seen = None, None
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block != at:
                    if at is not None:
                        yield out()
                    at, seen = block, np.zeros(size, np.uint8)
                seen = np.minimum(seen + np.frombuffer(cells, np.uint8), 2)
        if at is not None:
            yield out()

    schema = "block long, cells binary"
    dealt = map_batches(rows.select("x1", "x2"), count, schema).repartition("block").sortWithinPartitions("block")
    bits = np.zeros((2 * width // size, size // 8), np.uint8)
    for row in map_batches(dealt, merge, schema).collect():
        bits[row["block"]] = np.frombuffer(row["cells"], np.uint8)
    return bits.reshape(2, -1)


def screened(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """The prefixes with ``meets``: whether the parent may be shared. If not, it has one member, and so has the prefix."""
    width = bits.shape[1] * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            meets = np.ones(len(batch), bool)
            for row, name in zip(bits, ("p1", "p2"), strict=True):
                cells = _cells(batch.column(name), width)
                meets &= (row[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
            meets |= batch.column("depth").to_numpy() == 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(meets)], names=[*batch.schema.names, "meets"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return map_batches(rows, run, f"{schema}, meets boolean")


def hashed_ids(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256) of rows (depth, x1, x2, conv): the hash of each node's ids, ascending, comma-joined.

    A hash can only be taken in order. Ids are sorted by range and joined to texts where they are, so that one row for
    ``IDS`` of them reaches the task that hashes a node's texts as a stream.
    """
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "conv", "ids"]
        for batch in batches:
            plain = np.stack([c.to_numpy() for c in batch.columns], 1)
            cut = np.flatnonzero((plain[1:, :3] != plain[:-1, :3]).any(1)) + 1
            rows = [run[i : i + IDS] for run in np.split(plain, cut) for i in range(0, len(run), IDS)]
            firsts = np.array([r[0] for r in rows], np.int64).reshape(-1, 4)
            texts = [",".join(map(str, r[:, 3].tolist())) for r in rows]
            yield pa.RecordBatch.from_arrays([*[pa.array(firsts[:, i]) for i in range(4)], pa.array(texts, pa.string())], names=names)

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None

        def out(found: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], names=[*NODE, "ends_sha256"])

        for batch in batches:
            done = []
            for *node, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if node != at:
                    if at is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield out(done)
        if at is not None:
            yield out([(*at, state.hexdigest())])

    rows = ends.select(*[F.col(c).cast("long") for c in NODE], "conv")
    texts = map_batches(rows.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv"), join, "depth long, x1 long, x2 long, conv long, ids string")
    return map_batches(texts.repartition(*NODE).sortWithinPartitions(*NODE, "conv"), hash_all, "depth long, x1 long, x2 long, ends_sha256 string")


def _sha(ids: Column) -> Column:
    return F.sha2(F.coalesce(ids.cast("string"), F.lit("")), 256)


def trie(spark: SparkSession, rows: DataFrame, ids: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """The nodes of conversations ``ids`` (conv, distinct) with turns ``rows`` (conv, pos, h1, h2, chars). See ``prefix_trie``."""
    paths = stage(spark, prefixes(spark, rows), "trie_prefixes")
    judged = screened(paths, sketch(spark, paths, most_cells))
    met = stage(spark, judged.where("meets").drop("meets"), "trie_met")
    nodes = stage(spark, met.groupBy(*NODE).agg(
        F.min("conv").alias("rep"), F.count("*").alias("n"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars"),
        F.min("upto").alias("upto"), F.sum(F.col("last").cast("long")).alias("n_ends"), F.min(F.when(F.col("last"), F.col("conv"))).alias("end")), "trie_nodes")
    members = stage(spark, met.select(*NODE, "conv", "last").join(nodes.select(*NODE, "rep", "n", "n_ends", "chars", "upto"), list(NODE)), "trie_members")
    # A conversation that goes on below what may be shared ends in a leaf of its own.
    own_leaf = (F.col("rep") == F.col("conv")) & F.col("last") & (F.col("n_ends") == F.col("n"))
    each = stage(spark, members.groupBy("conv").agg(
        F.coalesce(F.max(F.when(F.col("rep") != F.col("conv"), F.col("upto"))), F.lit(0)).alias("most_shared"),
        (~F.max("last") | F.max(own_leaf)).cast("long").alias("leaf")), "trie_each")
    saved = F.sum(F.when(F.col("conv") != F.col("rep"), F.col("most_shared")).otherwise(0))
    below = members.where("n > 1").join(each, "conv").groupBy(*NODE).agg(
        F.sum("leaf").alias("n_leaves"), (saved - (F.count("*") - 1) * F.min(F.col("upto") - F.col("chars"))).alias("saved_tokens"))
    kids = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count("*").alias("kids"))
    long = lambda n: F.lit(n).cast("long")

    bare = ids.join(each, "conv", "left_anti")
    top = ids.join(each, "conv", "left").agg(
        F.min("conv").alias("rep"), F.count("*").alias("n"), F.coalesce(F.sum("leaf"), long(0)).alias("leaves"), F.coalesce(F.sum("most_shared"), long(0)).alias("saved_tokens"),
        F.count_if(F.col("leaf").isNull()).alias("n_ends"), F.min(F.when(F.col("leaf").isNull(), F.col("conv"))).alias("end")).where("n > 0")
    root = stage(spark, top.select(*[long(0).alias(c) for c in NODE], "rep", "n", *[long(None).alias(c) for c in ("p1", "p2")], "n_ends", "end",
                                   F.greatest("leaves", long(1)).alias("n_leaves"), "saved_tokens"), "trie_root")

    full = nodes.join(below, list(NODE), "left").select(
        *NODE, "rep", "n", "p1", "p2", "n_ends", "end", F.coalesce("n_leaves", long(1)).alias("n_leaves"), F.coalesce("saved_tokens", long(0)).alias("saved_tokens"))
    full = full.unionByName(root).join(kids, list(NODE), "left")
    parents = nodes.select(*NODE, "rep").unionByName(root.select(*NODE, "rep")).select(
        (F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("rep").alias("parent"))
    full = full.join(parents, ["depth", "p1", "p2"], "left")
    many = met.where("last").select(*NODE, "conv").unionByName(bare.select(*[long(0).alias(c) for c in NODE], "conv")).join(
        full.where("n_ends > 1").select(*NODE), list(NODE), "left_semi")
    full = full.join(hashed_ids(many), list(NODE), "left")
    # A proven single node has its next turn as its only child, whether or not that is grouped too.
    children = F.when(F.col("depth") == 0, F.coalesce("kids", long(0))).when(F.col("n") == 1, 1 - F.col("n_ends")).otherwise(F.coalesce("kids", long(0)))
    grouped = full.select(
        F.col("rep").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "rep")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        children.alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", _sha(F.col("end"))).alias("ends_sha256"))
    tails = judged.where("not meets").select(
        F.col("conv").alias("conv_id"), "depth", F.col("conv").alias("parent_conv_id"), long(1).alias("n_convs"), (1 - F.col("last").cast("long")).alias("n_children"),
        long(1).alias("n_leaves"), long(0).alias("saved_tokens"), _sha(F.when(F.col("last"), F.col("conv"))).alias("ends_sha256"))
    return grouped.unionByName(tails)


def prefix_trie(spark: SparkSession, turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id (the parent's; null for the root), n_convs, n_children, n_leaves of
    its subtree, saved_tokens (code points that its subtree needn't hold twice) and ends_sha256 (of the ids of conversations that end there)."""
    rows = stage(spark, placed_turns(spark, slim_turns(turns, conv, turn, role, text)), "trie_placed")
    return trie(spark, rows, rows.select("conv").distinct())


def branched(spark: SparkSession, rows: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) of conversations that start with the first h turns of their group's first one (c - c % group, if it is there) and go on
    with their own turns after the first h; h is crc32 of the decimal id modulo ``most``. From and to rows (conv, pos, h1, h2, chars)."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    base = (F.col("conv") - F.col("conv") % group).alias("base")
    heads = rows.where((F.col("conv") % group == 0) & (F.col("pos") < most)).groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "chars"))).alias("head"))
    heads = stage(spark, heads, "trie_heads")
    ids = stage(spark, rows.select("conv").distinct(), "trie_ids")
    first = ids.select("conv", base, h.cast("int").alias("h")).join(heads, "base").select("conv", F.explode(F.slice("head", F.lit(1), F.col("h"))).alias("turn")).select("conv", "turn.*")
    own = rows.select("*", base, h.alias("h")).where("pos > h").join(heads.select("base", F.size("head").cast("long").alias("there")), "base", "left")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("there", F.lit(0).cast("long")))).alias("pos"), "h1", "h2", "chars")
    return stage(spark, first.unionByName(own), "trie_branched"), ids
