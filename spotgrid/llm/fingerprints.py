"""Document fingerprints from improbable features.

Every window of ``WIDTH`` bytes is ranked by the information in it: the mean, over its bytes, of log2 of the distance
to the byte's last occurrence, which estimates the local entropy. Among any ``SPAN`` neighbouring windows the rarest is
a favourite; windows that are the favourite of at least ``LEAST_VOTES`` neighbourhoods are features. Ranks depend on
nearby bytes alone, so an edit leaves the features elsewhere as they were.

Features go, in order of first occurrence, into Bloom filters of ``BITS`` bits; a filter that holds ``FULL`` features
is closed and the next is chained. Two fingerprints are compared filter by filter: the overlap of two filters beyond
what chance gives, over the most there could be. Each filter of the shorter chain counts with its best partner.

Defined cases: null text is empty; an empty text has an empty fingerprint, which is like another empty one (1) and
unlike any other (0). A text shorter than a window is one feature. Equal texts have equal fingerprints. The text is
read in segments with margins, so memory for ranks doesn't grow with its length. Rows of one key follow each other by
text, repeated rows too; an empty table gives no rows, and other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotgrid.llm.batches import map_batches
from spotgrid.sources.shared import stage

WIDTH = 24
SPAN = 32
LEAST_VOTES = 8
FARTHEST = 256
BITS = 2048
HASHES = 5
FULL = 160
SEGMENT = 1 << 20
MARGIN = 512
CHANCE = 0.1

_INFORMATION = np.round(64 * np.log2(np.arange(FARTHEST + 1).clip(1))).astype(np.int32)
_ODD = np.random.default_rng(20240601).integers(1, 2**63, (2, WIDTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _favourites(data: np.ndarray) -> np.ndarray:
    """Starts of the windows that are the rarest of enough neighbourhoods."""
    n = len(data)
    order = np.argsort(data, kind="stable")
    last = np.full(n, -FARTHEST, np.int64)
    same = data[order[1:]] == data[order[:-1]]
    last[order[1:][same]] = order[:-1][same]
    far = np.minimum(np.arange(n) - last, FARTHEST)
    total = np.concatenate([[0], np.cumsum(_INFORMATION[far], dtype=np.int64)])
    rank = total[WIDTH:] - total[:-WIDTH]
    # Rank first, then the leftmost: one number whose maximum over a neighbourhood names its favourite.
    best = (rank << np.int64(32)) - np.arange(len(rank))
    width = 1
    while width * 2 <= min(SPAN, len(rank)):
        best = np.maximum(best[:-width], best[width:])
        width *= 2
    at = -(best - ((best + (1 << 31)) >> np.int64(32) << np.int64(32)))
    edges = np.flatnonzero(np.diff(at)) + 1
    bounds = np.concatenate([[0], edges, [len(at)]])
    votes = np.diff(bounds)
    chosen = votes >= LEAST_VOTES
    if not chosen.any():
        chosen[votes.argmax()] = True
    return at[bounds[:-1]][chosen]


def features(data: bytes) -> np.ndarray:
    """Hashes (n, 2) of the selected windows, each once, in order of first occurrence."""
    if not data:
        return np.zeros((0, 2), np.uint64)
    whole = np.frombuffer(data, np.uint8)
    if len(whole) < WIDTH:
        whole = np.concatenate([whole, np.full(WIDTH - len(whole), 255, np.uint8)])
    found = []
    for start in range(0, len(whole), SEGMENT):
        low = max(0, start - MARGIN)
        piece = whole[low : start + SEGMENT + MARGIN]
        if len(piece) < WIDTH:
            continue
        at = _favourites(piece)
        at = at[(at + low >= start) & (at + low < start + SEGMENT)] if len(whole) > SEGMENT else at
        windows = np.lib.stride_tricks.sliding_window_view(piece, WIDTH)[at].astype(np.uint64) + np.uint64(1)
        mixed = np.stack([(windows * _ODD[i]).sum(1, dtype=np.uint64) for i in range(2)], 1)
        mixed ^= mixed >> np.uint64(31)
        found.append(mixed * _ODD[:, 0])
    every = np.concatenate(found)
    _, first = np.unique(every[:, 0], return_index=True)
    return every[np.sort(first)]


def digest(text: str) -> list[tuple[int, np.ndarray]]:
    """Chained filters: (features, bits as bytes)."""
    hashes, chain = features(text.encode()), []
    for start in range(0, len(hashes), FULL):
        part, bits = hashes[start : start + FULL], np.zeros(BITS, np.uint8)
        for i in range(HASHES):
            bits[((part[:, 0] >> np.uint64(11 * i)) ^ part[:, 1]) % np.uint64(BITS)] = 1
        chain.append((len(part), np.packbits(bits)))
    return chain


def to_string(chain: list[tuple[int, np.ndarray]]) -> str:
    return ";".join(f"{n}:{base64.b64encode(bits.tobytes()).decode()}" for n, bits in chain)


def from_string(text: str) -> list[tuple[int, np.ndarray]]:
    return [(int(n), np.frombuffer(base64.b64decode(b), np.uint8)) for n, _, b in (part.partition(":") for part in text.split(";") if part)]


def likeness(a: list[tuple[int, np.ndarray]], b: list[tuple[int, np.ndarray]]) -> float:
    """0 to 1. The filters of the shorter chain, each with its best partner, weighed by their features."""
    if not a or not b:
        return float(not a and not b)
    if len(a) > len(b) or len(a) == len(b) and to_string(a) > to_string(b):
        a, b = b, a
    there = np.stack([bits for _, bits in b])
    ones = np.bitwise_count(there).sum(1, dtype=np.int64)
    score = weight = 0.0
    for n, bits in a:
        own = int(np.bitwise_count(bits).sum(dtype=np.int64))
        both = np.bitwise_count(there & bits).sum(1, dtype=np.int64)
        most = np.minimum(own, ones)
        least = own * ones / BITS
        least = least + CHANCE * (most - least)
        score += n * float(np.clip((both - least) / np.maximum(most - least, 1e-9), 0, 1).max())
        weight += n
    return score / weight


def edited(text: str, after: str) -> str:
    """The last quarter of the text replaced by the start of another."""
    cut = len(text) // 4
    return text[: len(text) - cut] + after[:cut]


def with_neighbours(spark: SparkSession, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows dealt into blocks of neighbouring keys, each block followed by the first row of the next (``guest``).

    Block bounds come from the keys alone, one for each shuffle partition, so a block is a task's share of the rows. A row
    finds its block by halving, so its work grows with the logarithm of their number. The last block's guest is the first row.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = stage(spark, docs.select(F.col(key).alias("key")).repartitionByRange(parts, F.col("key").asc_nulls_first()).withColumn(
        "part", F.spark_partition_id()), "fingerprint_keys")
    firsts = sorted((r.first for r in keys.groupBy("part").agg(F.min("key").alias("first")).collect() if r.first is not None))
    kind = docs.schema[key].dataType.simpleString()
    cuts = F.array(*[F.lit(f) for f in firsts[1:]]).cast(f"array<{kind}>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(firsts).bit_length()))]).cast("array<int>")
    last = max(len(firsts) - 1, 0)

    def further(at: Column, step: Column) -> Column:
        return F.when((at + step <= last) & (F.get(cuts, at + step - 1) <= F.col("key")), at + step).otherwise(at)

    block = F.aggregate(steps, F.lit(0), further)
    rows = docs.select(F.col(key).cast(kind).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("block", block)
    opens = (F.col("block") > 0) & F.coalesce(F.get(cuts, F.col("block") - 1) == F.col("key"), F.lit(False))
    lowest = docs.agg(F.min(F.struct(F.col(key).isNotNull().alias("known"), F.col(key).alias("key"))).alias("m")).first().m
    is_first = F.lit(False) if lowest is None else F.col("key").eqNullSafe(F.lit(lowest.key).cast(kind))
    before = F.when(is_first, F.lit(last)).when(opens, F.col("block") - 1)
    copies = F.filter(F.array(F.struct(F.col("block").alias("block"), F.lit(0).alias("guest")), F.struct(before.alias("block"), F.lit(1).alias("guest"))),
                      lambda c: c["block"].isNotNull())
    dealt = rows.select("key", "text", F.explode(copies).alias("at")).select("at.block", "at.guest", "key", "text")
    return dealt.repartitionById(parts, "block").sortWithinPartitions("block", "guest", F.col("key").asc_nulls_first(), "text")


_RESULT = [
    ("n_chars", "long", pa.int64()), ("edited_sha256", "string", pa.string()), ("fingerprint", "string", pa.string()),
    ("edited_fingerprint", "string", pa.string()), ("near_edited", "double", pa.float64()), ("near_next", "double", pa.float64()),
]


def compare_neighbours(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its text with the end replaced by the next one's start, and likenesses.

    The next document follows in order of key, nulls first, then text; after the last comes the first.
    """
    def judge(own: tuple, after: tuple) -> tuple:
        changed = edited(own[2], after[2])
        chain = digest(changed)
        return (own[1], len(own[2]), sha256(changed.encode()).hexdigest(), to_string(own[3]), to_string(chain), likeness(own[3], chain), likeness(own[3], after[3]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (block, key, text, fingerprint) of the row whose next row is still to come
        for batch in batches:
            found = []
            for block, guest, k, t in zip(*[batch.column(i) for i in range(4)], strict=True):
                block, guest = block.as_py(), guest.as_py()
                if guest and (held is None or held[0] != block):
                    continue  # repeated rows of the guest
                row = (block, k.as_py(), (body := t.as_py()), digest(body))
                if held is not None:
                    found.append(judge(held, row))
                held = None if guest else row
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate([batch.schema.field(2).type, *(x for _, _, x in _RESULT)])]
            yield pa.RecordBatch.from_arrays(columns, names=[key, *(n for n, _, _ in _RESULT)])

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(with_neighbours(spark, docs, key, text), run, ", ".join([f"`{key}` {kind}", *(f"{n} {t}" for n, t, _ in _RESULT)]))
