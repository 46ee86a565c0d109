"""Hard negatives by exact inner-product search over lists that clusters of anchors share.

Anchors are clustered by direction. Vectors lie in blocks of ``BLOCK_ROWS``; every block meets every cluster, anchors
being sent to the blocks (they are the stated queries, few beside the vectors), never vectors to anchors. In a block,
a cluster's list is sorted once, by an upper bound of any member's score: with the angle ``b`` between the cluster's
centre and its farthest member, and ``t`` between the centre and a vector x, a member of length 1 scores at most
|x| cos(max(0, t - b)). Each member walks down that list and stops when its worst kept score is above the bound of
all that is left: a certificate, so results are exact. Blocks' results are merged by the same order.

Two walks follow each other: the first finds an anchor's nearest rows of its own label, the second finds, for each of
them, the best rows of other labels whose score lies within a band of shares of the positive's score; there a walk
also ends where the bounds fall below the band.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; a component
counts as floor(256 x); a shorter vector counts as padded with zeros, an empty one as zeros. Rows with an anchor's own
id are none of its candidates; other rows of one id are rows of their own, equal ones too. Equal anchor rows count as
one, differing ones of one id give their results each. Equal scores come in order of id. An anchor without positives, a
positive without negatives (all with a negative score, as the band is then empty) give no rows. An empty table gives an
empty result; other columns are ignored. Scores must fit 63 bits after a multiplication by 100; otherwise the job fails.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotgrid.llm.batches import map_batches
from spotgrid.sources.shared import stage

#: Vectors of a block, which one task holds at a time.
BLOCK_ROWS = 8192
#: Anchors that walk one list together.
MEMBERS = 256
#: Clusters are fitted on at most so many anchors, those of the smallest hashes; there are at most so many clusters.
FIT = 4096
CLUSTERS = 64
SCALE = 256
#: A bound's allowance for rounding, as a share of the vector's length.
SLACK = 1e-6
FIRST_STEP, LAST_STEP = 64, 1024


def usable(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """(id, label, v) of the rows that take part, v as whole numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    there = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
    wide = rows.where(there).select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    return wide.where(~F.exists("x", bad)).select("id", "label", F.transform("x", lambda x: F.floor(x * SCALE)).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of a batch as rows of whole numbers."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    plain = vectors.astype(np.float64)
    length = np.sqrt((plain**2).sum(1))
    return plain / np.where(length > 0, length, 1)[:, None], length


def centres(anchors: DataFrame, dim: int) -> np.ndarray:
    """Directions of clusters, by rounds of spherical k-means on the sample."""
    sample = anchors.select("id", "v", F.xxhash64("id", "v").alias("h")).orderBy("h").limit(FIT).collect()
    if not sample:
        return np.zeros((1, dim))
    units, _ = _units(np.array([r["v"] + [0] * (dim - len(r["v"])) for r in sample], np.int64))
    found = units[:: max(1, len(units) // min(CLUSTERS, -(-len(units) // 32)))][:CLUSTERS]
    for _ in range(10):
        own = (units @ found.T).argmax(1)
        sums = np.stack([units[own == i].sum(0) for i in range(len(found))])
        length = np.sqrt((sums**2).sum(1))[:, None]
        found = np.where(length > 0, sums / np.where(length > 0, length, 1), found)
    return found


def clustered(anchors: DataFrame, found: np.ndarray) -> DataFrame:
    """Anchors with their cluster and how far they lie from its centre."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, _ = _units(_matrix(batch.column("v"), found.shape[1]))
            near = units @ found.T
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.argmax(1)), pa.array(-near.max(1))], names=[*batch.schema.names, "cluster", "away"])

    return map_batches(anchors, run, "anchor long, id long, label long, v array<long>, cluster long, away double")


class Shared:
    """A cluster's members over a block's vectors, sorted by the members' common upper bound."""

    def __init__(self, members: np.ndarray, vectors: np.ndarray):
        most = float(np.abs(members).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * members.shape[1]
        if 100 * most >= 2**63:
            raise OverflowError("inner products of these vectors don't fit a long")
        kind = np.float64 if most < 2**53 else np.int64
        units, self.length = _units(members)
        centre, size = _units(units.sum(0, keepdims=True))
        centre = centre if size[0] > 0 else units[:1]
        angle = lambda u: np.arccos(np.clip(u @ centre[0], -1, 1))
        widest = angle(units[self.length > 0]).max(initial=0)
        own, long = _units(vectors)
        bound = long * (np.cos(np.maximum(angle(own) - widest, 0)) + SLACK)
        self.order = np.argsort(-bound, kind="stable")
        self.bound = np.append(bound[self.order], -np.inf)
        self.members, self.vectors = members.astype(kind), vectors[self.order].astype(kind)

    def walk(self, of: np.ndarray, fits: Callable, ids: np.ndarray, keep: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(request, place in the block, score) of the first ``keep`` fitting vectors of each request; ``of`` is a request's member.

        ``fits(requests, places, scores)`` tells which pairs count. Nothing below ``floor`` counts.
        """
        ids = ids[self.order]
        n, at, step = len(self.order), 0, FIRST_STEP
        worst = floor.copy()
        top = (np.zeros(0, np.int64),) * 3
        going = np.arange(len(of))
        while at < n and len(going):
            stop = min(n, at + step)
            who, place = np.unique(of[going], return_inverse=True)
            scores = np.rint(self.members[who] @ self.vectors[at:stop].T).astype(np.int64)[place]
            row, column = np.nonzero((scores >= worst[going][:, None]) & fits(going, self.order[at:stop], scores))
            request, at_place, score = (np.concatenate([a, b]) for a, b in zip(top, (going[row], column + at, scores[row, column]), strict=True))
            best = np.lexsort((ids[at_place], -score, request))
            request = request[best]
            first = np.searchsorted(request, request)
            best, rank = best[(kept := np.arange(len(best)) - first < keep)], (np.arange(len(first)) - first)[kept]
            top = (request[kept], at_place[best], score[best])
            full = rank == keep - 1
            worst[top[0][full]] = np.maximum(worst[top[0][full]], top[2][full])
            is_full = np.zeros(len(of), bool)
            is_full[top[0][full]] = True
            at, step = stop, min(2 * step, LAST_STEP)
            # What is left scores at most this; a tie might still come first by its id.
            most = self.length[of[going]] * self.bound[at]
            going = going[~((is_full[going] & (worst[going] > most)) | (most < floor[going]))]
        return top[0], self.order[top[1]], top[2]


LOW = -(2**62)


def search(items: DataFrame, anchors: DataFrame, blocks: int, dim: int, keep: int, band: tuple[int, int] | None) -> DataFrame:
    """(anchor, place, id, score): every block's first ``keep`` rows for each anchor (place 0, its own label), or, with a band, for each of its positives."""
    wanted = "array<struct<place:int,id:bigint,score:bigint>>"
    none = F.lit(None).cast(wanted).alias("wanted")
    zero = F.lit(0).cast("long")
    own = items.select("block", F.lit(0).alias("role"), zero.alias("cluster"), F.lit(0.0).alias("away"), zero.alias("anchor"), "id", "label", "v", none)
    asked = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "block", F.lit(1).alias("role"), "cluster", "away", "anchor", "id", "label", "v", F.col("wanted") if band else none)
    dealt = own.unionByName(asked).repartition("block").sortWithinPartitions("block", "role", "cluster", "away", "anchor")

    def judge(vectors: tuple, members: list[tuple]) -> tuple:
        matrix, ids, labels = vectors
        anchor, own_id, own_label, _, wants = (list(x) for x in zip(*members, strict=True))
        own_id, own_label = np.array(own_id), np.array(own_label)
        shared = Shared(np.stack([m[3] for m in members]), matrix)
        if band is None:
            of, places = np.arange(len(members)), np.zeros(len(members), np.int64)
            floor = np.full(len(of), LOW)
            fits = lambda r, c, s: (labels[c] == own_label[of[r]][:, None]) & (ids[c] != own_id[of[r]][:, None])
        else:
            asks = [(i, w["place"], w["score"]) for i, ws in enumerate(wants) for w in ws]
            of, places, score = (np.array([a[i] for a in asks], np.int64) for i in range(3))
            floor = -(-band[0] * score // 100)
            fits = lambda r, c, s: (labels[c] != own_label[of[r]][:, None]) & (ids[c] != own_id[of[r]][:, None]) & (100 * s <= band[1] * score[r][:, None])
        request, place, score_found = shared.walk(of, fits, ids, keep, floor)
        return np.array(anchor)[of[request]], places[request], ids[place], score_found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, vectors, members = None, [], None, []

        def out() -> pa.RecordBatch:
            found = judge(vectors, members)
            members.clear()
            return pa.RecordBatch.from_arrays([pa.array(f) for f in found], names=["anchor", "place", "id", "score"])

        for batch in batches:
            block, role, cluster = (batch.column(c).to_numpy() for c in ("block", "role", "cluster"))
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(role) != 0) | (np.diff(cluster) != 0)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                part = batch.slice(low, high - low)
                if not len(part):
                    continue
                now = (int(block[low]), int(role[low]), int(cluster[low]))
                if members and now != at:
                    yield out()
                if at is None or now[0] != at[0]:
                    held, vectors = [], None
                at = now
                matrix, ids, labels = _matrix(part.column("v"), dim), part.column("id").to_numpy(), part.column("label").to_numpy()
                if now[1] == 0:
                    held.append((matrix, ids, labels))
                    continue
                if vectors is None:
                    if not held:
                        continue
                    vectors, held = tuple(np.concatenate(x) for x in zip(*held, strict=True)), []
                wants = part.column("wanted").to_pylist()
                for row in zip(part.column("anchor").to_pylist(), ids.tolist(), labels.tolist(), matrix, wants, strict=True):
                    members.append(row)
                    if len(members) == MEMBERS:
                        yield out()
        if members:
            yield out()

    return map_batches(dealt, run, "anchor long, place long, id long, score long")


def _first(found: DataFrame, keep: int) -> DataFrame:
    """The first rows of every request over all blocks, with their rank."""
    order = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine_negatives(spark: SparkSession, rows: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
                   positives: int = 5, negatives: int = 10, band: tuple[int, int] = (30, 90)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (a condition on column ``id``) and each of
    its nearest ``positives`` rows of the same label, the first ``negatives`` rows of other labels that score within ``band`` percent of it."""
    items = stage(spark, usable(rows, key, label, vector), "negatives_rows")
    n, dim = items.agg(F.count("*"), F.greatest(F.max(F.size("v")), F.lit(1))).first()
    blocks = max(1, -(-n // BLOCK_ROWS))
    items = items.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    distinct = stage(spark, items.where(is_anchor).select("id", "label", "v").distinct(), "negatives_anchors").withColumn("anchor", F.monotonically_increasing_id())
    anchors = stage(spark, clustered(distinct.select("anchor", "id", "label", "v"), centres(distinct, dim or 1)), "negatives_clusters")
    near = _first(search(items, anchors, blocks, dim or 1, positives, None), positives)
    wanted = F.sort_array(F.collect_list(F.struct(F.col("rank").alias("place"), "id", "score"))).alias("wanted")
    asked = stage(spark, anchors.join(near.groupBy("anchor").agg(wanted), "anchor"), "negatives_asked")
    found = _first(search(items, asked, blocks, dim or 1, negatives, band), negatives)
    pairs = asked.select("anchor", F.col("id").alias("anchor_id"), F.explode("wanted").alias("positive")).select(
        "anchor", "anchor_id", F.col("positive.place").cast("long").alias("place"), F.col("positive.id").alias("positive_id"), F.col("positive.score").alias("positive_score"))
    return found.join(pairs, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
