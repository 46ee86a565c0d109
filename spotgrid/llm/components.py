"""Connected components by alternating stars, one written table a round."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotgrid.sources.shared import stage

#: Edges that one task may take at a time.
SMALL = 200_000


class Forest:
    """Trees of what has been joined so far, by their smallest node. It starts anew beyond ``most`` nodes, which only costs repeated edges."""

    def __init__(self, most: int | None = 1 << 20):
        self.parent: dict = {}
        self.most = most

    def root(self, x):
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, u, v) -> bool:
        """Whether u and v were apart; they no longer are."""
        if self.most and len(self.parent) > self.most:
            self.parent.clear()
        a, b = self.root(u), self.root(v)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _forest(edges: DataFrame) -> DataFrame:
    """The edges of every part, replaced by an edge to the smallest node of each tree they form."""
    schema = edges.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, kind = Forest(None), None
        for batch in batches:
            kind = batch.schema
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                trees.join(u, v)
        if kind is not None:
            pairs = [(x, r) for x in trees.parent if (r := trees.root(x)) != x]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], kind.field(i).type) for i in range(2)], schema=kind)

    return edges.mapInArrow(run, schema)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); the root is the component's smallest node.

    A round hooks the larger neighbours of every node to the smallest one, then the smaller neighbours. Minima are
    summed up before they are shuffled and joined back, so a node with very many edges isn't gathered anywhere. Rounds
    end when the edges stay the same. At most ``SMALL`` edges, counted first, are one task's work and need no rounds.
    """
    now = stage(spark, edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if now.limit(SMALL + 1).count() <= SMALL:
        now = stage(spark, _forest(now.coalesce(1)), "forest")
    else:
        now = _star_rounds(spark, now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _star_rounds(spark: SparkSession, now: DataFrame) -> DataFrame:
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every edge now points from a node to a smaller one; nodes take their smallest as the root of the others.
        large = stage(spark, large.where("u != v").distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = stage(spark, small.where("u != v").distinct(), "edges")
        print_ = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if print_ == seen:
            return now
        seen = print_
