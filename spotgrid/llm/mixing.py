"""Mixing sources to target weights by hash-threshold histograms.

Every source gets a target number of words. A document's place in its source is a hash of its id, so "the first
``budget`` words of the source" is the set of documents below a hash threshold. The threshold is found from
histograms of (source, hash bucket): sums over buckets name the bucket in which the budget ends, and only that bucket
is cut finer on the next bits. Nothing is sorted by hash; what shuffles is one row per source and bucket.

Defined cases: null text has size 0 and is taken with 0 words; a null source is a source of its own, last in order;
null ids hash alike. Rows that share one hash at the very edge of the budget (repeated rows, repeated ids) share the
words that are left in proportion to their sizes, rounded down; a single document there gets all words that are left,
so it is taken in part. An empty table gives an empty result. Columns other than the three named ones are ignored.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotgrid.llm.ranks import with_rank
from spotgrid.sources.shared import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_REPEATS = 2
POINT_BITS = 60
STEP_BITS = 12
#: Cuts of at most so many sources are sent to the documents; beyond, documents are shuffled to the cuts.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def point_of(key: Column) -> Column:
    """A place in 0 .. 2^60 - 1 that depends on the key alone."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, POINT_BITS // 4), 16, 10).cast("long")


def _exact(value: int) -> Column:
    return F.lit(Decimal(value)).cast("decimal(38,0)")


def targets(spark: SparkSession, sized: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, most=MOST_REPEATS) -> DataFrame:
    """(source, source_size, target, whole, budget): the words each source should give.

    The share of a source is ``level * weight`` words, cut at ``most`` times its size. The level rises until the cut
    sources' excess is spent; each round is one sum over the table of sources. ``whole`` counts full passes over the
    source and ``budget`` the words of one more, partial pass.
    """
    totals = stage(spark, sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix_sources")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = with_rank(spark, totals, F.col("source").asc_nulls_last(), "rank")
    table = stage(spark, ranked.select(
        "source", "source_size", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    ), "mix_weights")
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    words, free, cut = share_percent * (total or 0), weight or 0, -1
    level = (words, 100 * free)
    while free:
        level = (words - 100 * max(cut, 0), 100 * free)
        over = F.col("cap").cast("decimal(38,0)") * _exact(level[1]) <= F.col("weight").cast("decimal(38,0)") * _exact(level[0])
        now, free = table.agg(F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if now == cut:
            break
        cut = now
    over = F.col("cap").cast("decimal(38,0)") * _exact(level[1]) <= F.col("weight").cast("decimal(38,0)") * _exact(level[0])
    share = F.lit(float(level[0])) * F.col("weight") / F.lit(float(max(level[1], 1)))
    target = F.when(over, F.col("cap").cast("double")).otherwise(share)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return table.select("source", "source_size", target.alias("target")).withColumn("whole", whole.cast("long")).withColumn(
        "budget", (F.floor("target") - F.col("whole") * F.col("source_size")).cast("long"))


def thresholds(spark: SparkSession, sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, prefix, bits, left, edge_size): all documents whose point is below the prefix belong to the partial pass.

    Documents in the bucket ``prefix`` (of ``bits`` leading bits) share the ``left`` words. A bucket is cut finer until
    it holds one document or all bits are used.
    """
    edges = plan.where("budget > 0").select("source", F.lit(0).cast("long").alias("prefix"), F.col("budget").alias("left"))
    bits = 0
    while True:
        bits += STEP_BITS
        at = F.shiftright("point", POINT_BITS - bits)
        own = F.shiftright("point", POINT_BITS - bits + STEP_BITS)
        rows = sized.where("size > 0").select(F.col("source").alias("of"), "size", at.alias("bucket"), own.alias("within"))
        sums = rows.join(edges, F.col("of").eqNullSafe(F.col("source")) & (F.col("within") == F.col("prefix"))).groupBy(
            "source", "left", "bucket").agg(F.sum("size").alias("bucket_size"), F.count("*").alias("documents"))
        upto = F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket"))
        edges = stage(spark, sums.withColumn("upto", upto).where("upto >= left and upto - bucket_size < left").select(
            "source", F.col("bucket").alias("prefix"), (F.col("left") - F.col("upto") + F.col("bucket_size")).alias("left"), "bucket_size", "documents",
        ), "mix_edges")
        if bits >= POINT_BITS or not edges.where("documents > 1").limit(1).count():
            return edges.select("source", "prefix", F.lit(bits).alias("bits"), "left", F.col("bucket_size").alias("edge_size"))


def cuts(spark: SparkSession, sized: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, most=MOST_REPEATS) -> DataFrame:
    """One row per source with all that decides on a document: of, source_size, target, whole, prefix, bits, left, edge_size."""
    plan = stage(spark, targets(spark, sized, weights, share_percent, most), "mix_targets")
    edges = thresholds(spark, sized, plan).withColumnRenamed("source", "edge_source")
    return plan.join(edges, F.col("source").eqNullSafe(F.col("edge_source")), "left").select(
        F.col("source").alias("of"), "source_size", "target", "whole", "prefix", "bits", "left", "edge_size")


def taken_words() -> Column:
    """The words taken from a document with columns ``size`` and ``point`` beside its source's cut."""
    place = F.expr(f"shiftright(point, {POINT_BITS} - bits)")
    share = (F.col("left").cast("decimal(20,0)") * F.col("size") / F.col("edge_size")).cast("decimal(38,6)")
    part = F.when(place < F.col("prefix"), F.col("size")).when(place == F.col("prefix"), F.floor(share).cast("long")).otherwise(F.lit(0))
    return (F.col("whole") * F.col("size") + F.coalesce(part, F.lit(0))).cast("long")


def sizes(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), point_of(F.col(key)).alias("point"))


def mix_sources(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
                share_percent=SHARE_PERCENT, most=MOST_REPEATS) -> DataFrame:
    """One row per document: key, size, source_size, target (its source's) and taken, the words the mix takes from it."""
    sized = stage(spark, sizes(docs, key, text, source), "mix_sizes")
    cut = cuts(spark, sized, weights, share_percent, most)
    return sized.join(cut, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("key").alias(key), "size", "source_size", "target", taken_words().alias("taken"))


def mixed_documents(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
                    share_percent=SHARE_PERCENT, most=MOST_REPEATS) -> DataFrame:
    """The documents of the mix, whole: none, one or two rows of each, by the nearest to the words taken. Half counts as whole."""
    cut = stage(spark, cuts(spark, stage(spark, sizes(docs, key, text, source), "mix_sizes"), weights, share_percent, most), "mix_cuts")
    if cut.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        cut = F.broadcast(cut)
    rows = docs.select(F.struct("*").alias("row"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), point_of(F.col(key)).alias("point"))
    times = F.when(F.col("size") > 0, F.floor((2 * taken_words() + F.col("size")) / (2 * F.col("size")))).otherwise(0).cast("int")
    dealt = rows.join(cut, F.col("source").eqNullSafe(F.col("of"))).select("row", F.explode(F.array_repeat(F.lit(0), times)).alias("_"))
    return dealt.select("row.*")
