"""Join shapes the planning jobs need and Spark would otherwise run as nested loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotgrid.sources.shared import stage

#: Asks of one key that one sorted sequence holds.
AS_OF_ASKS = 100_000


def day_map(cal: DataFrame, period_type: str) -> DataFrame:
    """One row per calendar day with the period that holds it.

    A date-in-period join then becomes an equi join on the day. The map has one row
    per calendar day, so its size is bounded by the calendar, not by the facts.
    """
    return cal.where(F.col("period_type") == period_type).select(
        F.explode(F.sequence("start_date", "end_date")).alias("day"),
        "period_id", "name", "fiscal_qtr",
        F.col("start_date").alias("period_start"), F.col("end_date").alias("period_end"),
    )


def join_on_period(df: DataFrame, date_col: str, cal: DataFrame, period_type: str, how: str = "inner") -> DataFrame:
    """Attach the calendar period that holds ``date_col`` as ``period_id``, ``period_start``, ``period_end``."""
    days = day_map(cal, period_type).select("day", "period_id", "period_start", "period_end")
    return df.join(days, df[date_col] == days["day"], how).drop("day")


def _all_known(cols: list[str]) -> Column:
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    return known


def as_of_lines(asks: DataFrame, points: DataFrame, keys: list[str], at: str, value: str, id_cols: list[str], split: int) -> DataFrame:
    """Points (_asks 0) and asks (_asks 1) of every key in lines; a key with more than ``split`` asks has several, each with the key's points."""
    known = _all_known([*keys, at])
    deals = asks.where(known).groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / split).cast("int").alias("_deals"))
    dealt_points = points.where(known).select(*keys, at, F.col(value).alias("_value")).join(deals, keys).withColumn(
        "_deal", F.explode(F.sequence(F.lit(0), F.col("_deals") - 1))).withColumn("_asks", F.lit(0))
    dealt_asks = asks.where(known).select(*id_cols, *keys, at).join(deals, keys).withColumn(
        "_deal", F.pmod(F.xxhash64(*id_cols), F.col("_deals")).cast("int")).withColumn("_asks", F.lit(1))
    return dealt_points.drop("_deals").unionByName(dealt_asks.drop("_deals"), allowMissingColumns=True)


def as_of(asks: DataFrame, points: DataFrame, keys: list[str], at: str, value: str, id_cols: list[str], split: int = AS_OF_ASKS) -> DataFrame:
    """(id_cols, lower, upper) of every ask: the largest ``value`` among points whose ``at`` is not above the ask's, and the smallest among those not below.

    One sorted pass: points and asks lie in one line by ``at``, and a running maximum from below and a running minimum from
    above meet each ask, so no ask meets the points of its key one by one, and ``value`` may rise and fall along ``at``.
    Asks with a null key or place have no points.
    """
    lines, line = as_of_lines(asks, points, keys, at, value, id_cols, split), [*keys, "_deal"]
    up = Window.partitionBy(*line).orderBy(F.col(at), "_asks").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*line).orderBy(F.col(at).desc(), "_asks").rowsBetween(Window.unboundedPreceding, 0)
    met = lines.withColumns({"lower": F.max("_value").over(up), "upper": F.min("_value").over(down)}).where(F.col("_asks") == 1)
    none = [F.lit(None).cast(points.schema[value].dataType).alias(c) for c in ("lower", "upper")]
    return met.select(*id_cols, "lower", "upper").unionByName(asks.where(~_all_known([*keys, at])).select(*id_cols, *none))


def _tags(key: str, fallback: list[str]) -> tuple[Column, Column]:
    """A row's tagged forms: (0, key, 0, ...) and (1, fallback ...), null where a part is."""
    def form(kind: int, cols: list[str]) -> Column:
        parts = [F.col(c).cast("bigint") for c in cols] + [F.lit(0).cast("bigint")] * (len(fallback) - len(cols))
        whole = F.struct(F.lit(kind).alias("kind"), *[p.alias(f"k{i}") for i, p in enumerate(parts)])
        return F.when(_all_known(cols), whole)

    return form(0, [key]), form(1, fallback)


def match_left_null(left: DataFrame, right: DataFrame, key: str, fallback: list[str], shared: list[str]) -> DataFrame:
    """Left join on ``shared`` and ``key``; left rows without a key join on ``fallback`` instead.

    One equi join on a tagged key: a left row has one form, by the nullness of its key, and the right side unfolds once into
    both. Keys are whole numbers.
    """
    extra = [c for c in right.columns if c not in {key, *fallback, *shared}]
    by_key, by_fallback = _tags(key, fallback)
    tagged = right.withColumn("_tag", F.explode(F.array(by_key, by_fallback))).where(F.col("_tag").isNotNull()).select("_tag", *shared, *extra)
    one = left.withColumn("_tag", F.when(F.col(key).isNotNull(), by_key).otherwise(by_fallback))
    return one.join(tagged, ["_tag", *shared], "left").select(*left.columns, *extra)


def match_right_null(left: DataFrame, right: DataFrame, key: str, fallback: str, shared: list[str], deal: list[str] | None = None) -> DataFrame:
    """Left join on ``shared`` and ``key``; right rows without a key match on ``fallback`` instead.

    One equi join on a tagged key: a right row has one form, and matches of a form are gathered before the join (the rows of
    one key, bounded as a goal's weeks are); the left side unfolds into both forms and takes its matches together again,
    dealt by its columns ``deal`` (all, if none are named), so what follows by these needs no shuffle. Keys are whole numbers.
    """
    extra = [c for c in right.columns if c not in {key, fallback, *shared}]
    by_key, by_fallback = _tags(key, [fallback])
    own = F.when(F.col(key).isNotNull(), by_key).otherwise(by_fallback)
    gathered = right.withColumn("_tag", own).where(F.col("_tag").isNotNull()).groupBy("_tag", *shared).agg(F.collect_list(F.struct(*extra)).alias("_hits"))
    both = left.withColumn("_tag", F.explode(F.array(by_key, by_fallback)))
    met = both.join(gathered, ["_tag", *shared], "left").repartition(*(deal or left.columns)).groupBy(*left.columns).agg(
        F.flatten(F.collect_list("_hits")).alias("_hits"), (F.count(F.lit(1)) / 2).cast("int").alias("_rows"))
    none = F.array_repeat(F.lit(None).cast(gathered.schema["_hits"].dataType.elementType), F.col("_rows"))
    hit = F.explode(F.when(F.size("_hits") > 0, F.col("_hits")).otherwise(none)).alias("_hit")
    return met.select(*left.columns, hit).select(*left.columns, *[F.col("_hit")[c].alias(c) for c in extra])


def snapshot_merge(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old rows with equal keys; all other old rows stay."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def replace_groups(old: DataFrame, new: DataFrame, touched: DataFrame, group: list[str]) -> DataFrame:
    """Drop every old row of a touched group and put the new rows in their place."""
    return old.join(touched.select(*group).distinct(), group, "left_anti").unionByName(new, allowMissingColumns=True)


def assign_ids(df: DataFrame, id_col: str, key: str, existing: DataFrame) -> DataFrame:
    """Number rows after the largest id in ``existing``, in order of ``key``, without sorting them in one task.

    Rows are dealt to ranges of the key and written; each range is numbered on its own and shifted by the rows before
    it. Only the ranges' counts, one row each, meet in one window.
    """
    parts = stage(df.sparkSession, df.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "id_ranges")
    start = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("_n")).select(F.lit(-1).alias("_part"), "_n")
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = start.unionByName(parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))).select("_part", F.sum("_n").over(before).alias("_shift"))
    within = Window.partitionBy("_part").orderBy(key)
    return parts.join(shifts, "_part").withColumn(id_col, (F.col("_shift") + F.row_number().over(within)).cast("bigint")).drop("_part", "_shift")
