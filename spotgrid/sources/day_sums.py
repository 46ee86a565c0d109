"""Day sums of the spot schedules, kept by outlet and quarter beyond one session.

A store is a folder with two tables for each schedule: the sums, and which plans lie in which partition. Both are
partitioned by the outlet and the calendar quarter of the spot, which every spot shows by itself. So a change of some
outlets and quarters sums these anew and nothing else, and a report of some plans reads the partitions they lie in.

Defined cases: spots without an outlet or a start are kept in partitions of their own (null); a schedule without spots
gives tables without rows; repeated spots count as often as they come; columns that are no key and no amount are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotgrid.sources.shared import stage
from spotgrid.sources.snapshot import replace_partitions, write_table

DAY_KEYS = ("plan_id", "plan_version_id", "active_yn", "media_outlet_id", "project_id", "campaign_goal_id", "daypart_id", "start_date", "end_date")
#: Spot schedules, and what their day sums are kept by.
SCHEDULES = {"schedule": DAY_KEYS, "schedule_episode": (*DAY_KEYS, "episode_id")}
PARTITION = ("media_outlet_id", "spot_quarter")
#: Partitions that a scan names one by one; reports of more than these read all of them.
NAMED_PARTITIONS = 1000


def sum_days(spots: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Units and points by the keys that the spots have."""
    return spots.groupBy(*[k for k in keys if k in spots.columns]).agg(
        F.sum("planned_units").alias("planned_units"), F.sum("planned_grp").alias("planned_grp"))


def spot_quarter() -> Column:
    """Years times four plus the quarter of the spot's start."""
    return (F.year("start_date") * 4 + F.quarter("start_date")).cast("int").alias("spot_quarter")


def partitions_of(spots: DataFrame) -> DataFrame:
    """The partitions that spots lie in, for ``DaySums.refresh``."""
    return spots.select("media_outlet_id", spot_quarter()).distinct()


class DaySums:
    """The kept sums of one schedule under ``<path>/<schedule>``."""

    def __init__(self, spark: SparkSession, path: str, schedule: str, spots: DataFrame):
        """``spots`` is the schedule as it is now; nothing is read of it before ``write`` or ``refresh``."""
        self.spark, self._keys, self._spots = spark, SCHEDULES[schedule], spots
        self._sums, self._plans = f"{path}/{schedule}/sums", f"{path}/{schedule}/plans"

    def write(self) -> None:
        """Sum the whole schedule."""
        # The hint splits partitions that are large for one task, and puts small ones together.
        write_table(self._summed(self._spots).hint("rebalance", *PARTITION), self._sums, PARTITION)
        write_table(self._lying(self._stored()), self._plans, PARTITION)

    def refresh(self, touched: DataFrame) -> None:
        """Sum the spots of the partitions ``touched`` anew and leave the others as they are.

        Partitions without spots by now go. Plans are named for a partition before its sums appear, and taken out after, so a run
        that ends in between leaves no sums that a report misses; doing it again finishes it. Nobody else may refresh meanwhile.
        """
        touched = stage(self.spark, touched.select(*PARTITION).distinct(), "touched_partitions")
        fresh = stage(self.spark, self._summed(self._within(self._spots.withColumn("spot_quarter", spot_quarter()), touched).drop("spot_quarter")), "fresh_sums")
        before = self._within(self._listed(), touched)
        replace_partitions(self.spark, self._lying(fresh).unionByName(before).distinct(), self._plans, PARTITION)
        replace_partitions(self.spark, fresh.hint("rebalance", *PARTITION), self._sums, PARTITION, touched)
        replace_partitions(self.spark, self._lying(fresh), self._plans, PARTITION, touched)

    def rows(self) -> DataFrame:
        """All sums."""
        return self._stored().drop("spot_quarter")

    def of_plans(self, plans: DataFrame) -> DataFrame:
        """The sums of all partitions that one of the plans lies in, so also other plans' sums there.

        The partitions are named in the scan's filter if there are at most ``NAMED_PARTITIONS``, so other files aren't opened.
        """
        lying = self._listed().join(plans.select("plan_id"), "plan_id", "left_semi").select(*PARTITION).distinct()
        named = lying.limit(NAMED_PARTITIONS + 1).collect()
        if len(named) > NAMED_PARTITIONS:
            return self.rows()
        quarters: dict[int | None, list[int | None]] = {}
        for outlet, quarter in named:
            quarters.setdefault(outlet, []).append(quarter)
        wanted = F.lit(False)
        for outlet, of_outlet in quarters.items():
            known = [q for q in of_outlet if q is not None]
            when = F.coalesce(F.col("spot_quarter").isin(known), F.lit(False))
            when = when | F.col("spot_quarter").isNull() if len(known) < len(of_outlet) else when
            wanted = wanted | (F.col("media_outlet_id").eqNullSafe(F.lit(outlet)) & when)
        return self._stored().where(wanted).drop("spot_quarter")

    def _summed(self, spots: DataFrame) -> DataFrame:
        return sum_days(spots, self._keys).withColumn("spot_quarter", spot_quarter())

    @staticmethod
    def _lying(sums: DataFrame) -> DataFrame:
        return sums.select("plan_id", *PARTITION).distinct()

    def _within(self, rows: DataFrame, touched: DataFrame) -> DataFrame:
        wanted = touched.select(*[F.col(c).alias(f"of_{c}") for c in PARTITION])
        same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in PARTITION]
        return rows.join(wanted, same, "left_semi")

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self._summed(self._spots).schema).parquet(self._sums)

    def _listed(self) -> DataFrame:
        return self.spark.read.schema(self._lying(self._summed(self._spots)).schema).parquet(self._plans)
