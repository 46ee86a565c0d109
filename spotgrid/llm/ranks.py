"""Global row numbers without one task that sorts everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotgrid.sources.shared import stage


def with_rank(spark: SparkSession, rows: DataFrame, order: Column, name: str) -> DataFrame:
    """Add ``name``, the row's place from 0 in the given order.

    Rows are range-partitioned and written; places within a part are shifted by the counts of the parts before it.
    The only unpartitioned window runs over one row per part.
    """
    parts = stage(spark, rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranked_parts")
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return parts.withColumn("_at", within).join(before, "_part").withColumn(name, (F.col("_before") + F.col("_at") - 1).cast("long")).drop("_part", "_at", "_before")
