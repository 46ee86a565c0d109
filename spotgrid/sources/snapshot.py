"""Write job results as table snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotgrid.sources.shared import stage


def write_table(frame: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write a whole snapshot as parquet."""
    frame.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_rows(frame: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Add rows to a log-like table, such as new runs."""
    frame.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_run(spark: SparkSession, frame: DataFrame, path: str, run_id: str, run_column: str = "save_run") -> None:
    """Add a run's rows to a history that is partitioned by run. A run that is repeated replaces its own rows, so doing it twice changes nothing."""
    touched = spark.range(1).select(F.lit(run_id).alias(run_column))
    replace_partitions(spark, frame.withColumn(run_column, F.lit(run_id)), path, (run_column,), touched)


def replace_partitions(spark: SparkSession, frame: DataFrame, path: str, partition_by: tuple[str, ...], touched: DataFrame | None = None) -> None:
    """Overwrite the partitions that ``frame`` has rows for, and empty those of ``touched`` that it has none for; the others stay as they are.

    ``touched`` holds the partition columns of all that a job may have changed; a frame that is a whole new state of these
    partitions then loses no removal. The rows are staged first, since a snapshot is usually computed from the very table
    it replaces; only partition values reach the driver, as Spark's own partitioned write has them. Rows are published
    before emptied partitions go, and doing all of it again gives the same table.
    """
    staged = stage(spark, frame, "snapshot")
    keys = [F.col(c).cast("string").alias(c) for c in partition_by]
    wanted = stage(spark, touched.select(*keys).distinct(), "touched") if touched is not None else None
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    if wanted is None:
        return
    known = staged.select(*keys).distinct().alias("known")
    same = [wanted[c].eqNullSafe(F.col(f"known.{c}")) for c in partition_by]
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    Path = spark._jvm.org.apache.hadoop.fs.Path
    files = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for row in wanted.join(known, same, "left_anti").toLocalIterator():
        files.delete(Path("/".join([path, *[named(c, row[c]) for c in partition_by]])), True)
