"""The shared folder where jobs put tables that several steps read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_MARKED: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset, a session on one machine (tests, the benchmark) gets a folder of its own that
    is deleted when the process ends. On a cluster there is no such folder and the job is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="spotgrid-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return _OWN[app]


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path nothing has been written to yet; the run's tables are deleted when its JVM ends."""
    app = f"{shared_folder(spark)}/spotgrid/{spark.sparkContext.applicationId}"
    if app not in _MARKED:
        folder = spark._jvm.org.apache.hadoop.fs.Path(app)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _MARKED.add(app)
    return f"{app}/{uuid.uuid4().hex[:8]}/{name}"


def stage(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """Write a frame that several steps read to the shared folder, and read it back.

    A written table cuts the lineage and outlives lost executors.
    """
    path = new_table_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
