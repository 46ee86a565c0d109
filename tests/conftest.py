import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("spotgrid-tests").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="session")
def calendar(spark):
    """Days, weeks and quarters of 2024, quarters made of whole weeks."""
    monday, rows = day("2024-01-01"), []
    for q in range(4):
        start = monday + dt.timedelta(days=91 * q)
        rows.append((100 + q, "Q", f"{q + 1}Q24", f"{q + 1}Q24", start, start + dt.timedelta(days=90)))
        for w in range(13):
            ws = start + dt.timedelta(days=7 * w)
            rows.append((1000 + 13 * q + w, "W", f"W{13 * q + w}", f"{q + 1}Q24", ws, ws + dt.timedelta(days=6)))
        for d in range(91):
            ds = start + dt.timedelta(days=d)
            rows.append((5000 + 91 * q + d, "D", f"D{91 * q + d}", f"{q + 1}Q24", ds, ds))
    return spark.createDataFrame(rows, "period_id int, period_type string, name string, fiscal_qtr string, start_date date, end_date date")
