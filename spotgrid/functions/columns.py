"""Column expressions shared by the reports and jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output types, and the model type that runs each plan type.
UNITS, GRP = 1, 2
MODEL_TYPE_OF_PLAN_TYPE = {1: 1, 2: 3}


def measure(output_type: int, units: str = "planned_units", grp: str = "planned_grp") -> Column:
    """Spots for output type 1, rating points for any other."""
    return F.col(units) if output_type == UNITS else F.col(grp)


def model_type(plan_type: Column) -> Column:
    pairs = [F.when(plan_type == p, F.lit(m)) for p, m in MODEL_TYPE_OF_PLAN_TYPE.items()]
    return F.coalesce(*pairs)


def greatest_known(*cols: str) -> Column:
    """The greatest of the columns, null if one of them is; Spark's own leaves nulls out."""
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    return F.when(known, F.greatest(*cols))


def json_fault(text: str, root: str, other: Column, sound: Column) -> Column:
    """Why a JSON text can't be loaded: it is null, no JSON, no ``root`` (ARRAY or OBJECT), or, with reason ``other``, not ``sound``; else null."""
    parsed = F.try_parse_json(text)
    return (
        F.when(F.col(text).isNull(), "no text").when(parsed.isNull(), "no JSON")
        .when(~F.startswith(F.schema_of_variant(parsed), F.lit(root)), F.lit(f"no {root.lower()}")).when(~F.coalesce(sound, F.lit(False)), other)
    )


def flight_weeks(start: Column, end: Column) -> Column:
    """Weeks a flight covers, counting a same-day flight as one day."""
    days = F.datediff(end, start)
    return F.ceil(F.when(days == 0, F.lit(1)).otherwise(days) / 7).cast("int")


def monday_of(d: Column) -> Column:
    return F.date_trunc("week", d).cast("date")


def time_to_offset(clock: Column) -> Column:
    """Seconds since midnight of an ``HH:MM:SS`` text; hours may pass 24 on the broadcast clock."""
    part = F.split(clock, ":")
    return (part[0].cast("int") * 3600 + part[1].cast("int") * 60 + part[2].cast("int")).cast("int")


def offset_to_time(seconds: Column) -> Column:
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(seconds / 3600).cast("int"), F.floor(seconds % 3600 / 60).cast("int"), (seconds % 60).cast("int"),
    )


def clock12(seconds: Column) -> Column:
    """``hh:mm AM`` of a seconds offset; offsets past midnight wrap round."""
    return F.date_format(F.timestamp_seconds(seconds % 86400), "hh:mm a")


def own_network_first(project_outlet: Column, plan_outlet: Column) -> Column:
    return F.when(project_outlet == plan_outlet, F.lit(1)).otherwise(F.lit(99))


def week_label(quarter_start: Column, week_date: Column) -> Column:
    return F.concat(F.lit("Week"), (F.round(F.datediff(week_date, quarter_start) / 7) + 1).cast("int").cast("string"))
