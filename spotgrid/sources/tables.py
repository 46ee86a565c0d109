"""Where operators get their input tables from.

``Tables`` reads one parquet directory (or catalog table) per planning table.
``BoundTables`` derives the same tables from the star-schema files. Both hand out
DataFrames lazily by attribute, so a report only touches what it uses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from spotgrid.sources.binding import BASE_TABLES, referenced, takes_shuffle, view_sql
from spotgrid.sources.day_sums import SCHEDULES, DaySums, sum_days
from spotgrid.sources.shared import new_table_path, stage


class Tables:
    """Planning tables held as ``<root>/<name>`` parquet, or as ``<database>.<name>`` tables."""

    def __init__(self, spark: SparkSession, root: str | None = None, database: str | None = None,
                 overrides: dict[str, DataFrame] | None = None):
        self.spark = spark
        # Rows that a report deals by plan and project once stay there for joins by these and more columns.
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        self._root, self._database = root, database
        self._given: dict[str, DataFrame] = dict(overrides or {})
        self._frames: dict[str, DataFrame] = dict(self._given)
        self._made: dict[str, DataFrame] = {}
        self._stores: dict[str, DaySums] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def _load(self, name: str) -> DataFrame:
        if self._root is not None:
            return self.spark.read.parquet(f"{self._root}/{name}")
        if self._database is not None:
            return self.spark.table(f"{self._database}.{name}")
        raise KeyError(f"table {name!r} was not given")

    def given(self, name: str) -> bool:
        """Whether the table was handed in, rather than to be read from storage."""
        return name in self._given

    def replace(self, **frames: DataFrame) -> "Tables":
        """The same tables with some of them swapped, e.g. filtered to one plan."""
        other = type(self)(self.spark, self._root, self._database, {**self._given, **frames})
        other._frames = {**self._frames, **other._given}
        other._made = {name: frame for name, frame in self._made.items() if not set(self._made_of[name]) & set(frames)}
        other._stores = {name: store for name, store in self._stores.items() if name not in frames}
        return other

    #: Derived tables and the tables they are made of.
    _made_of: dict[str, tuple[str, ...]] = {}

    def _kept(self, made_of: tuple[str, ...]) -> dict[str, DataFrame]:
        """Where what is made of these tables is remembered."""
        return self._made

    def derived(self, name: str, made_of: tuple[str, ...], build: Callable[[Tables], DataFrame]) -> DataFrame:
        """A table that many reports read, written once for these tables; swapping one that it is made of makes it anew."""
        self._made_of[name] = made_of
        kept = self._kept(made_of)
        if name not in kept:
            kept[name] = stage(self.spark, build(self), name)
        return kept[name]

    def day_sums(self, path: str) -> dict[str, DaySums]:
        """The stores of both schedules' day sums under a folder, to be written or refreshed."""
        return {name: DaySums(self.spark, path, name, getattr(self, name)) for name in SCHEDULES}

    def with_stored_sums(self, path: str) -> "Tables":
        """The same tables, with day sums read from the stores written under a folder. A schedule that is swapped leaves its store."""
        other = self.replace()
        other._stores = self.day_sums(path)
        return other

    def with_day_sums(self, own_plans: bool = False, schedules: Iterable[str] = SCHEDULES) -> "Tables":
        """The same tables with both schedules, or the given ones, summed per day, goal and daypart.

        Without a store the sums are written once for these tables and serve every grid that needs weeks or days of spots. With
        ``own_plans``, sums of plans that are not in a swapped plan table may be left out, as far as a store needn't read them.
        """
        def sums(name: str, keys: tuple[str, ...]) -> DataFrame:
            if name in self._stores:
                return self._stores[name].of_plans(self.plan) if own_plans and self.given("plan") else self._stores[name].rows()
            return self.derived(f"{name}_days", (name,), lambda t: sum_days(getattr(t, name), keys))

        return self.replace(**{name: sums(name, keys) for name, keys in SCHEDULES.items() if name in schedules})


class BoundTables(Tables):
    """Planning tables derived from ``<root>/{lineitem,orders,...}.parquet``.

    Plain projections stay lazy over the base files. Tables that take a join or an aggregation
    are written once per session to the shared folder, as a planning database would hold them;
    so a report reads stored tables instead of deriving the same one several times.
    """

    _frames_of: dict[tuple[str, str], dict[str, DataFrame]] = {}

    def __init__(self, spark: SparkSession, root: str, database: str | None = None,
                 overrides: dict[str, DataFrame] | None = None):
        super().__init__(spark, str(root), database, overrides)
        # Opened tables are kept per application, so a table is listed and written once.
        self._opened = self._frames_of.setdefault((spark.sparkContext.applicationId, str(root)), {})

    def _kept(self, made_of: tuple[str, ...]) -> dict[str, DataFrame]:
        return self._made if set(made_of) & set(self._given) else self._opened

    def _load(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._open(name)
        return self._opened[name]

    def _open(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self._root}/{name}.parquet")
        sql = view_sql(name, "spark")
        frame = self.spark.sql(sql, **{dep: self._load(dep) for dep in referenced(sql)})
        path = new_table_path(self.spark, name) if takes_shuffle(sql) else None
        if path is None:
            return frame
        frame.write.parquet(path)
        return self.spark.read.parquet(path)
