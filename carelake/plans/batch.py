"""Batch runs of the warehouse jobs over a set of source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.operators.changelog import materialize
from carelake.plans import standins
from carelake.plans.warehouse import JOBS, build, checked_rows
from carelake.session import work_dir


def table_reader(spark: SparkSession, sf_dir: str):
    """``name -> DataFrame`` over ``{sf_dir}/{name}.parquet``."""
    sf_dir = sf_dir.rstrip("/")
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Warehouse:
    """Builds any target table in batch, deriving the lookups it needs.

    Lookup views are the live rows of the source (``ods_dict``) or of
    another target table (``dim_*``), built from the same tables.

    Each lookup view is written once to the shared working folder and read back, as a job reads a
    dimension's state table: it is computed once however many lookups use it, lookups read only the
    columns they need, and the planner sees its real size, so it is broadcast only when it is
    under ``spark.sql.autoBroadcastJoinThreshold`` and joined by a shuffle
    otherwise. (A view derived through joins and aggregates otherwise gets
    a static estimate far above its size, and the fact side would be
    shuffled for a tiny dimension.) Nothing stays cached.
    """

    def __init__(self, tables, *, materialize_views: bool = True):
        self.tables = tables
        self.materialize_views = materialize_views
        self._views: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        return standins.SOURCES[name](self.tables)

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            view = self.table(name) if name in JOBS else materialize(self.source(name), ["id"])
            if self.materialize_views:
                path = work_dir(view.sparkSession, f"view-{name}")
                view.write.parquet(path)
                view = view.sparkSession.read.schema(view.schema).parquet(path)
            self._views[name] = view
        return self._views[name]

    def rejects(self, name: str) -> DataFrame:
        """Rows of a table's source that do not fit, with ``errors``: what ``table`` leaves out."""
        return checked_rows(JOBS[name], self.source(JOBS[name].source))[1]

    def table(self, name: str) -> DataFrame:
        job = JOBS[name]
        return build(job, self.source(job.source), {n: self.view(n) for n in job.lookups})
