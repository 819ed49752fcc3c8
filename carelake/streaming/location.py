"""Where a target table lives, and rebuilding it without deleting in place.

A table ``name`` under ``root`` has numbered versions; each version has its
own state, checkpoint, change feed and rejects folders. ``rebuild`` (the
jobs' ``drop table`` + ``CREATE TABLE``) starts a new version: the new
streaming query has a fresh checkpoint, so it re-reads its source from the
start into empty state, while the old version stays readable until it is
removed by retention. Pointers are append-only: one small file per published
version, the highest wins. A death between a version's creation and its
publication leaves a version that nobody sees and that the next ``open_table`` takes up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from carelake.sources.specs import TableSpec
from carelake.streaming.files import NumberedLog, names, write_once
from carelake.streaming.sink import create_if_absent


@dataclass(frozen=True)
class TableLocation:
    root: str
    name: str
    version: int

    @property
    def base(self) -> str:
        return f"{self.root.rstrip('/')}/{self.name}/v{self.version}"

    @property
    def state(self) -> str:
        return f"{self.base}/state"

    @property
    def checkpoint(self) -> str:
        return f"{self.base}/checkpoint"

    @property
    def feed(self) -> str:
        return f"{self.base}/feed"

    @property
    def rejects(self) -> str:
        return f"{self.base}/rejects"


def _pointers(spark: SparkSession, root: str, name: str) -> NumberedLog:
    return NumberedLog(spark, f"{root.rstrip('/')}/{name}/_published")


def _opened(root: str, name: str) -> str:
    """Holds a mark for every version ever published, apart from the pointers: tells a lost pointer from a
    table that was never published."""
    return f"{root.rstrip('/')}/{name}/_marks"


def current(spark: SparkSession, root: str, name: str) -> TableLocation:
    """The current version of ``name`` (version 0 when never built).

    Raises if a version was published but its pointer is gone: falling back to an older one would
    bring old rows back.
    """
    newest = _pointers(spark, root, name).newest()
    marks = names(spark, _opened(root, name))
    if marks and int(marks[-1]) > newest:
        raise FileNotFoundError(f"{root}/{name}: version {int(marks[-1])} was published, its pointer is gone")
    return TableLocation(root, name, max(newest, 0))


def publish(spark: SparkSession, loc: TableLocation) -> None:
    """Make ``loc`` the current version: one more pointer, written once; the highest wins."""
    pointers = _pointers(spark, loc.root, loc.name)
    if not pointers.has(loc.version):
        pointers.write(loc.version, {"version": loc.version})
    mark = f"{_opened(loc.root, loc.name)}/{loc.version:09d}"
    if not names(spark, mark):
        write_once(spark, f"{mark}/published", "")


def open_table(spark: SparkSession, root: str, spec: TableSpec, *,
               rebuild: bool = False, publish_now: bool = True) -> TableLocation:
    """``CREATE TABLE IF NOT EXISTS``, or with ``rebuild`` a fresh version of it.

    With ``publish_now=False`` a rebuilt version stays out of sight until ``publish``
    is called, after its job has caught up.
    """
    loc = current(spark, root, spec.name)
    if rebuild:
        loc = TableLocation(root, spec.name, loc.version + 1)
    create_if_absent(spark, spec, loc.state)
    if publish_now:
        publish(spark, loc)
    return loc
