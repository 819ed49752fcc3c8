"""Partition day and time-of-day columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the day pattern of the ``dt`` partition column.
DAY_PATTERN = "yyyy-MM-dd"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_of(ts: str | Column) -> Column:
    """``DATE_FORMAT(ts, 'yyyy-MM-dd')``; zone-less input is not shifted."""
    return F.date_format(_c(ts), DAY_PATTERN)


def hour_of(ts: str | Column) -> Column:
    """``HOUR(ts)`` as BIGINT (Spark returns INT, the target stores BIGINT)."""
    return F.hour(_c(ts)).cast("bigint")


def minute_of(ts: str | Column) -> Column:
    """``MINUTE(ts)`` as BIGINT."""
    return F.minute(_c(ts)).cast("bigint")


def proc_time() -> Column:
    """Processing time: one value per query or micro-batch."""
    return F.current_timestamp()


def with_dt(df: DataFrame, source: str = "create_time", name: str = "dt") -> DataFrame:
    return df.withColumn(name, day_of(source))
