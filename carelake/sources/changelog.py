"""Change-log scans.

A change log is any DataFrame with data columns plus ``rowkind`` and
``arrival``. In batch it is read with ``spark.read``; as a stream with
``spark.readStream`` over an append-only folder (or any append source).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from carelake.sources.specs import ARRIVAL, ROWKIND


def as_changelog(df: DataFrame, rowkind: Column | str | None = None,
                 arrival: Column | str | None = None) -> DataFrame:
    """Attach ``rowkind`` / ``arrival`` to an arbitrary DataFrame.

    Without ``rowkind`` every row is an insert. ``arrival`` must come from the
    producer (a log offset); it must be stable when a batch is replayed.
    """
    def col(x):
        return F.col(x) if isinstance(x, str) else x
    kind = col(rowkind) if rowkind is not None else F.lit("+I")
    if arrival is None:
        raise ValueError("as_changelog needs an arrival column (producer offset)")
    data = [c for c in df.columns if c not in (ROWKIND, ARRIVAL)]
    return df.select(*data, kind.alias(ROWKIND), col(arrival).cast("bigint").alias(ARRIVAL))


def read_changelog(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   *, stream: bool = False, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Read a change-log folder in batch or as a stream."""
    if stream:
        reader = spark.readStream.format(fmt)
        if schema is None:
            schema = spark.read.format(fmt).load(path).schema
        reader = reader.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.load(path)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
