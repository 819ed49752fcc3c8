"""Helpers shared by the text operators: reading, table cuts, blocks of rows."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from carelake.session import work_dir

#: Characters of text that one Python block works on at a time; a single longer text is a block of its own.
BLOCK_CHARS = 4_000_000


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_carelake_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="carelake-")) / "carelake.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._carelake_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared working folder and read it back, which ends its lineage."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_blocks(batches: Iterable[pa.RecordBatch], text: str = "text",
                chars: int = BLOCK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with about ``chars`` bytes of text each, and their texts (null: empty)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
        ends = np.cumsum(np.diff(np.frombuffer(column.buffers()[1], np.int64)[
            column.offset:column.offset + len(column) + 1]))
        start = 0
        while start < len(column):
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + chars, "right")), start + 1)
            yield (batch.slice(start, stop - start),
                   [t or "" for t in column.slice(start, stop - start).to_pylist()])
            start = stop


class RecentCache:
    """A dictionary that holds what was used lately, at most ``2 * size`` entries.

    Entries that were not asked for while ``size`` others came in are let go,
    so the memory of a worker does not grow with the corpus.
    """

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys: Iterable) -> list:
        """The keys it doesn't hold; those it holds are kept for the next generation."""
        new, old, out = self.new, self.old, []
        for k in keys:
            if k not in new:
                v = old.get(k)
                if v is None:
                    out.append(k)
                else:
                    new[k] = v
        return out

    def trim(self) -> None:
        """To be called between blocks."""
        if len(self.new) > self.size:
            self.new, self.old = {}, self.new


_HELD: dict = {}


def held(key, make: Callable):
    """What ``make()`` gives, kept in the Python worker until another key is asked for: workers are
    used again by other tasks and operators, and only one large object stays in each."""
    if _HELD.get("key") != key:
        release()
        _HELD.update(key=key, value=make())
    return _HELD["value"]


def release() -> None:
    """Let go of what ``held`` keeps, for tasks that need the worker's memory for something else, and give
    freed memory back to the system: allocators keep it otherwise, and workers are used again."""
    if _HELD:
        _HELD.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_blocks(df: DataFrame, fn: Callable[[pa.RecordBatch, list[str]], dict], schema,
               chars: int = BLOCK_CHARS) -> DataFrame:
    """``fn(batch, texts)`` returns the columns of its block of about ``chars``, by name of ``schema``.

    Slices of ``chars // 400`` rows are looked at, all of an Arrow batch by default, so small blocks copy few texts."""
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(schema)
    ship(df.sparkSession)

    def run(batches):
        rows = max(chars // 400, 1)
        slices = (b.slice(k, rows) for b in batches for k in range(0, b.num_rows, rows))
        for batch, texts in text_blocks(slices, chars=chars):
            columns = fn(batch, texts)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                 for f in target for c in [columns[f.name]]], schema=target)

    return df.mapInArrow(run, schema)
