"""Hash buckets of a key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bucket_of(key: str | Column, n: int, method: str = "hash") -> Column:
    """Bucket number in ``[0, n)`` of ``key``.

    ``hash`` uses ``xxhash64`` (stable across runs and engines of Spark);
    ``mod`` uses the integral key itself, for layouts another engine must
    reproduce.
    """
    k = F.col(key) if isinstance(key, str) else key
    if n <= 1:
        return F.lit(0)
    if method == "hash":
        return F.pmod(F.xxhash64(k), F.lit(n)).cast("int")
    if method == "mod":
        return F.pmod(k.cast("bigint"), F.lit(n)).cast("int")
    raise ValueError(f"unknown bucket method {method!r}")
