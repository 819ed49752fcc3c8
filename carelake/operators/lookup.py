"""Lookup joins against dimension state.

Every lookup is a LEFT equi join on the dimension key: a miss (or a NULL
foreign key) yields NULL attributes and never drops or repeats a fact row,
provided the dimension is unique on its key, which a materialized keyed
table is. The join strategy is left to Catalyst and AQE: the dimension is
broadcast only when its estimated or measured size is under
``spark.sql.autoBroadcastJoinThreshold``, otherwise a shuffled join is used.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from carelake.functions.rowkind import DELETE, RETRACT_KINDS

_seq = itertools.count()


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _mapping(dim: DataFrame, dim_key: str, cols, prefix: str) -> dict[str, str]:
    if cols is None:
        cols = [c for c in dim.columns if c != dim_key]
    if isinstance(cols, Mapping):
        return dict(cols)
    return {c: f"{prefix}{c}" for c in cols}


def lookup_join(facts: DataFrame, dim: DataFrame, on: str, *, dim_key: str = "id",
                cols: Mapping[str, str] | Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """Left-join dimension attributes onto ``facts`` where ``facts[on] == dim[dim_key]``.

    ``cols`` maps dimension column -> output name (or lists columns, named
    ``prefix + column``). The planner decides from sizes whether to broadcast.
    """
    mapping = _mapping(dim, dim_key, cols, prefix)
    tmp = f"__lk{next(_seq)}"
    d = dim.select(_q(dim_key).alias(tmp), *[_q(c).alias(o) for c, o in mapping.items()])
    return facts.join(d, F.col(on) == F.col(tmp), "left").drop(tmp)


def decode_codes(df: DataFrame, dictionary: DataFrame, codes: Mapping[str, str], *,
                 dict_key: str = "id", dict_value: str = "value") -> DataFrame:
    """Role-playing decode: one lookup of the same dictionary per code column.

    ``codes`` maps code column -> output name column.
    """
    out = df
    for code_col, name_col in codes.items():
        out = lookup_join(out, dictionary, code_col, dim_key=dict_key, cols={dict_value: name_col})
    return out


def lookup_join_asof(facts: DataFrame, dims: DataFrame, *, fact_key: str, dim_key: str,
                     fact_time: str, dim_time: str,
                     cols: Mapping[str, str] | Sequence[str] | None = None, prefix: str = "",
                     wait_seconds: int | None = None, bucket_seconds: int = 86400,
                     kind: str | None = None, dim_order: Sequence[str] = (), salts: int = 4) -> DataFrame:
    """Deterministic replay of a processing-time lookup over recorded times.

    Each fact gets the dimension version of its key with the greatest
    ``dim_time <= fact_time``. With ``wait_seconds``, a fact that finds no row
    takes the first version with ``fact_time < dim_time <=
    fact_time + wait``, the bounded wait for a late dimension row; otherwise
    its attributes are NULL.

    With ``kind`` (a row-kind column of ``dims``) versions are changes: after a
    retraction the key is absent, and the wait goes on to the next live
    version. Versions of one time are ordered by ``dim_order`` (the producer's arrival),
    then before-images, deletes and live images in this order, then attributes.

    Skew: a key may hold a large share of rows, so the ordered scan is split
    by (key, time bucket, salt of the fact); versions, few beside the facts, are copied to the
    salts. Only a per-bucket summary (the last and the first live
    version of each bucket) is carried across buckets of a key, one row per key-bucket.
    Facts with a NULL key or time match nothing and skip the scan.
    """
    mapping = _mapping(dims, dim_key, cols, prefix)
    if dim_time in mapping:
        raise ValueError("include the dimension time through a separate column")
    fact_cols = facts.columns
    bucket_us = int(bucket_seconds) * 1_000_000

    def tbucket(t: Column) -> Column:
        return F.floor(F.unix_micros(t.cast("timestamp")) / F.lit(bucket_us))

    live = ~_q(kind).isin(*RETRACT_KINDS) if kind else F.lit(True)
    rank = F.when(live, 2).when(_q(kind) == DELETE, 1).otherwise(0) if kind else F.lit(2)
    dstruct = F.struct(_q(dim_time).alias("__t"), *[_q(c).alias(f"__o{k}") for k, c in enumerate(dim_order)],
                       rank.alias("__rank"), *[_q(c).alias(o) for c, o in mapping.items()])
    d = (dims.filter(_q(dim_key).isNotNull() & _q(dim_time).isNotNull())
             .select(_q(dim_key).alias("__k"), _q(dim_time).alias("__t"), F.lit(0).alias("__tag"),
                     F.lit(None).alias("__f"), dstruct.alias("__d")))
    usable = _q(fact_key).isNotNull() & _q(fact_time).isNotNull()
    f = facts.filter(usable).select(
        _q(fact_key).alias("__k"), _q(fact_time).alias("__t"), F.lit(1).alias("__tag"),
        F.struct(*[_q(c) for c in fact_cols]).alias("__f"),
        F.lit(None).cast(d.schema["__d"].dataType).alias("__d"))
    d = d.withColumn("__f", F.lit(None).cast(f.schema["__f"].dataType)).withColumn("__b", tbucket(F.col("__t")))
    n_salts = max(int(salts), 1)
    f = f.withColumn("__b", tbucket(F.col("__t"))).withColumn(
        "__s", F.pmod(F.xxhash64("__f"), F.lit(n_salts)).cast("int"))
    copies = d.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))))
    u = f.unionByName(copies)
    is_live = F.col("__d.__rank") == 2

    # 1. inside each (key, bucket, salt): nearest version before and live version after each fact
    w = Window.partitionBy("__k", "__b", "__s").orderBy("__t", "__tag", "__d")
    local = (u.withColumn("__prev", F.last("__d", ignorenulls=True).over(
                 w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    if wait_seconds is not None:
        local = local.withColumn("__next", F.first(F.when(is_live, F.col("__d")), ignorenulls=True).over(
            w.rowsBetween(1, Window.unboundedFollowing)))
    else:
        local = local.withColumn("__next", F.lit(None).cast(d.schema["__d"].dataType))
    fact_rows = local.filter(F.col("__tag") == 1)

    # 2. per (key, bucket) summary, carried across the buckets of a key; a
    #    partial aggregate before its shuffle, so it moves one row per
    #    key-bucket and input partition
    places = f.select("__k", "__b", F.lit(None).cast(d.schema["__d"].dataType).alias("__d"))
    summary = d.select("__k", "__b", "__d").unionByName(places).groupBy("__k", "__b").agg(
        F.max("__d").alias("__last"), F.min(F.when(is_live, F.col("__d"))).alias("__first"))
    wk = Window.partitionBy("__k").orderBy("__b")
    carry = summary.select(
        "__k", "__b",
        F.last("__last", ignorenulls=True).over(wk.rowsBetween(Window.unboundedPreceding, -1)).alias("__cprev"),
        F.first("__first", ignorenulls=True).over(wk.rowsBetween(1, Window.unboundedFollowing)).alias("__cnext"))

    j = fact_rows.join(carry, on=["__k", "__b"], how="left")
    prev = F.coalesce(F.col("__prev"), F.col("__cprev"))
    nxt = F.coalesce(F.col("__next"), F.col("__cnext"))
    hit = F.when(prev["__rank"] == 2, prev)
    if wait_seconds is not None:
        deadline = F.col("__t") + F.make_interval(secs=F.lit(int(wait_seconds)))
        hit = hit.when(nxt["__t"] <= deadline, nxt)
    j = j.withColumn("__hit", hit)
    found = j.select(*[F.col("__f")[c].alias(c) for c in fact_cols],
                     *[F.col("__hit")[o].alias(o) for o in mapping.values()])
    types = {fld.name: fld.dataType for fld in found.schema.fields}
    rest = facts.filter(~usable).select(*[_q(c) for c in fact_cols],
                                        *[F.lit(None).cast(types[o]).alias(o) for o in mapping.values()])
    return found.unionByName(rest)


def duplicate_keys(dim: DataFrame, keys: Sequence[str] | str = "id") -> DataFrame:
    """Keys that occur more than once in ``dim`` with their counts (S3 check)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return dim.groupBy(*[_q(k) for k in keys]).count().filter(F.col("count") > 1)


def assert_unique_key(dim: DataFrame, keys: Sequence[str] | str = "id") -> DataFrame:
    """Raise if a lookup side repeats a key (a lookup would then repeat facts).

    One distributed aggregation; only the first offending key reaches the
    driver. Returns ``dim`` for chaining.
    """
    dup = duplicate_keys(dim, keys).limit(1).collect()
    if dup:
        raise ValueError(f"lookup key not unique: {dup[0].asDict()}")
    return dim
