"""Typed conform of a DataFrame to a target schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from carelake.sources.specs import META


def _cast(col: Column, dtype: T.DataType, strict: bool) -> Column:
    return col.cast(dtype) if strict else col.try_cast(dtype)


def conform(df: DataFrame, schema: T.StructType, *, strict: bool = True,
            keep: tuple[str, ...] = META) -> DataFrame:
    """Assign the data columns of ``df`` to ``schema`` **by position**.

    Like an ``INSERT INTO t SELECT ...``, the i-th data column lands in the
    i-th target column whatever its name (R10), cast to the target type.
    ``strict`` casts raise on overflow (ANSI); otherwise bad values become
    NULL (R13). Bookkeeping columns named in ``keep`` pass through at the end.
    A casting no-op (same type) is dropped by the optimizer.
    """
    data = [c for c in df.columns if c not in keep]
    if len(data) != len(schema.fields):
        raise ValueError(
            f"conform: {len(data)} source columns {data} for {len(schema.fields)} "
            f"target columns {[f.name for f in schema.fields]}")
    cols = [
        _cast(F.col(f"`{src}`"), fld.dataType, strict).alias(fld.name, metadata=fld.metadata)
        for src, fld in zip(data, schema.fields)
    ]
    cols += [F.col(c) for c in df.columns if c in keep]
    return df.select(*cols)


def split_rejects(df: DataFrame, not_null: tuple[str, ...] | list[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows with a NULL in any ``not_null`` column off.

    Returns ``(good, rejects)``; both are lazy filters of the same input,
    so callers that use both should persist or checkpoint ``df`` first.
    """
    if not not_null:
        return df, df.limit(0)
    bad = F.lit(False)
    for c in not_null:
        bad = bad | F.col(c).isNull()
    return df.filter(~bad), df.filter(bad)


#: What a rejected row carries: the column, its value and why it does not fit.
ERRORS = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("field", "value", "reason")]))


def split_unfit(df: DataFrame, target: T.StructType, required: tuple[str, ...] | list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split off rows that strict casts to ``target`` would stop at, or with a NULL in ``required``.

    Source columns are checked against the target column of their name. Returns ``(good, rejects)``, each row of ``df``
    in one of them; rejects keep the source's columns and have ``errors``, one for every column that does not fit.
    Both are lazy filters, so a bad value is seen before any cast of it.
    """
    checks = [(F.col(f"`{f.name}`"), f.name, f.dataType) for f in target.fields
              if f.name in df.columns and df.schema[f.name].dataType != f.dataType and not isinstance(f.dataType, T.StringType)]
    bad = [(c, name, c.isNotNull() & c.try_cast(t).isNull(), f"not {t.simpleString()}") for c, name, t in checks]
    bad += [(F.col(f"`{name}`"), name, F.col(f"`{name}`").isNull(), "null") for name in required]
    if not bad:
        return df, df.limit(0).withColumn("errors", F.lit(None).cast(ERRORS))
    unfit = F.lit(False)
    for _, _, test, _ in bad:
        unfit = unfit | test
    errors = F.array(*[F.when(test, F.struct(F.lit(name).alias("field"), c.cast("string").alias("value"),
                                             F.lit(reason).alias("reason"))) for c, name, test, reason in bad])
    return df.filter(~unfit), df.filter(unfit).withColumn("errors", F.filter(errors, lambda e: e.isNotNull()))
