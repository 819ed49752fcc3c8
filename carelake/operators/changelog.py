"""Change-log state operators.

The winner of a key is the row with the greatest ``order`` tuple (sequence,
then arrival); remaining columns break any tie, so the result never depends
on input order. NULL sorts lowest, so a NULL sequence loses to any value (R2).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from carelake.functions.rowkind import DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE, is_live
from carelake.sources.specs import ARRIVAL, META, ROWKIND


def _q(name: str) -> str:
    """A column name in SQL. Select lists here are SQL texts: one call to the JVM instead of one per column."""
    return "`" + name.replace("`", "``") + "`"


def _struct(names: Sequence[str]) -> str:
    return f"struct({', '.join(_q(c) for c in names)})"


def _images(before: str, after: str) -> Column:
    """Change rows (kind, image) of a key from its images before and after."""
    return F.expr(f"""CASE WHEN {before} IS NULL THEN array(struct('{INSERT}' AS k, {after} AS v))
        WHEN {after} IS NULL THEN array(struct('{DELETE}' AS k, {before} AS v))
        ELSE array(struct('{UPDATE_BEFORE}' AS k, {before} AS v), struct('{UPDATE_AFTER}' AS k, {after} AS v)) END""")


def _changes(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows of the images ``__b`` and ``__a`` of each key."""
    out = df.select(*[_q(k) for k in keys], F.explode(_images("__b", "__a")).alias("__c"))
    return out.selectExpr(f"__c.k AS {ROWKIND}", *[_q(k) for k in keys], *[f"__c.v.{_q(c)} AS {_q(c)}" for c in cols])


def inserts_only(df: DataFrame, *, drop_kind: bool = False) -> DataFrame:
    """Insert events of an audit log: ``WHERE rowkind = '+I'``."""
    out = df.filter(F.col(ROWKIND) == INSERT)
    return out.drop(ROWKIND) if drop_kind else out


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (ARRIVAL,)) -> DataFrame:
    """One row per key: the greatest by ``order``, then by every other column.

    A group-by on the key with ``max(struct(...))``: it
    runs a partial aggregate before the shuffle, so each input partition
    sends at most one row per key, and a key holding a large share of the
    rows is collapsed map-side instead of landing whole in one task.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    winner = F.expr(f"max({_struct(order + rest)})").alias("__win") if order + rest else F.lit(None).alias("__win")
    out = df.groupBy(*[_q(k) for k in keys]).agg(winner)
    return out.selectExpr(*[_q(c) if c in keys else f"__win.{_q(c)} AS {_q(c)}" for c in df.columns])


def materialize(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (ARRIVAL,),
                *, keep_meta: bool = False) -> DataFrame:
    """Current rows of a change log: winner per key, tombstones hidden."""
    out = latest_by_key(df, keys, order).filter(is_live())
    return out if keep_meta else out.drop(*[c for c in META if c in out.columns])


def filter_changelog(df: DataFrame, predicate: Column) -> DataFrame:
    """``WHERE predicate`` on an updating table.

    A row failing the predicate is not dropped but turned into a tombstone
    of its key, so a key that stops matching leaves the result. NULL counts
    as failing, as in SQL.
    """
    kind = F.when(predicate, F.col(ROWKIND)).otherwise(F.lit(DELETE))
    return df.withColumn(ROWKIND, kind)


def merge_state(state: DataFrame, batch: DataFrame, keys: Sequence[str],
                order: Sequence[str] = (ARRIVAL,)) -> DataFrame:
    """New state of a keyed table after a batch of changes (C4).

    Tombstones stay in the state so a late, older version of a deleted key
    cannot bring it back. Idempotent: merging the same batch twice gives the
    same state.
    """
    return latest_by_key(state.unionByName(batch), keys, order)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed between two snapshots of a keyed table.

    Rows only in ``after`` become ``+I``; rows only in ``before`` become
    ``-D``; changed rows become a ``-U`` (old values) and ``+U`` (new values)
    pair. Unchanged rows (NULL-safe equal) produce nothing. One full outer
    join on the key; the two images are emitted with one ``explode``.
    """
    keys = list(keys)
    cols = [c for c in after.columns if c not in keys and c not in META]
    b = before.selectExpr(*[_q(k) for k in keys], f"{_struct(cols)} AS __b")
    a = after.selectExpr(*[_q(k) for k in keys], f"{_struct(cols)} AS __a")
    joined = b.join(a, on=keys, how="full_outer").filter("NOT (__b <=> __a)")
    return _changes(joined, keys, cols)


def compact_feed(feed: DataFrame, keys: Sequence[str], after_batch: int | None = None,
                 upto_batch: int | None = None, *, batch_col: str = "batch_id") -> DataFrame:
    """Net change between two versions from a per-batch change feed.

    ``feed`` holds each commit's changes (``+I``; ``-U``/``+U`` pairs; ``-D``)
    with the commit number in ``batch_col``. The result is the change feed
    between the state after ``after_batch`` and the state after
    ``upto_batch``: per key, the first before-image and the last after-image
    in the range, compared like ``snapshot_diff``. Keys changed and changed
    back produce nothing. One aggregation by key (partial before the
    shuffle), so a feed of many commits compacts at the cost of one pass.
    """
    keys = list(keys)
    cols = [c for c in feed.columns if c not in keys and c not in (ROWKIND, batch_col)]
    f = feed
    if after_batch is not None:
        f = f.filter(F.col(batch_col) > F.lit(after_batch))
    if upto_batch is not None:
        f = f.filter(F.col(batch_col) <= F.lit(upto_batch))
    # within a commit the before-image (-U/-D) sorts ahead of the after-image (+I/+U)
    change = (f"struct({_q(batch_col)} AS b, CAST({ROWKIND} IN ('{INSERT}', '{UPDATE_AFTER}') AS INT) AS a, "
              f"{_struct(cols)} AS img)")
    per_key = f.groupBy(*[_q(k) for k in keys]).agg(F.expr(f"min({change})").alias("__first"),
                                                    F.expr(f"max({change})").alias("__last"))
    net = per_key.selectExpr(*[_q(k) for k in keys], "CASE WHEN __first.a = 0 THEN __first.img END AS __b",
                             "CASE WHEN __last.a = 1 THEN __last.img END AS __a")
    return _changes(net.filter("NOT (__b <=> __a)"), keys, cols)
