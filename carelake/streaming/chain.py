"""Wide facts with bounded waits on their lookups (W7, W8 as streams; J6).

The consultation and prescription jobs retry a missing doctor, hospital or
patient every 10 seconds, 30 times, before giving NULLs. Here that is a
table of pending facts: one query whose input is the fact stream and a ``rate`` source, which
wakes it when no fact arrives.

Micro-batch n looks up stage after stage (doctor, the doctor's hospital, patient). A fact
passes a stage if its row is there, its key is NULL, it is a retraction, or it has
waited its time there. What has passed all stages goes to the table.

``delta_step`` (dimensions are state tables) moves only facts that can move at a tick: the new ones, pending
ones whose key is in a dimension's commits since the last tick, and those that are due. It
writes once ``steps/n`` with what moved: facts that are done, facts that begin to wait
(``wait``), and the marks of those that no longer wait (``freed``). All facts that began to wait
at one step are due at one time, so the due ones are whole steps. Rows written at a tick are changes plus
due rows, whatever is pending; steps older than the wait are not looked at again.

``wait_step`` takes any reader of dimension rows: it joins all pending facts anew and writes them all.

A step's clock and dimension versions are written once before it, and its outcome is a write-once folder
that the upsert and later steps read. So a replayed batch finds
what the first attempt decided, no fact goes two ways, and every version
of a fact reaches the keyed upsert, which alone orders them. A step that is gone raises. The lookups are
plain joins (broadcast by measured size or shuffled, AQE splits hot keys), no
dimension row is kept in the query's state.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carelake.functions.rowkind import RETRACT_KINDS
from carelake.plans.warehouse import DOCTOR_ATTRS, HOSPITAL_ATTRS, PATIENT_ATTRS, Job, checked_rows, wide_output
from carelake.sources.specs import ARRIVAL, ROWKIND
from carelake.streaming.files import NumberedLog, complete
from carelake.streaming.jobs import StateLookup
from carelake.streaming.sink import as_changes, fold, upsert, with_layout

# The retry step and attempts of the waiting lookups (about 300 s).
RETRY_STEP = "10 seconds"
WAIT_SECONDS = 10 * 30

_STAGE, _SINCE, _FOUND = "lk_stage", "lk_since", "lk_found"


#: Folders that a step's waiting facts are dealt to by key.
WAIT_BUCKETS = 16
_STEP, _KIND, _ORIGIN, _BUCKET, _ID, _KEY = "lk_step", "lk_kind", "lk_origin", "lk_bucket", "lk_id", "lk_key"


def feed_as_changes(feed: DataFrame) -> DataFrame:
    """A table's change feed as a dimension change stream."""
    return as_changes(feed)


class WaitStage:
    """One lookup of ``attrs`` (dimension column -> output) by ``facts[on] == dim[key]``."""

    def __init__(self, dim: Callable[[], DataFrame], on: str, attrs: Mapping[str, str], key: str = "id"):
        self.dim, self.on, self.attrs, self.key = dim, on, dict(attrs), key


def _pass_stage(rows: DataFrame, number: int, stage: WaitStage, now: float, wait_seconds: float,
                at: int | None = None) -> DataFrame:
    """Facts at stage ``number`` that pass it, one stage on; the others as they were."""
    view = (stage.dim() if at is None else stage.dim(at=at)).selectExpr(
        f"`{stage.key}` AS {_FOUND}", *[f"`{c}` AS `new_{o}`" for c, o in stage.attrs.items()])
    here, on = f"({_STAGE} = {number})", f"`{stage.on}`"
    kinds = ", ".join(f"'{k}'" for k in RETRACT_KINDS)
    passes = (f"({here} AND ({_FOUND} IS NOT NULL OR {on} IS NULL OR {ROWKIND} IN ({kinds}) "
              f"OR {now!r}D - {_SINCE} >= {wait_seconds!r}D))")
    joined = rows.join(view, F.expr(f"{here} AND {on} = {_FOUND}"), "left")

    def kept(c: str) -> str:
        if c in stage.attrs.values():
            return f"IF({here}, `new_{c}`, `{c}`) AS `{c}`"
        if c == _STAGE:
            return f"IF({passes}, {number + 1}, {_STAGE}) AS {_STAGE}"
        return f"IF({passes}, {now!r}D, {_SINCE}) AS {_SINCE}" if c == _SINCE else f"`{c}`"

    return joined.selectExpr(*[kept(c) for c in rows.columns])


def wait_step(spark: SparkSession, facts: DataFrame, stages: Sequence[WaitStage], steps: str, batch_id: int, *,
              now: float, wait_seconds: float = WAIT_SECONDS) -> DataFrame:
    """Batch ``batch_id``: ``facts`` and what is pending, moved on as far as they pass.

    Writes ``steps/<batch_id>`` once (a replay reads it) and returns the facts that have passed all
    stages. ``facts`` carry ``rowkind``.
    """
    added = [T.StructField(o, stage.dim().schema[c].dataType) for stage in stages for c, o in stage.attrs.items()]
    schema = T.StructType(list(facts.schema.fields) + [f for f in added if f.name not in facts.columns] + [
        T.StructField(_STAGE, T.IntegerType()), T.StructField(_SINCE, T.DoubleType())])
    target = f"{steps}/{batch_id}"
    if not complete(spark, target):
        rows = facts
        for f in added:
            if f.name not in facts.columns:
                rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
        rows = rows.withColumn(_STAGE, F.lit(0)).withColumn(_SINCE, F.lit(float(now))).select(*schema.names)
        if batch_id > 0:
            if not complete(spark, f"{steps}/{batch_id - 1}"):
                raise FileNotFoundError(f"{steps}/{batch_id - 1}: the facts that were pending are gone")
            before = spark.read.schema(schema).parquet(f"{steps}/{batch_id - 1}")
            rows = rows.unionByName(before.filter(F.col(_STAGE) < len(stages)))
        for k, stage in enumerate(stages):
            rows = _pass_stage(rows, k, stage, float(now), float(wait_seconds))
        rows.write.mode("overwrite").parquet(target)
    done = spark.read.schema(schema).parquet(target).filter(F.col(_STAGE) == len(stages))
    return done.drop(_STAGE, _SINCE)


def _added(facts: DataFrame, stages: Sequence[WaitStage]) -> list[T.StructField]:
    known = set(facts.columns)
    return [T.StructField(o, stage.dim.spec.schema[c].dataType) for stage in stages for c, o in stage.attrs.items()
            if o not in known]


def _key_of(stages: Sequence[WaitStage]) -> str:
    """The key for which a fact waits at its stage, in SQL."""
    return f"CASE {_STAGE} {' '.join(f'WHEN {k} THEN CAST(`{s.on}` AS STRING)' for k, s in enumerate(stages))} END"


def delta_step(spark: SparkSession, facts: DataFrame, stages: Sequence[WaitStage], steps: str, batch_id: int, *,
               now: float, wait_seconds: float = WAIT_SECONDS) -> DataFrame:
    """As ``wait_step``, for stages whose dimensions are state tables: joins and writes only what can move."""
    added = _added(facts, stages)
    inner = T.StructType(list(facts.schema.fields) + added + [
        T.StructField(_STAGE, T.IntegerType()), T.StructField(_SINCE, T.DoubleType()),
        T.StructField(_ID, T.LongType()), T.StructField(_KEY, T.StringType())])
    schema = T.StructType(list(inner.fields) + [T.StructField(_KIND, T.StringType()),
                          T.StructField(_ORIGIN, T.LongType()), T.StructField(_BUCKET, T.IntegerType())])
    stored = T.StructType(list(schema.fields) + [T.StructField(_STEP, T.LongType())])
    plans = NumberedLog(spark, f"{steps}/plans")
    if not plans.has(batch_id):
        plans.write(batch_id, {"now": float(now), "dims": [stage.dim.number() for stage in stages]})
    plan, target = plans.read(batch_id), f"{steps}/{_STEP}={batch_id}"
    now = plan["now"]

    def rows_of(numbers: Sequence[int], kind: str) -> DataFrame:
        if not numbers:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(stored).option("basePath", steps).parquet(*[f"{steps}/{_STEP}={m}" for m in numbers])
        return rows.filter(F.col(_KIND) == kind).select(*schema.names)

    if not complete(spark, target):
        before = plans.read(batch_id - 1) if batch_id else {"now": now, "dims": plan["dims"]}
        waiting, due, m = [], [], batch_id - 1
        while m >= 0 and (began := plans.read(m)["now"]) + wait_seconds > before["now"]:
            if not complete(spark, f"{steps}/{_STEP}={m}"):
                raise FileNotFoundError(f"{steps}/{_STEP}={m}: the facts that were pending are gone")
            (due if began + wait_seconds <= now else waiting).append(m)
            m -= 1
        changes = [k for k in range(len(stages)) if plan["dims"][k] > before["dims"][k]] if waiting else []
        if not due and not changes and facts.isEmpty():  # nothing can move
            (spark.createDataFrame([], schema).write.mode("overwrite").option("partitionOverwriteMode", "static")
                  .partitionBy(_KIND, _ORIGIN, _BUCKET).parquet(target))
            return rows_of([], "done").select(*[f.name for f in list(facts.schema.fields) + added])
        start = {_STAGE: "0", _SINCE: f"{now!r}D", _ID: "CAST(NULL AS BIGINT)", _KEY: "CAST(NULL AS STRING)",
                 _KIND: "'new'", _ORIGIN: "CAST(NULL AS BIGINT)", _BUCKET: "0",
                 **{f.name: f"CAST(NULL AS {f.dataType.simpleString()})" for f in added}}
        new = facts.selectExpr(*[f"{start[c]} AS `{c}`" if c in start else f"`{c}`" for c in schema.names])
        rows = new
        pending = rows_of(due, "wait")
        changed = None
        for k in changes:
            keys = stages[k].dim.changed_keys(before["dims"][k], plan["dims"][k]).select(
                F.lit(k).alias(_STAGE), F.col(stages[k].key).cast("string").alias(_KEY))
            changed = keys if changed is None else changed.unionByName(keys)
        if changed is not None:
            # Folders of the keys' buckets only; buckets, not keys, reach the driver.
            changed = changed.withColumn(_BUCKET, F.expr(_wait_bucket(_KEY)))
            buckets = [r[0] for r in changed.select(_BUCKET).distinct().collect()]
            pending = pending.unionByName(rows_of(waiting, "wait").filter(F.col(_BUCKET).isin(buckets)).join(
                changed, [_STAGE, _KEY, _BUCKET], "left_semi").select(*schema.names))
        if due or changed is not None:
            later = range(min(due + waiting) + 1, batch_id)
            freed = rows_of(list(later), "freed").select(_ORIGIN, _ID)
            rows = rows.unionByName(pending.join(freed, [_ORIGIN, _ID], "left_anti").select(*schema.names))
        moved = rows.withColumn("lk_from", F.col(_STAGE))
        for k, stage in enumerate(stages):
            moved = _pass_stage(moved, k, stage, now, float(wait_seconds), at=plan["dims"][k])
        moved = moved.filter(f"{_ID} IS NULL OR {_STAGE} <> lk_from")
        following = f"IF({_STAGE} = {len(stages)}, 'done', 'wait')"
        moved = moved.selectExpr("*", f"explode(IF({_ID} IS NULL, array({following}), array({following}, 'freed'))) AS lk_out")
        out = moved.selectExpr(
            *[f"IF(lk_out = 'freed', NULL, `{f.name}`) AS `{f.name}`" for f in list(facts.schema.fields) + added],
            _STAGE, _SINCE, f"IF(lk_out = 'freed', {_ID}, monotonically_increasing_id()) AS {_ID}",
            f"IF(lk_out = 'wait', {_key_of(stages)}, NULL) AS {_KEY}", f"lk_out AS {_KIND}",
            f"IF(lk_out = 'freed', {_ORIGIN}, {batch_id}L) AS {_ORIGIN}",
            f"IF(lk_out = 'wait', {_wait_bucket(_key_of(stages))}, 0) AS {_BUCKET}",
        )
        # Rows that are done go to one folder, so only what waits, without most lookup columns, is shuffled to its folders.
        rest = out.filter(f"{_KIND} <> 'done'").hint("rebalance", _KIND, _ORIGIN, _BUCKET)
        out.filter(f"{_KIND} = 'done'").unionByName(rest).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy(_KIND, _ORIGIN, _BUCKET).parquet(target)
    return rows_of([batch_id], "done").select(*[f.name for f in list(facts.schema.fields) + added])


def _wait_bucket(key: str) -> str:
    return f"CAST(pmod(xxhash64({key}), {WAIT_BUCKETS}) AS INT)"


def start_wait(spark: SparkSession, facts: DataFrame, stages: Sequence[WaitStage], root: str,
               write: Callable[[DataFrame, int], None], *, wait_seconds: float = WAIT_SECONDS,
               trigger: Mapping[str, object] | None = None, clock: Callable[[], float] = time.time) -> StreamingQuery:
    """Run the stages on a fact stream; ``write(passed facts, batch number)`` must be idempotent.

    ``trigger`` is the retry step; a ``rate`` source wakes the query at every one. ``clock`` gives
    the seconds by which facts wait.
    """
    step = delta_step if all(isinstance(stage.dim, StateLookup) for stage in stages) else wait_step
    columns = facts.columns
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    ticks = ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields],
                         F.lit(True).alias("lk_tick"))
    both = facts.withColumn("lk_tick", F.lit(False)).unionByName(ticks)

    def run(batch: DataFrame, batch_id: int) -> None:
        new = batch.filter(~F.col("lk_tick")).select(*columns)
        write(step(spark, new, stages, f"{root}/steps", batch_id, now=clock(), wait_seconds=wait_seconds), batch_id)

    return (both.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/checkpoint")
            .trigger(**(trigger or {"processingTime": RETRY_STEP})).start())


def wide_stages(dims: Mapping[str, Callable[[], DataFrame]]) -> list[WaitStage]:
    """The stages of W7/W8, in order; ``dims`` maps table name to a reader of its current rows."""
    return [WaitStage(dims["dim_doctor"], "doctor_id", DOCTOR_ATTRS),
            WaitStage(dims["dim_hospital"], "hospital_id", HOSPITAL_ATTRS),
            WaitStage(dims["dim_patient"], "patient_id", PATIENT_ATTRS)]


def start_waiting_job(spark: SparkSession, job: Job, source: DataFrame,
                      dims: Mapping[str, Callable[[], DataFrame]], root: str, *,
                      wait_seconds: float = WAIT_SECONDS, trigger: Mapping[str, object] | None = None,
                      clock: Callable[[], float] = time.time) -> list[StreamingQuery]:
    """Start W7 or W8; returns its queries (the job, and the one that stores its rejects).

    ``root`` holds the steps, checkpoints, ``rejects`` (source rows that do not
    fit, all of them, with ``errors``), the target ``state`` and its change ``feed``. Use a
    processing-time trigger: waiting does not end an ``availableNow`` run.
    """
    rows, rejects = checked_rows(job, source)

    def write(done: DataFrame, batch_id: int) -> None:
        if not done.isEmpty():
            rows = fold(with_layout(wide_output(job.spec, done), job.spec), job.spec.pk, job.spec.order)
            upsert(rows, job.spec, f"{root}/state", feed_path=f"{root}/feed", batch_id=batch_id, folded=True)

    rejected = (rejects.writeStream.format("parquet").option("path", f"{root}/rejects")
                .option("checkpointLocation", f"{root}/checkpoint_rejects")
                .trigger(**(trigger or {"processingTime": RETRY_STEP})).start())
    return [start_wait(spark, rows, wide_stages(dims), root, write, wait_seconds=wait_seconds,
                       trigger=trigger, clock=clock), rejected]
