"""

Every query reads the supplied tables (``{sf_dir}/{name}.parquet``) through
the source adapters of ``carelake.plans.standins`` and runs the library's
operators or whole warehouse jobs on them. ``oracle_sql()`` gives the same
result as DuckDB SQL over the same tables.
"""

from __future__ import annotations

import os
import sys
import time
from collections.abc import Callable
from dataclasses import replace

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.errors import AnalysisException  # noqa: E402
from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracle_sql as _oracle  # noqa: E402
from carelake.functions.conform import conform  # noqa: E402
from carelake.functions.timeparts import day_of, hour_of, minute_of, proc_time  # noqa: E402
from carelake.operators import (compact_feed, decode_codes, filter_changelog, inserts_only,  # noqa: E402
                                latest_by_key, lookup_join, lookup_join_asof, materialize,
                                merge_state, snapshot_diff)
from carelake.plans import standins  # noqa: E402
from carelake.plans.backfill import backfill_wide  # noqa: E402
from carelake.plans.batch import Warehouse, table_reader  # noqa: E402
from carelake.plans.warehouse import (JOBS, WIDE_LOOKUP_COLUMNS, build,  # noqa: E402
                                      doctor_insert_preview, enrich_doctor_hospital_patient,
                                      checked_rows, keyed_rows, wide_output)
from carelake.session import DEFAULT_CONF, work_dir  # noqa: E402
from carelake.sources.changelog import read_changelog  # noqa: E402
from carelake.sources.specs import ARRIVAL, ODS_DICT, ROWKIND, TableSpec  # noqa: E402
from carelake.streaming.audit import audit_schema, start_audit_log  # noqa: E402
from carelake.streaming.files import NumberedLog, complete, exists, names  # noqa: E402
from carelake.streaming.jobs import (start_feed_compaction, start_job, start_table, start_table_scan,  # noqa: E402
                                     state_lookup)  # noqa: E402
from carelake.streaming.chain import start_waiting_job  # noqa: E402
from carelake.streaming.location import current, open_table, publish  # noqa: E402
from carelake.streaming.sink import (as_changes, feed_log, feed_schema, live_view, read_feed,  # noqa: E402
                                     read_state, upsert)
from carelake.streaming.wait import lookup_join_wait  # noqa: E402

ROCKSDB_PROVIDER = DEFAULT_CONF["spark.sql.streaming.stateStore.providerClass"]

FLAGSHIP_SF = "/root/testdata/sf0.001"
EV_COLS = ["user_id", "ts", "event_id", "event_type", "value", "props"]


def _t(spark: SparkSession, sf_dir: str):
    return table_reader(spark, sf_dir)


def _ev(spark, sf_dir) -> DataFrame:
    return standins.events_changelog(_t(spark, sf_dir))


# ------------------------------------------------------------- operator keys

def q_conform_cast(spark, sf_dir):
    part = _t(spark, sf_dir)("part")
    src = part.select("p_partkey", "p_name", "p_size", F.col("p_size").alias("p_size_again"),
                      "p_retailprice")
    target = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("size_small", T.ShortType()), T.StructField("size_tiny", T.ByteType()),
        T.StructField("price", T.DecimalType(19, 2))])
    return conform(src, target)


def q_positional_conform(spark, sf_dir):
    s = _t(spark, sf_dir)("supplier")
    # source names disagree with the targets on purpose: position decides
    src = s.select("s_suppkey", F.col("s_name").alias("title"), F.col("s_nationkey").alias("name"),
                   F.col("s_acctbal").alias("gender_name"))
    target = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("hospital_id", T.StringType()),
        T.StructField("consultation_fee", T.DecimalType(19, 2))])
    return conform(src, target)


def q_time_parts(spark, sf_dir):
    e = _t(spark, sf_dir)("events")
    return e.select("event_id", "ts", day_of("ts").alias("dt"), hour_of("ts").alias("hour"),
                    minute_of("ts").alias("minute"))


def q_status_filter(spark, sf_dir):
    c = standins.ods_consultation(_t(spark, sf_dir))
    return c.filter(F.col("status") == 207).select(
        F.col("id").cast("string").alias("id"), "create_time",
        F.col("status").cast("smallint").alias("status"),
        F.col("rating").cast("tinyint").alias("rating"))


def q_inserts_only(spark, sf_dir):
    return inserts_only(_ev(spark, sf_dir), drop_kind=True)


def q_dedupe_last_arrival(spark, sf_dir):
    return latest_by_key(_ev(spark, sf_dir), ["user_id"], [ARRIVAL])


def q_dedupe_by_sequence(spark, sf_dir):
    li = _t(spark, sf_dir)("lineitem")
    return latest_by_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def q_materialize_changelog(spark, sf_dir):
    return materialize(_ev(spark, sf_dir), ["user_id"], ["ts", ARRIVAL])


def q_filter_changelog(spark, sf_dir):
    kept = filter_changelog(_ev(spark, sf_dir), F.col("value") > 20)
    return materialize(kept, ["user_id"], ["ts", ARRIVAL])


def q_out_of_order_upsert(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    late_half = ev.filter(F.col("ts") >= cut)           # arrives first
    # the older half arrives second: its arrival offsets are higher
    early_half = ev.filter(F.col("ts") < cut).withColumn(ARRIVAL, F.col(ARRIVAL) + F.lit(1 << 40))
    keys, order = ["user_id"], ["ts", ARRIVAL]
    state = latest_by_key(late_half, keys, order)
    state = merge_state(state, early_half, keys, order)
    return state.select(*EV_COLS, ROWKIND)


EVENTS_SPEC = TableSpec(
    name="user_events",
    schema=T.StructType([
        T.StructField("dt", T.StringType()), T.StructField("user_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()), T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType())]),
    pk=("dt", "user_id"), sequence="ts", partition=("dt",), buckets=2, bucket_key="user_id")


def _events_rows(ev: DataFrame) -> DataFrame:
    return ev.select(day_of("ts").alias("dt"), *EV_COLS, ROWKIND, ARRIVAL)


def q_partitioned_upsert(spark, sf_dir):
    """Two batches upserted into a (dt, bucket)-partitioned state table."""
    path = work_dir(spark, "partitioned_upsert")
    rows = _events_rows(_ev(spark, sf_dir))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    upsert(rows.filter(F.col("ts") >= cut), EVENTS_SPEC, path)
    upsert(rows.filter(F.col("ts") < cut), EVENTS_SPEC, path)
    return live_view(spark, EVENTS_SPEC, path)


def q_bucket_layout(spark, sf_dir):
    """dim_user written with 4 buckets by key modulo; rows per bucket directory."""
    spec = JOBS["dim_user"].spec.with_(bucket_method="mod")
    path = work_dir(spark, "bucket_layout")
    wh = Warehouse(_t(spark, sf_dir))
    job = JOBS["dim_user"]
    rows = job.enrich(job.prepare(wh.source(job.source)))
    upsert(rows, spec, path)
    state = read_state(spark, spec, path)
    return state.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"))


def q_snapshot_diff(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    cut = F.lit(_oracle.SNAPSHOT_CUT).cast("timestamp_ntz")
    keys, order = ["user_id"], ["ts", ARRIVAL]
    before = materialize(ev.filter(F.col("ts") < cut), keys, order)
    after = materialize(ev, keys, order)
    return snapshot_diff(before, after, keys)


def q_lookup_join(spark, sf_dir):
    t = _t(spark, sf_dir)
    docs = t("documents").select("doc_id", "lang", "source", "n_chars")
    return lookup_join(docs, t("labels"), "doc_id", dim_key="doc_id", cols=["quality", "toxic"])


def q_decode_codes(spark, sf_dir):
    t = _t(spark, sf_dir)
    s = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("gender"),
                             (F.col("s_suppkey") % 25).alias("specialty"),
                             ((F.col("s_suppkey") * 7) % 30).alias("title"))
    dictionary = materialize(standins.ods_dict(t), ["id"])
    out = decode_codes(s, dictionary, {"gender": "gender_name", "specialty": "specialty_name",
                                       "title": "title_name"})
    return out.select("id", "gender", "gender_name", "specialty", "specialty_name", "title",
                      "title_name")


def q_lookup_chain(spark, sf_dir):
    wh = Warehouse(_t(spark, sf_dir))
    job = JOBS["dwd_prescription"]
    rows = materialize(job.prepare(wh.source(job.source)), job.spec.pk, job.spec.order)
    out = enrich_doctor_hospital_patient(rows, wh.view("dim_doctor"), wh.view("dim_hospital"),
                                         wh.view("dim_patient"))
    return out.select("id", *WIDE_LOOKUP_COLUMNS)


def _purchases_signups(spark, sf_dir):
    e = _t(spark, sf_dir)("events")
    purchases = e.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    signups = e.filter(F.col("event_type") == "signup").select(
        "user_id", "ts", F.col("ts").alias("signup_ts"), "event_id", "value")
    return purchases, signups


_SIGNUP_COLS = {"event_id": "signup_event_id", "signup_ts": "signup_ts", "value": "signup_value"}


def q_lookup_asof(spark, sf_dir):
    purchases, signups = _purchases_signups(spark, sf_dir)
    return lookup_join_asof(purchases, signups, fact_key="user_id", dim_key="user_id",
                            fact_time="ts", dim_time="ts", cols=_SIGNUP_COLS)


def q_lookup_asof_wait(spark, sf_dir):
    purchases, signups = _purchases_signups(spark, sf_dir)
    return lookup_join_asof(purchases, signups, fact_key="user_id", dim_key="user_id",
                            fact_time="ts", dim_time="ts", cols=_SIGNUP_COLS,
                            wait_seconds=_oracle.WAIT_SECONDS)


# --------------------------------------------------------------- stream keys

def _land(df: DataFrame, path: str) -> None:
    """Append change rows to a landing folder, in as many files as they have partitions."""
    df.write.mode("append").parquet(path)


def _half(df: DataFrame, second: bool) -> DataFrame:
    return df.filter((F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 1) == F.lit(second))


def _stream_job(spark, sf_dir, job_name: str, log: DataFrame) -> DataFrame:
    """A job as a stream over its change log, which lands in two parts, each a run of its own."""
    t = _t(spark, sf_dir)
    root = work_dir(spark, f"stream_{job_name}")
    job = JOBS[job_name]
    wh = Warehouse(t)
    lookups = {}
    for name in job.lookups:
        if name == "ods_dict":
            spec, rows = ODS_DICT, conform(standins.ods_dict(t), ODS_DICT.schema)
        else:
            spec, dim = JOBS[name].spec, JOBS[name]
            rows = dim.enrich(dim.prepare(wh.source(dim.source)), **{n: wh.view(n) for n in dim.lookups})
        upsert(rows, spec, f"{root}/{name}")
        lookups[name] = state_lookup(spark, spec, f"{root}/{name}")
    for second in (True, False):  # later changes may land first
        _land(_half(log, second), f"{root}/landing")
        stream = read_changelog(spark, f"{root}/landing", log.schema, stream=True)
        q = start_job(job, stream, f"{root}/state", f"{root}/checkpoint", lookups,
                      reject_path=f"{root}/rejects", trigger={"availableNow": True})
        q.awaitTermination()
    return live_view(spark, job.spec, f"{root}/state")


def q_stream_upsert(spark, sf_dir):
    """W3 as a stream."""
    return _stream_job(spark, sf_dir, "dwd_patient_register", standins.ods_patient_log(_t(spark, sf_dir)))


def q_stream_dim_doctor(spark, sf_dir):
    """D2 as a stream."""
    return _stream_job(spark, sf_dir, "dim_doctor", standins.ods_doctor(_t(spark, sf_dir)))


def q_stream_dwd_prescription_detail(spark, sf_dir):
    """W6 as a stream, with its dimension read from a state table."""
    return _stream_job(spark, sf_dir, "dwd_prescription_detail", standins.ods_prescription_detail(_t(spark, sf_dir)))


def q_changing_payment(spark, sf_dir):
    """W4 over updates, deletes, late and NULL versions."""
    return build(JOBS["dwd_payment"], standins.changing(standins.ods_payment(_t(spark, sf_dir))), {})


def q_changing_review(spark, sf_dir):
    """W5 over a log in which consultations enter and leave status 207."""
    return build(JOBS["dwd_review"], standins.changing(standins.ods_consultation(_t(spark, sf_dir))), {})


def q_stream_changing_payment(spark, sf_dir):
    return _stream_job(spark, sf_dir, "dwd_payment", standins.changing(standins.ods_payment(_t(spark, sf_dir))))


def q_stream_changing_review(spark, sf_dir):
    return _stream_job(spark, sf_dir, "dwd_review", standins.changing(standins.ods_consultation(_t(spark, sf_dir))))


def _normalised(spark, sf_dir, job_name: str, log: DataFrame) -> DataFrame:
    """A job as a stream over a log without before-images, which lands in parts that cut histories of keys apart."""
    root = work_dir(spark, f"normalised_{job_name}")
    job = replace(JOBS[job_name], spec=JOBS[job_name].spec.with_(before_images=False))
    for part in range(3):
        _land(log.filter(F.col("arrival") % 10 % 3 == part), f"{root}/landing")
        stream = read_changelog(spark, f"{root}/landing", log.schema, stream=True)
        start_job(job, stream, f"{root}/state", f"{root}/checkpoint", reject_path=f"{root}/rejects",
                  trigger={"availableNow": True}).awaitTermination()
    return live_view(spark, job.spec, f"{root}/state")


def q_moved_day_upsert(spark, sf_dir):
    """W4 over payments that move to another day: none stays in its old partition."""
    return _normalised(spark, sf_dir, "dwd_payment", standins.moving(standins.ods_payment(_t(spark, sf_dir))))


def q_normalised_review(spark, sf_dir):
    """W5 over consultations that leave status 207, move or are deleted, without before-images."""
    return _normalised(spark, sf_dir, "dwd_review", standins.moving(standins.ods_consultation(_t(spark, sf_dir))))


def q_stream_consultation_wait(spark, sf_dir, deadline_s: float = 600.0):
    """W8 as a stream with its three waits: a third of the doctors become known after the facts.

    The query runs on a real trigger; its clock stands still until the late doctors are found and is then
    ten minutes on, so the result doesn't depend on the machine's speed.
    """
    t = _t(spark, sf_dir)
    root = work_dir(spark, "stream_consultation_wait")
    job, wh = JOBS["dwd_consultation"], Warehouse(t)
    late = F.col("id").cast("bigint") % 3 == 0

    def put(name, keep):
        dim = JOBS[name]
        rows = dim.enrich(dim.prepare(wh.source(dim.source)), **{n: wh.view(n) for n in dim.lookups})
        upsert(rows.filter(keep), dim.spec, f"{root}/{name}")

    put("dim_doctor", ~late)
    put("dim_hospital", F.lit(True))
    put("dim_patient", F.lit(True))
    log = standins.ods_consultation(t)
    _land(log, f"{root}/landing")
    dims = {n: state_lookup(spark, JOBS[n].spec, f"{root}/{n}") for n in ("dim_doctor", "dim_hospital", "dim_patient")}
    clock, stop_at = {"now": 0.0}, time.time() + deadline_s
    queries = start_waiting_job(spark, job, read_changelog(spark, f"{root}/landing", log.schema, stream=True), dims, root,
                                trigger={"processingTime": "1 second"}, clock=lambda: clock["now"])
    doctors = dims["dim_doctor"].number()

    def until(ready):
        while not ready():
            for q in queries:
                if q.exception() is not None:
                    raise q.exception()
            if time.time() >= stop_at:
                raise TimeoutError(f"the facts did not come out within {deadline_s} s")
            time.sleep(0.2)

    steps = NumberedLog(spark, f"{root}/steps/plans")
    done = lambda n: steps.newest() > n  # noqa: E731  (a later step has begun: step n is written and stored)
    try:
        until(lambda: done(_first_step_with_rows(spark, f"{root}/steps")))
        put("dim_doctor", late)
        until(lambda: steps.newest() >= 0 and steps.read(steps.newest())["dims"][0] > doctors)
        for _ in range(3):  # a fact may wait at each of the stages
            clock["now"] += 600.0
            n = steps.newest() + 1
            until(lambda n=n: done(n))
    finally:
        for q in queries:
            q.stop()
    return live_view(spark, job.spec, f"{root}/state")


def _first_step_with_rows(spark, steps: str) -> int:
    """The first step that has written rows; far ahead while none has."""
    for n in sorted(int(x.partition("=")[2]) for x in names(spark, steps) if "=" in x):
        if complete(spark, f"{steps}/lk_step={n}") and any("=" in x for x in names(spark, f"{steps}/lk_step={n}")):
            return n
    return 1 << 60


def q_replay_upsert(spark, sf_dir):
    """Streaming batches that are played again, after a compaction too."""
    path = work_dir(spark, "replay_upsert")
    rows = _events_rows(_ev(spark, sf_dir))
    for n in (0, 1):
        for _ in range(2):
            upsert(_half(rows, bool(n)), EVENTS_SPEC, path, batch_id=n, compact_every=1)
    return live_view(spark, EVENTS_SPEC, path)


def _net_feed(spark, feed: str, after: int) -> DataFrame:
    return compact_feed(read_feed(spark, EVENTS_SPEC, feed), EVENTS_SPEC.pk, after_batch=after)


def q_replay_change_feed(spark, sf_dir):
    """The feed of commits that were first made without it, and of one that is played again."""
    path = work_dir(spark, "replay_change_feed")
    rows = _events_rows(_ev(spark, sf_dir))
    for n, phase in enumerate((F.hour("ts") < 12, F.hour("ts") >= 12)):
        upsert(rows.filter(phase), EVENTS_SPEC, f"{path}/state", batch_id=n)
        for _ in range(2):
            upsert(rows.filter(phase), EVENTS_SPEC, f"{path}/state", feed_path=f"{path}/feed", batch_id=n)
    return _net_feed(spark, f"{path}/feed", 0)


DOCTOR_BRIEF = TableSpec(
    name="doctor_brief", schema=T.StructType([
        T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("title_code", T.StringType()), T.StructField("commits", T.LongType())]), buckets=4)


def q_table_scan_handover(spark, sf_dir):
    """D2's table read as a stream by a second job: its rows first, then exactly the changes since."""
    t = _t(spark, sf_dir)
    root = work_dir(spark, "table_scan_handover")
    job, wh = JOBS["dim_doctor"], Warehouse(t)
    spec = job.spec
    every = job.enrich(job.prepare(wh.source(job.source)), **{n: wh.view(n) for n in job.lookups})
    number = F.col("id").cast("bigint")

    def put(rows, n):
        upsert(rows.withColumn(ARRIVAL, F.lit(n).cast("long")), spec, f"{root}/state", feed_path=f"{root}/feed")

    def scan():
        def write(rows, batch_id):
            brief = as_changes(rows).select("id", "name", "title_code", F.col(ARRIVAL).alias("commits"), ROWKIND, ARRIVAL)
            upsert(brief, DOCTOR_BRIEF, f"{root}/brief", batch_id=batch_id)
        start_table_scan(spark, spec, f"{root}/state", f"{root}/feed", write, f"{root}/checkpoint",
                         trigger={"availableNow": True}).awaitTermination()

    renamed = every.withColumn("name", F.concat("name", F.lit(" B")))
    put(every.filter(number % 2 == 0), 1)
    put(renamed.filter(number % 4 == 0), 2)
    scan()                                                   # the rows of version 1
    put(every.filter(number % 2 == 1), 3)
    put(every.filter(number % 3 == 0).withColumn(ROWKIND, F.lit("-D")), 4)
    scan()                                                   # commits 2 and 3
    put(renamed.filter(number % 5 == 0), 5)
    scan()
    scan()                                                   # nothing is left
    # The commit that each row came with: 3 stands for the snapshot of version 1, later ones are twice the commit + 1.
    return live_view(spark, DOCTOR_BRIEF, f"{root}/brief")


def q_feed_consumer_replay(spark, sf_dir):
    """A consumer that runs between commits, of which each is played twice, sees every change once."""
    root = work_dir(spark, "feed_consumer_replay")
    rows = _events_rows(_ev(spark, sf_dir))
    for n in range(3):
        for _ in range(2):
            upsert(rows.filter(F.col("event_id") % 3 == n), EVENTS_SPEC, f"{root}/state", feed_path=f"{root}/feed", batch_id=n)
        start_feed_compaction(spark, EVENTS_SPEC, f"{root}/feed", f"{root}/net", f"{root}/checkpoint",
                              trigger={"availableNow": True}).awaitTermination()
    net = spark.read.schema(T.StructType([*feed_schema(EVENTS_SPEC).fields, T.StructField("feed_batch", T.LongType())])).parquet(
        f"{root}/net")
    return net.drop("batch_id")


def q_audit_log_table(spark, sf_dir):
    """The audit log of a table without a feed, followed by a stream while four commits (one played twice) and compactions are made."""
    root = work_dir(spark, "audit_log_table")
    rows = _events_rows(_ev(spark, sf_dir))

    def write(changes, batch_id):
        changes.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    for n in range(4):
        for _ in range(1 + (n == 2)):
            upsert(rows.filter(F.col("event_id") % 4 == n), EVENTS_SPEC, f"{root}/state", batch_id=n, compact_every=2)
        if n % 2:
            start_audit_log(spark, EVENTS_SPEC, f"{root}/state", write, f"{root}/checkpoint",
                            trigger={"availableNow": True}).awaitTermination()
    return spark.read.schema(audit_schema(EVENTS_SPEC)).parquet(*[f"{root}/out/{n}" for n in names(spark, f"{root}/out")])


def q_stream_change_feed(spark, sf_dir):
    """Change feed written by the upsert stream: morning events, then the net change by the rest."""
    root = work_dir(spark, "stream_change_feed")
    rows = _events_rows(_ev(spark, sf_dir))
    morning = F.hour("ts") < 12
    feed, last = f"{root}/feed", -1
    for phase in (rows.filter(morning), rows.filter(~morning)):
        if phase is not None and last < 0 and exists(spark, feed):
            last = feed_log(spark, feed).newest()
        _land(phase, f"{root}/landing")
        stream = read_changelog(spark, f"{root}/landing", rows.schema, stream=True)
        q = start_table(EVENTS_SPEC, stream, f"{root}/state", f"{root}/checkpoint",
                        feed_path=feed, trigger={"availableNow": True})
        q.awaitTermination()
    return _net_feed(spark, feed, last)


def q_rebuild_table(spark, sf_dir):
    """A table with half its rows, rebuilt out of sight and published once it is whole."""
    root = work_dir(spark, "rebuild_table")
    rows = _events_rows(_ev(spark, sf_dir))
    old = open_table(spark, root, EVENTS_SPEC)
    upsert(_half(rows, True), EVENTS_SPEC, old.state)
    new = open_table(spark, root, EVENTS_SPEC, rebuild=True, publish_now=False)
    upsert(rows, EVENTS_SPEC, new.state)
    if current(spark, root, EVENTS_SPEC.name) != old:
        raise AssertionError("an unpublished version is in sight")
    publish(spark, new)
    return live_view(spark, EVENTS_SPEC, current(spark, root, EVENTS_SPEC.name).state)


def q_lookup_asof_changes(spark, sf_dir):
    """As-of lookup over versions with -U/+U pairs of one time, deletes and re-inserts."""
    t = _t(spark, sf_dir)
    facts = t("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("at"),
                               F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey") % 120).alias("k"))
    return lookup_join_asof(facts, standins.doctor_versions(t), fact_key="k", dim_key="id", fact_time="at",
                            dim_time="version_time", cols={"name": "doctor_name"},
                            kind=ROWKIND).select("o_orderkey", "doctor_name")


def q_backfill_consultation(spark, sf_dir):
    """W8 rebuilt with each lookup as of the fact's own time, over versions with pairs, deletes and re-inserts."""
    t = _t(spark, sf_dir)
    wh, versions = Warehouse(t), {}
    for name in ("dim_doctor", "dim_hospital", "dim_patient"):
        versions[name] = standins.dimension_versions(wh.view(name))
    return backfill_wide(JOBS["dwd_consultation"], standins.ods_consultation(t), versions).select(
        "id", "dt", "doctor_name", "hospital_id", "hospital_name", "patient_name")


def q_reject_rows(spark, sf_dir):
    """Payments of which every fourth has no create_time: what is written and what is rejected."""
    source = standins.ods_payment(_t(spark, sf_dir))
    source = source.withColumn("create_time", F.when(F.col("id") % 4 != 0, F.col("create_time")))
    rows, rejects = keyed_rows(JOBS["dwd_payment"], source)
    return rows.select("id", F.lit(False).alias("rejected")).unionByName(
        rejects.select("id", F.lit(True).alias("rejected")))


def q_reject_reasons(spark, sf_dir):
    """Consultations with statuses and ratings beyond their types and without a create_time: what is kept, and each
    column that does not fit."""
    source, number = standins.ods_consultation(_t(spark, sf_dir)), F.col("id")
    source = source.withColumns({"status": F.when(number % 9 == 0, 40000).otherwise(F.col("status")),
                                 "rating": F.when(number % 10 == 0, 300).otherwise(F.col("rating")),
                                 "create_time": F.when(number % 4 != 0, F.col("create_time"))})
    rows, rejects = checked_rows(JOBS["dwd_consultation"], source)
    told = rejects.select(F.col("id").cast("string").alias("id"), F.inline("errors"))
    none = F.lit(None).cast("string")
    return told.unionByName(rows.select("id", none.alias("field"), none.alias("value"), none.alias("reason")))


def q_bucket_hash(spark, sf_dir):
    """The hash layout after two upserts: every key in one bucket within range."""
    path = work_dir(spark, "bucket_hash")
    job, wh = JOBS["dim_user"], Warehouse(_t(spark, sf_dir))
    rows = job.enrich(job.prepare(wh.source(job.source)))
    for _ in range(2):
        upsert(rows, job.spec, path, compact_every=1)
    layout = spark.read.parquet(f"{path}/base").groupBy("id").agg(
        F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    return layout.agg(F.count("*").alias("n_keys"),
                      F.count_if((F.col("lo") < 0) | (F.col("hi") >= job.spec.buckets)).alias("out_of_range"),
                      F.count_if(F.col("lo") != F.col("hi")).alias("in_two_buckets"))


def q_doctor_preview(spark, sf_dir):
    """Insert events with one processing time each run."""
    rows = doctor_insert_preview(standins.ods_doctor_log(_t(spark, sf_dir)))
    return rows.select("id", "create_time", "name", (F.col("proc_time") == proc_time()).alias("one_time"))


def q_stream_lookup_wait(spark, sf_dir, wait_seconds: float = 2.0, deadline_s: float = 300.0):
    """J6 on a stream: purchases wait up to 2 s for their user's signup row."""
    root = work_dir(spark, "stream_lookup_wait")
    e = _t(spark, sf_dir)("events")
    facts = e.filter(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "ts", "value", F.lit("+I").alias(ROWKIND),
        F.col("event_id").alias(ARRIVAL))
    dims = e.filter(F.col("event_type") == "signup").select(
        "user_id", "event_id", "ts", "value", F.lit("+I").alias(ROWKIND),
        F.col("event_id").alias(ARRIVAL))
    _land(facts, f"{root}/facts")
    _land(dims, f"{root}/dims")
    n_facts = spark.read.parquet(f"{root}/facts").count()
    out = lookup_join_wait(
        read_changelog(spark, f"{root}/facts", facts.schema, stream=True),
        read_changelog(spark, f"{root}/dims", dims.schema, stream=True),
        fact_key="user_id", dim_key="user_id", fact_id="event_id",
        cols={"event_id": "signup_event_id", "ts": "signup_ts", "value": "signup_value"},
        wait_seconds=wait_seconds)
    # The state store provider and the number of state partitions are fixed
    # when a stateful query first starts: use RocksDB and one partition per
    # core, then restore the session's settings.
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
                "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}
    previous = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        q = (out.writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/checkpoint")
             .trigger(processingTime="1 second").start())
    finally:
        for k, v in previous.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    try:
        stop_at = time.time() + deadline_s
        while True:
            if time.time() >= stop_at:
                raise TimeoutError(f"not all of {n_facts} facts came out within {deadline_s} s")
            if q.exception() is not None:
                raise q.exception()
            try:
                if spark.read.schema(out.schema).parquet(f"{root}/out").count() >= n_facts:
                    break
            except AnalysisException as err:  # the sink folder appears with the first commit
                if "PATH_NOT_FOUND" not in str(err) and "Path does not exist" not in str(err):
                    raise
            time.sleep(1.0)
    finally:
        q.stop()
    return spark.read.schema(out.schema).parquet(f"{root}/out").select(
        "event_id", "user_id", "ts", "value", "signup_event_id", "signup_ts", "signup_value")


def _table_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Warehouse(_t(spark, sf_dir)).table(name)
    run.__name__ = f"q_{name}"
    run.__doc__ = f"Batch build of {name} (live rows) from the supplied tables."
    return run


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conform_cast": q_conform_cast,
    "positional_conform": q_positional_conform,
    "time_parts": q_time_parts,
    "status_filter": q_status_filter,
    "inserts_only": q_inserts_only,
    "dedupe_last_arrival": q_dedupe_last_arrival,
    "dedupe_by_sequence": q_dedupe_by_sequence,
    "materialize_changelog": q_materialize_changelog,
    "filter_changelog": q_filter_changelog,
    "out_of_order_upsert": q_out_of_order_upsert,
    "partitioned_upsert": q_partitioned_upsert,
    "bucket_layout": q_bucket_layout,
    "snapshot_diff": q_snapshot_diff,
    "lookup_join": q_lookup_join,
    "decode_codes": q_decode_codes,
    "lookup_chain": q_lookup_chain,
    "lookup_asof": q_lookup_asof,
    "lookup_asof_wait": q_lookup_asof_wait,
    **{name: _table_query(name) for name in JOBS},
    "stream_upsert": q_stream_upsert,
    "stream_change_feed": q_stream_change_feed,
    "stream_lookup_wait": q_stream_lookup_wait,
    "changing_payment": q_changing_payment,
    "changing_review": q_changing_review,
    "stream_changing_payment": q_stream_changing_payment,
    "stream_changing_review": q_stream_changing_review,
    "stream_dim_doctor": q_stream_dim_doctor,
    "stream_dwd_prescription_detail": q_stream_dwd_prescription_detail,
    "stream_consultation_wait": q_stream_consultation_wait,
    "moved_day_upsert": q_moved_day_upsert,
    "normalised_review": q_normalised_review,
    "replay_upsert": q_replay_upsert,
    "replay_change_feed": q_replay_change_feed,
    "table_scan_handover": q_table_scan_handover,
    "feed_consumer_replay": q_feed_consumer_replay,
    "audit_log_table": q_audit_log_table,
    "rebuild_table": q_rebuild_table,
    "lookup_asof_changes": q_lookup_asof_changes,
    "backfill_consultation": q_backfill_consultation,
    "reject_rows": q_reject_rows,
    "reject_reasons": q_reject_reasons,
    "bucket_hash": q_bucket_hash,
    "doctor_preview": q_doctor_preview,
}
_SQL: dict[str, str] = dict(_oracle.ORACLE)

# The training-data operators are an optional subpackage: without it the rest works alone.
try:
    import corpus_pipeline
    from carelake.llm import queries as _llm
except ImportError:
    pass
else:
    _QUERIES |= _llm.QUERIES | {"pipeline": corpus_pipeline.run}
    _SQL |= _llm.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the patient-register fact (change log -> inserts -> decode -> dt -> upsert)."""
    return _QUERIES["dwd_patient_register"](spark, FLAGSHIP_SF)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL with the same result for each key of ``queries()``."""
    return {k: v for k, v in _SQL.items() if k in _QUERIES}
