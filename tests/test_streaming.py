"""Streaming behaviour: batch = stream, replay, processing-time lookups, bounded wait."""

import json
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.conform import conform
from carelake.operators import materialize, merge_state, snapshot_diff
from carelake.plans import standins
from carelake.plans.batch import Warehouse, table_reader
from carelake.plans.warehouse import JOBS
from carelake.sources.changelog import read_changelog
from carelake.sources.specs import DIM_MEDICINE, ODS_DICT
from carelake.streaming import live_view, read_state, start_job, state_lookup, upsert
from carelake.streaming.wait import lookup_join_wait
from helpers import SF_SMALL
from helpers import ts


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _run_available_now(job, spark, landing, schema, root, lookups, files_per_trigger=None):
    stream = read_changelog(spark, landing, schema, stream=True,
                            max_files_per_trigger=files_per_trigger)
    q = start_job(job, stream, f"{root}/state", f"{root}/checkpoint", lookups,
                  trigger={"availableNow": True})
    q.awaitTermination()
    return q


def test_batch_equals_stream_in_any_split_and_order(spark, tmp_dir):
    t = table_reader(spark, SF_SMALL)
    job = JOBS["dwd_patient_register"]
    log = standins.ods_patient_log(t)
    dictionary = conform(standins.ods_dict(t), ODS_DICT.schema)
    upsert(dictionary, ODS_DICT, f"{tmp_dir}/dict")
    expected = _rows(Warehouse(t).table(job.name))
    lookups = {"ods_dict": state_lookup(spark, ODS_DICT, f"{tmp_dir}/dict")}
    for n_files in (1, 3):
        root = f"{tmp_dir}/split{n_files}"
        # files land in random order: later changes may be applied first (C4)
        parts = log.withColumn("part", (F.rand(seed=n_files) * n_files).cast("int"))
        order = list(range(n_files))
        random.Random(n_files).shuffle(order)
        for p in order:
            parts.filter(F.col("part") == p).drop("part").coalesce(1).write.mode("append") \
                 .parquet(f"{root}/landing")
        _run_available_now(job, spark, f"{root}/landing", log.schema, root, lookups,
                           files_per_trigger=1)
        assert _rows(live_view(spark, job.spec, f"{root}/state")) == expected


def test_replayed_batch_gives_same_state(spark, tmp_dir):
    t = table_reader(spark, SF_SMALL)
    job = JOBS["dwd_payment"]
    rows = job.enrich(job.prepare(standins.ods_payment(t)))
    upsert(rows, job.spec, f"{tmp_dir}/s")
    first = _rows(read_state(spark, job.spec, f"{tmp_dir}/s"))
    upsert(rows, job.spec, f"{tmp_dir}/s")
    assert _rows(read_state(spark, job.spec, f"{tmp_dir}/s")) == first


def test_dimension_change_does_not_rewrite_stored_facts(spark, tmp_dir):
    job = JOBS["dwd_prescription_detail"]
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("create_time", T.TimestampNTZType()),
        T.StructField("update_time", T.TimestampNTZType()), T.StructField("count", T.IntegerType()),
        T.StructField("instruction", T.StringType()), T.StructField("medicine_id", T.LongType()),
        T.StructField("prescription_id", T.LongType()), T.StructField("rowkind", T.StringType()),
        T.StructField("arrival", T.LongType())])

    def medicine(name, arrival):
        row = [("1", "A1", "tablet", name, name.upper(), Decimal("2.50"), "10", "Brand")]
        df = spark.createDataFrame(row, DIM_MEDICINE.schema)
        return df.withColumn("rowkind", F.lit("+I")).withColumn("arrival", F.lit(arrival).cast("long"))

    def fact(id_, update, arrival):
        return spark.createDataFrame(
            [(id_, ts("2024-01-01 08:00:00"), ts(update), 2, "after meals", 1, 9, "+I", arrival)], schema)

    dim_path, landing = f"{tmp_dir}/dim_medicine", f"{tmp_dir}/landing"
    lookups = {"dim_medicine": state_lookup(spark, DIM_MEDICINE, dim_path)}
    upsert(medicine("aspirin", 1), DIM_MEDICINE, dim_path)
    fact(1, "2024-01-01 08:00:00", 1).write.mode("append").parquet(landing)
    _run_available_now(job, spark, landing, schema, tmp_dir, lookups)
    upsert(medicine("aspirin forte", 2), DIM_MEDICINE, dim_path)
    fact(2, "2024-01-01 08:00:00", 2).write.mode("append").parquet(landing)
    _run_available_now(job, spark, landing, schema, tmp_dir, lookups)
    names = {r.id: r.name for r in live_view(spark, job.spec, f"{tmp_dir}/state").collect()}
    assert names == {"1": "aspirin", "2": "aspirin forte"}
    # a later update of the first fact is enriched afresh
    fact(1, "2024-01-01 09:00:00", 3).write.mode("append").parquet(landing)
    _run_available_now(job, spark, landing, schema, tmp_dir, lookups)
    names = {r.id: r.name for r in live_view(spark, job.spec, f"{tmp_dir}/state").collect()}
    assert names == {"1": "aspirin forte", "2": "aspirin forte"}


def test_snapshot_diff_applied_to_before_gives_after(spark):
    for seed in (1, 2):
        rnd = random.Random(seed)
        keys = range(30)
        before = [(k, rnd.choice(["a", "b", None])) for k in keys if rnd.random() < 0.7]
        after = [(k, rnd.choice(["a", "b", None])) for k in keys if rnd.random() < 0.7]
        b = spark.createDataFrame(before, "k int, v string")
        a = spark.createDataFrame(after, "k int, v string")
        diff = snapshot_diff(b, a, ["k"])
        state = b.withColumn("rowkind", F.lit("+I")).withColumn("arrival", F.lit(0).cast("long"))
        changes = diff.withColumn("arrival", F.when(F.col("rowkind") == "-U", 1).otherwise(2).cast("long"))
        result = materialize(merge_state(state, changes.select(*state.columns), ["k"]), ["k"])
        assert _rows(result) == _rows(a)
        assert diff.filter(F.col("rowkind").isin("-U", "+U")).count() % 2 == 0


# ---------------------------------------------------------------- bounded wait

FACT_SCHEMA = "id long, user_id long, amount double, rowkind string, arrival long"
DIM_SCHEMA = "user_id long, name string, rowkind string, arrival long"


def _start_wait(spark, root, wait_seconds):
    facts = read_changelog(spark, f"{root}/facts", T._parse_datatype_string(FACT_SCHEMA), stream=True)
    dims = read_changelog(spark, f"{root}/dims", T._parse_datatype_string(DIM_SCHEMA), stream=True)
    out = lookup_join_wait(facts, dims, fact_key="user_id", dim_key="user_id", fact_id="id",
                           cols={"name": "user_name"}, wait_seconds=wait_seconds)
    return (out.writeStream.format("memory").queryName(f"wait_{int(time.time() * 1000)}")
            .outputMode("append").trigger(processingTime="1 second").start())


def _put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _poll(spark, q, n, deadline=45.0):
    end = time.time() + deadline
    while time.time() < end:
        rows = spark.sql(f"SELECT * FROM {q.name}").collect()
        if len(rows) >= n:
            return rows
        time.sleep(0.5)
    return spark.sql(f"SELECT * FROM {q.name}").collect()


def test_wait_hit_late_arrival_timeout_and_cancel(spark, tmp_dir):
    root = tmp_dir
    # empty dimension and fact folders so both streams start
    _put(spark, f"{root}/dims", [(0, "nobody", "+I", 0)], DIM_SCHEMA)
    _put(spark, f"{root}/facts", [(100, 1, 1.0, "+I", 1), (101, None, 2.0, "+I", 2),
                                  (102, 2, 3.0, "+I", 3), (103, 3, 4.0, "+I", 4)], FACT_SCHEMA)
    # a micro-batch of this operator takes seconds here: leave ample margin
    q = _start_wait(spark, root, wait_seconds=20)
    try:
        _poll(spark, q, 1, deadline=30)
        # user 1 arrives within the wait; fact 103 is withdrawn while waiting
        _put(spark, f"{root}/dims", [(1, "Ann", "+I", 5)], DIM_SCHEMA)
        _put(spark, f"{root}/facts", [(103, 3, 4.0, "-D", 6)], FACT_SCHEMA)
        rows = _poll(spark, q, 4, deadline=90)
        time.sleep(3)
        rows = spark.sql(f"SELECT * FROM {q.name}").collect()
    finally:
        q.stop()
    got = sorted((r.id, r.rowkind, r.user_name) for r in rows)
    # 100: filled after its dimension arrived; 101: NULL key, never waits;
    # 102: timed out with NULLs; 103: only its retraction comes out
    assert got == [(100, "+I", "Ann"), (101, "+I", None), (102, "+I", None), (103, "-D", None)]


def test_waiting_versions_do_not_replace_each_other(spark, tmp_dir):
    """An older version that arrives while a newer one waits, and a late before-image, lose no fact."""
    root = tmp_dir
    _put(spark, f"{root}/dims", [(0, "nobody", "+I", 0)], DIM_SCHEMA)
    _put(spark, f"{root}/facts", [(100, 1, 10.0, "+U", 10)], FACT_SCHEMA)
    q = _start_wait(spark, root, wait_seconds=12)
    try:
        _poll(spark, q, 1, deadline=4)
        _put(spark, f"{root}/facts", [(100, 1, 5.0, "+U", 5), (100, 1, 4.0, "-U", 4)], FACT_SCHEMA)
        rows = _poll(spark, q, 3, deadline=90)
    finally:
        q.stop()
    assert sorted((r.arrival, r.rowkind, r.amount) for r in rows) == [(4, "-U", 4.0), (5, "+U", 5.0), (10, "+U", 10.0)]


WIDE = "id string, doctor_id string, rowkind string, arrival long"


def _doctor_stage(spark, rows):
    from carelake.streaming import WaitStage
    return [WaitStage(lambda: spark.createDataFrame(rows, "id string, name string, hospital_id string"),
                      "doctor_id", {"name": "doctor_name", "hospital_id": "hospital_id"}),
            WaitStage(lambda: spark.createDataFrame([("h", "Clinic")], "id string, name string"),
                      "hospital_id", {"name": "hospital_name"})]


def test_wait_steps_hit_late_row_time_out_and_replay(spark, tmp_dir):
    from carelake.streaming import wait_step

    def step(n, facts, doctors, now):
        out = wait_step(spark, spark.createDataFrame(facts, WIDE), _doctor_stage(spark, doctors), f"{tmp_dir}/steps", n,
                        now=now, wait_seconds=300)
        return sorted((r.id, r.rowkind, r.arrival, r.doctor_name, r.hospital_name) for r in out.collect())

    ann, bob = ("d1", "Ann", "h"), ("d2", "Bob", "nowhere")
    first = [("1", "d1", "+I", 1), ("2", "d2", "+I", 2), ("3", None, "+I", 3), ("4", "d9", "+U", 10)]
    assert step(0, first, [ann], 0) == [("1", "+I", 1, "Ann", "Clinic"), ("3", "+I", 3, None, None)]
    # An older version and a late before-image of the waiting fact 4: both go their own way.
    late = [("4", "d9", "+U", 5), ("4", "d9", "-U", 4)]
    assert step(1, late, [ann, bob], 200) == [("4", "-U", 4, None, None)]
    # A replay finds what the first attempt decided, whatever the dimension holds by now.
    assert step(1, late, [ann, bob, ("d9", "Zoe", "h")], 250) == [("4", "-U", 4, None, None)]
    assert step(2, [], [ann, bob], 300) == [("4", "+U", 10, None, None)]
    assert step(3, [], [ann, bob, ("d9", "Zoe", "h")], 310) == [("4", "+U", 5, "Zoe", "Clinic")]
    assert step(4, [], [ann, bob], 500) == [("2", "+I", 2, "Bob", None)]
    assert step(5, [], [ann, bob], 900) == []


def test_wide_fact_with_waiting_lookups_equals_batch(spark, tmp_dir):
    """W8 through its waits, a third of the doctors arriving late, equals the batch build; rejects are kept."""
    from carelake.sources.specs import DIM_DOCTOR, DIM_HOSPITAL, DIM_PATIENT
    from carelake.streaming import start_waiting_job
    t = table_reader(spark, SF_SMALL)
    wh = Warehouse(t)
    live = lambda name: (wh.view(name).withColumn("rowkind", F.lit("+I"))
                         .withColumn("arrival", F.lit(0).cast("long")))
    late = F.col("id").cast("int") % 3 == 0
    upsert(live("dim_doctor").filter(~late), DIM_DOCTOR, f"{tmp_dir}/dim_doctor")
    for spec in (DIM_HOSPITAL, DIM_PATIENT):
        upsert(live(spec.name), spec, f"{tmp_dir}/{spec.name}")
    dims = {s.name: state_lookup(spark, s, f"{tmp_dir}/{s.name}") for s in (DIM_DOCTOR, DIM_HOSPITAL, DIM_PATIENT)}
    job = JOBS["dwd_consultation"]
    log = standins.ods_consultation(t)
    bad = log.limit(1).withColumn("create_time", F.lit(None).cast("timestamp_ntz"))
    log.unionByName(bad).write.parquet(f"{tmp_dir}/landing")
    source = read_changelog(spark, f"{tmp_dir}/landing", log.schema, stream=True)
    want = sorted(tuple(r) for r in wh.table(job.name).collect())
    queries = start_waiting_job(spark, job, source, dims, f"{tmp_dir}/w8", wait_seconds=25,
                                trigger={"processingTime": "2 seconds"})
    try:
        end, n = time.time() + 200, -1
        while n < len(want):
            for q in queries:
                if q.exception() is not None:
                    raise q.exception()
            assert time.time() < end, f"{n} of {len(want)} facts"
            n = live_view(spark, job.spec, f"{tmp_dir}/w8/state").count()
            if n > 0 and late is not None:
                upsert(live("dim_doctor").filter(late), DIM_DOCTOR, f"{tmp_dir}/dim_doctor")
                late = None
        queries[1].processAllAvailable()
    finally:
        for q in queries:
            q.stop()
    assert sorted(tuple(r) for r in live_view(spark, job.spec, f"{tmp_dir}/w8/state").collect()) == want
    assert spark.read.parquet(f"{tmp_dir}/w8/rejects").count() == 1


# ---------------------------------------------------------------- commits

class _Stop(Exception):
    pass


def _versioned_spec():
    from carelake.sources.specs import TableSpec
    return TableSpec(name="t", schema=T.StructType([T.StructField(c, T.StringType()) for c in ("dt", "id", "v")]),
                     pk=("dt", "id"), partition=("dt",), buckets=2)


VERSIONED = "dt string, id string, v string, rowkind string, arrival long"


@pytest.mark.parametrize("where", ["_publish", "write_feed", "compact"])
def test_commit_that_dies_anywhere_is_replayed_once(spark, tmp_dir, monkeypatch, where):
    from carelake.streaming import sink
    spec = _versioned_spec()
    batches = [[("d1", "1", "a", "+I", 1), ("d2", "2", "a", "+I", 2)],
               [("d1", "1", "b", "+U", 3), ("d2", "2", "a", "-D", 4), ("d1", "3", "c", "+I", 5)],
               [("d1", "1", "b", "-D", 6), ("d2", "2", "z", "+I", 7)]]

    def run(root, dying=None):
        for n, rows in enumerate(batches):
            df = spark.createDataFrame(rows, VERSIONED)
            go = lambda: upsert(df, spec, f"{root}/s", feed_path=f"{root}/f", batch_id=n, compact_every=3)  # noqa: E731, B023
            if n == dying:
                before = _rows(live_view(spark, spec, f"{root}/s"))
                with monkeypatch.context() as m:
                    m.setattr(sink, where, lambda *a, **k: (_ for _ in ()).throw(_Stop()))
                    with pytest.raises(_Stop):
                        go()
                if where == "_publish":  # nothing of it is to be seen
                    assert _rows(live_view(spark, spec, f"{root}/s")) == before
            go()
        go()  # a batch that is published already
        feed = _rows(sink.read_feed(spark, spec, f"{root}/f").select("batch_id", "rowkind", "dt", "id", "v"))
        return _rows(read_state(spark, spec, f"{root}/s")), feed

    whole = run(f"{tmp_dir}/whole")
    assert whole == run(f"{tmp_dir}/dying", dying=2)
    assert [r[1:] for r in whole[1] if r[0] == 1] == [
        ("+I", "d1", "3", "c"), ("+U", "d1", "1", "b"), ("-D", "d2", "2", "a"), ("-U", "d1", "1", "a")]


def test_reader_keeps_its_version(spark, tmp_dir):
    spec = _versioned_spec()
    upsert(spark.createDataFrame([("d1", "1", "a", "+I", 1)], VERSIONED), spec, f"{tmp_dir}/s")
    old = live_view(spark, spec, f"{tmp_dir}/s")
    for k in range(4):  # compacts on the way
        upsert(spark.createDataFrame([("d1", "1", f"b{k}", "+U", 2 + k)], VERSIONED), spec, f"{tmp_dir}/s", compact_every=2)
    assert _rows(old) == [("d1", "1", "a")]
    assert _rows(live_view(spark, spec, f"{tmp_dir}/s")) == [("d1", "1", "b3")]


def test_feed_compaction_stream_gives_net_change(spark, tmp_dir):
    from carelake.sources.specs import TableSpec
    from carelake.streaming import start_feed_compaction
    spec = TableSpec(name="t", schema=T.StructType([T.StructField("id", T.StringType()),
                                                    T.StructField("v", T.StringType())]),
                     pk=("id",), buckets=1)
    schema = "id string, v string, rowkind string, arrival long"
    b1 = [("1", "a", "+I", 1), ("2", "a", "+I", 2), ("3", "a", "+I", 3)]
    b2 = [("1", "b", "+U", 4), ("2", "a", "-D", 5), ("4", "a", "+I", 6)]
    b3 = [("1", "a", "+U", 7), ("4", "c", "+U", 8)]
    for n, rows in enumerate((b1, b2, b3), start=1):
        upsert(spark.createDataFrame(rows, schema), spec, f"{tmp_dir}/s", feed_path=f"{tmp_dir}/f",
               batch_id=n)
    q = start_feed_compaction(spark, spec, f"{tmp_dir}/f", f"{tmp_dir}/net", f"{tmp_dir}/ck",
                              trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted((r.rowkind, r.id, r.v) for r in spark.read.parquet(f"{tmp_dir}/net").collect())
    # all three commits in one trigger: from nothing to {1:a, 3:a, 4:c}
    assert got == [("+I", "1", "a"), ("+I", "3", "a"), ("+I", "4", "c")]


# ---------------------------------------------------------------- deaths at any write

def _stop_at(monkeypatch, nth: int, after: bool):
    """The ``nth`` metadata file is lost on its way: before its rename, or with the driver right after it."""
    from carelake.streaming import files
    whole, seen = files.write_once, {"n": 0}

    def write(spark, path, text):
        seen["n"] += 1
        if seen["n"] != nth:
            return whole(spark, path, text)
        if after:
            whole(spark, path, text)
        else:  # what a death before the rename leaves
            whole(spark, f"{path.rpartition('/')[0]}/_half", text)
        raise _Stop()

    monkeypatch.setattr(files, "write_once", write)


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("nth", [1, 2, 3])  # the commit's entry, the feed's, the compaction's
def test_death_at_any_metadata_write_is_replayed(spark, tmp_dir, monkeypatch, nth, after):
    from carelake.streaming import compact
    from carelake.streaming.sink import read_feed, version
    spec = _versioned_spec()
    first = spark.createDataFrame([("d1", "1", "a", "+I", 1), ("d2", "2", "a", "+I", 2)], VERSIONED)
    second = spark.createDataFrame([("d1", "1", "b", "+U", 3), ("d2", "2", "a", "-D", 4)], VERSIONED)
    go = lambda df, n: upsert(df, spec, f"{tmp_dir}/s", feed_path=f"{tmp_dir}/f", batch_id=n, compact_every=2)
    go(first, 0)
    with monkeypatch.context() as m:
        _stop_at(m, nth, after)
        with pytest.raises(_Stop):
            go(second, 1)
    go(second, 1)
    go(second, 1)
    assert _rows(live_view(spark, spec, f"{tmp_dir}/s")) == [("d1", "1", "b")]
    compact(spark, spec, f"{tmp_dir}/s")
    assert _rows(live_view(spark, spec, f"{tmp_dir}/s")) == [("d1", "1", "b")]
    feed = read_feed(spark, spec, f"{tmp_dir}/f", after=0)
    assert _rows(feed.select("rowkind", "dt", "id", "v")) == [("+U", "d1", "1", "b"), ("-D", "d2", "2", "a"), ("-U", "d1", "1", "a")]
    assert version(spark, f"{tmp_dir}/s").batch == 1


def test_log_reads_of_a_commit_do_not_grow(spark, tmp_dir, monkeypatch):
    from carelake.streaming import files, sink
    spec = _versioned_spec()
    log = files.NumberedLog(spark, f"{tmp_dir}/s/log")
    for n in range(2500):  # entries of a table that is compacted every 30 commits
        kind = {"kind": "base", "base": {}, "upto": n - 1} if n % 30 == 29 else {"kind": "delta", "folder": "x", "places": {}}
        files.write_once(spark, log.path(n), json.dumps({"number": n, "batch": n, "batch_number": n, **kind}))
    reads = []
    whole = files.read_text
    monkeypatch.setattr(files, "read_text", lambda s, p: reads.append(p) or whole(s, p))
    v = sink.version(spark, f"{tmp_dir}/s")
    assert v.number == 2499 and v.batch == 2499 and len(reads) <= 30
    assert log.numbers(2490) == list(range(2491, 2500))


def test_keys_read_their_buckets_only(spark, tmp_dir):
    from carelake.sources.specs import TableSpec
    from carelake.streaming import compact
    spec = TableSpec(name="t", schema=T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType())]),
                     pk=("id",), buckets=16)
    rows = spark.range(200).selectExpr("CAST(id AS STRING) AS id", "id AS v", "'+I' AS rowkind", "id AS arrival")
    upsert(rows, spec, f"{tmp_dir}/s")
    compact(spark, spec, f"{tmp_dir}/s")
    upsert(rows.filter("v < 50").selectExpr("id", "v + 1000 AS v", "rowkind", "arrival + 1000 AS arrival"), spec, f"{tmp_dir}/s")
    keys = spark.createDataFrame([("7",), ("150",), ("none",)], "id string")
    found = live_view(spark, spec, f"{tmp_dir}/s", keys=keys)
    assert _rows(found) == [("150", 150), ("7", 1007)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [", 1)[1][:200]
    base = {f.rsplit("/", 2)[1] for f in found.inputFiles() if "/base/" in f}  # by folder; commits by the filter
    assert 1 <= len(base) <= 3


def test_table_scan_takes_over_from_the_snapshot(spark, tmp_dir):
    """Commits land before, between and while the scan is stopped; a commit without feed raises."""
    from carelake.streaming import as_changes, start_table_scan
    spec, rnd = _versioned_spec(), random.Random(4)
    got = []

    def scan():
        def write(rows, batch_id):
            got.append((batch_id, [tuple(r) for r in rows.collect()]))
            upsert(as_changes(rows).select("dt", "id", "v", "rowkind", "arrival"), spec, f"{tmp_dir}/copy", batch_id=batch_id)
        q = start_table_scan(spark, spec, f"{tmp_dir}/s", f"{tmp_dir}/f", write, f"{tmp_dir}/ck", trigger={"availableNow": True})
        q.awaitTermination()

    for n in range(7):
        rows = [(rnd.choice(["d1", "d2"]), str(rnd.randrange(6)), str(n), rnd.choice(["+I", "+U", "-D"]), n) for _ in range(4)]
        rows = list({r[:2]: r for r in rows}.values())
        upsert(spark.createDataFrame(rows, VERSIONED), spec, f"{tmp_dir}/s", feed_path=f"{tmp_dir}/f", compact_every=3)
        if n in (1, 4, 6):
            scan()
            assert _rows(live_view(spark, spec, f"{tmp_dir}/copy")) == _rows(live_view(spark, spec, f"{tmp_dir}/s"))
    assert {r[0] for r in got[0][1]} == {"+I"} and len(got) == 3
    upsert(spark.createDataFrame([("d1", "9", "x", "+I", 90)], VERSIONED), spec, f"{tmp_dir}/s")
    upsert(spark.createDataFrame([("d1", "8", "x", "+I", 91)], VERSIONED), spec, f"{tmp_dir}/s", feed_path=f"{tmp_dir}/f")
    scan_again = lambda: scan()
    with pytest.raises(Exception, match="has no feed"):
        scan_again()


# ---------------------------------------------------------------- delta joins of waits

def test_delta_steps_equal_wait_steps(spark, tmp_dir):
    """Random facts, late, changed and deleted dimension rows: what comes out at every tick is the same."""
    from carelake.sources.specs import TableSpec
    from carelake.streaming import WaitStage, delta_step, wait_step
    s = T.StringType()
    doctor = TableSpec(name="doctor", schema=T.StructType([T.StructField(c, s) for c in ("id", "name", "hospital_id")]), buckets=4)
    hospital = TableSpec(name="hospital", schema=T.StructType([T.StructField(c, s) for c in ("id", "name")]))

    def stages(plain):
        out = []
        for spec, on, attrs in ((doctor, "doctor_id", {"name": "doctor_name", "hospital_id": "hospital_id"}),
                                (hospital, "hospital_id", {"name": "hospital_name"})):
            dim = state_lookup(spark, spec, f"{tmp_dir}/{spec.name}")
            out.append(WaitStage((lambda d=dim: d()) if plain else dim, on, attrs))
        return out

    rnd = random.Random(8)
    none = spark.createDataFrame([], WIDE)
    for spec in (doctor, hospital):
        upsert(spark.createDataFrame([], T.StructType([*spec.schema.fields, T.StructField("rowkind", s),
                                                       T.StructField("arrival", T.LongType())])), spec, f"{tmp_dir}/{spec.name}")
    now, number, written = 0.0, 0, []
    for n in range(9):
        if n in (1, 3, 4, 6):
            rows = [(f"d{rnd.randrange(6)}", f"N{n}", f"h{rnd.randrange(3)}", rnd.choice(["+I", "+U", "+U", "-D"]), n) for _ in range(3)]
            rows = list({r[0]: r for r in rows}.values())
            upsert(spark.createDataFrame(rows, "id string, name string, hospital_id string, rowkind string, arrival long"),
                   doctor, f"{tmp_dir}/doctor")
        if n in (2, 5):
            upsert(spark.createDataFrame([(f"h{n % 3}", f"H{n}", "+I", n)], "id string, name string, rowkind string, arrival long"),
                   hospital, f"{tmp_dir}/hospital")
        facts = []
        for _ in range(rnd.randrange(5) if n < 6 else 0):
            number += 1
            facts.append((str(rnd.randrange(8)), rnd.choice([None, "d0", "d1", "d2", "d3", "d9"]),
                          rnd.choice(["+I", "+U", "+U", "-D"]), number))
        df = spark.createDataFrame(facts, WIDE) if facts else none
        out = [_rows(step(spark, df, stages(plain), f"{tmp_dir}/{plain}", n, now=now, wait_seconds=25.0)
                     .select("id", "rowkind", "arrival", "doctor_name", "hospital_id", "hospital_name"))
               for step, plain in ((wait_step, True), (delta_step, False))]
        assert out[0] == out[1], n
        again = delta_step(spark, df, stages(False), f"{tmp_dir}/False", n, now=now + 7, wait_seconds=25.0)
        assert _rows(again.select("id", "rowkind", "arrival", "doctor_name", "hospital_id", "hospital_name")) == out[1]
        written.append(out[1])
        now += rnd.choice([5.0, 10.0, 20.0])
    for n in range(9, 16):
        now += 30.0
        out = [_rows(step(spark, none, stages(plain), f"{tmp_dir}/{plain}", n, now=now, wait_seconds=25.0).select("id", "arrival"))
               for step, plain in ((wait_step, True), (delta_step, False))]
        assert out[0] == out[1]
        written.append(out[1])
    assert sum(map(len, written)) == number


def test_a_tick_writes_what_moves_not_what_is_pending(spark, tmp_dir):
    from carelake.sources.specs import TableSpec
    from carelake.streaming import WaitStage, delta_step
    spec = TableSpec(name="doctor", schema=T.StructType([T.StructField(c, T.StringType()) for c in ("id", "name")]), buckets=4)
    upsert(spark.createDataFrame([("x", "X", "+I", 0)], "id string, name string, rowkind string, arrival long"), spec, f"{tmp_dir}/d")
    stage = [WaitStage(state_lookup(spark, spec, f"{tmp_dir}/d"), "doctor_id", {"name": "doctor_name"})]
    pending = spark.range(3000).selectExpr("CAST(id AS STRING) AS id", "concat('d', id) AS doctor_id", "'+I' AS rowkind", "id AS arrival")
    none = pending.limit(0)
    steps = f"{tmp_dir}/steps"
    size = lambda n: spark.read.parquet(f"{steps}/lk_step={n}").count()
    delta_step(spark, pending, stage, steps, 0, now=0.0, wait_seconds=100)
    upsert(spark.createDataFrame([("d5", "V", "+I", 1)], "id string, name string, rowkind string, arrival long"), spec, f"{tmp_dir}/d")
    assert [r.id for r in delta_step(spark, none, stage, steps, 1, now=10.0, wait_seconds=100).collect()] == ["5"]
    assert size(0) == 3000 and size(1) == 2  # the fact and the mark that it waits no more
    assert delta_step(spark, none, stage, steps, 2, now=20.0, wait_seconds=100).count() == 0
    assert delta_step(spark, none, stage, steps, 3, now=100.0, wait_seconds=100).count() == 2999
    import shutil
    delta_step(spark, pending.limit(3), stage, steps, 4, now=110.0, wait_seconds=100)
    shutil.rmtree(f"{steps}/lk_step=4")
    with pytest.raises(FileNotFoundError):
        delta_step(spark, none, stage, steps, 5, now=120.0, wait_seconds=100)


# ------------------------------------------------------------- audit log

def test_audit_log_equals_the_feed_of_every_commit(spark, tmp_dir):
    from carelake.streaming import read_audit_log, sink
    spec = _versioned_spec()
    batches = [[("d1", "1", "a", "+I", 1), ("d2", "2", "a", "+I", 2), ("d2", "4", None, "+I", 2)],
               [("d1", "1", "b", "+U", 3), ("d2", "2", "a", "-D", 4), ("d1", "3", "c", "+I", 5)],
               [("d1", "1", "b", "+U", 6), ("d2", "2", "late", "+U", 3), ("d1", "9", "never", "-D", 7)],
               [("d1", "1", "b", "-D", 8), ("d2", "2", "z", "+I", 9), ("d2", "4", "x", "+U", 9)]]
    assert read_audit_log(spark, spec, f"{tmp_dir}/s").count() == 0
    for n, rows in enumerate(batches):
        upsert(spark.createDataFrame(rows, VERSIONED), spec, f"{tmp_dir}/s", feed_path=f"{tmp_dir}/f", batch_id=n, compact_every=2)

    def feed(after, upto):
        return _rows(sink.read_feed(spark, spec, f"{tmp_dir}/f", after=after, upto=upto).select("rowkind", "dt", "id", "v", "batch_id"))

    def audit(after, upto):
        return _rows(read_audit_log(spark, spec, f"{tmp_dir}/s", after=after, upto=upto).select("rowkind", "dt", "id", "v", "commit"))

    assert len(feed(-1, 99)) > 8
    for after in range(-1, 6):
        for upto in range(after, 7):
            assert audit(after, upto) == feed(after, upto), (after, upto)
