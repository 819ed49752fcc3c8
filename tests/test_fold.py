"""Folds whose shuffles hold hashes of keys, and rows only of keys that occur more than once."""

import random

import pytest
from pyspark.sql import types as T

from carelake.operators import latest_by_key
from carelake.plans.warehouse import JOBS
from carelake.streaming import jobs, live_view, sink, upsert
from test_streaming import VERSIONED, _rows, _versioned_spec


@pytest.fixture()
def always_apart(monkeypatch):
    monkeypatch.setattr(sink, "FOLD_APART", 0)


@pytest.mark.parametrize("shared", [1_000_000, 3])
def test_fold_equals_latest_by_key(spark, monkeypatch, always_apart, shared):
    monkeypatch.setattr(sink, "FOLD_SHARED", shared)
    rnd = random.Random(5)
    rows = [(rnd.choice(["d1", None]), rnd.choice([None, *map(str, range(40))]), str(rnd.randrange(9)), "+I", rnd.randrange(4))
            for _ in range(80)]
    rows = spark.createDataFrame(rows + rows[:20], VERSIONED)
    got, want = sink.fold(rows, ["dt", "id"], ["arrival"]), latest_by_key(rows, ["dt", "id"], ["arrival"])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_state_of_commits_is_the_same_and_one_commit_is_not_shuffled(spark, tmp_dir, monkeypatch):
    spec = _versioned_spec()
    put = lambda rows: upsert(spark.createDataFrame(rows, VERSIONED), spec, f"{tmp_dir}/s")
    put([("d1", str(n), "a", "+I", n) for n in range(9)] + [("d1", "3", "b", "+U", 20)])
    one = live_view(spark, spec, f"{tmp_dir}/s")
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    assert len(one.collect()) == 9
    put([("d1", "3", "late", "+U", 10), ("d1", "4", "", "-D", 30), ("d2", "4", "c", "+I", 31)])
    plain = _rows(live_view(spark, spec, f"{tmp_dir}/s"))
    monkeypatch.setattr(sink, "FOLD_APART", 0)
    assert _rows(live_view(spark, spec, f"{tmp_dir}/s")) == plain
    assert len(plain) == 9 and ("d1", "3", "b") in [r[:3] for r in plain]


def test_stream_looks_up_one_row_of_each_key(spark, tmp_dir, monkeypatch, always_apart):
    """Lookup columns are joined after the fold, so no shuffle by key holds them."""
    job, plans = JOBS["dwd_prescription_detail"], []
    source = spark.sql("""SELECT id % 7 AS id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS create_time, CAST(NULL AS TIMESTAMP_NTZ) AS
        update_time, CAST(id AS INT) AS count, 'x' AS instruction, id % 3 AS medicine_id, id AS prescription_id, '+I' AS rowkind,
        id AS arrival FROM range(20)""")
    medicine = spark.createDataFrame([(str(n), *["m"] * 4, 1, "s", "t") for n in range(2)],
                                     "id string, approval_code string, dose_type string, name string, name_en string, price int, "
                                     "specs string, trade_name string")
    seen = lambda rows, *a, **k: (plans.append(rows), upsert(rows, *a, **k))
    monkeypatch.setattr(jobs, "upsert", seen)
    jobs.batch_writer(job, f"{tmp_dir}/s", {"dim_medicine": lambda: medicine})(source, 0)
    assert plans[0].select("dt", "id").distinct().count() == plans[0].count() == 7
    got = {r.id: (r["count"], r.medicine_id, r.name) for r in live_view(spark, job.spec, f"{tmp_dir}/s").collect()}
    assert got == {str(k): (str(n), str(n % 3), "m" if n % 3 < 2 else None)
                   for k, n in ((n % 7, n) for n in range(13, 20))}


def test_no_schema_is_lost_by_an_empty_fold(spark, always_apart):
    rows = spark.createDataFrame([], T.StructType([T.StructField("id", T.StringType()), T.StructField("arrival", T.LongType())]))
    assert sink.fold(rows, ["id"], ["arrival"]).collect() == []


def test_feed_of_large_commits_is_the_same(spark, tmp_dir, monkeypatch):
    """Changes of keys that are new, changed, unchanged, deleted and late, with and without hashes of keys."""
    spec, rnd = _versioned_spec(), random.Random(6)
    commits = [{(rnd.choice(["d1", "d2"]), str(rnd.randrange(12))): (str(rnd.randrange(3)), rnd.choice(["+I", "+U", "-D"]),
                                                                     rnd.randrange(9)) for _ in range(8)} for _ in range(5)]
    feeds = []
    for apart in (1 << 60, 0):
        monkeypatch.setattr(sink, "FOLD_APART", apart)
        root = f"{tmp_dir}/{apart}"
        for rows in commits:
            rows = spark.createDataFrame([(*k, v, kind, n) for k, (v, kind, n) in rows.items()], VERSIONED)
            upsert(rows, spec, f"{root}/s", feed_path=f"{root}/f", compact_every=3)
        feeds.append(_rows(sink.read_feed(spark, spec, f"{root}/f")))
    assert feeds[0] == feeds[1] and {r[0] for r in feeds[0]} == {"+I", "-U", "+U", "-D"}


def test_first_feed_and_done_facts_are_not_shuffled(spark, tmp_dir, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from carelake.sources.specs import TableSpec
    from carelake.streaming import WaitStage, delta_step, state_lookup
    spec = _versioned_spec()
    rows = spark.createDataFrame([("d1", str(n), "a", "+I", n) for n in range(9)] + [("d1", "12", "a", "-D", 12)], VERSIONED)
    upsert(rows, spec, f"{tmp_dir}/s", feed_path=f"{tmp_dir}/f")
    feed = sink.feed_changes(spark, spec, f"{tmp_dir}/s", 0)
    assert "Exchange" not in feed._jdf.queryExecution().executedPlan().toString()
    assert feed.count() == 9 == sink.read_feed(spark, spec, f"{tmp_dir}/f").count()

    doctor = TableSpec(name="doctor", schema=T.StructType([T.StructField(c, T.StringType()) for c in ("id", "name")]))
    upsert(spark.createDataFrame([("1", "A", "+I", 1)], "id string, name string, rowkind string, arrival bigint"), doctor,
           f"{tmp_dir}/doctor")
    stage = WaitStage(state_lookup(spark, doctor, f"{tmp_dir}/doctor"), "doctor_id", {"name": "doctor_name"})
    facts = spark.createDataFrame([("f1", "1", "+I", 1), ("f2", "2", "+I", 2)], "id string, doctor_id string, rowkind string, arrival bigint")
    plans, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (plans.append(w._df), parquet(w, *a, **k))[1])
    done = delta_step(spark, facts, [stage], f"{tmp_dir}/steps", 0, now=0.0)
    assert [r.doctor_name for r in done.collect()] == ["A"]
    tree = plans[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert tree[0].startswith("Union") and sum("Rebalance" in line for line in tree) == 1
