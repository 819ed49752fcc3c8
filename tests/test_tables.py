"""Table creation, rebuild, lookup key checks, console preview and a wide job as a stream."""

import pytest
from pyspark.sql import functions as F

from carelake.operators import assert_unique_key, duplicate_keys
from carelake.plans import standins
from carelake.plans.batch import Warehouse, table_reader
from carelake.plans.warehouse import JOBS, doctor_insert_preview
from carelake.sources.changelog import read_changelog
from carelake.sources.specs import DIM_DOCTOR, DIM_HOSPITAL, DIM_PATIENT
from carelake.streaming import (current, live_view, open_table, publish, read_state,
                                start_job, start_preview, state_lookup, upsert)
from helpers import SF_SMALL


def test_create_if_absent_and_rebuild_keep_old_version(spark, tmp_dir):
    spec = JOBS["dwd_payment"].spec
    loc = open_table(spark, tmp_dir, spec)
    assert loc.version == 0
    assert read_state(spark, spec, loc.state).count() == 0
    assert live_view(spark, spec, loc.state).columns == spec.columns
    t = table_reader(spark, SF_SMALL)
    job = JOBS["dwd_payment"]
    upsert(job.enrich(job.prepare(standins.ods_payment(t))), spec, loc.state)
    n = live_view(spark, spec, loc.state).count()
    assert open_table(spark, tmp_dir, spec).version == 0        # IF NOT EXISTS: same table
    new = open_table(spark, tmp_dir, spec, rebuild=True)          # drop + create
    assert new.version == 1 and current(spark, tmp_dir, spec.name).version == 1
    assert live_view(spark, spec, new.state).count() == 0
    assert live_view(spark, spec, loc.state).count() == n         # never deleted in place
    assert new.checkpoint != loc.checkpoint


def test_lookup_key_check(spark):
    ok = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    bad = spark.createDataFrame([("1", "a"), ("1", "b")], "id string, v string")
    assert assert_unique_key(ok) is ok
    assert duplicate_keys(bad).first()["count"] == 2
    with pytest.raises(ValueError):
        assert_unique_key(bad)


def test_doctor_insert_preview_has_every_insert(spark, tmp_dir):
    t = table_reader(spark, SF_SMALL)
    log = standins.ods_doctor_log(t)
    log.write.parquet(f"{tmp_dir}/landing")
    inserts = log.filter(F.col("rowkind") == "+I").count()
    assert doctor_insert_preview(log).count() == inserts
    stream = read_changelog(spark, f"{tmp_dir}/landing", log.schema, stream=True)
    q = start_preview(doctor_insert_preview(stream), f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == inserts and out.columns[-1] == "proc_time"


def test_lost_pointer_raises(spark, tmp_dir):
    import shutil
    spec = JOBS["dim_user"].spec
    open_table(spark, tmp_dir, spec)
    hidden = open_table(spark, tmp_dir, spec, rebuild=True, publish_now=False)
    assert hidden.version == 1 and current(spark, tmp_dir, spec.name).version == 0
    publish(spark, hidden)
    assert current(spark, tmp_dir, spec.name).version == 1
    shutil.rmtree(f"{tmp_dir}/{spec.name}/_published")
    with pytest.raises(FileNotFoundError):
        current(spark, tmp_dir, spec.name)


def test_wide_fact_stream_equals_batch(spark, tmp_dir):
    """W8 as a stream: three lookups re-read from state tables on every batch."""
    t = table_reader(spark, SF_SMALL)
    wh = Warehouse(t)
    dims = {}
    for spec in (DIM_DOCTOR, DIM_HOSPITAL, DIM_PATIENT):
        upsert(wh.view(spec.name).withColumn("rowkind", F.lit("+I"))
                 .withColumn("arrival", F.lit(0).cast("long")), spec, f"{tmp_dir}/{spec.name}")
        dims[spec.name] = state_lookup(spark, spec, f"{tmp_dir}/{spec.name}")
    job = JOBS["dwd_consultation"]
    log = standins.ods_consultation(t)
    log.repartition(3).write.parquet(f"{tmp_dir}/landing")
    stream = read_changelog(spark, f"{tmp_dir}/landing", log.schema, stream=True,
                            max_files_per_trigger=1)
    q = start_job(job, stream, f"{tmp_dir}/state", f"{tmp_dir}/ckpt", dims,
                  trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted(tuple(r) for r in live_view(spark, job.spec, f"{tmp_dir}/state").collect())
    want = sorted(tuple(r) for r in wh.table(job.name).collect())
    assert got == want


def test_death_between_create_and_publish_is_taken_up(spark, tmp_dir):
    spec = JOBS["dim_user"].spec
    hidden = open_table(spark, tmp_dir, spec, publish_now=False)  # as if the driver died here
    assert open_table(spark, tmp_dir, spec) == hidden
    assert live_view(spark, spec, current(spark, tmp_dir, spec.name).state).count() == 0
