"""Every warehouse job as a stream (3 files in shuffled order, one per batch) equals its batch build."""

import pytest
from pyspark.sql import functions as F

from carelake.functions.conform import conform
from carelake.plans import standins
from carelake.plans.batch import Warehouse, table_reader
from carelake.plans.warehouse import JOBS
from carelake.sources.changelog import read_changelog
from carelake.sources.specs import ALL_SPECS, ODS_DICT
from carelake.streaming import live_view, start_job, state_lookup, upsert
from helpers import SF_SMALL


@pytest.fixture(scope="module")
def lookups(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lookups"))
    t = table_reader(spark, SF_SMALL)
    wh = Warehouse(t)
    readers = {}
    upsert(conform(standins.ods_dict(t), ODS_DICT.schema), ODS_DICT, f"{root}/ods_dict")
    readers["ods_dict"] = state_lookup(spark, ODS_DICT, f"{root}/ods_dict")
    for name in ("dim_doctor", "dim_hospital", "dim_patient", "dim_medicine"):
        spec = ALL_SPECS[name]
        rows = wh.view(name).withColumn("rowkind", F.lit("+I")).withColumn("arrival", F.lit(0).cast("long"))
        upsert(rows, spec, f"{root}/{name}")
        readers[name] = state_lookup(spark, spec, f"{root}/{name}")
    return readers


@pytest.mark.parametrize("name", [n for n in JOBS if n not in ("dwd_patient_register", "dwd_consultation")])
def test_job_stream_equals_batch(spark, tmp_dir, lookups, name):
    t = table_reader(spark, SF_SMALL)
    job = JOBS[name]
    log = standins.SOURCES[job.source](t)
    parts = log.withColumn("part", F.pmod(F.xxhash64(*log.columns), F.lit(3)))
    for p in (2, 0, 1):   # later change-log files may land first
        parts.filter(F.col("part") == p).drop("part").coalesce(1).write.mode("append") \
             .parquet(f"{tmp_dir}/landing")
    stream = read_changelog(spark, f"{tmp_dir}/landing", log.schema, stream=True,
                            max_files_per_trigger=1)
    q = start_job(job, stream, f"{tmp_dir}/state", f"{tmp_dir}/checkpoint",
                  {n: lookups[n] for n in job.lookups}, trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted(tuple(r) for r in live_view(spark, job.spec, f"{tmp_dir}/state").collect())
    want = sorted(tuple(r) for r in Warehouse(t).table(name).collect())
    assert got == want
