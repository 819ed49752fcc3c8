"""Every driver key equals its DuckDB oracle on the smallest supplied tables."""

import pytest

import __spark_entry__ as entry
import oracle_sql
from helpers import SF_SMALL
from oracle_check import compare

STREAM_KEYS = {"stream_upsert", "stream_change_feed", "stream_lookup_wait"}
OWN_KEYS = list(oracle_sql.ORACLE)  # the training-data queries have their own tests
BATCH_KEYS = [k for k in OWN_KEYS if k not in STREAM_KEYS]


def test_every_query_has_an_oracle():
    assert set(OWN_KEYS) <= set(entry.queries())
    assert set(OWN_KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_batch_key_matches_duckdb(spark, key):
    ok, msg = compare(spark, SF_SMALL, [key], verbose=False)[key]
    assert ok, msg


@pytest.mark.parametrize("key", sorted(STREAM_KEYS))
def test_stream_key_matches_duckdb(spark, key):
    ok, msg = compare(spark, SF_SMALL, [key], verbose=False)[key]
    assert ok, msg


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == [f.name for f in entry.JOBS["dwd_patient_register"].spec.schema.fields]
    assert df.count() > 0
