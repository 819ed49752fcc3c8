"""Hand-computed scenarios for the semantic rules R1-R15 (FIXTURES.md section 3)."""

from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from carelake.functions.conform import conform
from carelake.operators import lookup_join, materialize
from carelake.plans.warehouse import JOBS, build, keyed_rows
from carelake.sources import specs as S
from carelake.streaming.sink import live_view, read_state, upsert
from helpers import (DICT_ROWS, ODS_CONSULTATION, ODS_DICT, ODS_DOCTOR, ODS_PAYMENT, ODS_USER,
                     consultation, payment, ts)


def _payments(spark, rows):
    return build(JOBS["dwd_payment"], spark.createDataFrame(rows, ODS_PAYMENT), {})


def _ids(df):
    return sorted((r["dt"], r["id"]) for r in df.select("dt", "id").collect())


def test_insert_update_delete_leaves_key_absent(spark):
    t = "2024-01-01 10:00:00"
    rows = [payment("+I", 1, 7, t, t), payment("-U", 2, 7, t, t), payment("+U", 3, 7, t, t),
            payment("-D", 4, 7, t, t)]
    assert _payments(spark, rows).count() == 0


def test_reinsert_after_delete(spark):
    t = "2024-01-01 10:00:00"
    rows = [payment("+I", 1, 7, t, t, "1.00"), payment("-D", 2, 7, t, t),
            payment("+I", 3, 7, t, t, "3.00")]
    out = _payments(spark, rows).collect()
    assert [(r.id, r.payment_amount) for r in out] == [("7", Decimal("3.00"))]


def test_older_version_arriving_later_is_ignored(spark):
    c = "2024-01-01 09:00:00"
    rows = [payment("+I", 1, 7, c, "2024-01-01 10:05:00", "5.00"),
            payment("+U", 2, 7, c, "2024-01-01 10:01:00", "1.00")]
    assert [r.payment_amount for r in _payments(spark, rows).collect()] == [Decimal("5.00")]


def test_equal_versions_higher_arrival_wins(spark):
    c, u = "2024-01-01 09:00:00", "2024-01-01 10:05:00"
    rows = [payment("+U", 9, 7, c, u, "9.00"), payment("+I", 4, 7, c, u, "4.00")]
    assert [r.payment_amount for r in _payments(spark, rows).collect()] == [Decimal("9.00")]


def test_null_version_loses(spark):
    c = "2024-01-01 09:00:00"
    rows = [payment("+I", 1, 7, c, "2024-01-01 10:05:00", "5.00"),
            payment("+U", 2, 7, c, None, "6.00")]
    assert [r.payment_amount for r in _payments(spark, rows).collect()] == [Decimal("5.00")]


def test_late_update_after_newer_delete_stays_deleted(spark):
    c = "2024-01-01 09:00:00"
    rows = [payment("+I", 1, 7, c, "2024-01-01 10:00:00"),
            payment("-D", 2, 7, c, "2024-01-01 10:05:00"),
            payment("+U", 3, 7, c, "2024-01-01 10:01:00")]
    assert _payments(spark, rows).count() == 0


def test_same_id_two_days_without_before_image_gives_two_rows(spark):
    rows = [payment("+I", 1, 7, "2024-01-01 10:00:00", "2024-01-01 10:00:00"),
            payment("+U", 2, 7, "2024-01-02 10:00:00", "2024-01-02 10:00:00")]
    assert _ids(_payments(spark, rows)) == [("2024-01-01", "7"), ("2024-01-02", "7")]


def test_same_id_two_days_with_before_image_gives_one_row(spark):
    rows = [payment("+I", 1, 7, "2024-01-01 10:00:00", "2024-01-01 10:00:00"),
            payment("-U", 2, 7, "2024-01-01 10:00:00", "2024-01-02 10:00:00"),
            payment("+U", 3, 7, "2024-01-02 10:00:00", "2024-01-02 10:00:00")]
    assert _ids(_payments(spark, rows)) == [("2024-01-02", "7")]


def test_day_boundary_parts(spark):
    j = JOBS["dwd_consultation"]
    src = spark.createDataFrame([
        consultation("+I", 1, 1, 201, create="2024-01-01 23:59:59.999999"),
        consultation("+I", 2, 2, 201, create="2024-01-02 00:00:00")], ODS_CONSULTATION)
    rows = j.prepare(src).select("id", "dt", "hour", "minute").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "2024-01-01", 23, 59), ("2", "2024-01-02", 0, 0)]


def test_null_create_time_goes_to_rejects(spark):
    src = spark.createDataFrame([payment("+I", 1, 7, "2024-01-01 10:00:00", None)], ODS_PAYMENT)
    src = src.union(spark.createDataFrame([(8, None, None, Decimal("1.00"), 203, 1, 2, 3, "+I", 2)],
                                          ODS_PAYMENT))
    good, bad = keyed_rows(JOBS["dwd_payment"], src)
    assert [r.id for r in good.collect()] == ["7"]
    assert [r.id for r in bad.collect()] == ["8"]


def test_one_bad_value_stops_no_job(spark, tmp_dir):
    """A status that its type does not take and a NULL create_time are rejected with reasons; the rest is stored."""
    from carelake.plans.warehouse import checked_rows
    from carelake.sources.changelog import read_changelog
    from carelake.streaming import live_view, start_job
    job = JOBS["dwd_payment"]
    src = spark.createDataFrame(
        [payment("+I", 1, 7, "2024-01-01 10:00:00", None), payment("+I", 2, 8, "2024-01-01 10:00:00", None, status=40000),
         (9, None, None, Decimal("1.00"), -40000, 1, 2, 3, "+I", 3), payment("+I", 4, 10, "2024-01-02 10:00:00", None)], ODS_PAYMENT)
    good, rejects = checked_rows(job, src)
    assert {r.id: [tuple(e) for e in r.errors] for r in rejects.collect()} == {
        8: [("status", "40000", "not smallint")], 9: [("status", "-40000", "not smallint"), ("create_time", None, "null")]}
    assert sorted(r.id for r in good.collect()) == ["10", "7"]
    assert sorted(r.id for r in build(job, src, {}).collect()) == ["10", "7"]
    src.write.parquet(f"{tmp_dir}/landing")
    start_job(job, read_changelog(spark, f"{tmp_dir}/landing", src.schema, stream=True), f"{tmp_dir}/state", f"{tmp_dir}/checkpoint",
              reject_path=f"{tmp_dir}/rejects", trigger={"availableNow": True}).awaitTermination()
    assert sorted(r.id for r in live_view(spark, job.spec, f"{tmp_dir}/state").collect()) == ["10", "7"]
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()) == [8, 9]


def test_every_job_can_tell_its_rejects(spark):
    from carelake.plans.batch import table_reader
    from helpers import SF_SMALL
    from carelake.plans.standins import SOURCES
    from carelake.plans.warehouse import checked_rows
    for job in JOBS.values():
        _, rejects = checked_rows(job, SOURCES[job.source](table_reader(spark, SF_SMALL)))
        assert rejects.count() == 0 and "errors" in rejects.columns, job.name


def test_review_withdrawn_leaves_table(spark):
    src = spark.createDataFrame([
        consultation("+I", 1, 5, 207, update="2024-01-01 10:00:00"),
        consultation("+U", 2, 5, 206, update="2024-01-01 11:00:00"),
        consultation("+I", 3, 6, 207)], ODS_CONSULTATION)
    out = build(JOBS["dwd_review"], src, {})
    assert [r.id for r in out.collect()] == ["6"]


def test_register_keeps_insert_event(spark):
    src = spark.createDataFrame([
        (1, ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00"), "a@x", "1", "first", "+I", 1),
        (1, ts("2024-01-01 10:00:00"), ts("2024-01-01 11:00:00"), "b@x", "2", "second", "+U", 2),
    ], ODS_USER)
    out = build(JOBS["dwd_user_register"], src, {}).collect()
    assert [(r.id, r.username) for r in out] == [("1", "first")]


def test_positional_insert_and_missing_codes(spark):
    doctors = spark.createDataFrame([
        (1, None, Decimal("9.50"), 102, "Ann", 501, 302, 10, "+I", 1),
        (2, None, Decimal("9.50"), 999, "Bob", None, 301, 11, "+I", 2)], ODS_DOCTOR)
    dictionary = materialize(spark.createDataFrame(DICT_ROWS, ODS_DICT), ["id"])
    out = {r.id: r for r in build(JOBS["dim_doctor"], doctors, {"ods_dict": dictionary}).collect()}
    # the decoded gender name lands in the column named ``gender``
    assert out["1"].gender_code == "102" and out["1"].gender == "female"
    assert out["1"].specialty_name == "cardiology" and out["1"].title_name == "doctor"
    # unknown code and NULL code: NULL names, row kept
    assert out["2"].gender is None and out["2"].specialty_code is None
    assert out["2"].specialty_name is None and out["2"].title_name == "assistant doctor"


def test_missing_doctor_nulls_doctor_and_hospital_but_keeps_patient(spark):
    j = JOBS["dwd_consultation"]
    src = spark.createDataFrame([consultation("+I", 1, 1, 201, doctor=77, patient=5)],
                                ODS_CONSULTATION)
    dim_doctor = spark.createDataFrame([], S.DIM_DOCTOR.schema)
    dim_hospital = spark.createDataFrame([], S.DIM_HOSPITAL.schema)
    dim_patient = spark.createDataFrame([("5", "1990-01-01", "101", "male", "Pat", "9")],
                                        S.DIM_PATIENT.schema)
    r = build(j, src, {"dim_doctor": dim_doctor, "dim_hospital": dim_hospital,
                       "dim_patient": dim_patient}).collect()[0]
    assert r.doctor_id == "77" and r.doctor_name is None and r.hospital_id is None
    assert r.hospital_name is None and r.patient_name == "Pat"


def test_strict_and_tolerant_narrowing_casts(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(70000, 300)], "status int, rating int")
    narrow = T.StructType([T.StructField("status", T.ShortType()), T.StructField("rating", T.ByteType())])
    with pytest.raises(ArithmeticException):
        conform(df, narrow).collect()
    row = conform(df, narrow, strict=False).collect()[0]
    assert row.status is None and row.rating is None


def test_conform_checks_arity(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        conform(df, S.DIM_USER.schema)


def test_last_key_of_partition_deleted_empties_it(spark, tmp_dir):
    j = JOBS["dwd_payment"]
    path = f"{tmp_dir}/state"
    t = "2024-01-03 10:00:00"
    first = spark.createDataFrame([payment("+I", 1, 7, t, t)], ODS_PAYMENT)
    upsert(j.enrich(j.prepare(first)), j.spec, path)
    assert _ids(live_view(spark, j.spec, path)) == [("2024-01-03", "7")]
    second = spark.createDataFrame([payment("-D", 2, 7, t, t)], ODS_PAYMENT)
    upsert(j.enrich(j.prepare(second)), j.spec, path)
    assert live_view(spark, j.spec, path).filter(F.col("dt") == "2024-01-03").count() == 0
    # the tombstone stays in the state so older versions cannot revive the key
    assert read_state(spark, j.spec, path).filter(F.col("rowkind") == "-D").count() == 1


def test_dimension_overwrite_last_arrival_wins(spark):
    rows = [(1, None, Decimal("1.00"), 101, "old", None, None, 1, "+I", 1),
            (1, None, Decimal("2.00"), 101, "new", None, None, 1, "+U", 2)]
    doctors = spark.createDataFrame(rows, ODS_DOCTOR)
    dictionary = materialize(spark.createDataFrame(DICT_ROWS, ODS_DICT), ["id"])
    out = build(JOBS["dim_doctor"], doctors, {"ods_dict": dictionary}).collect()
    assert [(r.id, r.name) for r in out] == [("1", "new")]


def test_lookup_join_never_changes_row_count(spark):
    facts = spark.range(100).withColumn("fk", (F.col("id") % 7).cast("string"))
    dim = spark.createDataFrame([(str(i), f"v{i}") for i in range(5)], "id string, v string")
    assert lookup_join(facts, dim, "fk", cols=["v"]).count() == 100


def test_upsert_with_escaped_partition_values(spark, tmp_dir):
    from pyspark.sql import types as T
    from carelake.sources.specs import TableSpec
    spec = TableSpec(name="t", schema=T.StructType([
        T.StructField("p", T.StringType()), T.StructField("id", T.StringType()),
        T.StructField("v", T.StringType())]), pk=("p", "id"), partition=("p",), buckets=2)
    schema = "p string, id string, v string, rowkind string, arrival long"
    path = f"{tmp_dir}/s"
    upsert(spark.createDataFrame([("a b", "1", "x", "+I", 1), ("c:d", "2", "x", "+I", 2)], schema),
           spec, path)
    upsert(spark.createDataFrame([("a b", "1", "y", "+U", 3), ("c:d", "3", "z", "+I", 4)], schema),
           spec, path)
    got = sorted(tuple(r) for r in live_view(spark, spec, path).collect())
    assert got == [("a b", "1", "y"), ("c:d", "2", "x"), ("c:d", "3", "z")]


def test_backfill_uses_dimension_versions_as_of_each_fact(spark):
    from carelake.plans.backfill import backfill_wide

    from pyspark.sql import types as T

    def versioned(spec):  # a new schema: StructType.add would change the shared spec
        return T.StructType(list(spec.schema.fields) + [
            T.StructField("rowkind", T.StringType()), T.StructField("version_time", T.TimestampNTZType())])

    def doc(id_, name, hosp):
        return (id_, "1970-01-01", Decimal("1.00"), "101", "male", name, "501", "x", "301", "y", hosp)

    dims_doctor = spark.createDataFrame(
        [doc("1", "Old", "7") + ("+I", ts("2024-01-01 08:00:00")),
         doc("1", "New", "7") + ("+U", ts("2024-01-01 12:00:00")),
         doc("2", "Gone", "7") + ("+I", ts("2024-01-01 08:00:00")),
         doc("2", "Gone", "7") + ("-D", ts("2024-01-01 09:00:00")),
         doc("3", "Late", None) + ("+I", ts("2024-01-01 10:30:00"))],
        versioned(S.DIM_DOCTOR))
    hosp = spark.createDataFrame(
        [("7", "a", "b", 1, "c", 1, "d", "1999-01-01", 1, "yes", "L1", "General", "P", "+I",
          ts("2023-01-01 00:00:00"))], versioned(S.DIM_HOSPITAL))
    pat = spark.createDataFrame([], versioned(S.DIM_PATIENT))
    src = spark.createDataFrame([
        consultation("+I", 1, 10, 201, update="2024-01-01 10:00:00", doctor=1),   # before the rename
        consultation("+I", 2, 11, 201, update="2024-01-01 13:00:00", doctor=1),   # after it
        consultation("+I", 3, 12, 201, update="2024-01-01 10:00:00", doctor=2),   # doctor deleted
        consultation("+I", 4, 13, 201, update="2024-01-01 10:00:00", doctor=3),   # doctor 30 min late
    ], ODS_CONSULTATION)
    job = JOBS["dwd_consultation"]
    vers = {"dim_doctor": dims_doctor, "dim_hospital": hosp, "dim_patient": pat}
    out = {r.id: r for r in backfill_wide(job, src, vers).collect()}
    assert out["10"].doctor_name == "Old" and out["10"].hospital_name == "General"
    assert out["11"].doctor_name == "New"
    assert out["12"].doctor_name is None and out["12"].hospital_id is None
    assert out["13"].doctor_name is None
    waited = {r.id: r for r in backfill_wide(job, src, vers, wait_seconds=3600).collect()}
    assert waited["13"].doctor_name == "Late" and waited["13"].hospital_id is None
    assert waited["10"].doctor_name == "Old"
    assert out["10"].patient_name is None
