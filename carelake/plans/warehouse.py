"""The warehouse jobs: 5 dimensions (D1-D5) and 8 date-partitioned facts.

Each job is split in two DataFrame functions:

* ``prepare(source)``: the inner ``SELECT`` of the job: casts, row-kind
  filter, status filter, ``dt``/``hour``/``minute``; yields keyed rows with
  ``rowkind`` and ``arrival``.
* ``enrich(rows, **lookups)``: the lookup joins against dimension state and
  the positional conform into the target schema.

Batch (``build``) materializes between the two steps, so only the winning
row of each key is enriched; a stream (``carelake.streaming``) runs both on
every micro-batch and re-reads the lookups each time (processing-time
semantics, R7).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from carelake.functions.conform import conform, split_rejects, split_unfit
from carelake.functions.timeparts import day_of, hour_of, minute_of, proc_time
from carelake.operators.changelog import filter_changelog, inserts_only, materialize
from carelake.operators.lookup import decode_codes, lookup_join
from carelake.sources import specs as S
from carelake.sources.specs import META, TableSpec


def _s(name: str, alias: str | None = None):
    """``CAST(name AS STRING) AS alias``."""
    return F.col(f"`{name}`").cast("string").alias(alias or name)


def _keep(*names: str):
    return [F.col(f"`{n}`") for n in names]


def _meta(df: DataFrame):
    return [F.col(c) for c in META if c in df.columns]


@dataclass(frozen=True)
class Job:
    """One target table: its spec, source, lookups and the two steps."""

    spec: TableSpec
    source: str
    prepare: Callable[[DataFrame], DataFrame]
    enrich: Callable[..., DataFrame]
    lookups: tuple[str, ...] = field(default=())
    waits: tuple[str, ...] = field(default=())   # lookups with a bounded wait (J6)

    @property
    def name(self) -> str:
        return self.spec.name


# ---------------------------------------------------------------- dimensions

def _prep_hospital(src: DataFrame) -> DataFrame:
    return src.select(_s("id"), *_keep("address", "alias", "bed_num", "city", "department_num",
                                       "district", "establish_time", "health_care_num",
                                       "insurance", "level", "name", "province"), *_meta(src))


def _prep_doctor(src: DataFrame) -> DataFrame:
    return src.select(_s("id"), *_keep("birthday", "consultation_fee", "gender", "name",
                                       "specialty", "title", "hospital_id"), *_meta(src))


def _enrich_doctor(rows: DataFrame, ods_dict: DataFrame) -> DataFrame:
    d = decode_codes(rows, ods_dict, {"gender": "gender_name", "specialty": "specialty_name",
                                      "title": "title_name"})
    # The decoded gender name is selected into the 5th position, whose
    # target column is named ``gender`` (positional insert, R10).
    d = d.select("id", "birthday", "consultation_fee", F.col("gender").alias("gender_code"),
                 "gender_name", "name", F.col("specialty").alias("specialty_code"),
                 "specialty_name", F.col("title").alias("title_code"), "title_name",
                 "hospital_id", *_meta(d))
    return conform(d, S.DIM_DOCTOR.schema)


def _prep_patient(src: DataFrame) -> DataFrame:
    return src.select(_s("id"), *_keep("birthday", "gender", "name", "user_id"), *_meta(src))


def _enrich_patient(rows: DataFrame, ods_dict: DataFrame) -> DataFrame:
    d = decode_codes(rows, ods_dict, {"gender": "gender_name"})
    d = d.select("id", "birthday", "gender", "gender_name", "name", "user_id", *_meta(d))
    return conform(d, S.DIM_PATIENT.schema)


def _prep_medicine(src: DataFrame) -> DataFrame:
    return src.select(_s("id"), *_keep("approval_code", "dose_type", "name", "name_en", "price",
                                       "specs", "trade_name"), *_meta(src))


def _prep_user(src: DataFrame) -> DataFrame:
    return src.select(_s("id"), *_keep("email", "telephone", "username"), *_meta(src))


def _conform_to(spec: TableSpec):
    return lambda rows: conform(rows, spec.schema)


# --------------------------------------------------------------------- facts

def _dt():
    return day_of("create_time").alias("dt")


def _prep_user_register(src: DataFrame) -> DataFrame:
    ins = inserts_only(src)
    return ins.select(_s("id"), *_keep("create_time", "update_time", "email", "telephone",
                                       "username"), _dt(), *_meta(ins))


def _prep_doctor_register(src: DataFrame) -> DataFrame:
    ins = inserts_only(src)
    return ins.select(_s("id"), *_keep("create_time", "update_time", "birthday", "consultation_fee",
                                       "gender", "name", "specialty", "title", "hospital_id"),
                      _dt(), *_meta(ins))


def _enrich_doctor_register(rows: DataFrame, ods_dict: DataFrame) -> DataFrame:
    d = decode_codes(rows, ods_dict, {"gender": "gender_name", "specialty": "specialty_name",
                                      "title": "title_name"})
    d = d.select("id", "create_time", "update_time", "birthday", "consultation_fee",
                 F.col("gender").alias("gender_code"), "gender_name", "name",
                 F.col("specialty").alias("specialty_code"), "specialty_name",
                 F.col("title").alias("title_code"), "title_name", "hospital_id", "dt", *_meta(d))
    return conform(d, S.DWD_DOCTOR_REGISTER.schema)


def _prep_patient_register(src: DataFrame) -> DataFrame:
    ins = inserts_only(src)
    return ins.select(_s("id"), *_keep("create_time", "update_time", "birthday", "gender", "name",
                                       "user_id"), _dt(), *_meta(ins))


def _enrich_patient_register(rows: DataFrame, ods_dict: DataFrame) -> DataFrame:
    d = decode_codes(rows, ods_dict, {"gender": "gender_name"})
    d = d.select("id", "create_time", "update_time", "birthday", F.col("gender").alias("gender_code"),
                 "gender_name", "name", "user_id", "dt", *_meta(d))
    return conform(d, S.DWD_PATIENT_REGISTER.schema)


def _prep_payment(src: DataFrame) -> DataFrame:
    return src.select(_s("id"), *_keep("create_time", "update_time", "payment_amount"),
                      F.col("status").cast("smallint").alias("status"),
                      _s("consultation_id"), _s("prescription_id"), _s("user_id"), _dt(),
                      *_meta(src))


def _prep_review(src: DataFrame) -> DataFrame:
    # ``WHERE status = 207`` on an updating source: leaving 207 retracts.
    kept = filter_changelog(src, F.col("status") == 207)
    return kept.select(_s("id"), *_keep("create_time", "update_time"),
                       F.col("rating").cast("tinyint").alias("rating"), _s("review"),
                       _s("doctor_id"), _s("patient_id"), _s("user_id"), _dt(), *_meta(kept))


def _prep_detail(src: DataFrame) -> DataFrame:
    return src.select(_s("id"), *_keep("create_time", "update_time"), _s("count"),
                      _s("instruction"), _s("medicine_id"), _s("prescription_id"), _dt(),
                      *_meta(src))


_MEDICINE_COLS = ["approval_code", "name", "name_en", "price", "specs", "trade_name"]


def _enrich_detail(rows: DataFrame, dim_medicine: DataFrame) -> DataFrame:
    d = lookup_join(rows, dim_medicine, "medicine_id", cols={c: f"m_{c}" for c in _MEDICINE_COLS})
    d = d.select("id", "create_time", "update_time", "count", "instruction", "medicine_id",
                 *[f"m_{c}" for c in _MEDICINE_COLS], "prescription_id", "dt", *_meta(d))
    return conform(d, S.DWD_PRESCRIPTION_DETAIL.schema)


# doctor attributes copied under a prefix (J3); ``gender`` holds the name
DOCTOR_ATTRS = {"name": "doctor_name", "birthday": "doctor_birthday",
                 "gender_code": "doctor_gender_code", "gender": "doctor_gender_name",
                 "specialty_code": "doctor_specialty_code", "specialty_name": "doctor_specialty_name",
                 "title_code": "doctor_title_code", "title_name": "doctor_title_name",
                 "hospital_id": "hospital_id"}
HOSPITAL_ATTRS = {"name": "hospital_name", "establish_time": "hospital_establish_time",
                   "level": "hospital_level", "province": "hospital_province",
                   "city": "hospital_city", "district": "hospital_district"}
PATIENT_ATTRS = {"name": "patient_name", "birthday": "patient_birthday",
                  "gender_code": "patient_gender_code", "gender_name": "patient_gender_name"}


def enrich_doctor_hospital_patient(rows: DataFrame, dim_doctor: DataFrame,
                                   dim_hospital: DataFrame, dim_patient: DataFrame) -> DataFrame:
    """Doctor lookup, then hospital by the doctor's hospital (J4) and patient."""
    d = lookup_join(rows, dim_doctor, "doctor_id", cols=DOCTOR_ATTRS)
    d = lookup_join(d, dim_hospital, "hospital_id", cols=HOSPITAL_ATTRS)
    return lookup_join(d, dim_patient, "patient_id", cols=PATIENT_ATTRS)


WIDE_LOOKUP_COLUMNS = ["doctor_id", *DOCTOR_ATTRS.values(), *HOSPITAL_ATTRS.values(), "patient_id",
               *PATIENT_ATTRS.values()]


def _prep_prescription(src: DataFrame) -> DataFrame:
    return src.select(_s("id"), *_keep("create_time", "update_time"), _s("instruction"),
                      F.col("status").cast("smallint").alias("status"), "total_amount",
                      _s("consultation_id"), _s("doctor_id"), _s("patient_id"), _dt(),
                      hour_of("create_time").alias("hour"), minute_of("create_time").alias("minute"),
                      *_meta(src))


def wide_output(spec: TableSpec, enriched: DataFrame) -> DataFrame:
    """Final projection of W7/W8: the fact's own columns around the lookup block, conformed."""
    fact_cols = [c for c in spec.columns if c not in WIDE_LOOKUP_COLUMNS]
    tail = [c for c in ("user_id", "dt", "hour", "minute") if c in fact_cols]
    head = [c for c in fact_cols if c not in tail]
    d = enriched.select(*head, *WIDE_LOOKUP_COLUMNS, *tail, *_meta(enriched))
    return conform(d, spec.schema)


def _enrich_prescription(rows: DataFrame, dim_doctor: DataFrame, dim_hospital: DataFrame,
                         dim_patient: DataFrame) -> DataFrame:
    d = enrich_doctor_hospital_patient(rows, dim_doctor, dim_hospital, dim_patient)
    return wide_output(S.DWD_PRESCRIPTION, d)


def _prep_consultation(src: DataFrame) -> DataFrame:
    return src.select(_s("id"), *_keep("create_time", "update_time", "consultation_fee"),
                      _s("description"), _s("diagnosis"),
                      F.col("rating").cast("tinyint").alias("rating"), _s("review"),
                      F.col("status").cast("smallint").alias("status"),
                      _s("doctor_id"), _s("patient_id"), _s("user_id"), _dt(),
                      hour_of("create_time").alias("hour"), minute_of("create_time").alias("minute"),
                      *_meta(src))


def _enrich_consultation(rows: DataFrame, dim_doctor: DataFrame, dim_hospital: DataFrame,
                         dim_patient: DataFrame) -> DataFrame:
    d = enrich_doctor_hospital_patient(rows, dim_doctor, dim_hospital, dim_patient)
    return wide_output(S.DWD_CONSULTATION, d)


JOBS: dict[str, Job] = {j.name: j for j in [
    Job(S.DIM_HOSPITAL, "ods_hospital", _prep_hospital, _conform_to(S.DIM_HOSPITAL)),
    Job(S.DIM_DOCTOR, "ods_doctor", _prep_doctor, _enrich_doctor, lookups=("ods_dict",)),
    Job(S.DIM_PATIENT, "ods_patient", _prep_patient, _enrich_patient, lookups=("ods_dict",)),
    Job(S.DIM_MEDICINE, "ods_medicine", _prep_medicine, _conform_to(S.DIM_MEDICINE)),
    Job(S.DIM_USER, "ods_user", _prep_user, _conform_to(S.DIM_USER)),
    Job(S.DWD_USER_REGISTER, "ods_user_log", _prep_user_register,
        _conform_to(S.DWD_USER_REGISTER)),
    Job(S.DWD_DOCTOR_REGISTER, "ods_doctor_log", _prep_doctor_register, _enrich_doctor_register,
        lookups=("ods_dict",)),
    Job(S.DWD_PATIENT_REGISTER, "ods_patient_log", _prep_patient_register,
        _enrich_patient_register, lookups=("ods_dict",)),
    Job(S.DWD_PAYMENT, "ods_payment", _prep_payment, _conform_to(S.DWD_PAYMENT)),
    Job(S.DWD_REVIEW, "ods_consultation", _prep_review, _conform_to(S.DWD_REVIEW)),
    Job(S.DWD_PRESCRIPTION_DETAIL, "ods_prescription_detail", _prep_detail, _enrich_detail,
        lookups=("dim_medicine",)),
    Job(S.DWD_PRESCRIPTION, "ods_prescription", _prep_prescription, _enrich_prescription,
        lookups=("dim_doctor", "dim_hospital", "dim_patient"),
        waits=("dim_doctor", "dim_hospital", "dim_patient")),
    Job(S.DWD_CONSULTATION, "ods_consultation", _prep_consultation, _enrich_consultation,
        lookups=("dim_doctor", "dim_hospital", "dim_patient"),
        waits=("dim_doctor", "dim_hospital", "dim_patient")),
]}


def doctor_insert_preview(ods_doctor_log: DataFrame) -> DataFrame:
    """Insert events of the doctors' audit log with their processing time."""
    ins = inserts_only(ods_doctor_log)
    return ins.select("id", "create_time", "update_time", "birthday", "consultation_fee", "gender",
                      "name", "specialty", "title", "hospital_id", proc_time().alias("proc_time"))


def keyed_rows(job: Job, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``prepare`` plus the NULL-key split (R15): returns ``(rows, rejects)``."""
    rows = job.prepare(source)
    return split_rejects(rows, tuple(dict.fromkeys(job.spec.pk + job.spec.not_null)))


def checked_rows(job: Job, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``prepare`` of the rows that fit (R13, R15): returns ``(rows, rejects)``.

    Rejects are source rows with ``errors``: values that the target's types do not take, and NULLs where
    the key or a NOT NULL column comes from. One bad value stops no job.
    """
    needed = tuple(dict.fromkeys("create_time" if c == "dt" else c for c in job.spec.pk + job.spec.not_null))
    missing = [c for c in needed if c not in source.columns]
    if missing:
        raise ValueError(f"{job.name}: {missing} are not in the source, so their rejects cannot be told")
    good, rejects = split_unfit(source, job.spec.schema, needed)
    return job.prepare(good), rejects


def build(job: Job, source: DataFrame, lookups: Mapping[str, DataFrame]) -> DataFrame:
    """Batch result of a job: the current (live) rows of its target table.

    The source is collapsed to one row per key first (partial aggregation
    before the shuffle), tombstones are dropped, and only then are the
    survivors enriched, so lookups see one row per key instead of every
    change.
    """
    rows, _ = checked_rows(job, source)
    live = materialize(rows, job.spec.pk, job.spec.order)
    return job.enrich(live, **{name: lookups[name] for name in job.lookups})
