"""Back-fill of the wide facts with lookups as of each fact's own time (J7 for W7/W8).

A stream enriches a fact with the dimension rows present when it is
processed. Rebuilding a fact table from recorded change logs must reproduce
that, not today's dimension state: each lookup takes the dimension version
with the greatest ``version_time <= fact time``, or with ``wait_seconds`` the
first live version within the wait (the bounded wait for a late row). Versions are
changes: after a delete the row is absent until its next live version. It is three as-of lookups in one
batch plan: doctor, the doctor's hospital, then the patient.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from carelake.operators.changelog import materialize
from carelake.operators.lookup import lookup_join_asof
from carelake.plans.warehouse import (DOCTOR_ATTRS, HOSPITAL_ATTRS, PATIENT_ATTRS, Job,
                                      checked_rows, wide_output)
from carelake.sources.specs import ROWKIND

def backfill_wide(job: Job, source: DataFrame, versions: Mapping[str, DataFrame], *,
                  fact_time: str = "update_time", version_time: str = "version_time",
                  wait_seconds: int | None = None, bucket_seconds: int = 86400,
                  version_order: Sequence[str] = ()) -> DataFrame:
    """Live rows of W7/W8 rebuilt from their change log with as-of lookups.

    ``versions`` maps ``dim_doctor``/``dim_hospital``/``dim_patient`` to their
    versions: the table's columns, ``rowkind``, ``version_time`` (when the
    version became visible) and ``version_order`` (what orders versions of one time). ``fact_time`` is the fact's time of processing
    (a column of the prepared rows).
    """
    rows, _ = checked_rows(job, source)
    live = materialize(rows, job.spec.pk, job.spec.order)
    for dim, on, attrs in (("dim_doctor", "doctor_id", DOCTOR_ATTRS),
                           ("dim_hospital", "hospital_id", HOSPITAL_ATTRS),
                           ("dim_patient", "patient_id", PATIENT_ATTRS)):
        live = lookup_join_asof(live, versions[dim], fact_key=on, dim_key="id", fact_time=fact_time,
                                dim_time=version_time, cols=attrs, wait_seconds=wait_seconds,
                                bucket_seconds=bucket_seconds, kind=ROWKIND, dim_order=version_order)
    return wide_output(job.spec, live)
