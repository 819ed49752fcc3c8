"""Target tables: typed schemas and keyed-table settings.

Column names, order and types are the declared target schemas of the
warehouse (fixed values, they must stay as declared). A column has a comment
where its name alone does not tell what it holds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Change-log bookkeeping columns carried next to the data columns.
ROWKIND = "rowkind"     # '+I' insert, '-U' update before-image, '+U' update after-image, '-D' delete
ARRIVAL = "arrival"     # producer order (log offset); higher arrives later
BUCKET = "bucket"       # physical bucket of the key, a partition column of a state table
META = (ROWKIND, ARRIVAL)

_STR, _BIG, _TS = T.StringType(), T.LongType(), T.TimestampNTZType()
_MONEY = T.DecimalType(19, 2)
_SMALL, _TINY = T.ShortType(), T.ByteType()


def _f(name: str, dtype: T.DataType, comment: str = "", nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, metadata={"comment": comment} if comment else {})


@dataclass(frozen=True)
class TableSpec:
    """Schema and keyed-table properties of one target table.

    ``sequence``: version column, newest wins (None: last arrival wins).
    ``partition``: value-partition columns (``dt`` for facts).
    ``buckets`` / ``bucket_key``: hash buckets of the key inside each partition.
    ``bucket_method``: ``hash`` (xxhash64 of the key) or ``mod`` (key modulo n,
    integral keys only).
    ``before_images``: whether the change log that feeds the table has the
    images before updates and deletes; a job over one without them has to normalise it.
    """

    name: str
    schema: T.StructType
    pk: tuple[str, ...] = ("id",)
    sequence: str | None = None
    partition: tuple[str, ...] = ()
    buckets: int = 1
    bucket_key: str = "id"
    bucket_method: str = "hash"
    not_null: tuple[str, ...] = field(default=())
    before_images: bool = True

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def order(self) -> tuple[str, ...]:
        """Columns that decide which row of a key wins, most significant first."""
        return ((self.sequence,) if self.sequence else ()) + (ARRIVAL,)

    @property
    def layout(self) -> tuple[str, ...]:
        """Directory partition columns of the state table."""
        return self.partition + (BUCKET,)

    def with_(self, **changes) -> "TableSpec":
        values = {**self.__dict__, **changes}
        return TableSpec(**values)


def _dim(name, fields, buckets):
    return TableSpec(name=name, schema=T.StructType(fields), pk=("id",), buckets=buckets)


def _fact(name, fields, not_null=()):
    return TableSpec(name=name, schema=T.StructType(fields), pk=("dt", "id"),
                     sequence="update_time", partition=("dt",), buckets=2,
                     not_null=not_null)


DIM_HOSPITAL = _dim("dim_hospital", [
    _f("id", _STR),
    _f("address", _STR),
    _f("alias", _STR, "other name"),
    _f("bed_num", _BIG),
    _f("city", _STR),
    _f("department_num", _BIG),
    _f("district", _STR),
    _f("establish_time", _STR),
    _f("health_care_num", _BIG, "number of medical staff"),
    _f("insurance", _STR, "accepts public insurance"),
    _f("level", _STR),
    _f("name", _STR),
    _f("province", _STR),
], buckets=1)

DIM_DOCTOR = _dim("dim_doctor", [
    _f("id", _STR),
    _f("birthday", _STR),
    _f("consultation_fee", _MONEY),
    _f("gender_code", _STR, "gender code, 101/102"),
    _f("gender", _STR),
    _f("name", _STR),
    _f("specialty_code", _STR, "specialty code, 5xx"),
    _f("specialty_name", _STR),
    _f("title_code", _STR, "title code, 301-305"),
    _f("title_name", _STR),
    _f("hospital_id", _STR),
], buckets=4)

DIM_PATIENT = _dim("dim_patient", [
    _f("id", _STR),
    _f("birthday", _STR),
    _f("gender_code", _STR),
    _f("gender_name", _STR),
    _f("name", _STR),
    _f("user_id", _STR),
], buckets=2)

DIM_MEDICINE = _dim("dim_medicine", [
    _f("id", _STR),
    _f("approval_code", _STR),
    _f("dose_type", _STR),
    _f("name", _STR),
    _f("name_en", _STR),
    _f("price", _MONEY),
    _f("specs", _STR),
    _f("trade_name", _STR),
], buckets=1)

DIM_USER = _dim("dim_user", [
    _f("id", _STR),
    _f("email", _STR),
    _f("telephone", _STR),
    _f("username", _STR),
], buckets=4)

DWD_USER_REGISTER = _fact("dwd_user_register", [
    _f("id", _STR),
    _f("create_time", _TS),
    _f("update_time", _TS),
    _f("email", _STR),
    _f("telephone", _STR),
    _f("username", _STR),
    _f("dt", _STR),
])

DWD_DOCTOR_REGISTER = _fact("dwd_doctor_register", [
    _f("id", _STR),
    _f("create_time", _TS),
    _f("update_time", _TS),
    _f("birthday", _STR),
    _f("consultation_fee", _MONEY),
    _f("gender_code", _STR, "gender code, 101/102"),
    _f("gender_name", _STR),
    _f("name", _STR),
    _f("specialty_code", _STR, "specialty code, 5xx"),
    _f("specialty_name", _STR),
    _f("title_code", _STR, "title code, 301-305"),
    _f("title_name", _STR),
    _f("hospital_id", _STR),
    _f("dt", _STR),
])

DWD_PATIENT_REGISTER = _fact("dwd_patient_register", [
    _f("id", _STR),
    _f("create_time", _TS),
    _f("update_time", _TS),
    _f("birthday", _STR),
    _f("gender_code", _STR),
    _f("gender_name", _STR),
    _f("name", _STR),
    _f("user_id", _STR),
    _f("dt", _STR),
])

DWD_PAYMENT = _fact("dwd_payment", [
    _f("id", _STR, nullable=False),
    _f("create_time", _TS),
    _f("update_time", _TS),
    _f("payment_amount", _MONEY),
    _f("status", _SMALL, "payment status, 202 unpaid / 203 paid"),
    _f("consultation_id", _STR),
    _f("prescription_id", _STR),
    _f("user_id", _STR),
    _f("dt", _STR),
], not_null=("id",))

DWD_REVIEW = _fact("dwd_review", [
    _f("id", _STR),
    _f("create_time", _TS),
    _f("update_time", _TS),
    _f("rating", _TINY, "rating 1-5"),
    _f("review", _STR),
    _f("doctor_id", _STR),
    _f("patient_id", _STR),
    _f("user_id", _STR),
    _f("dt", _STR),
])

DWD_PRESCRIPTION_DETAIL = _fact("dwd_prescription_detail", [
    _f("id", _STR, nullable=False),
    _f("create_time", _TS),
    _f("update_time", _TS),
    _f("count", _STR, "dose"),
    _f("instruction", _STR),
    _f("medicine_id", _STR),
    _f("approval_code", _STR),
    _f("name", _STR),
    _f("name_en", _STR),
    _f("price", _MONEY),
    _f("specs", _STR),
    _f("trade_name", _STR),
    _f("prescription_id", _STR),
    _f("dt", _STR),
], not_null=("id",))

_DOCTOR_COLS = [
    _f("doctor_id", _STR),
    _f("doctor_name", _STR),
    _f("doctor_birthday", _STR),
    _f("doctor_gender_code", _STR),
    _f("doctor_gender_name", _STR),
    _f("doctor_specialty_code", _STR),
    _f("doctor_specialty_name", _STR),
    _f("doctor_title_code", _STR),
    _f("doctor_title_name", _STR),
    _f("hospital_id", _STR),
    _f("hospital_name", _STR),
    _f("hospital_establish_time", _STR),
    _f("hospital_level", _STR),
    _f("hospital_province", _STR),
    _f("hospital_city", _STR),
    _f("hospital_district", _STR),
    _f("patient_id", _STR),
    _f("patient_name", _STR),
    _f("patient_birthday", _STR),
    _f("patient_gender_code", _STR),
    _f("patient_gender_name", _STR),
]

_TIME_COLS = [
    _f("dt", _STR),
    _f("hour", _BIG),
    _f("minute", _BIG),
]

DWD_PRESCRIPTION = _fact("dwd_prescription", [
    _f("id", _STR, nullable=False),
    _f("create_time", _TS),
    _f("update_time", _TS),
    _f("instruction", _STR),
    _f("status", _SMALL, "status, 202 unpaid / 203 paid"),
    _f("total_amount", _MONEY),
    _f("consultation_id", _STR),
    *_DOCTOR_COLS,
    *_TIME_COLS,
], not_null=("id",))

DWD_CONSULTATION = _fact("dwd_consultation", [
    _f("id", _STR, nullable=False),
    _f("create_time", _TS),
    _f("update_time", _TS),
    _f("consultation_fee", _MONEY),
    _f("description", _STR),
    _f("diagnosis", _STR),
    _f("rating", _TINY, "rating 1-5"),
    _f("review", _STR),
    _f("status", _SMALL, "status 201-207, 207 = reviewed"),
    *_DOCTOR_COLS,
    _f("user_id", _STR),
    *_TIME_COLS,
], not_null=("id",))

ALL_SPECS = {s.name: s for s in [
    DIM_HOSPITAL, DIM_DOCTOR, DIM_PATIENT, DIM_MEDICINE, DIM_USER,
    DWD_USER_REGISTER, DWD_DOCTOR_REGISTER, DWD_PATIENT_REGISTER, DWD_PAYMENT,
    DWD_REVIEW, DWD_PRESCRIPTION_DETAIL, DWD_PRESCRIPTION, DWD_CONSULTATION,
]}

# The code dictionary is itself a keyed source table, kept in a state table
# when the jobs run as streams.
ODS_DICT = TableSpec(name="ods_dict", schema=T.StructType([
    _f("id", T.IntegerType(), "code"),
    _f("value", _STR),
]), pk=("id",), buckets=1)
