"""Small change-log fixtures with the source shapes of FIXTURES.md section 1."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"
TS = T.TimestampNTZType()
MONEY = T.DecimalType(19, 2)
META = [T.StructField("rowkind", T.StringType()), T.StructField("arrival", T.LongType())]


def schema(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields] + META)


ODS_PAYMENT = schema(("id", T.LongType()), ("create_time", TS), ("update_time", TS),
                     ("payment_amount", MONEY), ("status", T.IntegerType()),
                     ("consultation_id", T.LongType()), ("prescription_id", T.LongType()),
                     ("user_id", T.LongType()))
ODS_CONSULTATION = schema(("id", T.LongType()), ("create_time", TS), ("update_time", TS),
                          ("consultation_fee", MONEY), ("description", T.StringType()),
                          ("diagnosis", T.StringType()), ("rating", T.IntegerType()),
                          ("review", T.StringType()), ("status", T.IntegerType()),
                          ("doctor_id", T.LongType()), ("patient_id", T.LongType()),
                          ("user_id", T.LongType()))
ODS_USER = schema(("id", T.LongType()), ("create_time", TS), ("update_time", TS),
                  ("email", T.StringType()), ("telephone", T.StringType()),
                  ("username", T.StringType()))
ODS_DOCTOR = schema(("id", T.LongType()), ("birthday", T.DateType()), ("consultation_fee", MONEY),
                    ("gender", T.IntegerType()), ("name", T.StringType()),
                    ("specialty", T.IntegerType()), ("title", T.IntegerType()),
                    ("hospital_id", T.LongType()))
ODS_DICT = schema(("id", T.IntegerType()), ("value", T.StringType()))


def ts(s):
    return datetime.fromisoformat(s)


def payment(kind, arrival, id_, create, update, amount="10.00", status=203):
    return (id_, ts(create), ts(update) if update else None, Decimal(amount), status,
            1, 2, 3, kind, arrival)


def consultation(kind, arrival, id_, status, create="2024-01-01 10:00:00",
                 update="2024-01-01 10:00:00", rating=5, doctor=1, patient=1):
    return (id_, ts(create), ts(update), Decimal("50.00"), "cough", "cold", rating, "good",
            status, doctor, patient, 9, kind, arrival)


DICT_ROWS = [(101, "male", "+I", 1), (102, "female", "+I", 2), (301, "assistant doctor", "+I", 3),
             (302, "doctor", "+I", 4), (501, "cardiology", "+I", 5)]
