"""Source change logs (``ods_*``) derived from the supplied test tables.

The warehouse's own sources are change logs of an online-consultation
system. The test tables are a TPC-H-like star schema plus an ``events``
stream; these adapters give them the source shapes, so every plan runs on
data that grows with the tables:

* ``nation`` -> code dictionary; ``nation`` with ``region`` -> hospitals
* ``supplier`` -> doctors, ``customer`` -> patients and users, ``part`` -> medicines
* ``orders`` -> consultations, prescriptions, payments
* ``lineitem`` -> prescription details (keys repeat: real upserts)
* ``events`` -> a change log keyed by ``user_id``: signup = insert,
  click / purchase = update after-image, view = update before-image,
  error = delete; sequence ``ts``, arrival ``event_id``

Code columns: doctors' gender is their nation, specialty ``id % 25`` and
title ``(id * 7) % 30`` (codes 25-29 miss the 25-row dictionary); an order's
doctor is ``o_orderkey % 120`` (more ids than suppliers at small scales).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from carelake.sources.changelog import as_changelog

Tables = Callable[[str], DataFrame]

# The change kind each event type stands for.
EVENT_KINDS = {"signup": "+I", "click": "+U", "purchase": "+U", "view": "-U", "error": "-D"}


def event_kind(col: str = "event_type") -> Column:
    kind = None
    for etype, k in EVENT_KINDS.items():
        kind = (F.when(F.col(col) == etype, F.lit(k)) if kind is None
                else kind.when(F.col(col) == etype, F.lit(k)))
    return kind


def _days_after(start: str, n: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), n.cast("int"))


def events_changelog(t: Tables) -> DataFrame:
    """``events`` as a keyed change log: key ``user_id``, sequence ``ts``."""
    e = t("events")
    return as_changelog(e.select("user_id", "ts", "event_id", "event_type", "value", "props"),
                        rowkind=event_kind(), arrival="event_id")


def ods_dict(t: Tables) -> DataFrame:
    n = t("nation")
    return as_changelog(n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("value")),
                        arrival="id")


def ods_hospital(t: Tables) -> DataFrame:
    n, r = t("nation"), t("region")
    h = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("address"),
        F.col("r_name").alias("alias"),
        (F.col("n_nationkey") * 10).alias("bed_num"),
        F.col("n_name").alias("city"),
        F.col("n_regionkey").alias("department_num"),
        F.col("r_name").alias("district"),
        _days_after("1950-01-01", F.col("n_nationkey") * 365).alias("establish_time"),
        (F.col("n_nationkey") * 100).alias("health_care_num"),
        F.when(F.col("n_nationkey") % 2 == 0, "yes").otherwise("no").alias("insurance"),
        F.col("r_name").alias("level"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("province"))
    return as_changelog(h, arrival="id")


def ods_doctor(t: Tables) -> DataFrame:
    s = t("supplier")
    d = s.select(
        F.col("s_suppkey").alias("id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("create_time"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("update_time"),
        _days_after("1960-01-01", F.col("s_suppkey") % 10000).alias("birthday"),
        F.col("s_acctbal").cast("decimal(19,2)").alias("consultation_fee"),
        F.col("s_nationkey").alias("gender"),
        F.col("s_name").alias("name"),
        (F.col("s_suppkey") % 25).cast("int").alias("specialty"),
        ((F.col("s_suppkey") * 7) % 30).cast("int").alias("title"),
        F.col("s_nationkey").cast("bigint").alias("hospital_id"))
    return as_changelog(d, arrival="id")


def ods_patient(t: Tables) -> DataFrame:
    c = t("customer")
    p = c.select(
        F.col("c_custkey").alias("id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("create_time"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("update_time"),
        _days_after("1960-01-01", F.col("c_custkey") % 10000).alias("birthday"),
        F.col("c_nationkey").alias("gender"),
        F.col("c_name").alias("name"),
        F.col("c_custkey").alias("user_id"))
    return as_changelog(p, arrival="id")


def ods_medicine(t: Tables) -> DataFrame:
    p = t("part")
    m = p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("approval_code"),
        F.col("p_type").alias("dose_type"),
        F.col("p_name").alias("name"),
        F.upper(F.col("p_name")).alias("name_en"),
        F.col("p_retailprice").cast("decimal(19,2)").alias("price"),
        F.col("p_size").cast("string").alias("specs"),
        F.col("p_brand").alias("trade_name"))
    return as_changelog(m, arrival="id")


def ods_user(t: Tables) -> DataFrame:
    c = t("customer")
    u = c.select(
        F.col("c_custkey").alias("id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("create_time"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("update_time"),
        F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("telephone"),
        F.col("c_name").alias("username"))
    return as_changelog(u, arrival="id")


def _events_with(t: Tables, other: str, key: str) -> DataFrame:
    e = t("events")
    o = t(other)
    return e.join(o, e.user_id == o[key], "left")


def ods_user_log(t: Tables) -> DataFrame:
    """Users' change log (audit-log view) from ``events`` with customer attributes."""
    j = _events_with(t, "customer", "c_custkey")
    u = j.select(
        F.col("user_id").alias("id"), F.col("ts").alias("create_time"), F.col("ts").alias("update_time"),
        F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("telephone"), F.col("c_name").alias("username"),
        event_kind().alias("rowkind"), F.col("event_id").alias("arrival"))
    return as_changelog(u, rowkind="rowkind", arrival="arrival")


def ods_patient_log(t: Tables) -> DataFrame:
    """Patients' change log from ``events`` with customer attributes."""
    j = _events_with(t, "customer", "c_custkey")
    p = j.select(
        F.col("user_id").alias("id"), F.col("ts").alias("create_time"), F.col("ts").alias("update_time"),
        _days_after("1960-01-01", F.col("c_custkey") % 10000).alias("birthday"),
        F.col("c_nationkey").alias("gender"), F.col("c_name").alias("name"),
        F.col("c_custkey").alias("user_id"),
        event_kind().alias("rowkind"), F.col("event_id").alias("arrival"))
    return as_changelog(p, rowkind="rowkind", arrival="arrival")


def ods_doctor_log(t: Tables) -> DataFrame:
    """Doctors' change log from ``events`` with supplier attributes (misses stay NULL)."""
    j = _events_with(t, "supplier", "s_suppkey")
    d = j.select(
        F.col("user_id").alias("id"), F.col("ts").alias("create_time"), F.col("ts").alias("update_time"),
        _days_after("1960-01-01", F.col("s_suppkey") % 10000).alias("birthday"),
        F.col("s_acctbal").cast("decimal(19,2)").alias("consultation_fee"),
        F.col("s_nationkey").alias("gender"), F.col("s_name").alias("name"),
        (F.col("user_id") % 25).cast("int").alias("specialty"),
        ((F.col("user_id") * 7) % 30).cast("int").alias("title"),
        F.col("s_nationkey").cast("bigint").alias("hospital_id"),
        event_kind().alias("rowkind"), F.col("event_id").alias("arrival"))
    return as_changelog(d, rowkind="rowkind", arrival="arrival")


def _order_status() -> Column:
    return F.when(F.col("o_orderstatus") == "F", F.lit(203)).otherwise(F.lit(202))


def ods_payment(t: Tables) -> DataFrame:
    o = t("orders")
    p = o.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("create_time"),
        F.col("o_orderdate").alias("update_time"),
        F.col("o_totalprice").cast("decimal(19,2)").alias("payment_amount"),
        _order_status().alias("status"),
        F.col("o_orderkey").alias("consultation_id"), F.col("o_orderkey").alias("prescription_id"),
        F.col("o_custkey").alias("user_id"))
    return as_changelog(p, arrival="id")


def ods_consultation(t: Tables) -> DataFrame:
    o = t("orders")
    c = o.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("create_time"),
        F.col("o_orderdate").alias("update_time"),
        F.col("o_totalprice").cast("decimal(19,2)").alias("consultation_fee"),
        F.col("o_orderpriority").alias("description"),
        F.col("o_orderstatus").alias("diagnosis"),
        (F.col("o_custkey") % 5 + 1).cast("int").alias("rating"),
        F.col("o_orderpriority").alias("review"),
        (F.col("o_orderkey") % 7 + 201).cast("int").alias("status"),
        (F.col("o_orderkey") % 120).alias("doctor_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_custkey").alias("user_id"))
    return as_changelog(c, arrival="id")


def ods_prescription(t: Tables) -> DataFrame:
    o = t("orders")
    p = o.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("create_time"),
        F.col("o_orderdate").alias("update_time"),
        F.col("o_orderpriority").alias("instruction"),
        _order_status().alias("status"),
        F.col("o_totalprice").cast("decimal(19,2)").alias("total_amount"),
        F.col("o_orderkey").alias("consultation_id"),
        (F.col("o_orderkey") % 120).alias("doctor_id"),
        F.col("o_custkey").alias("patient_id"))
    return as_changelog(p, arrival="id")


def ods_prescription_detail(t: Tables) -> DataFrame:
    """Line items as prescription details; ``(order, line)`` repeats, so keys upsert."""
    li = t("lineitem")
    d = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_shipdate").alias("create_time"), F.col("l_shipdate").alias("update_time"),
        F.col("l_quantity").cast("int").alias("count"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("instruction"),
        F.col("l_partkey").alias("medicine_id"),
        F.col("l_orderkey").alias("prescription_id"),
        F.col("l_suppkey").alias("arrival"))
    return as_changelog(d, arrival="arrival")


SOURCES: dict[str, Callable[[Tables], DataFrame]] = {
    "ods_dict": ods_dict,
    "ods_hospital": ods_hospital,
    "ods_doctor": ods_doctor,
    "ods_patient": ods_patient,
    "ods_medicine": ods_medicine,
    "ods_user": ods_user,
    "ods_user_log": ods_user_log,
    "ods_patient_log": ods_patient_log,
    "ods_doctor_log": ods_doctor_log,
    "ods_payment": ods_payment,
    "ods_consultation": ods_consultation,
    "ods_prescription": ods_prescription,
    "ods_prescription_detail": ods_prescription_detail,
}


#: Changes made of every row of a source: number, kind, days by which its version is shifted (None: no
#: version), what its status gains, and of which ids (every n-th).
CHANGES = ((0, "+I", 0, 0, 1), (1, "-U", 0, 0, 3), (2, "+U", 1, 1, 3), (3, "-D", 2, 0, 5), (4, "+U", -1, 2, 4),
           (5, "+U", None, 1, 9))


def changing(source: DataFrame) -> DataFrame:
    """A change log with updates, deletes, late older versions and NULL versions of ``source``'s rows."""
    data = source.drop("rowkind", "arrival")
    changes = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"), F.lit(days).cast("int").alias("days"),
                                 F.lit(gain).alias("gain"), F.lit(every).alias("every"))
                        for n, kind, days, gain, every in CHANGES])
    each = data.withColumn("change", F.explode(changes)).filter(F.col("id") % F.col("change.every") == 0)
    each = (each.withColumn("update_time", F.col("update_time") + F.make_interval(days=F.col("change.days")))
            .withColumn("status", (F.col("status") + F.col("change.gain")).cast("int"))
            .withColumn("rowkind", F.col("change.kind"))
            .withColumn("arrival", F.col("id") * 10 + F.col("change.n")).drop("change"))
    return as_changelog(each, rowkind="rowkind", arrival="arrival")


#: Changes without before-images: number, kind, days by which version and creation are shifted, what the status
#: gains, and of which ids (every n-th). Every third id moves to another day, every fifth is deleted, every
#: seventh moves back, every fourth sends an older version late.
MOVES = ((0, "+I", 0, 0, 0, 1), (1, "+U", 1, 1, 1, 3), (2, "-D", 2, 1, 1, 5), (3, "+U", -1, 3, 2, 4), (4, "+U", 3, 0, 7, 7))


def moving(source: DataFrame) -> DataFrame:
    """A change log without before-images in which rows change their day and their status."""
    changes = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"), F.lit(version).alias("version"),
                                 F.lit(created).alias("created"), F.lit(gain).alias("gain"), F.lit(every).alias("every"))
                        for n, kind, version, created, gain, every in MOVES])
    each = source.drop("rowkind", "arrival").withColumn("change", F.explode(changes))
    each = each.filter(F.col("id") % F.col("change.every") == 0)
    each = (each.withColumn("update_time", F.col("update_time") + F.make_interval(days=F.col("change.version")))
            .withColumn("create_time", F.col("create_time") + F.make_interval(days=F.col("change.created")))
            .withColumn("status", (F.col("status") + F.col("change.gain")).cast("int"))
            .withColumn("rowkind", F.col("change.kind"))
            .withColumn("arrival", F.col("id") * 10 + F.col("change.n")).drop("change"))
    return as_changelog(each, rowkind="rowkind", arrival="arrival")


def doctor_versions(t: Tables) -> DataFrame:
    """Doctors' recorded versions: renamed with -U/+U pairs of one time, deleted, inserted again."""
    s = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    versions = F.array(*[F.struct(F.lit(kind).alias("rowkind"), F.lit(day).cast("timestamp_ntz").alias("version_time"),
                                  F.lit(mark).alias("mark"), F.lit(every).alias("every"))
                         for kind, day, mark, every in DOCTOR_VERSIONS])
    return (s.withColumn("v", F.explode(versions)).filter(F.col("id") % F.col("v.every") == 0)
            .select("id", F.concat("name", "v.mark").alias("name"), "v.rowkind", "v.version_time"))


#: Kind, time, what the name gains, and of which ids (every n-th).
DOCTOR_VERSIONS = (("+I", "1993-01-01 00:00:00", "", 1), ("-U", "1995-06-01 00:00:00", "", 2),
                   ("+U", "1995-06-01 00:00:00", " B", 2), ("-D", "1996-06-01 00:00:00", "", 3),
                   ("+I", "1997-06-01 00:00:00", " C", 6))


def dimension_versions(view: DataFrame) -> DataFrame:
    """Recorded versions of a dimension's rows, at the times and of the ids of ``DOCTOR_VERSIONS``."""
    versions = F.array(*[F.struct(F.lit(kind).alias("rowkind"), F.lit(day).cast("timestamp_ntz").alias("version_time"),
                                  F.lit(mark).alias("mark"), F.lit(every).alias("every"))
                         for kind, day, mark, every in DOCTOR_VERSIONS])
    return (view.withColumn("v", F.explode(versions)).filter(F.col("id").cast("bigint") % F.col("v.every") == 0)
            .withColumn("name", F.concat("name", "v.mark")).select("*", "v.rowkind", "v.version_time").drop("v"))
