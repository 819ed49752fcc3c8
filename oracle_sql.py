"""DuckDB oracle SQL for every ``queries()`` key (tables registered as views).

Each statement is an independent, plain-SQL statement of the same result:
the source shapes (see ``carelake.plans.standins``), then ``row_number()``
for keyed winners, ``ASOF`` joins for as-of lookups and ``FULL OUTER JOIN``
for change feeds.
"""

# Change log from ``events``: key user_id, sequence ts, arrival event_id.
from carelake.plans import standins

EV = """
SELECT user_id, ts, event_id, event_type, value, props,
       CASE event_type WHEN 'signup' THEN '+I' WHEN 'click' THEN '+U' WHEN 'purchase' THEN '+U'
                       WHEN 'view' THEN '-U' WHEN 'error' THEN '-D' END AS rowkind,
       event_id AS arrival
FROM events
"""

EV_COLS = "user_id, ts, event_id, event_type, value, props"


def _latest(src: str, keys: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY {order}) AS rn FROM ({src})) WHERE rn = 1")


def _live(src: str, keys: str, order: str) -> str:
    return f"SELECT * FROM ({_latest(src, keys, order)}) WHERE rowkind IN ('+I', '+U')"


def _diff(before: str, after: str, keys: list[str], cols: list[str]) -> str:
    """Change feed between two keyed snapshots: +I, -D and -U/+U pairs."""
    on = " AND ".join(f"b.{k} = a.{k}" for k in keys)
    kcols = ", ".join(f"coalesce(b.{k}, a.{k}) AS {k}" for k in keys)
    bcols = ", ".join(f"b.{c} AS b_{c}" for c in cols)
    acols = ", ".join(f"a.{c} AS a_{c}" for c in cols)
    changed = " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in cols)
    k = ", ".join(keys)
    bv = ", ".join(f"b_{c} AS {c}" for c in cols)
    av = ", ".join(f"a_{c} AS {c}" for c in cols)
    return f"""
WITH b AS ({before}), a AS ({after}),
j AS (SELECT {kcols}, b.{keys[0]} IS NOT NULL AS in_b, a.{keys[0]} IS NOT NULL AS in_a, {bcols}, {acols}
      FROM b FULL OUTER JOIN a ON {on}
      WHERE b.{keys[0]} IS NULL OR a.{keys[0]} IS NULL OR {changed})
SELECT '+I' AS rowkind, {k}, {av} FROM j WHERE NOT in_b
UNION ALL SELECT '-D' AS rowkind, {k}, {bv} FROM j WHERE NOT in_a
UNION ALL SELECT '-U' AS rowkind, {k}, {bv} FROM j WHERE in_a AND in_b
UNION ALL SELECT '+U' AS rowkind, {k}, {av} FROM j WHERE in_a AND in_b
"""


EV_ORDER = "ts DESC NULLS LAST, arrival DESC NULLS LAST, event_id DESC, event_type DESC, value DESC, props DESC, rowkind DESC"

DIM_HOSPITAL = """
SELECT CAST(n.n_nationkey AS VARCHAR) AS id, n.n_name AS address, r.r_name AS alias,
       CAST(n.n_nationkey * 10 AS BIGINT) AS bed_num, n.n_name AS city,
       CAST(n.n_regionkey AS BIGINT) AS department_num, r.r_name AS district,
       CAST(DATE '1950-01-01' + CAST(n.n_nationkey * 365 AS INTEGER) AS VARCHAR) AS establish_time,
       CAST(n.n_nationkey * 100 AS BIGINT) AS health_care_num,
       CASE WHEN n.n_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END AS insurance,
       r.r_name AS level, n.n_name AS name, r.r_name AS province
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

DIM_DOCTOR = """
SELECT CAST(s.s_suppkey AS VARCHAR) AS id,
       CAST(DATE '1960-01-01' + CAST(s.s_suppkey % 10000 AS INTEGER) AS VARCHAR) AS birthday,
       CAST(s.s_acctbal AS DECIMAL(19,2)) AS consultation_fee,
       CAST(s.s_nationkey AS VARCHAR) AS gender_code, g.n_name AS gender, s.s_name AS name,
       CAST(CAST(s.s_suppkey % 25 AS INTEGER) AS VARCHAR) AS specialty_code, sp.n_name AS specialty_name,
       CAST(CAST((s.s_suppkey * 7) % 30 AS INTEGER) AS VARCHAR) AS title_code, ti.n_name AS title_name,
       CAST(s.s_nationkey AS VARCHAR) AS hospital_id
FROM supplier s
LEFT JOIN nation g ON s.s_nationkey = g.n_nationkey
LEFT JOIN nation sp ON CAST(s.s_suppkey % 25 AS INTEGER) = sp.n_nationkey
LEFT JOIN nation ti ON CAST((s.s_suppkey * 7) % 30 AS INTEGER) = ti.n_nationkey
"""

DIM_PATIENT = """
SELECT CAST(c.c_custkey AS VARCHAR) AS id,
       CAST(DATE '1960-01-01' + CAST(c.c_custkey % 10000 AS INTEGER) AS VARCHAR) AS birthday,
       CAST(c.c_nationkey AS VARCHAR) AS gender_code, g.n_name AS gender_name, c.c_name AS name,
       CAST(c.c_custkey AS VARCHAR) AS user_id
FROM customer c LEFT JOIN nation g ON c.c_nationkey = g.n_nationkey
"""

DIM_MEDICINE = """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS approval_code, p_type AS dose_type,
       p_name AS name, upper(p_name) AS name_en, CAST(p_retailprice AS DECIMAL(19,2)) AS price,
       CAST(p_size AS VARCHAR) AS specs, p_brand AS trade_name
FROM part
"""

DIM_USER = """
SELECT CAST(c_custkey AS VARCHAR) AS id, lower(c_name) || '@example.com' AS email,
       c_mktsegment AS telephone, c_name AS username
FROM customer
"""

FACT_ORDER = "update_time DESC NULLS LAST, arrival DESC NULLS LAST"

USER_REGISTER = f"""
SELECT id, create_time, update_time, email, telephone, username, dt FROM ({_latest('''
  SELECT CAST(e.user_id AS VARCHAR) AS id, e.ts AS create_time, e.ts AS update_time,
         lower(c.c_name) || '@example.com' AS email, c.c_mktsegment AS telephone,
         c.c_name AS username, strftime(e.ts, '%Y-%m-%d') AS dt, e.event_id AS arrival
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
  WHERE e.event_type = 'signup' ''', 'dt, id', FACT_ORDER)})
"""

DOCTOR_REGISTER = f"""
SELECT r.id, r.create_time, r.update_time, r.birthday, r.consultation_fee,
       CAST(r.gender AS VARCHAR) AS gender_code, g.n_name AS gender_name, r.name,
       CAST(r.specialty AS VARCHAR) AS specialty_code, sp.n_name AS specialty_name,
       CAST(r.title AS VARCHAR) AS title_code, ti.n_name AS title_name,
       r.hospital_id, r.dt
FROM ({_latest('''
  SELECT CAST(e.user_id AS VARCHAR) AS id, e.ts AS create_time, e.ts AS update_time,
         CAST(DATE '1960-01-01' + CAST(s.s_suppkey % 10000 AS INTEGER) AS VARCHAR) AS birthday,
         CAST(s.s_acctbal AS DECIMAL(19,2)) AS consultation_fee, s.s_nationkey AS gender,
         s.s_name AS name, CAST(e.user_id % 25 AS INTEGER) AS specialty,
         CAST((e.user_id * 7) % 30 AS INTEGER) AS title,
         CAST(s.s_nationkey AS VARCHAR) AS hospital_id, strftime(e.ts, '%Y-%m-%d') AS dt,
         e.event_id AS arrival
  FROM events e LEFT JOIN supplier s ON e.user_id = s.s_suppkey
  WHERE e.event_type = 'signup' ''', 'dt, id', FACT_ORDER)}) r
LEFT JOIN nation g ON r.gender = g.n_nationkey
LEFT JOIN nation sp ON r.specialty = sp.n_nationkey
LEFT JOIN nation ti ON r.title = ti.n_nationkey
"""

PATIENT_REGISTER = f"""
SELECT r.id, r.create_time, r.update_time, r.birthday, CAST(r.gender AS VARCHAR) AS gender_code,
       g.n_name AS gender_name, r.name, r.user_id, r.dt
FROM ({_latest('''
  SELECT CAST(e.user_id AS VARCHAR) AS id, e.ts AS create_time, e.ts AS update_time,
         CAST(DATE '1960-01-01' + CAST(c.c_custkey % 10000 AS INTEGER) AS VARCHAR) AS birthday,
         c.c_nationkey AS gender, c.c_name AS name, CAST(c.c_custkey AS VARCHAR) AS user_id,
         strftime(e.ts, '%Y-%m-%d') AS dt, e.event_id AS arrival
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
  WHERE e.event_type = 'signup' ''', 'dt, id', FACT_ORDER)}) r
LEFT JOIN nation g ON r.gender = g.n_nationkey
"""

PAYMENT = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS create_time, o_orderdate AS update_time,
       CAST(o_totalprice AS DECIMAL(19,2)) AS payment_amount,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 203 ELSE 202 END AS SMALLINT) AS status,
       CAST(o_orderkey AS VARCHAR) AS consultation_id, CAST(o_orderkey AS VARCHAR) AS prescription_id,
       CAST(o_custkey AS VARCHAR) AS user_id, strftime(o_orderdate, '%Y-%m-%d') AS dt
FROM orders
"""

REVIEW = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS create_time, o_orderdate AS update_time,
       CAST(o_custkey % 5 + 1 AS TINYINT) AS rating, o_orderpriority AS review,
       CAST(o_orderkey % 120 AS VARCHAR) AS doctor_id, CAST(o_custkey AS VARCHAR) AS patient_id,
       CAST(o_custkey AS VARCHAR) AS user_id, strftime(o_orderdate, '%Y-%m-%d') AS dt
FROM orders WHERE o_orderkey % 7 + 201 = 207
"""

DETAIL_ROWS = """
SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id, l_shipdate AS create_time,
       l_shipdate AS update_time, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS count,
       l_returnflag || l_linestatus AS instruction, CAST(l_partkey AS VARCHAR) AS medicine_id,
       CAST(l_orderkey AS VARCHAR) AS prescription_id, strftime(l_shipdate, '%Y-%m-%d') AS dt,
       '+I' AS rowkind, l_suppkey AS arrival
FROM lineitem
"""
DETAIL_ORDER = ("update_time DESC NULLS LAST, arrival DESC NULLS LAST, create_time DESC NULLS LAST, "
                "count DESC NULLS LAST, instruction DESC NULLS LAST, medicine_id DESC NULLS LAST, "
                "prescription_id DESC NULLS LAST, rowkind DESC NULLS LAST")

PRESCRIPTION_DETAIL = f"""
SELECT r.id, r.create_time, r.update_time, r.count, r.instruction, r.medicine_id,
       m.approval_code, m.name, m.name_en, m.price, m.specs, m.trade_name, r.prescription_id, r.dt
FROM ({_latest(DETAIL_ROWS, 'dt, id', DETAIL_ORDER)}) r
LEFT JOIN ({DIM_MEDICINE}) m ON r.medicine_id = m.id
"""

DOCTOR_HOSPITAL_PATIENT_COLS = """
       CAST(o.o_orderkey % 120 AS VARCHAR) AS doctor_id, d.name AS doctor_name,
       d.birthday AS doctor_birthday, d.gender_code AS doctor_gender_code,
       d.gender AS doctor_gender_name, d.specialty_code AS doctor_specialty_code,
       d.specialty_name AS doctor_specialty_name, d.title_code AS doctor_title_code,
       d.title_name AS doctor_title_name, d.hospital_id AS hospital_id,
       h.name AS hospital_name, h.establish_time AS hospital_establish_time,
       h.level AS hospital_level, h.province AS hospital_province, h.city AS hospital_city,
       h.district AS hospital_district,
       CAST(o.o_custkey AS VARCHAR) AS patient_id, p.name AS patient_name,
       p.birthday AS patient_birthday, p.gender_code AS patient_gender_code,
       p.gender_name AS patient_gender_name"""

DOCTOR_HOSPITAL_PATIENT_JOINS = f"""
LEFT JOIN ({DIM_DOCTOR}) d ON CAST(o.o_orderkey % 120 AS VARCHAR) = d.id
LEFT JOIN ({DIM_HOSPITAL}) h ON d.hospital_id = h.id
LEFT JOIN ({DIM_PATIENT}) p ON CAST(o.o_custkey AS VARCHAR) = p.id"""

PRESCRIPTION = f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, o.o_orderdate AS create_time, o.o_orderdate AS update_time,
       o.o_orderpriority AS instruction,
       CAST(CASE WHEN o.o_orderstatus = 'F' THEN 203 ELSE 202 END AS SMALLINT) AS status,
       CAST(o.o_totalprice AS DECIMAL(19,2)) AS total_amount,
       CAST(o.o_orderkey AS VARCHAR) AS consultation_id,
       {DOCTOR_HOSPITAL_PATIENT_COLS},
       strftime(o.o_orderdate, '%Y-%m-%d') AS dt, CAST(hour(o.o_orderdate) AS BIGINT) AS hour,
       CAST(minute(o.o_orderdate) AS BIGINT) AS minute
FROM orders o {DOCTOR_HOSPITAL_PATIENT_JOINS}
"""

CONSULTATION = f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, o.o_orderdate AS create_time, o.o_orderdate AS update_time,
       CAST(o.o_totalprice AS DECIMAL(19,2)) AS consultation_fee,
       o.o_orderpriority AS description, o.o_orderstatus AS diagnosis,
       CAST(o.o_custkey % 5 + 1 AS TINYINT) AS rating, o.o_orderpriority AS review,
       CAST(o.o_orderkey % 7 + 201 AS SMALLINT) AS status,
       {DOCTOR_HOSPITAL_PATIENT_COLS},
       CAST(o.o_custkey AS VARCHAR) AS user_id,
       strftime(o.o_orderdate, '%Y-%m-%d') AS dt, CAST(hour(o.o_orderdate) AS BIGINT) AS hour,
       CAST(minute(o.o_orderdate) AS BIGINT) AS minute
FROM orders o {DOCTOR_HOSPITAL_PATIENT_JOINS}
"""

PURCHASES = "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'"
SIGNUPS = "SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'signup'"

LOOKUP_ASOF = f"""
SELECT p.event_id, p.user_id, p.ts, p.value, s.event_id AS signup_event_id, s.ts AS signup_ts,
       s.value AS signup_value
FROM ({PURCHASES}) p ASOF LEFT JOIN ({SIGNUPS}) s ON p.user_id = s.user_id AND p.ts >= s.ts
"""

WAIT_SECONDS = 86400

LOOKUP_ASOF_WAIT = f"""
WITH p AS ({PURCHASES}), s AS ({SIGNUPS}),
prev AS (SELECT p.event_id, s.event_id AS se, s.ts AS st, s.value AS sv
         FROM p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.ts >= s.ts),
nxt AS (SELECT p.event_id, s.event_id AS se, s.ts AS st, s.value AS sv
        FROM p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.ts < s.ts)
SELECT p.event_id, p.user_id, p.ts, p.value,
       CASE WHEN prev.se IS NOT NULL THEN prev.se
            WHEN nxt.st <= p.ts + INTERVAL {WAIT_SECONDS} SECOND THEN nxt.se END AS signup_event_id,
       CASE WHEN prev.se IS NOT NULL THEN prev.st
            WHEN nxt.st <= p.ts + INTERVAL {WAIT_SECONDS} SECOND THEN nxt.st END AS signup_ts,
       CASE WHEN prev.se IS NOT NULL THEN prev.sv
            WHEN nxt.st <= p.ts + INTERVAL {WAIT_SECONDS} SECOND THEN nxt.sv END AS signup_value
FROM p JOIN prev ON p.event_id = prev.event_id JOIN nxt ON p.event_id = nxt.event_id
"""

SNAPSHOT_CUT = "2024-01-15 00:00:00"

_EV_LIVE_ALL = _live(EV, "user_id", EV_ORDER)
_EV_LIVE_CUT = _live(f"SELECT * FROM ({EV}) WHERE ts < TIMESTAMP '{SNAPSHOT_CUT}'", "user_id", EV_ORDER)

SNAPSHOT_DIFF = f"""
WITH b AS ({_EV_LIVE_CUT}), a AS ({_EV_LIVE_ALL}),
j AS (
  SELECT coalesce(b.user_id, a.user_id) AS user_id, b.user_id AS b_key, a.user_id AS a_key,
         b.ts AS b_ts, b.event_id AS b_event_id, b.event_type AS b_event_type, b.value AS b_value, b.props AS b_props,
         a.ts AS a_ts, a.event_id AS a_event_id, a.event_type AS a_event_type, a.value AS a_value, a.props AS a_props
  FROM b FULL OUTER JOIN a ON b.user_id = a.user_id
  WHERE b.ts IS DISTINCT FROM a.ts OR b.event_id IS DISTINCT FROM a.event_id
     OR b.event_type IS DISTINCT FROM a.event_type OR b.value IS DISTINCT FROM a.value
     OR b.props IS DISTINCT FROM a.props OR b.user_id IS NULL OR a.user_id IS NULL)
SELECT '+I' AS rowkind, user_id, a_ts AS ts, a_event_id AS event_id, a_event_type AS event_type, a_value AS value, a_props AS props FROM j WHERE b_key IS NULL
UNION ALL
SELECT '-D', user_id, b_ts, b_event_id, b_event_type, b_value, b_props FROM j WHERE a_key IS NULL
UNION ALL
SELECT '-U', user_id, b_ts, b_event_id, b_event_type, b_value, b_props FROM j WHERE a_key IS NOT NULL AND b_key IS NOT NULL
UNION ALL
SELECT '+U', user_id, a_ts, a_event_id, a_event_type, a_value, a_props FROM j WHERE a_key IS NOT NULL AND b_key IS NOT NULL
"""

EV_DT = f"SELECT *, strftime(ts, '%Y-%m-%d') AS dt FROM ({EV})"
EV_DT_ORDER = "ts DESC NULLS LAST, arrival DESC NULLS LAST"

_EV_DT_LIVE_ALL = _live(EV_DT, "dt, user_id", EV_DT_ORDER)
_EV_DT_LIVE_AM = _live(f"SELECT * FROM ({EV_DT}) WHERE hour(ts) < 12", "dt, user_id", EV_DT_ORDER)
_EV_VALUE_COLS = ["ts", "event_id", "event_type", "value", "props"]

STREAM_CHANGE_FEED = _diff(f"SELECT dt, {EV_COLS} FROM ({_EV_DT_LIVE_AM})",
                           f"SELECT dt, {EV_COLS} FROM ({_EV_DT_LIVE_ALL})",
                           ["dt", "user_id"], _EV_VALUE_COLS)

STREAM_LOOKUP_WAIT = f"""
SELECT p.event_id, p.user_id, p.ts, p.value, s.event_id AS signup_event_id, s.ts AS signup_ts,
       s.value AS signup_value
FROM ({PURCHASES}) p
LEFT JOIN ({_latest(SIGNUPS, 'user_id', 'event_id DESC')}) s ON p.user_id = s.user_id
"""

def _values(rows) -> str:
    text = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)


def _changing(status: str) -> str:
    """``orders`` as the live winners of its changes: o_ columns, ``upd`` and ``st``."""
    changes = f"""
      SELECT o.*, rowkind, CAST(o_orderdate AS TIMESTAMP) + days * INTERVAL 1 DAY AS upd, {status} + gain AS st, o_orderkey * 10 + n AS arrival
      FROM orders o, (VALUES {_values(standins.CHANGES)}) c(n, rowkind, days, gain, every) WHERE o_orderkey % every = 0"""
    return _live(changes, "o_orderkey", "upd DESC NULLS LAST, arrival DESC")


_CHANGED_PAYMENTS = _changing("CASE WHEN o_orderstatus = 'F' THEN 203 ELSE 202 END")
_CHANGED_CONSULTATIONS = _changing("(o_orderkey % 7 + 201)")

CHANGING_PAYMENT = (PAYMENT.replace("o_orderdate AS update_time", "upd AS update_time")
                    .replace("CASE WHEN o_orderstatus = 'F' THEN 203 ELSE 202 END", "st")
                    .replace("FROM orders", f"FROM ({_CHANGED_PAYMENTS})"))
CHANGING_REVIEW = (REVIEW.replace("o_orderdate AS update_time", "upd AS update_time")
                   .replace("FROM orders WHERE o_orderkey % 7 + 201 = 207", f"FROM ({_CHANGED_CONSULTATIONS}) WHERE st = 207"))



def _moved(status: str) -> str:
    """``orders`` as the live winners of its moves, by id alone: o_ columns, ``upd``, ``created`` and ``st``."""
    changes = f"""
      SELECT o.*, rowkind, CAST(o_orderdate AS TIMESTAMP) + version * INTERVAL 1 DAY AS upd,
             CAST(o_orderdate AS TIMESTAMP) + shift * INTERVAL 1 DAY AS created, {status} + gain AS st, o_orderkey * 10 + n AS arrival
      FROM orders o, (VALUES {_values(standins.MOVES)}) c(n, rowkind, version, shift, gain, every) WHERE o_orderkey % every = 0"""
    return _live(changes, "o_orderkey", "upd DESC NULLS LAST, arrival DESC")


def _of_moved(sql: str) -> str:
    return (sql.replace("o_orderdate AS create_time", "created AS create_time").replace("o_orderdate AS update_time", "upd AS update_time")
            .replace("strftime(o_orderdate", "strftime(created"))


MOVED_DAY_UPSERT = (_of_moved(PAYMENT).replace("CASE WHEN o_orderstatus = 'F' THEN 203 ELSE 202 END", "st")
                    .replace("FROM orders", "FROM (" + _moved("CASE WHEN o_orderstatus = 'F' THEN 203 ELSE 202 END") + ")"))
NORMALISED_REVIEW = _of_moved(REVIEW).replace("FROM orders WHERE o_orderkey % 7 + 201 = 207",
                                              "FROM (" + _moved("(o_orderkey % 7 + 201)") + ") WHERE st = 207")

LOOKUP_ASOF_CHANGES = f"""
WITH v AS (SELECT s_suppkey AS id, s_name || mark AS name, rowkind, CAST(t AS TIMESTAMP) AS t
           FROM supplier, (VALUES {_values(standins.DOCTOR_VERSIONS)}) c(rowkind, t, mark, every)
           WHERE s_suppkey % every = 0 AND rowkind <> '-U')
SELECT o_orderkey, CASE WHEN v.rowkind <> '-D' THEN v.name END AS doctor_name
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 120 END AS k, CAST(o_orderdate AS TIMESTAMP) AS at FROM orders) f
ASOF LEFT JOIN v ON f.k = v.id AND f.at >= v.t
"""



def _versions_of(dim: str, cols: str) -> str:
    """Versions of a dimension; a before-image is followed by its after-image of the same time."""
    return f"""SELECT id, {cols}, name || mark AS name, rowkind, CAST(t AS TIMESTAMP) AS t
               FROM ({dim}) d, (VALUES {_values(standins.DOCTOR_VERSIONS)}) c(rowkind, t, mark, every)
               WHERE CAST(id AS BIGINT) % every = 0 AND rowkind <> '-U'"""


BACKFILL_CONSULTATION = f"""
WITH dv AS ({_versions_of(DIM_DOCTOR, "hospital_id")}), hv AS ({_versions_of(DIM_HOSPITAL, "1 AS one")}),
pv AS ({_versions_of(DIM_PATIENT, "1 AS one")}),
f AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') AS dt, CAST(o_orderkey % 120 AS VARCHAR) AS doctor_id,
             CAST(o_custkey AS VARCHAR) AS patient_id, CAST(o_orderdate AS TIMESTAMP) AS at FROM orders),
a AS (SELECT f.*, CASE WHEN dv.rowkind <> '-D' THEN dv.name END AS doctor_name, CASE WHEN dv.rowkind <> '-D' THEN dv.hospital_id END AS hospital_id
      FROM f ASOF LEFT JOIN dv ON f.doctor_id = dv.id AND f.at >= dv.t),
b AS (SELECT a.*, CASE WHEN hv.rowkind <> '-D' THEN hv.name END AS hospital_name
      FROM a ASOF LEFT JOIN hv ON a.hospital_id = hv.id AND a.at >= hv.t)
SELECT b.id, dt, doctor_name, hospital_id, hospital_name, CASE WHEN pv.rowkind <> '-D' THEN pv.name END AS patient_name
FROM b ASOF LEFT JOIN pv ON b.patient_id = pv.id AND b.at >= pv.t
"""

REJECT_ROWS = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey % 4 = 0 AS rejected FROM orders
"""

REJECT_REASONS = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS reason
FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 10 <> 0 AND o_orderkey % 4 <> 0
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'status', '40000', 'not smallint' FROM orders WHERE o_orderkey % 9 = 0
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'rating', '300', 'not tinyint' FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'create_time', NULL, 'null' FROM orders WHERE o_orderkey % 4 = 0
"""

BUCKET_HASH = """
SELECT count(*) AS n_keys, CAST(0 AS BIGINT) AS out_of_range, CAST(0 AS BIGINT) AS in_two_buckets FROM customer
"""

DOCTOR_PREVIEW = """
SELECT e.user_id AS id, e.ts AS create_time, s.s_name AS name, true AS one_time
FROM events e LEFT JOIN supplier s ON e.user_id = s.s_suppkey WHERE e.event_type = 'signup'
"""

# Even doctors first, every fourth renamed before the scan begins; then odd ones, every third deleted, every
# fifth renamed. ``commits``: 3 for the snapshot of version 1, then twice the commit's number + 1.
TABLE_SCAN_HANDOVER = f"""
SELECT id, CASE WHEN n % 5 = 0 OR n % 4 = 0 THEN name || ' B' ELSE name END AS name, title_code,
       CAST(CASE WHEN n % 5 = 0 AND NOT (n % 4 = 0 AND n % 3 <> 0) THEN 9 WHEN n % 2 = 0 THEN 3 ELSE 5 END AS BIGINT) AS commits
FROM (SELECT *, CAST(id AS BIGINT) AS n FROM ({DIM_DOCTOR}))
WHERE n % 3 <> 0 OR n % 5 = 0"""


def _feed_commit(n: int) -> str:
    """Changes by the n-th third of the events, by event_id."""
    def upto(k):
        live = _live(f"SELECT * FROM ({EV_DT}) WHERE event_id % 3 <= {k}", "dt, user_id", EV_DT_ORDER)
        return f"SELECT dt, {EV_COLS} FROM ({live})"
    diff = _diff(upto(n - 1), upto(n), ["dt", "user_id"], ["ts", "event_id", "event_type", "value", "props"])
    return f"SELECT *, CAST({n} AS BIGINT) AS feed_batch FROM ({diff})"


# Four commits by event_id; a compaction after every second one takes a number of its own.
# A window tells the winner of each key after each commit, without the joins of snapshots above.
AUDIT_LOG_TABLE = f"""
WITH firsts AS (SELECT *, event_id % 4 AS n FROM ({EV_DT})),
batch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dt, user_id, n ORDER BY {EV_DT_ORDER}) AS rn FROM firsts) WHERE rn = 1),
best AS (SELECT n, dt, user_id, max((ts, event_id)) OVER (PARTITION BY dt, user_id ORDER BY n) AS w FROM batch),
stood AS (SELECT b.n, b.dt, b.user_id, e.rowkind IN ('+I', '+U') AS live, e.ts, e.event_id, e.event_type, e.value, e.props
          FROM best b JOIN batch e ON e.dt = b.dt AND e.user_id = b.user_id AND (e.ts, e.event_id) = b.w),
pairs AS (SELECT n, dt, user_id, CASE WHEN live THEN (ts, event_id, event_type, value, props) END AS a,
                 CASE WHEN lag(live) OVER k THEN lag((ts, event_id, event_type, value, props)) OVER k END AS b
          FROM stood WINDOW k AS (PARTITION BY dt, user_id ORDER BY n)),
moved AS (SELECT * FROM pairs WHERE a IS DISTINCT FROM b),
images AS (SELECT n, dt, user_id, CASE WHEN b IS NULL THEN '+I' ELSE '+U' END AS rowkind, a AS v FROM moved WHERE a IS NOT NULL
           UNION ALL
           SELECT n, dt, user_id, CASE WHEN a IS NULL THEN '-D' ELSE '-U' END, b FROM moved WHERE b IS NOT NULL)
SELECT rowkind, dt, user_id, v[1] AS ts, v[2] AS event_id, v[3] AS event_type, v[4] AS value, v[5] AS props,
       CAST(n + CAST(floor(n / 2) AS BIGINT) AS BIGINT) AS "commit" FROM images
"""

FEED_CONSUMER_REPLAY = " UNION ALL ".join(_feed_commit(n) for n in range(3))

ORACLE: dict[str, str] = {
    "conform_cast": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(p_size AS SMALLINT) AS size_small,
               CAST(p_size AS TINYINT) AS size_tiny, CAST(p_retailprice AS DECIMAL(19,2)) AS price
        FROM part""",
    "positional_conform": """
        SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS hospital_id,
               CAST(s_acctbal AS DECIMAL(19,2)) AS consultation_fee
        FROM supplier""",
    "time_parts": """
        SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS dt, CAST(hour(ts) AS BIGINT) AS hour,
               CAST(minute(ts) AS BIGINT) AS minute
        FROM events""",
    "status_filter": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS create_time,
               CAST(o_orderkey % 7 + 201 AS SMALLINT) AS status, CAST(o_custkey % 5 + 1 AS TINYINT) AS rating
        FROM orders WHERE o_orderkey % 7 + 201 = 207""",
    "inserts_only": f"SELECT {EV_COLS}, arrival FROM ({EV}) WHERE rowkind = '+I'",
    "dedupe_last_arrival": _latest(EV, "user_id", "arrival DESC"),
    "dedupe_by_sequence": _latest(
        "SELECT * FROM lineitem", "l_orderkey, l_linenumber",
        "l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, "
        "l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, "
        "l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST"),
    "materialize_changelog": f"SELECT {EV_COLS} FROM ({_EV_LIVE_ALL})",
    "filter_changelog": f"SELECT {EV_COLS} FROM ({_EV_LIVE_ALL}) WHERE value > 20",
    "out_of_order_upsert": f"SELECT {EV_COLS}, rowkind FROM ({_latest(EV, 'user_id', 'ts DESC')})",
    "partitioned_upsert": f"SELECT dt, {EV_COLS} FROM ({_live(EV_DT, 'dt, user_id', EV_DT_ORDER)})",
    "bucket_layout": """
        SELECT CAST(c_custkey % 4 AS INTEGER) AS bucket, count(*) AS n_rows FROM customer GROUP BY 1""",
    "snapshot_diff": SNAPSHOT_DIFF,
    "lookup_join": """
        SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "decode_codes": """
        SELECT s.s_suppkey AS id, s.s_nationkey AS gender, g.n_name AS gender_name,
               s.s_suppkey % 25 AS specialty, sp.n_name AS specialty_name,
               (s.s_suppkey * 7) % 30 AS title, ti.n_name AS title_name
        FROM supplier s
        LEFT JOIN nation g ON s.s_nationkey = g.n_nationkey
        LEFT JOIN nation sp ON s.s_suppkey % 25 = sp.n_nationkey
        LEFT JOIN nation ti ON (s.s_suppkey * 7) % 30 = ti.n_nationkey""",
    "lookup_chain": f"""
        SELECT CAST(o.o_orderkey AS VARCHAR) AS id, {DOCTOR_HOSPITAL_PATIENT_COLS}
        FROM orders o {DOCTOR_HOSPITAL_PATIENT_JOINS}""",
    "lookup_asof": LOOKUP_ASOF,
    "lookup_asof_wait": LOOKUP_ASOF_WAIT,
    "dim_hospital": DIM_HOSPITAL,
    "dim_doctor": DIM_DOCTOR,
    "dim_patient": DIM_PATIENT,
    "dim_medicine": DIM_MEDICINE,
    "dim_user": DIM_USER,
    "dwd_user_register": USER_REGISTER,
    "dwd_doctor_register": DOCTOR_REGISTER,
    "dwd_patient_register": PATIENT_REGISTER,
    "dwd_payment": PAYMENT,
    "dwd_review": REVIEW,
    "dwd_prescription_detail": PRESCRIPTION_DETAIL,
    "dwd_prescription": PRESCRIPTION,
    "dwd_consultation": CONSULTATION,
    "stream_upsert": PATIENT_REGISTER,
    "stream_change_feed": STREAM_CHANGE_FEED,
    "stream_lookup_wait": STREAM_LOOKUP_WAIT,
    "changing_payment": CHANGING_PAYMENT,
    "changing_review": CHANGING_REVIEW,
    "stream_changing_payment": CHANGING_PAYMENT,
    "stream_changing_review": CHANGING_REVIEW,
    "stream_dim_doctor": DIM_DOCTOR,
    "stream_dwd_prescription_detail": PRESCRIPTION_DETAIL,
    "stream_consultation_wait": CONSULTATION,
    "moved_day_upsert": MOVED_DAY_UPSERT,
    "normalised_review": NORMALISED_REVIEW,
    "replay_upsert": f"SELECT dt, {EV_COLS} FROM ({_live(EV_DT, 'dt, user_id', EV_DT_ORDER)})",
    "replay_change_feed": STREAM_CHANGE_FEED,
    "table_scan_handover": TABLE_SCAN_HANDOVER,
    "feed_consumer_replay": FEED_CONSUMER_REPLAY,
    "audit_log_table": AUDIT_LOG_TABLE,
    "rebuild_table": f"SELECT dt, {EV_COLS} FROM ({_live(EV_DT, 'dt, user_id', EV_DT_ORDER)})",
    "lookup_asof_changes": LOOKUP_ASOF_CHANGES,
    "backfill_consultation": BACKFILL_CONSULTATION,
    "reject_rows": REJECT_ROWS,
    "reject_reasons": REJECT_REASONS,
    "bucket_hash": BUCKET_HASH,
    "doctor_preview": DOCTOR_PREVIEW,
}
