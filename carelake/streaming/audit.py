"""The audit log of a keyed table (S2): every commit's changes with their row kinds, in commit order.

A table's commits hold the winning change of each key, as it came. What it did to the table depends on what
stood there: the first live row of a key is ``+I``, a later one a ``-U``/``+U`` pair, a tombstone
``-D``, a late older version or a repeated row nothing. ``read_audit_log`` rebuilds this from commits alone, for
tables that keep no feed, and for any range of versions: the state before the range is read from the
buckets of its keys only.

One shuffle by key. A key has at most one row for each commit of the range, so no key's group grows with the facts.
A commit whose folder retention has removed raises.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carelake.functions.rowkind import LIVE_KINDS
from carelake.operators.changelog import _changes, _q, _struct, latest_by_key
from carelake.sources.specs import ROWKIND, TableSpec
from carelake.streaming.files import NumberedLog, make_folder
from carelake.streaming.jobs import COMMIT_INTERVAL
from carelake.streaming.sink import Version, _version_rows, newest_version, state_schema, version

COMMIT = "commit"


def audit_schema(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField(ROWKIND, T.StringType()), *spec.schema.fields, T.StructField(COMMIT, T.LongType())])


def read_audit_log(spark: SparkSession, spec: TableSpec, path: str, *, after: int = -1,
                   upto: int | None = None) -> DataFrame:
    """Changes of the commits beyond version ``after`` up to ``upto``: ``rowkind``, the target columns, ``commit``.

    Compactions change no row and have none here. An empty range or table gives no rows.
    """
    newest = newest_version(spark, path)
    log = NumberedLog(spark, f"{path}/log")
    entries = [(n, log.read(n)) for n in range(after + 1, (newest if upto is None else min(upto, newest)) + 1)]
    commits = [(n, e) for n, e in entries if e["kind"] == "delta"]
    if not commits:
        return spark.createDataFrame([], audit_schema(spec))
    schema = state_schema(spec)
    numbers = spark.createDataFrame([(e["folder"], n) for n, e in commits], f"c STRING, {COMMIT} BIGINT")
    with_id = T.StructType([*schema.fields, T.StructField("c", T.StringType())])
    rows = (spark.read.schema(with_id).option("basePath", f"{path}/commits")
            .parquet(*[f"{path}/commits/c={e['folder']}" for _, e in commits])
            .join(numbers, "c").select(*schema.names, COMMIT))
    if after >= 0:
        places: dict[str, set[int]] = {}
        for _, e in commits:
            for p, buckets in e["places"].items():
                places.setdefault(p, set()).update(buckets)
        old = _version_rows(spark, spec, path, version(spark, path, after) or Version(),
                            {p: sorted(b) for p, b in places.items()})
        old = old.join(rows.select(*spec.pk), list(spec.pk), "left_semi").select(*schema.names)
        rows = rows.unionByName(latest_by_key(old, spec.pk, spec.order).withColumn(COMMIT, F.lit(after).cast("long")))
    return _effects(rows, spec).filter(F.col(COMMIT) > after).select(*audit_schema(spec).names)


def _effects(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """What each commit's row did to its key, by the same winner rule as ``latest_by_key``."""
    keys, order = list(spec.pk), list(spec.order)
    rest = [c for c in state_schema(spec).names if c not in keys and c not in order]
    cols = [c for c in spec.columns if c not in keys]
    by_commit = Window.partitionBy(*[_q(k) for k in keys]).orderBy(COMMIT)
    so_far = by_commit.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kinds = ", ".join(f"'{k}'" for k in LIVE_KINDS)
    image = f"named_struct({', '.join(f'{c!r}, __w.{_q(c)}' for c in cols)})"
    stood = rows.withColumn("__w", F.max(F.expr(_struct(order + rest))).over(so_far))
    stood = stood.selectExpr(*[_q(k) for k in keys], COMMIT, f"CASE WHEN __w.{ROWKIND} IN ({kinds}) THEN {image} END AS __a")
    stood = stood.withColumn("__b", F.lag("__a").over(by_commit))
    return _changes(stood.filter("NOT (__b <=> __a)"), [*keys, COMMIT], cols)


def start_audit_log(spark: SparkSession, spec: TableSpec, path: str, write: Callable[[DataFrame, int], None],
                    checkpoint: str, *, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Follow a table's audit log from its first commit: ``write(changes, batch number)`` gets every commit once.

    The stream is the table's log, whose entries appear whole; a replayed batch has the same commits, so
    ``write`` must be idempotent.
    """
    root = f"{path}/log"
    make_folder(spark, f"{root}/{0:09d}")
    entries = spark.readStream.schema("number BIGINT, kind STRING").json(f"{root}/*")

    def step(batch: DataFrame, batch_id: int) -> None:
        numbers = sorted(r.number for r in batch.filter("kind = 'delta'").collect())
        if numbers:
            changes = read_audit_log(spark, spec, path, after=numbers[0] - 1, upto=numbers[-1])
            write(changes.filter(F.col(COMMIT).isin(numbers)), batch_id)

    return (entries.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": COMMIT_INTERVAL})).start())
