"""Keyed upsert into a versioned parquet state table.

Nothing at ``path`` is ever replaced; every folder is written once:

* ``commits/c=<id>/bucket=<n>``: the winning change of each key of one batch;
* ``base/<partition>/c=<id>/bucket=<n>``: compacted buckets of partitions;
* ``log``: one small entry per published version (``NumberedLog``). A ``delta``
  entry names a commit folder and the buckets that it touches in each partition; a
  ``base`` entry names, for every bucket of every partition, the compacted folder in force.

A version exists once its log entry is there, which is the last write of a
commit and appears whole; readers take the newest base entry and the deltas after it and fold
them by key (``latest_by_key``). So a reader sees the version before or after
a commit, never half of one. A writer that dies at any point leaves folders and temporary files that no entry
names, and a replay goes on as if it had not been. A streaming batch is published under its number: if it is replayed
after its entry was written, it changes nothing (T3). One writer per table;
a second one fails on the entry. Entries are read from the newest back to the last base entry, so
a commit reads at most ``COMPACT_EVERY`` of them however old the table is.

A commit costs one shuffle of the batch by key, and tells its days and buckets on the way. Large folds shuffle hashes of
keys, and whole rows only of keys that occur more than once (``fold``); a table of one commit is read as it is. Deleted keys stay as tombstone
rows, because a late, older version must not bring them back; readers use
``live_view``. ``compact`` folds the buckets that deltas have touched since.

The change feed of a table is versioned like the table: the changes of commit n are a folder of
their own, published as entry n of the feed's log. Consumers read published commit
numbers, never a folder's listing (``read_feed``, ``start_table_scan``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from carelake.functions.bucket import bucket_of
from carelake.functions.rowkind import INSERT, is_live
from carelake.operators.changelog import latest_by_key, snapshot_diff
from carelake.session import work_dir
from carelake.sources.specs import ARRIVAL, BUCKET, ROWKIND, TableSpec
from carelake.streaming.files import NumberedLog

#: Deltas after which a commit also compacts. Compaction writes a folder for each partition and bucket
#: that was touched, thousands for a source that spans years, so it is much rarer than commits.
COMPACT_EVERY = 30

#: Bytes of rows from which a fold keeps keys that occur once out of its shuffle, and up to how many keys that
#: occur more than once are broadcast for it.
FOLD_APART, FOLD_SHARED = 16 << 20, 1_000_000
_HASH = "lk_hash"

Places = dict[str, list[int]]  # partition folder -> buckets


def state_schema(spec: TableSpec) -> T.StructType:
    return T.StructType(list(spec.schema.fields) + [
        T.StructField(ROWKIND, T.StringType()),
        T.StructField(ARRIVAL, T.LongType()),
        T.StructField(BUCKET, T.IntegerType()),
    ])


# ------------------------------------------------------------------ versions

@dataclass
class Version:
    """What is published: the base folder of each bucket, and the deltas since."""

    number: int = -1
    base: dict[str, dict[str, str]] = field(default_factory=dict)    # partition folder -> bucket -> compaction id
    deltas: list[tuple[int, str, Places]] = field(default_factory=list)  # number, folder, places; ascending
    upto: int | None = None                              # the last delta that the base holds
    batch: int | None = None                             # last streaming batch
    batch_number: int | None = None                      # the entry that published it


def _log(spark: SparkSession, path: str) -> NumberedLog:
    return NumberedLog(spark, f"{path}/log")


def version(spark: SparkSession, path: str, at: int | None = None) -> Version | None:
    """The newest published version (or that of entry ``at``); None without a table."""
    log = _log(spark, path)
    newest = log.newest()
    if newest < 0:
        return None
    out = Version(number=newest if at is None else min(at, newest))
    number = out.number
    while number >= 0:
        entry = log.read(number)
        if entry.get("batch") is not None and out.batch is None:
            out.batch, out.batch_number = entry["batch"], entry["batch_number"]
        if entry["kind"] == "base":
            out.base, out.upto = entry["base"], entry["upto"]
            break
        out.deltas.insert(0, (number, entry["folder"], entry["places"]))
        number -= 1
    return out


def newest_version(spark: SparkSession, path: str) -> int:
    """The number of the newest published version, -1 without a table."""
    return _log(spark, path).newest()


def commit_keys(spark: SparkSession, spec: TableSpec, path: str, after: int, upto: int) -> DataFrame:
    """Distinct keys of the commits beyond version ``after`` up to ``upto``."""
    log = _log(spark, path)
    entries = [log.read(n) for n in range(after + 1, upto + 1)]
    folders = [e["folder"] for e in entries if e["kind"] == "delta"]
    if not folders:
        return spark.createDataFrame([], state_schema(spec)).select(*spec.pk)
    return _commit_rows(spark, spec, path, folders).select(*spec.pk).distinct()


def _publish(spark: SparkSession, path: str, number: int, entry: dict) -> None:
    _log(spark, path).write(number, entry)


def _escape(value: str) -> str:
    """A partition value as Spark writes it in a folder name."""
    special = '"#%\'*/:=?\\\x7f{[]^'
    return "".join(f"%{ord(c):02X}" if c in special or c < " " else c for c in value)


def _partition_path(spec: TableSpec, row) -> str:
    return "/".join(f"{c}={_escape(str(row[c]))}" for c in spec.partition)


def _partition_range(spec: TableSpec, places: Places) -> dict[str, tuple[str, str]]:
    """The least and the greatest value of each partition column in ``places``: a batch may span years of days."""
    values: dict[str, set[str]] = {c: set() for c in spec.partition}
    for p in places:
        for piece in filter(None, p.split("/")):
            name, _, value = piece.partition("=")
            values[name].add(unquote(value))
    return {c: (min(v), max(v)) for c, v in values.items() if v}


def _version_rows(spark: SparkSession, spec: TableSpec, path: str, v: Version, places: Places | None = None) -> DataFrame:
    """All rows of a version, unfolded; with ``places``, only of those buckets of those partitions.

    Other buckets and partitions are left out by folder, so nothing of them is read.
    """
    schema = state_schema(spec)
    out = None
    wanted = {p: None for p in v.base} if places is None else places
    base = [f"{path}/base/{p + '/' if p else ''}c={c}/{BUCKET}={b}" for p, buckets in wanted.items()
            for b, c in v.base.get(p, {}).items() if buckets is None or int(b) in buckets]
    if base:
        with_id = T.StructType(list(schema.fields) + [T.StructField("c", T.StringType())])
        out = spark.read.schema(with_id).option("basePath", f"{path}/base").parquet(*base).select(*schema.names)
    deltas = [f for _, f, at in v.deltas if places is None or any(set(places.get(p, ())) & set(bs) for p, bs in at.items())]
    if deltas:
        rows = _commit_rows(spark, spec, path, deltas)
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], schema)
    if places is not None:
        out = out.filter(F.col(BUCKET).isin(sorted({b for bs in places.values() for b in bs})))
        for c, (least, most) in _partition_range(spec, places).items():
            out = out.filter(F.col(c).cast("string").between(least, most))
    return out


def _is_folded(spec: TableSpec, v: Version) -> bool:
    """Whether no key can have two rows: there is one commit, or base folders (a key is in one of them) alone."""
    if v.base:
        return not v.deltas and {*spec.partition, spec.bucket_key} <= set(spec.pk)
    return len(v.deltas) <= 1


def _commit_rows(spark: SparkSession, spec: TableSpec, path: str, folders: list[str]) -> DataFrame:
    schema = state_schema(spec)
    with_id = T.StructType(list(schema.fields) + [T.StructField("c", T.StringType())])
    return (spark.read.schema(with_id).option("basePath", f"{path}/commits")
            .parquet(*[f"{path}/commits/c={f}" for f in folders]).select(*schema.names))


def _shared(rows: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Hashes of the keys that more than one row has, for a broadcast; None if there are too many, or rows are few.

    Only hashes are shuffled. Keys that share a hash by chance count as repeated, so a key that is left out occurs once.
    """
    if int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < FOLD_APART:
        return None
    spark = rows.sparkSession
    path, schema = work_dir(spark, "shared"), T.StructType([T.StructField(_HASH, T.LongType())])
    hashes = rows.select(F.xxhash64(*keys).alias(_HASH)).groupBy(_HASH).count()
    hashes.filter("count > 1").select(_HASH).write.parquet(path)
    shared = spark.read.schema(schema).parquet(path)
    return F.broadcast(shared) if shared.count() <= FOLD_SHARED else None


def _with_hash(rows: DataFrame, keys: Sequence[str], shared: DataFrame, how: str) -> DataFrame:
    """Rows whose key hash is (``left_semi``) or is not (``left_anti``) in ``shared``."""
    return rows.withColumn(_HASH, F.xxhash64(*keys)).join(shared, _HASH, how).select(*rows.columns)


def fold(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_by_key`` of stored rows (they are read more than once): those whose key occurs once are not shuffled."""
    shared = _shared(rows, keys)
    if shared is None:
        return latest_by_key(rows, keys, order)
    return _with_hash(rows, keys, shared, "left_anti").unionByName(
        latest_by_key(_with_hash(rows, keys, shared, "left_semi"), keys, order))


def places_of(spec: TableSpec, keys: DataFrame) -> Places:
    """The partitions and buckets of a batch of keys: distinct places, not keys, reach the driver."""
    rows = keys.select(*spec.partition, bucket_of(spec.bucket_key, spec.buckets, spec.bucket_method).alias(BUCKET)).distinct()
    return _as_places([(_partition_path(spec, r), r[BUCKET]) for r in rows.collect()])


def _as_places(pairs) -> Places:
    out: Places = {}
    for p, b in sorted(pairs):
        out.setdefault(p, []).append(b)
    return out


# ------------------------------------------------------------------- reading

def read_state(spark: SparkSession, spec: TableSpec, path: str, *, at: int | None = None,
               keys: DataFrame | None = None) -> DataFrame | None:
    """The current row of every key, tombstones included; None when absent.

    ``at`` reads an older version. With ``keys`` (the key columns), only rows of those keys, and only
    their buckets are read. A key of a table without value partitions may be given by its bucket key alone.
    """
    v = version(spark, path, at)
    if v is None:
        return None
    if keys is None:
        rows = _version_rows(spark, spec, path, v)
        return rows if _is_folded(spec, v) else fold(rows, spec.pk, spec.order)
    on = [c for c in spec.pk if c in keys.columns]
    rows = _version_rows(spark, spec, path, v, places_of(spec, keys)).join(keys.select(*on).distinct(), on, "left_semi")
    return latest_by_key(rows.select(*state_schema(spec).names), spec.pk, spec.order)


def live_view(spark: SparkSession, spec: TableSpec, path: str, *, at: int | None = None,
              keys: DataFrame | None = None) -> DataFrame:
    """Current rows of a state table in the target schema (S3)."""
    state = read_state(spark, spec, path, at=at, keys=keys)
    if state is None:
        return spark.createDataFrame([], spec.schema)
    return state.filter(is_live()).select(*spec.columns)


def create_if_absent(spark: SparkSession, spec: TableSpec, path: str) -> None:
    """``CREATE TABLE IF NOT EXISTS``: an empty table."""
    if version(spark, path) is None:
        _publish(spark, path, 0, {"kind": "base", "base": {}, "upto": None, "batch": None, "batch_number": None})


# ------------------------------------------------------------------- writing

def with_layout(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Target columns + bookkeeping + ``bucket``, in state-table order."""
    out = rows.withColumn(BUCKET, bucket_of(spec.bucket_key, spec.buckets, spec.bucket_method))
    return out.select(*spec.columns, ROWKIND, ARRIVAL, BUCKET)


def upsert(rows: DataFrame, spec: TableSpec, path: str, *, feed_path: str | None = None,
           batch_id: int | None = None, compact_every: int = COMPACT_EVERY, folded: bool = False) -> int:
    """Apply a batch of conformed change rows to the state table at ``path``.

    ``rows`` carry the target columns plus ``rowkind`` and ``arrival``; ``folded``: one row of each key.
    ``batch_id`` is the number of a streaming batch, which ascends: one that is published
    already is not applied again. With ``feed_path``, the changes of the commit are published there
    once the commit is; they are a function of published
    versions, so a replay after a crash in between publishes the same. Returns the number of
    partitions the batch touched.
    """
    spark = rows.sparkSession
    v = version(spark, path) or Version()
    touched: Places = {}
    number = v.batch_number
    if batch_id is None or v.batch is None or batch_id > v.batch:
        folder, seen, number = uuid.uuid4().hex, Observation(), None
        winners = with_layout(rows, spec)
        if not folded:
            winners = latest_by_key(winners, spec.pk, spec.order)
        # Partition values and buckets only (the days of a batch) reach the driver, with the write itself.
        place = F.struct(*spec.layout)
        winners.observe(seen, F.collect_set(place).alias("places")).write.partitionBy(BUCKET).parquet(
            f"{path}/commits/c={folder}")
        touched = _as_places([(_partition_path(spec, r), r[BUCKET]) for r in seen.get["places"]])
        if touched:
            if v.number < 0 and batch_id:  # a stream's later batch: version 0 is the empty table before it
                create_if_absent(spark, spec, path)
                v.number = 0
            number = v.number + 1
            _publish(spark, path, number, {
                "kind": "delta", "folder": folder, "places": touched, "batch": v.batch if batch_id is None else batch_id,
                "batch_number": v.batch_number if batch_id is None else number})
            v.deltas.append((number, folder, touched))
    elif batch_id < v.batch:
        number = None
    if feed_path is not None and number is not None:
        write_feed(spark, spec, path, feed_path, number)
    if touched and len(v.deltas) >= compact_every:
        compact(spark, spec, path)
    return len(touched)


def compact(spark: SparkSession, spec: TableSpec, path: str) -> None:
    """Fold the buckets that deltas touched into new base folders and publish them."""
    v = version(spark, path)
    if v is None or not v.deltas:
        return
    places = _as_places({(p, b) for _, _, at in v.deltas for p, bs in at.items() for b in bs})
    c = uuid.uuid4().hex
    rows = latest_by_key(_version_rows(spark, spec, path, v, places), spec.pk, spec.order)
    # REBALANCE groups rows by folder: a few files each, and AQE splits a large partition.
    (rows.withColumn("c", F.lit(c)).hint("rebalance", *spec.layout)
         .write.mode("append").partitionBy(*spec.partition, "c", BUCKET).parquet(f"{path}/base"))
    base = {p: dict(at) for p, at in v.base.items()}
    for p, buckets in places.items():
        base.setdefault(p, {}).update({str(b): c for b in buckets})
    _publish(spark, path, v.number + 1, {"kind": "base", "base": base, "upto": v.deltas[-1][0],
                                         "batch": v.batch, "batch_number": v.batch_number})


# ---------------------------------------------------------------- change feed

def feed_schema(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField(ROWKIND, T.StringType())] + list(spec.schema.fields)
                        + [T.StructField("batch_id", T.LongType())])


def feed_log(spark: SparkSession, feed_path: str) -> NumberedLog:
    return NumberedLog(spark, f"{feed_path}/log")


def feed_changes(spark: SparkSession, spec: TableSpec, path: str, number: int) -> DataFrame:
    """What commit ``number`` changed: its keys before and after, read from their buckets only."""
    entry = _log(spark, path).read(number)
    batch = _commit_rows(spark, spec, path, [entry["folder"]])
    older = version(spark, path, number - 1) if number else None
    if older is None or not (older.base or older.deltas):
        return _inserts(batch, spec)
    before = _version_rows(spark, spec, path, older, entry["places"])
    # Keys that the table did not have are inserted: only the others' rows are joined.
    shared, fresh = _shared(before.unionByName(batch), spec.pk), None
    if shared is not None:
        fresh = _with_hash(batch, spec.pk, shared, "left_anti")
        before, batch = (_with_hash(rows, spec.pk, shared, "left_semi") for rows in (before, batch))
    old = before.join(batch.select(*spec.pk), list(spec.pk), "left_semi")
    old = latest_by_key(old.select(*state_schema(spec).names), spec.pk, spec.order)
    new = latest_by_key(old.unionByName(batch), spec.pk, spec.order)
    changes = snapshot_diff(old.filter(is_live()).select(*spec.columns), new.filter(is_live()).select(*spec.columns), spec.pk)
    return changes if fresh is None else changes.unionByName(_inserts(fresh, spec).select(*changes.columns))


def _inserts(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return rows.filter(is_live()).select(F.lit(INSERT).alias(ROWKIND), *spec.columns)


def write_feed(spark: SparkSession, spec: TableSpec, path: str, feed_path: str, number: int) -> None:
    """Publish the changes of commit ``number``, unless they are."""
    log = feed_log(spark, feed_path)
    if log.has(number):
        return
    folder = uuid.uuid4().hex
    feed = feed_changes(spark, spec, path, number).withColumn("batch_id", F.lit(number).cast("long"))
    feed.select(*feed_schema(spec).names).write.parquet(f"{feed_path}/changes/{folder}")
    # The table's commit before this one: a consumer finds out if a commit has no feed.
    older = version(spark, path, number - 1) if number else Version()
    log.write(number, {"folder": folder, "after": older.deltas[-1][0] if older.deltas else older.upto})


def read_feed(spark: SparkSession, spec: TableSpec, feed_path: str, *, after: int = -1,
              upto: int | None = None) -> DataFrame:
    """The published change feed of a table: ``rowkind``, the target columns, ``batch_id`` (the commit's number),
    of the commits beyond ``after`` up to ``upto``."""
    log = feed_log(spark, feed_path)
    folders = [log.read(n)["folder"] for n in log.numbers(after) if upto is None or n <= upto]
    if not folders:
        return spark.createDataFrame([], feed_schema(spec))
    return spark.read.schema(feed_schema(spec)).parquet(*[f"{feed_path}/changes/{f}" for f in folders])


def as_changes(feed: DataFrame) -> DataFrame:
    """A feed as a change log: ``arrival`` follows the commits, and in a commit the images after those before."""
    after = F.col(ROWKIND).isin("+I", "+U").cast("long")
    return feed.withColumn(ARRIVAL, F.col("batch_id") * 2 + after).drop("batch_id")
