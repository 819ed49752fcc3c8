"""Run a warehouse job as a Structured Streaming query.

The source is any append stream of change rows (a folder of change-log
files, a message bus). Every micro-batch goes through ``foreachBatch``:

1. split off rows with a NULL key or a value that its target's type does not take
   into the rejects folder, with reasons (R13, R15), and ``prepare`` the others (casts, filters, ``dt``);
2. re-read each lookup's current state (a static DataFrame captured once
   would stay frozen), and ``enrich``: processing-time lookups (J1, R7);
3. ``upsert`` into the state table, then the batch's change feed, if asked for.

Progress (source offsets) lives in the query's checkpoint, so a restarted
query resumes where it stopped. A replayed batch that is published already
changes nothing, its feed is written if it is missing, and its rejects are
the same rows under the same name (T3, T4).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carelake.plans.warehouse import Job, checked_rows
from carelake.sources.specs import TableSpec
from carelake.operators.changelog import compact_feed, latest_by_key
from carelake.streaming.files import NumberedLog, make_folder
from carelake.streaming.normalise import normalise, source_spec
from carelake.streaming.sink import commit_keys, feed_log, feed_schema, fold, live_view, newest_version, upsert

# The commit cadence of the jobs and of the change feed.
COMMIT_INTERVAL = "20 seconds"
FEED_INTERVAL = "1 minute"

LookupReader = Callable[[], DataFrame]


class StateLookup:
    """Reads the live rows of a state table when called (S3): as they stand then, or of one published version."""

    def __init__(self, spark: SparkSession, spec: TableSpec, path: str):
        self.spark, self.spec, self.path = spark, spec, path

    def __call__(self, at: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        return live_view(self.spark, self.spec, self.path, at=at, keys=keys)

    def number(self) -> int:
        """The newest published version, -1 without one."""
        return newest_version(self.spark, self.path)

    def changed_keys(self, after: int, upto: int) -> DataFrame:
        """Keys in the commits beyond ``after`` up to ``upto``; only those commits are read."""
        return commit_keys(self.spark, self.spec, self.path, after, upto)


def state_lookup(spark: SparkSession, spec: TableSpec, path: str) -> StateLookup:
    """A lookup that reads the live rows of a state table when called (S3)."""
    return StateLookup(spark, spec, path)


def batch_writer(job: Job, state_path: str, lookups: Mapping[str, LookupReader], *,
                 feed_path: str | None = None, reject_path: str | None = None):
    """The ``foreachBatch`` function of ``job``; a source without before-images is normalised beside the state."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            changes = batch
            if not job.spec.before_images:
                changes = normalise(batch, source_spec(job, batch), f"{state_path}_source", batch_id)
            rows, rejects = checked_rows(job, changes)

            # Published versions only, as of this batch; their files are never replaced.
            views = {name: lookups[name]() for name in job.lookups}
            # One row of each key is looked up, as in batch: the lookups' columns are not shuffled by key.
            pick = fold if job.spec.before_images else latest_by_key
            upsert(job.enrich(pick(rows, job.spec.pk, job.spec.order), **views), job.spec, state_path,
                   feed_path=feed_path, batch_id=batch_id, folded=True)
            # rejects are rare: a cheap emptiness check on the cached batch
            # saves a write and its commit on almost every batch
            if not rejects.isEmpty():
                rejects.write.mode("overwrite").parquet(
                    f"{reject_path or state_path + '_rejects'}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def start_job(job: Job, source: DataFrame, state_path: str, checkpoint: str,
              lookups: Mapping[str, LookupReader] | None = None, *,
              feed_path: str | None = None, reject_path: str | None = None,
              trigger: Mapping[str, object] | None = None,
              query_name: str | None = None) -> StreamingQuery:
    """Start ``job`` on the streaming change log ``source``.

    ``trigger`` defaults to the 20-second commit cadence; pass
    ``{"availableNow": True}`` to catch up and stop. One checkpoint folder
    per job. Rows that do not fit (``checked_rows``) go to ``reject_path``, or
    beside the state table (``<state_path>_rejects``).
    """
    lookups = dict(lookups or {})
    missing = [n for n in job.lookups if n not in lookups]
    if missing:
        raise ValueError(f"{job.name}: no reader for lookups {missing}")
    writer = (source.writeStream
              .foreachBatch(batch_writer(job, state_path, lookups, feed_path=feed_path,
                                         reject_path=reject_path))
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"processingTime": COMMIT_INTERVAL})))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def _feed_stream(spark: SparkSession, feed_path: str) -> DataFrame:
    """Published entries of a feed's log as a stream: an entry appears whole, after its changes are written."""
    log = feed_log(spark, feed_path)
    make_folder(spark, f"{log.root}/{0:09d}")
    return spark.readStream.schema("number BIGINT, folder STRING, after BIGINT").json(f"{log.root}/*")


def _feed_rows(spark: SparkSession, spec: TableSpec, feed_path: str, entries: list) -> DataFrame:
    if not entries:
        return spark.createDataFrame([], feed_schema(spec))
    return spark.read.schema(feed_schema(spec)).parquet(*[f"{feed_path}/changes/{e.folder}" for e in entries])


def start_table_scan(spark: SparkSession, spec: TableSpec, state_path: str, feed_path: str,
                     write: Callable[[DataFrame, int], None], checkpoint: str, *,
                     trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Read a keyed table as a stream: its rows first, then its changes.

    The first batch has the rows of one published version as inserts, each later one the
    changes of the commits since, by their numbers; the version is that of the last commit in
    the first batch of the feed's log, which the checkpoint holds, so nothing is left out or read twice and a replay
    sees the same. ``write(rows, batch number)`` gets the feed's columns and must be idempotent. Every
    commit of the table needs its feed: a commit without one, after the first, raises.
    """
    consumed = NumberedLog(spark, f"{checkpoint}/consumed")  # the last commit of each batch

    def run(entries: DataFrame, batch_id: int) -> None:
        if batch_id == 0:  # may be a long history: only its end reaches the driver
            last = entries.agg(F.max("number")).first()[0]
            rows = live_view(spark, spec, state_path, at=last)
            changes = rows.select(F.lit("+I").alias("rowkind"), "*", F.lit(last).cast("long").alias("batch_id"))
        else:
            last, new = consumed.read(batch_id - 1)["last"], sorted(entries.collect(), key=lambda e: e.number)
            for e in new:
                if e.after != last:
                    raise ValueError(f"{spec.name}: commit {e.after} before {e.number} has no feed")
                last = e.number
            changes = _feed_rows(spark, spec, feed_path, new)
        write(changes.select(*feed_schema(spec).names), batch_id)
        if not consumed.has(batch_id):
            consumed.write(batch_id, {"last": last})

    return (_feed_stream(spark, feed_path).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": COMMIT_INTERVAL})).start())


def start_feed_compaction(spark: SparkSession, spec: TableSpec, feed_path: str, out_path: str,
                          checkpoint: str, *, trigger: Mapping[str, object] | None = None
                          ) -> StreamingQuery:
    """The table's change feed at a coarser cadence (S8, T5; default 1 minute).

    Each trigger takes the commits that were published since the one before;
    ``compact_feed`` folds them into
    their net change, written under ``out_path/feed_batch=<n>``.
    """
    def write(entries: DataFrame, batch_id: int) -> None:
        net = compact_feed(_feed_rows(spark, spec, feed_path, entries.collect()), spec.pk)
        (net.withColumn("feed_batch", F.lit(int(batch_id)).cast("long"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("feed_batch").parquet(out_path))

    return (_feed_stream(spark, feed_path).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": FEED_INTERVAL})).start())


def start_preview(df: DataFrame, path: str, checkpoint: str, *,
                  trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Append a stream's rows, all of them, to a folder: the ad-hoc preview sink."""
    return (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"processingTime": COMMIT_INTERVAL})).start())


def start_table(spec: TableSpec, source: DataFrame, state_path: str, checkpoint: str, *,
                feed_path: str | None = None, trigger: Mapping[str, object] | None = None
                ) -> StreamingQuery:
    """Upsert an already conformed change stream into a state table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, spec, state_path, feed_path=feed_path, batch_id=batch_id)

    return (source.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": COMMIT_INTERVAL}))
            .start())
