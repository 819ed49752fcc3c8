"""Change logs without before-images made complete.

A source that sends ``+U`` rows alone never says what a row was before. A fact
whose day moved would stay in its old partition, and one that left a filter would
stay in the filtered table. So the source's rows are kept as a keyed table of their own
(the latest version of each source key), and its change feed, which has the images before and
after, is what the job reads: an update becomes ``-U`` of the stored row and ``+U`` of the new one,
a late older version becomes nothing. ``TableSpec.before_images`` says whether a table's source sends them.

It is one keyed commit and the feed of that commit, both published by number, so a replayed batch gives the same
changes, and a commit reads only the buckets of its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from carelake.plans.warehouse import Job
from carelake.sources.specs import META, TableSpec
from carelake.streaming.sink import as_changes, read_feed, upsert, version


def source_spec(job: Job, source: DataFrame, key: str = "id") -> TableSpec:
    """The keyed table of a job's source rows."""
    fields = [f for f in source.schema.fields if f.name not in META]
    return TableSpec(name=f"{job.name}_source", schema=T.StructType(fields), pk=(key,), sequence=job.spec.sequence,
                     buckets=job.spec.buckets, bucket_key=key)


def normalise(batch: DataFrame, spec: TableSpec, root: str, batch_id: int) -> DataFrame:
    """The complete changes of a batch: apply it to the source's table under ``root`` and read what it changed.

    Rows without key are passed on as they are, for the job to reject. ``batch`` is read twice.
    """
    key = f"`{spec.pk[0]}`"
    upsert(batch.filter(f"{key} IS NOT NULL"), spec, f"{root}/state", feed_path=f"{root}/feed", batch_id=batch_id)
    v = version(batch.sparkSession, f"{root}/state")
    columns = [*spec.columns, *META]
    rest = batch.filter(f"{key} IS NULL").select(*columns)
    if v is None or v.batch != batch_id:  # nothing in it has a key
        return rest
    feed = read_feed(batch.sparkSession, spec, f"{root}/feed", after=v.batch_number - 1, upto=v.batch_number)
    return as_changes(feed).select(*columns).unionByName(rest)
