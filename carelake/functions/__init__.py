"""Column-level building blocks: casts, time parts, row kinds, buckets."""

from carelake.functions.conform import conform, split_rejects, split_unfit
from carelake.functions.rowkind import INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE, is_live
from carelake.functions.timeparts import day_of, hour_of, minute_of, proc_time, with_dt
from carelake.functions.bucket import bucket_of

__all__ = [
    "conform", "split_rejects", "split_unfit", "INSERT", "UPDATE_BEFORE", "UPDATE_AFTER", "DELETE",
    "is_live", "day_of", "hour_of", "minute_of", "proc_time", "with_dt", "bucket_of",
]
