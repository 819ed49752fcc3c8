"""Structured Streaming: versioned keyed upsert, job runner, change feed, bounded-wait lookups."""

from carelake.streaming.audit import read_audit_log, start_audit_log
from carelake.streaming.chain import WaitStage, delta_step, start_wait, start_waiting_job, wait_step
from carelake.streaming.jobs import (batch_writer, StateLookup, start_feed_compaction, start_job, start_preview,
                                    start_table, start_table_scan, state_lookup)
from carelake.streaming.location import TableLocation, current, open_table, publish
from carelake.streaming.sink import (as_changes, compact, create_if_absent, live_view, read_feed,
                                     read_state, upsert)

__all__ = ["StateLookup", "WaitStage", "as_changes", "delta_step", "start_wait", "start_waiting_job", "wait_step",
           "batch_writer", "start_feed_compaction", "start_job", "start_preview", "start_table", "start_table_scan",
           "state_lookup", "TableLocation", "current", "open_table", "publish",
           "compact", "create_if_absent", "live_view", "read_audit_log", "read_feed", "read_state", "start_audit_log", "upsert"]
