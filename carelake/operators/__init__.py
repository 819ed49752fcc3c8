"""Relational operators over change logs and dimension state."""

from carelake.operators.changelog import (compact_feed, filter_changelog, inserts_only, latest_by_key,
                                          materialize, merge_state, snapshot_diff)
from carelake.operators.lookup import (assert_unique_key, decode_codes, duplicate_keys,
                                       lookup_join, lookup_join_asof)

__all__ = ["compact_feed", "filter_changelog", "inserts_only", "latest_by_key", "materialize", "merge_state",
           "snapshot_diff", "assert_unique_key", "decode_codes", "duplicate_keys", "lookup_join",
           "lookup_join_asof"]
