"""Change kinds of a change-log row."""

from pyspark.sql import Column, functions as F

from carelake.sources.specs import ROWKIND

# The four change kinds of a change log.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"
LIVE_KINDS = (INSERT, UPDATE_AFTER)          # upsert their key
RETRACT_KINDS = (UPDATE_BEFORE, DELETE)      # tombstone their own key


def is_live(col: str | Column = ROWKIND) -> Column:
    """True for rows that leave their key present."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isin(*LIVE_KINDS)
