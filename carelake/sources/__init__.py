"""Change-log sources, table specs and state-table reads."""

from carelake.sources.specs import ALL_SPECS, ARRIVAL, BUCKET, META, ROWKIND, TableSpec
from carelake.sources.changelog import as_changelog, read_changelog

__all__ = ["ALL_SPECS", "ARRIVAL", "BUCKET", "META", "ROWKIND", "TableSpec",
           "as_changelog", "read_changelog"]
