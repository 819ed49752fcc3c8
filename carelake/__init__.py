"""carelake: a Spark-native changelog warehouse.

Keyed change logs (insert / update / delete rows) are conformed to typed
schemas, enriched with dimension attributes as they stand at processing time
and kept up to date by key and version in parquet state tables, in batch and
in Structured Streaming with the same result.
"""

from carelake.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
