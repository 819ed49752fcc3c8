"""Warehouse jobs (D1-D5, W1-W8) and the source adapters for the test tables."""

from carelake.plans.warehouse import JOBS, Job, build, keyed_rows

__all__ = ["JOBS", "Job", "build", "keyed_rows"]
