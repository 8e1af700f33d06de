"""Bulk loading of governance concepts, as Spark DataFrame jobs.

Concept files and catalog snapshots go in as DataFrames; records to create,
relationship edges, policy changes and per-row outcomes come out as DataFrames.
"""

__version__ = "0.1.0"
