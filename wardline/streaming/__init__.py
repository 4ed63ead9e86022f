"""Streaming entry points.

The reference is batch only.  The one streaming use here is incremental
ingestion: record files (one complete stay per file) land in a folder, and
each micro-batch of new files is turned into grid rows with the same batch
operators and appended to a table.  A file is complete when it arrives, so
a micro-batch never splits a stay and the appended grid equals the batch
result.
"""

from wardline.streaming.ingest import start_grid_ingestion  # noqa: F401
