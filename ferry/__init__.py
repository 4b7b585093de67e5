"""ferry: a Spark-native engine for moving data from sources to loaders.

Sources are read as byte chunks or rows, wrapped in a JSON message envelope,
optionally passed through a queue directory, and loaded as NDJSON, full
overrides, incremental appends, deduplicated snapshots or upserts, with
per-connection sync state. Everything is a DataFrame plan.
"""

__version__ = "0.1.0"
