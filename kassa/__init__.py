"""kassa: retail transaction analytics as Spark DataFrame operators.

Staged JSON transactions -> typed, filled, duplicate-marked, enriched rows ->
monthly store summaries and a partition-aware upserted curated table, plus a
Structured Streaming ingest of encoded records.
"""

__version__ = "0.1.0"
