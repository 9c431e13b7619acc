"""Sinks: partitioned writes, partition-aware upsert, raw archive, publish."""

from kassa.sinks.tables import (  # noqa: F401
    write_partitioned, upsert_partitioned, table_exists,
)
