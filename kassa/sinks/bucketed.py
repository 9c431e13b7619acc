"""Catalog tables bucketed by the merge key: MERGE without shuffling the target.

The table is partitioned (so that a merge rewrites only what the updates touch)
and, within each partition, bucketed and sorted by the key. A merge deals the
updates into the same buckets; the anti join then reads the target's buckets as
they lie, and each task writes the files of one bucket. Only the updates, which
are few beside the target, cross the network.

Partition columns can't be bucket columns, so the buckets are those of the
other keys; ``co_located`` lets Spark join by all keys on buckets of some.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from kassa.operators.merge import check_same_columns, merge_frames
from kassa.schemas import MERGE_KEYS, PARTITION_COLS
from kassa.session import discard, materialize
from kassa.sinks.tables import blank_as_null, in_partitions, partitions_follow, partitions_of


SOME_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def co_located(spark: SparkSession):
    """Plans made inside the block take buckets by some of the join keys as
    they are. For jobs that run inside it."""
    before = spark.conf.get(SOME_KEYS)
    spark.conf.set(SOME_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(SOME_KEYS, before)


def bucket_keys(keys: list[str], partition_cols: list[str]) -> list[str]:
    out = [k for k in keys if k not in partition_cols]
    if not out or not partitions_follow(keys, partition_cols):
        raise ValueError(f"keys {keys} don't fix the partition columns {partition_cols} and a bucket")
    return out


def create_bucketed(df: DataFrame, name: str, buckets: int, keys: list[str] | None = None,
                    partition_cols: list[str] | None = None, path: str | None = None) -> None:
    """First load of table ``name`` (at ``path``, else in the warehouse)."""
    keys, cols = list(keys or MERGE_KEYS), list(partition_cols or PARTITION_COLS)
    by = bucket_keys(keys, cols)
    dealt = blank_as_null(df, cols).repartition(buckets, *by)  # one file a bucket and partition
    w = dealt.write.format("parquet").partitionBy(*cols).bucketBy(buckets, *by).sortBy(*by)
    (w.option("path", path) if path else w).saveAsTable(name)


def bucket_count(spark: SparkSession, name: str) -> int:
    found = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Num Buckets"]
    if not found:
        raise ValueError(f"{name} is not bucketed")
    return int(found[0])


def merge_bucketed(spark: SparkSession, updates: DataFrame, name: str, keys: list[str] | None = None,
                   partition_cols: list[str] | None = None, null_safe: bool = False, on_ambiguous: str = "error") -> None:
    """MERGE ``updates`` into the bucketed table ``name``; rewrites the
    partitions that the updates touch."""
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "dynamic":
        raise ValueError("spark.sql.sources.partitionOverwriteMode has to be dynamic, or other partitions would be dropped")
    keys, cols = list(keys or MERGE_KEYS), list(partition_cols or PARTITION_COLS)
    table = spark.table(name)
    check_same_columns(table, updates)
    scratch = [materialize(blank_as_null(updates, cols), "bucketed-updates")]
    try:
        staged = scratch[0]
        target = table.where(in_partitions(partitions_of(staged, cols), cols))
        with co_located(spark):
            merged = merge_frames(target, staged, keys, null_safe, on_ambiguous, scratch=scratch,
                                  dealt=(bucket_count(spark, name), bucket_keys(keys, cols)))
            merged.select(*table.columns).write.mode("overwrite").insertInto(name)
        spark.catalog.refreshTable(name)
    finally:
        for frame in scratch:
            discard(frame)
