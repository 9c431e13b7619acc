"""External table definitions over the staging and curated folders."""

from __future__ import annotations

from pyspark.sql import SparkSession

from kassa.schemas import STAGING_COLUMNS


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_staging_table(spark: SparkSession, name: str, location: str) -> None:
    """All-string staging table over Parquet files at ``location``."""
    cols = ",\n  ".join(f"`{c}` STRING" for c in STAGING_COLUMNS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(name)} (\n  {cols}\n) "
              f"USING PARQUET LOCATION '{location}'")


def create_curated_table(spark: SparkSession, name: str, location: str) -> None:
    """Curated table: schema and partitions come from the files; partitions
    are registered by ``MSCK REPAIR TABLE`` (rows are invisible before it)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(name)} USING PARQUET LOCATION '{location}'")
    refresh_partitions(spark, name)


def refresh_partitions(spark: SparkSession, name: str) -> None:
    try:
        spark.sql(f"MSCK REPAIR TABLE {_ident(name)}")
    except Exception as e:  # an unpartitioned table has nothing to repair
        if "NOT_A_PARTITIONED_TABLE" not in str(e) and "not partitioned" not in str(e):
            raise
