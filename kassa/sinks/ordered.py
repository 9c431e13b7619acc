"""Sorted tables on disk whose order can be read back.

A global sort writes range-partitioned files, named in the order of their
ranges, each sorted inside. A row's position is the rows of the files before
its own plus its row number in the file (``_metadata.row_index``), so readers
get the order back without sorting again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def write_ordered(df: DataFrame, path: str, *order: Column) -> None:
    """Range shuffle and a local sort per range; a file for each range."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, column: str = "position") -> DataFrame:
    """The rows with their position, from 0. The window runs over one row for
    each file."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return rows.join(files.drop("_n"), "_file").withColumn(column, F.col("_before") + F.col("_index")).drop("_file", "_index", "_before")
