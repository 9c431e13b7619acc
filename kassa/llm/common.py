"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from kassa.session import discard, scratch_path

#: Arrow batches are kept small, by rows and by bytes: one batch of very long
#: texts has to fit a Python worker beside its model or tokenizer.
BATCH_ROWS, BATCH_BYTES = 256, "16m"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text"):
    """A null text counts as empty everywhere in this folder."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder of ``spark.checkpoint.dir`` and
    read it back. Cuts the lineage: what a lost executor held is read again
    from the written files."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def drop_kept(df: DataFrame) -> None:
    """Delete the files behind a frame that ``keep`` returned, once nothing
    reads it any more."""
    discard(df)


def small_batches(spark: SparkSession) -> None:
    spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    spark.conf.set(ARROW_BYTES, BATCH_BYTES)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of so many rows, for jobs that run inside the block."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def ascii_lower(col):
    """Lower-cases A-Z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(col, upper, upper.lower())


def id_text():
    """doc_id on its way to pandas: as text, since a column of longs with a
    null in it would become doubles there."""
    return F.col("doc_id").cast("long").cast("string").alias("doc_id")


def with_ids(df: DataFrame) -> DataFrame:
    """doc_id back from text."""
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))


def whole_row(df: DataFrame):
    """All columns as one struct, so that a row can travel beside helper
    columns whatever its own are called."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])
