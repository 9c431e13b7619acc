"""Incremental load: only staging files that haven't been loaded yet.

The file source's own log (in the checkpoint) remembers which files a batch
held; ``availableNow`` takes what is new and stops. A batch that is run again
after a failure holds the same files, and its MERGE and its summary folder give
the same result, so replays are harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kassa.plans.batch import load_job
from kassa.schemas import STAGING_SCHEMA
from kassa.sources.files import PARQUET_GLOB


def load_incremental(spark: SparkSession, staging_path: str, dims: tuple[DataFrame, DataFrame, DataFrame], target_path: str,
                     summary_path: str, checkpoint: str, max_files: int | None = None, **load_options):
    """Load every new Parquet file under ``staging_path`` (any depth) into the
    table at ``target_path``; the summary of each batch goes to
    ``<summary_path>/batch_id=<n>``. ``max_files`` bounds the files of a batch;
    ``load_options`` are those of ``load_job``. Returns the ``StreamingQuery``,
    which ends when there is nothing new."""
    source = spark.readStream.schema(STAGING_SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", PARQUET_GLOB)
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)

    def load(batch: DataFrame, batch_id: int) -> None:
        summary = load_job(batch.sparkSession, batch, *dims, target_path, **load_options)
        if summary is not None:
            summary.write.mode("overwrite").parquet(f"{summary_path}/batch_id={batch_id}")
    return (source.parquet(staging_path).writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(load).trigger(availableNow=True).start())
