"""The corpus pipeline: from documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns the rows for the next one, with the columns of ``documents``; the
last returns the packed pieces. ``run`` chains them, writing each stage's rows
as Parquet in the shared folder of ``spark.checkpoint.dir`` and reading them
again, so that a lost executor costs part of one stage.

Learned scores, hashes and tokenization aren't expressible in SQL, hence no
``ORACLE_SQL``; the stages are tested against brute force.

Nulls, empty tables and repeated rows: a null text is treated as empty by
every stage; quality judges it like any text; line and near dedup leave it;
mixing drops documents without words, as they hold no tokens of any source;
an empty table passes through all stages as one. Of rows that repeat doc_id
and text one is left by near dedup, the same with rows without doc_id; where
different texts share a doc_id, each is judged by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kassa.llm import line_dedup, minhash, mixing, packing, quality
from kassa.llm.common import keep, small_batches, table, whole_row
from kassa.llm.queries import bpe_encoder


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.5 or more).
    The model is fitted on the labelled documents among ``docs``."""
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(quality.document_statistics(quality.labelled(docs, labels)), labels)
    small_batches(spark)
    return docs.where(quality.text_score(model)(F.coalesce("text", F.lit(""))) >= 0.5)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of lines that occurred before;
    a document of which nothing is left goes. n_chars follows the text."""
    runs = F.size("removed_spans")
    cut = line_dedup.dedup_lines(docs).where((runs == 0) | F.col("text").rlike(line_dedup.WORD))
    n_chars = F.when(runs > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.select(*[n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the one with the least id, of every group of near duplicates
    (five-word shingles, similarity of 0.8 or more). Rows are numbered first,
    so repeated ids and rows without one are judged row by row; rows without
    doc_id come last in a group."""
    rows = keep(docs.select(F.monotonically_increasing_id().alias("doc_id"), "text", whole_row(docs).alias("row")), "numbered")
    groups = minhash.near_duplicates(rows, k=5, numerator=80, denominator=100).select("doc_id", "component_id")
    ids = rows.select("doc_id", F.col("row.doc_id").alias("id"))
    order = F.struct(F.col("id").isNull(), "id", "doc_id")
    least = groups.join(ids, "doc_id").groupBy("component_id").agg(F.min(order).alias("least")).select(F.col("least.doc_id").alias("doc_id"))
    return rows.join(least.hint("shuffle_hash"), "doc_id", "left_semi").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, in whole copies: a copy of
    which the mix takes half or more is whole, one of which it takes less goes."""
    keyed = docs.select("doc_id", "source", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), whole_row(docs).alias("row"))
    ids = ["doc_id", "key"]
    taken = mixing.mix_sources(keyed, ids=ids).where("size > 0").groupBy(*ids).agg(
        F.round(F.avg(F.col("taken") / F.col("size"))).cast("int").alias("copies")).where("copies > 0")
    chosen = keyed.alias("d").join(taken.hint("shuffle_hash").alias("t"), F.expr("d.key = t.key AND d.doc_id <=> t.doc_id"))
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and their place in
    sequences of 2048 tokens."""
    return packing.pack(docs, bpe_encoder())


STAGES = [
    ("quality classifier", filter_quality),
    ("line dedup", remove_repeated_lines),
    ("MinHash near-dedup", remove_near_duplicates),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
