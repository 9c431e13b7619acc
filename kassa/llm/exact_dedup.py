"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own characters say so (a boundary pattern, with a
smallest and a largest chunk length), so equal texts have equal chunks. Each
distinct chunk is moved once, to be compared byte by byte with chunks of the
same fingerprint; that gives every chunk a verified identifier. Documents are
then compared by their ordered identifier lists (recipes), a few bytes for
each half kilobyte of text, and the texts themselves never move again.

Defined results: a null text is the empty text, whose recipe is the empty
list; texts are equal when identical with no normalisation; rows that share
doc_id and text are ties and carry the same flags; a group whose doc_ids are
all null keeps a null keep_id and its rows count as kept; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import keep, text_of

#: A chunk ends after a white-space character followed by a letter of each of
#: two classes; about one position in 400 of ordinary prose does.
BOUNDARY = r"\s[a-eA-E][n-tN-T]"
MIN_CHARS, MAX_CHARS = 256, 4096


def chunk_pattern(boundary: str = BOUNDARY, shortest: int = MIN_CHARS, longest: int = MAX_CHARS) -> str:
    """Regular expression whose successive matches are the chunks: they cover
    every character of a text, in order, and none is longer than ``longest``
    plus a boundary."""
    return rf"(?s).{{{shortest},{longest}}}?(?:{boundary})|(?s).{{1,{longest}}}"


def chunks(col, **cut):
    return F.regexp_extract_all(col, F.lit(chunk_pattern(**cut)), F.lit(0))


def chunk_recipes(docs: DataFrame, fingerprint=F.xxhash64, **cut) -> DataFrame:
    """doc_id, text_sha256, n_bytes and ``recipe``: the chunk fingerprints in
    order. Computed where the text lies; nothing is shuffled."""
    text = text_of()
    return docs.select(
        "doc_id", F.sha2(text, 256).alias("text_sha256"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.transform(chunks(text, **cut), lambda c: fingerprint(c)).alias("recipe"))


def colliding_chunks(docs: DataFrame, fingerprint=F.xxhash64, **cut) -> DataFrame:
    """Chunks whose fingerprint other chunks share, numbered from 0 within the
    fingerprint: (fp, chunk, variant). Distinct chunks are compared as texts.
    The aggregation combines equal chunks before the shuffle, so a hot chunk
    costs one row per task."""
    distinct = (docs.select(F.explode(chunks(text_of(), **cut)).alias("chunk"))
                .select(fingerprint("chunk").alias("fp"), "chunk").groupBy("fp", "chunk").agg(F.lit(1).alias("one")))
    return (distinct.groupBy("fp").agg(F.sort_array(F.collect_set("chunk")).alias("same"))
            .where(F.size("same") > 1).select("fp", F.posexplode("same").alias("variant", "chunk")))


def exact_dedup(docs: DataFrame, fingerprint=F.xxhash64, **cut) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (largest doc_id of the
    group), group_size, kept, text_sha256, n_chunks."""
    recipes = keep(chunk_recipes(docs, fingerprint, **cut), "recipes")
    collisions = keep(colliding_chunks(docs, fingerprint, **cut), "chunk-variants")
    if collisions.isEmpty():  # every fingerprint is one chunk: it is its identifier
        verified = recipes.withColumn("variants", F.array().cast("array<int>"))
    else:
        seen = (docs.select("doc_id", F.sha2(text_of(), 256).alias("text_sha256"),
                            F.posexplode(chunks(text_of(), **cut)).alias("pos", "chunk"))
                .withColumn("fp", fingerprint("chunk")).join(collisions, ["fp", "chunk"])
                .groupBy("doc_id", "text_sha256")
                .agg(F.sort_array(F.collect_set(F.struct("pos", "variant"))).alias("variants")))
        on = recipes["doc_id"].eqNullSafe(seen["doc_id"]) & (recipes["text_sha256"] == seen["text_sha256"])
        verified = recipes.join(seen, on, "left").select(
            recipes["*"], F.coalesce(seen["variants"], F.array().cast(seen.schema["variants"].dataType)).alias("variants"))
    recipe = ["recipe", "variants", "n_bytes"]
    groups = verified.groupBy(*recipe).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return verified.join(groups, recipe).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", F.size("recipe").alias("n_chunks"))
