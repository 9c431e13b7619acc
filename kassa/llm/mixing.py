"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a target number of words; the mix is dealt out in blocks of
equal size. Sainte-Laguë's highest quotients turn the targets into integer
block quotas, first for the sources and then, within a source, for its shards
(bounded hash groups of documents, so that no task gets a whole source). In a
shard documents stand in a seeded order; whole passes over the shard fill the
quota as far as they fit and the first blocks in that order fill the rest.
Only ids and sizes are shuffled, never texts.

Defined results: size is the number of words, 0 for a null text; the null
source is a source of its own, last in order; a source without words gets the
target 0; documents without words take 0; rows that share doc_id stay rows of
their own; an empty table gives an empty result; other columns pass by unread.
Runs agree: order and shards depend on doc_id, size and the seed only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .common import keep, text_of

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 32
SHARD_WORDS, SHARD_DOCS = 2_000_000, 20_000


def source_targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Adds ``ord`` and ``target`` to a table (source, source_size). Weights
    repeat over the sources in code-point order, null last; targets share the
    sum of all sizes by weight, none above ``most`` times its size. Sources in
    the order of limit by weight are cut off one after another until the share
    that is left for the others exceeds no limit: a running sum over the
    sources, which are few beside the documents."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("ord") % len(weights) + 1).cast("int"))
    one = W.partitionBy(F.lit(0))
    up = one.orderBy("reach", "ord")
    limit = (F.col("source_size") * most).cast("double")
    numbered = sources.withColumn("ord", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1)
    shares = (numbered.withColumn("w", w).withColumn("limit", limit).withColumn("reach", limit / w)
              .withColumn("left", F.sum("source_size").over(one) - F.sum("limit").over(up) + F.col("limit"))
              .withColumn("w_left", F.sum("w").over(one) - F.sum("w").over(up) + F.col("w"))
              .withColumn("full", F.col("limit") * F.col("w_left") <= F.col("left") * F.col("w")))
    rest = F.sum("source_size").over(one) - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(one)
    w_rest = F.sum(F.when(F.col("full"), F.lit(0.0)).otherwise(F.col("w"))).over(one)
    return shares.withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(F.col("w") * rest / F.nullif(w_rest, F.lit(0.0)))).select(
        *sources.columns, "ord", "target")


def sainte_lague(claims: DataFrame, group: list[str], key: list[str], claim: str, seats: str) -> DataFrame:
    """Integer ``quota`` per row: in each ``group`` the ``seats`` highest
    quotients claim / (2 s - 1), s = 1, 2, ..., ties to the smaller ``key``.

    With k claims no quota lies further from its exact share x than rounding
    after scaling x by up to (k + 1) / (2 seats) either way, so only the seats
    in that band are ranked: at most a few rows for each claim, however many
    seats there are."""
    all_ = W.partitionBy(*group)
    x = F.col(claim) * F.col(seats) / F.nullif(F.sum(claim).over(all_), F.lit(0))
    slack = (F.count(F.lit(1)).over(all_) + 1) / F.nullif(2 * F.col(seats), F.lit(0))
    band = (claims.where((F.col(claim) > 0) & (F.col(seats) > 0)).withColumn("_x", x).withColumn("_slack", slack)
            .withColumn("_lo", F.greatest(F.lit(0), F.floor(F.col("_x") * (1 - F.col("_slack")) - 0.5)).cast("long"))
            .withColumn("_hi", (F.ceil(F.col("_x") * (1 + F.col("_slack")) + 0.5)).cast("long"))
            .withColumn("_open", F.col(seats) - F.sum("_lo").over(all_)))
    tried = band.select("*", F.explode(F.sequence(F.col("_lo") + 1, F.col("_hi"))).alias("_s"))
    best = all_.orderBy((F.col(claim) / (2 * F.col("_s") - 1)).desc(), *key, "_s")
    return (tried.withColumn("_won", F.row_number().over(best) <= F.col("_open"))
            .groupBy(*group, *key).agg((F.first("_lo") + F.count(F.when(F.col("_won"), 1))).alias("quota")))


def mix_sources(docs: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS,
                shard_words: int = SHARD_WORDS, shard_docs: int = SHARD_DOCS, seed: int = 17,
                ids: list[str] | None = None) -> DataFrame:
    """A row per document: doc_id (or the columns ``ids``, which tell rows
    apart), size, source_size, target, taken (words the mix takes, repeats
    counted), shard, quota (the shard's blocks)."""
    ids = ids or ["doc_id"]
    sized = keep(docs.select(*ids, "source", F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size")), "sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    total = F.sum("source_size").over(W.partitionBy(F.lit(0)))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("n_docs") / shard_docs))
    sources = keep(source_targets(per_source, weights, most).withColumn("shards", shards.cast("long"))
                   .withColumn("blocks", F.greatest(F.lit(1), F.round(total / block_words)).cast("long"))
                   .withColumn("block", total / F.col("blocks")).withColumn("all", F.lit(0)), "targets")
    quotas = sainte_lague(sources, ["all"], ["ord"], "target", "blocks").select("ord", F.col("quota").alias("source_quota"))

    order = F.xxhash64(*ids, F.lit(seed))
    dealt = sized.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        *ids, "size", "ord", "source_size", "target", "block",
        F.pmod(F.xxhash64(*ids, F.lit(seed + 1)), F.col("shards")).alias("shard"), order.alias("place"))
    shards = dealt.groupBy("ord", "shard").agg(F.sum("size").alias("shard_size")).join(quotas, "ord")
    shard_quotas = keep(shards.join(
        sainte_lague(shards, ["ord"], ["shard"], "shard_size", "source_quota"), ["ord", "shard"]).select(
        "ord", "shard", "shard_size", "quota"), "quotas")
    placed = dealt.join(shard_quotas, ["ord", "shard"], "left")
    run = W.partitionBy("ord", "shard").orderBy("place", *ids, "size").rowsBetween(W.unboundedPreceding, 0)
    words = F.least(F.round(F.col("quota") * F.col("block")).cast("long"), F.col("shard_size") * most)
    passes = F.floor(F.col("words") / F.nullif(F.col("shard_size"), F.lit(0)))
    start = F.col("end") - F.col("size")
    rest = F.col("words") - F.col("passes") * F.col("shard_size")
    return (placed.withColumn("end", F.sum("size").over(run)).withColumn("words", words).withColumn("passes", passes)
            .withColumn("more", F.greatest(F.lit(0), F.least(F.col("end"), rest) - start))
            .select(*ids, "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.coalesce(F.col("passes") * F.col("size") + F.col("more"), F.lit(0)))
                    .otherwise(0).cast("long").alias("taken"), "shard", "quota"))
