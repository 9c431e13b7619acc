"""Exact top-k inner-product search by norm-bucketed retrieval.

Vectors are ordered by length and cut into buckets of bounded size. For a
query q with a known k-th best score s, a vector p of a bucket can only matter
if cos(q, p) >= s / (|q| max|p|): the bucket's local cosine threshold. Above 1
the bucket is skipped. A high threshold narrows the range of each coordinate
that p may have (coordinate pruning); a low one prunes by length alone: only
the prefix of the bucket with |p| >= s / |q|. What is left is verified with
exact integer products. The first bounds s come from the bucket of the longest
vectors.

The stated queries meet the buckets block by block: a task gets one block of
queries and one bucket, so its memory doesn't depend on the data, and returns
at most k rows a query. A bucket whose longest vector is too short for every
query of a block isn't sent to it.

Defined results: rows whose id or vector is null, or whose vector holds a null
or non-finite component, take no part; only vectors of equal dimension are
compared; ties go to the smaller id; rows with the query's own id are not its
candidates, other repeated vectors are; a query with fewer than k candidates
gets all of them; an empty table gives an empty result. Components saturate at
the range of a long and scores have to fit one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import batches_of, drop_kept, keep

BUCKET_ROWS = 4096
QUERY_ROWS = 512
ROWS_AT_A_TIME, BLOCKS_AT_A_TIME = 1024, 4  # in an Arrow batch: vectors, pairs of blocks
COORDINATE_FROM = 0.5  # local cosine threshold from which coordinates prune
FOCUS = 4              # coordinates that are tested
SLACK = 1e-9           # keeps rounding from pruning a tie
BLOCK = "dim int, block string, longest double, ids array<long>, norms array<double>, vectors binary"
FOUND = "query_id long, vec_id long, score long"


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, dim, v (integers) and norm of the rows that take part."""
    x = F.col(vector_col)
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, finite))
            .select(F.col(id_col).cast("long").alias("id"), F.size(x).alias("dim"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))))


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one dimension, longest first,
    cut from neighbours in the order of length."""
    parts = max(1, -(-rows.count() // size))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part, cut, held = TaskContext.get().partitionId(), 0, {}

        def block(dim, group):
            nonlocal cut
            group = pd.concat(group).sort_values(["norm", "id"], ascending=[False, True])
            cut += 1
            v = np.concatenate(group["v"].to_list()).astype("<i8") if dim else np.zeros(0, "<i8")
            return pd.DataFrame({"dim": [dim], "block": [f"{part}-{cut}"], "longest": [float(group["norm"].iloc[0])],
                                 "ids": [group["id"].to_list()], "norms": [group["norm"].to_list()], "vectors": [v.tobytes()]})
        for batch in batches:
            for dim, group in batch.groupby("dim"):
                for at in range(0, len(group), size):
                    some = held.setdefault(int(dim), [])
                    some.append(group.iloc[at:at + size])
                    if sum(map(len, some)) > size:
                        yield block(int(dim), held.pop(int(dim)))
        for dim, some in held.items():
            yield block(dim, some)
    return rows.repartitionByRange(parts, F.col("norm").desc(), "id").mapInPandas(pack, BLOCK)


def best_of_bucket(q: np.ndarray, q_ids: np.ndarray, bounds: np.ndarray, p: np.ndarray, p_ids: np.ndarray,
                   k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its at most k best (ids, scores) in a bucket sorted by
    length, of those with a score of its bound or more."""
    top = max(float(abs(q).max(initial=0)) * float(abs(p).max(initial=0)) * q.shape[1], 0)
    if top < 2 ** 53:  # products and sums are exact in doubles
        q, p = q.astype(float), p.astype(float)
    q_norm, p_norm = np.sqrt((q.astype(float) ** 2).sum(1)), np.sqrt((p.astype(float) ** 2).sum(1))
    with np.errstate(divide="ignore", invalid="ignore"):
        least = np.where(bounds > 0, bounds / q_norm, -np.inf)  # length a candidate needs
        cosine = np.where(bounds > 0, least / p_norm[0], -np.inf)
    prefix = np.searchsorted(-p_norm, -(least * (1 - SLACK) - SLACK), "right")
    by_coordinate = (cosine >= COORDINATE_FROM) & (cosine <= 1 + SLACK)
    by_length = np.flatnonzero(~by_coordinate & (cosine <= 1 + SLACK))

    def best(i, candidates, scores):
        ok = (scores >= bounds[i]) & (p_ids[candidates] != q_ids[i])
        candidates, scores = p_ids[candidates[ok]], scores[ok].astype(np.int64)
        if len(scores) > k:  # ties at the k-th score have to meet in the sort
            kth = np.partition(scores, -k)[-k]
            candidates, scores = candidates[scores >= kth], scores[scores >= kth]
        order = np.lexsort((candidates, -scores))[:k]
        return int(i), candidates[order], scores[order]

    if len(by_length):
        n = int(prefix[by_length].max())
        products = q[by_length] @ p[:n].T
        every = np.arange(n)
        for row, i in zip(products, by_length):
            yield best(i, every[:prefix[i]], row[:prefix[i]])
    unit = p / np.maximum(p_norm, 1e-300)[:, None] if by_coordinate.any() else None
    for i in np.flatnonzero(by_coordinate):
        t, at = min(float(cosine[i]), 1.0), q[i] / q_norm[i]
        inside = np.arange(prefix[i])
        for f in np.argsort(-abs(at))[:FOCUS]:
            # p lies within the angle of cosine t around q, so its angle to the axis f does around q's
            reach = np.sqrt(max(0.0, (1 - at[f] ** 2) * (1 - t * t))) + 1e-6
            low = at[f] * t - reach if at[f] >= -t else -2
            high = at[f] * t + reach if at[f] <= t else 2
            x = unit[inside, f]
            inside = inside[(x >= low) & (x <= high)]
        yield best(i, inside, p[inside] @ q[i])


def search(pairs: DataFrame, k: int) -> DataFrame:
    """Rows with a query block, its bounds and a bucket -> best rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                q_ids, p_ids = np.array(r.q_ids, np.int64), np.array(r.ids, np.int64)
                q = np.frombuffer(r.q_vectors, "<i8").reshape(len(q_ids), r.dim)
                p = np.frombuffer(r.vectors, "<i8").reshape(len(p_ids), r.dim)
                bounds = np.full(len(q_ids), -np.inf)
                if r.bounds is not None:
                    known = {x["query_id"]: x["bound"] for x in r.bounds}
                    bounds = np.array([known.get(i, -np.inf) for i in q_ids.tolist()])
                out = list(best_of_bucket(q, q_ids, bounds, p, p_ids, k))
                yield pd.DataFrame({
                    "query_id": np.repeat(q_ids[[i for i, _, _ in out]], [len(s) for _, _, s in out]) if out else q_ids[:0],
                    "vec_id": np.concatenate([v for _, v, _ in out]) if out else p_ids[:0],
                    "score": np.concatenate([s for _, _, s in out]) if out else p_ids[:0]})
    return pairs.mapInPandas(run, FOUND)


def block_bounds(asked: DataFrame, bounds: DataFrame) -> DataFrame:
    """dim, q_block, bounds (query_id, bound) of its queries, at most as many
    as a block has, and least: the length that a vector needs to matter to any
    of them. A query without a positive bound needs none."""
    members = asked.select("dim", "q_block", F.explode(F.arrays_zip("q_ids", "q_norms")).alias("q")).select(
        "dim", "q_block", F.col("q.q_ids").alias("query_id"), F.col("q.q_norms").alias("norm"))
    needs = F.when((F.col("bound") > 0) & (F.col("norm") > 0), F.col("bound") / F.col("norm")).otherwise(F.lit(float("-inf")))
    return members.join(bounds, "query_id", "left").groupBy("dim", "q_block").agg(
        F.min(needs).alias("least"),
        F.collect_set(F.when(F.col("bound").isNotNull(), F.struct("query_id", "bound"))).alias("bounds"))


def meetings(bounds: DataFrame, buckets: DataFrame) -> DataFrame:
    """dim, q_block, block: every query block with the buckets of its dimension
    whose longest vector is long enough for one of its queries."""
    return bounds.select("dim", "q_block", "least").join(buckets.select("dim", "block", "longest"), "dim").where(
        F.col("longest") >= F.col("least") * (1 - SLACK) - SLACK).select("dim", "q_block", "block")


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
               vector_col: str = "embedding", bucket_rows: int = BUCKET_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for every row where ``is_query`` holds
    its ``k`` best other rows by the inner product of floor(scale * x)."""
    spark = vectors.sparkSession
    rows = keep(quantized(vectors, id_col, vector_col, scale), "vectors")
    with batches_of(spark, ROWS_AT_A_TIME):
        buckets = keep(blocks(rows, bucket_rows), "buckets")
        asked = keep(blocks(quantized(vectors.where(is_query), id_col, vector_col, scale), query_rows), "queries")
    drop_kept(rows)
    asked = asked.select(
        "dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("norms").alias("q_norms"), F.col("vectors").alias("q_vectors"))

    longest = buckets.groupBy("dim").agg(F.max_by("block", "longest").alias("block")).select("dim", "block")
    none = F.lit(None).cast("array<struct<query_id:long,bound:double>>").alias("bounds")
    first = search(asked.join(buckets.join(longest, ["dim", "block"]), "dim").select(
        "dim", "q_ids", "q_vectors", none, "ids", "vectors"), k)
    ranked = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    bounds = first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k).select(
        "query_id", F.col("score").cast("double").alias("bound"))
    with batches_of(spark, BLOCKS_AT_A_TIME):
        bounds = keep(block_bounds(asked, bounds), "bounds")
    # a pair's rows are dealt by the pair
    deal = meetings(bounds, buckets).repartition("q_block", "block")
    pairs = deal.join(asked.join(bounds.select("q_block", "bounds"), "q_block"), ["dim", "q_block"]).join(buckets, ["dim", "block"])
    with batches_of(spark, BLOCKS_AT_A_TIME):
        found = keep(search(pairs.select("dim", "q_ids", "q_vectors", "bounds", "ids", "vectors"), k), "found")
    drop_kept(buckets)
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
