"""Duplicate marking: ``row_number`` per business key, newest source first.

The reference marks duplicates and filters nothing; ``keep="latest"`` is the
opt-in filter to the newest row per key.

Scale notes. A plain window sends every row of one key to one task. When a
key holds a large share of the data (placeholder keys after the null fill are
the usual suspects) that task is the whole job and AQE does not split skewed
window partitions. ``mark_duplicates`` therefore writes its input once, with a
hash of the key, and a heavy-hitter sketch of that hash is observed on the way:
the upstream is evaluated a single time. The rows of hot hashes are numbered by
a range-partitioned sort: each range partition numbers its slice locally and a
prefix sum over the (small) per-partition counts gives the global offset. The
result equals the plain window exactly. Where the sketch is too coarse for the
number of rows, the hashes in the written copy are counted instead (from a
sample of that one column), so there is no limit on the number of hot keys.
``keep="latest"`` needs none of this: the ``row_number() = 1`` filter is
planned as a partial per-group limit before the shuffle.

Rows of a table on disk (the written input, or ``written=True``) needn't all be
sent to their key's task: the hashes of the keys, a column of 8 bytes, are
counted first. Where few keys repeat, as in a feed that is sent again now and
then, a row alone under its hash is number 1 where it lies, and only the others
are ranked. Where many do, all rows take the window.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from kassa.plans.sizing import bounded_rows
from kassa.schemas import DEDUP_KEYS
from kassa.session import materialize

_UNORDERABLE = ("map<", "variant")

#: Size of the sketch of a task (some 64 kB at most), and the number of its
#: items that the driver gets. A key with more than SKETCH_ERROR / SKETCH_ITEMS
#: of all rows is among them.
SKETCH_ITEMS, SKETCH_TOP, SKETCH_ERROR = 4096, 1024, 4

#: Range partitions of the hot rows, unless they would hold more than
#: RANGE_ROWS rows each. The driver gets some 300 sampled rows for each of them.
MAX_RANGES, RANGE_ROWS = 256, 4_000_000

#: Number of range partitions up to which each is read back by a task of its own;
#: a scan would pack the files of small ones.
FEW_RANGES = 16

#: Repeated keys up to which, and the share of rows with such keys below which,
#: only these rows are sent for ranking. The keys' hashes are broadcast.
MAX_REPEATED, REPEATED_SHARE = 1_000_000, 1 / 8


def _ordering(df: DataFrame, keys: list[str], order: list[str], descending: bool,
              tiebreak: bool) -> list[Column]:
    first = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first()
             for c in order]
    if not tiebreak:
        return first
    used = set(keys) | set(order)
    rest = [F.col(c).asc_nulls_first() for c, t in df.dtypes
            if c not in used and not t.startswith(_UNORDERABLE)]
    return first + rest


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def mark_duplicates(df: DataFrame, keys: list[str] | None = None,
                    order: list[str] | str = "sourcets", descending: bool = True,
                    keep: str = "mark", column: str = "rownumber",
                    tiebreak: bool = True, skew: str = "auto",
                    hot_key_rows: int = 2_000_000, sample_fraction: float | None = None,
                    rows_per_task: int = 4_000_000,
                    hot_keys: list | DataFrame | None = None, written: bool = False) -> DataFrame:
    """Number rows per ``keys`` by ``order`` (newest first by default).

    keep:      "mark" adds ``column`` to every row (reference); "latest" keeps
               only the first row of each key.
    tiebreak:  complete the ordering with every other column so equal source
               times give the same numbers on every run.
    skew:      "auto" writes the input once, observes keys with more than
               ``hot_key_rows`` rows on the way and numbers those with a
               range-partitioned sort; "sample" looks for them in a sample of
               the input (which evaluates it once more; implied by
               ``sample_fraction``) and writes it only if there are some; "off"
               always uses the plain window.
    rows_per_task: rows of a range partition, more where that would make over
               ``MAX_RANGES`` partitions.
    hot_keys:  keys known to be hot (tuples in ``keys`` order, or a frame of
               key columns), e.g. the fill placeholders; skips the sampling
               pass. The rest of the keys take the plain window.
    written:   ``df`` reads a table on disk, which may be read several times;
               for ``keep="latest"``, which evaluates other input only once.
    """
    keys = list(keys or DEDUP_KEYS)
    order = [order] if isinstance(order, str) else list(order)
    ordering = _ordering(df, keys, order, descending, tiebreak)
    w = Window.partitionBy(*keys).orderBy(*ordering)

    if keep == "latest" and written:
        split = _split_repeated(df.withColumn("_k", F.xxhash64(*keys)))
        if split:
            once, again = (x.drop("_k") for x in split)
            ranked = again.withColumn(column, F.row_number().over(w)).filter(F.col(column) == 1)
            return once.withColumn(column, F.lit(1)).unionByName(ranked)
    if keep == "latest":
        return df.withColumn(column, F.row_number().over(w)).filter(F.col(column) == 1)
    if keep != "mark":
        raise ValueError(f"keep must be 'mark' or 'latest', not {keep!r}")

    if skew == "off":
        return df.withColumn(column, F.row_number().over(w))

    if hot_keys is None and sample_fraction is None and skew == "auto":
        base, hot, est_rows = _observed(df, keys, hot_key_rows)
        split = _split_repeated(base) if hot is None else None
        if split:
            once, again = (x.drop("_uid", "_k") for x in split)
            return once.withColumn(column, F.lit(1)).unionByName(again.withColumn(column, F.row_number().over(w)))
        if hot is None:
            return base.drop("_uid", "_k").withColumn(column, F.row_number().over(w))
        n_parts = _ranges(est_rows, rows_per_task)
        heavy = base.join(hot, "_k", "left_semi").select(*df.columns, "_uid")
        light = base.join(hot, "_k", "left_anti").select(*df.columns).withColumn(column, F.row_number().over(w))
        return light.unionByName(_number_by_range(heavy, keys, [*ordering, F.col("_uid")], column, n_parts).drop("_uid"))
    if hot_keys is not None:
        hot, est_rows = _given_hot_keys(df, keys, hot_keys, rows_per_task)
    else:
        hot, est_rows = _hot_keys(df, keys, hot_key_rows, sample_fraction)
    if hot.isEmpty():
        return df.withColumn(column, F.row_number().over(w))
    # The input is evaluated once more, into a table; the light and the heavy
    # part are read from it. ``_uid`` tells identical rows apart.
    base = materialize(df.withColumn("_uid", F.monotonically_increasing_id()), "marked", "zstd")
    light = base.join(hot, _null_safe_on(base, hot, keys), "left_anti").drop("_uid")
    heavy = base.join(hot, _null_safe_on(base, hot, keys), "left_semi")
    n_parts = _ranges(est_rows, rows_per_task)
    return (light.withColumn(column, F.row_number().over(w))
            .unionByName(_number_by_range(heavy, keys, [*ordering, F.col("_uid")], column, n_parts).drop("_uid")))


def _observed(df: DataFrame, keys: list[str], hot_key_rows: int) -> tuple[DataFrame, DataFrame | None, float]:
    """The input as written (with ``_uid``, which tells identical rows apart, and
    ``_k``, a hash of the key), the hashes of more than ``hot_key_rows`` rows
    (None if there are none) and the estimated number of their rows."""
    seen = Observation()
    top = F.expr(f"approx_top_k(_k, {SKETCH_TOP}, {SKETCH_ITEMS})")
    base = materialize(df.withColumns({"_uid": F.monotonically_increasing_id(), "_k": F.xxhash64(*keys)})
                       .observe(seen, F.count(F.lit(1)).alias("n"), top.alias("top")), "marked", "zstd")
    n, found = seen.get["n"], seen.get["top"] or []
    if n * SKETCH_ERROR / SKETCH_ITEMS > hot_key_rows:
        hot, est = _hot_keys(base, ["_k"], hot_key_rows, None)
        return base, None if hot.isEmpty() else hot, est
    hot = [(r["item"], r["count"]) for r in found if r["count"] >= hot_key_rows]
    if not hot:
        return base, None, 0.0
    return base, df.sparkSession.createDataFrame([(k,) for k, _ in hot], "_k long"), float(sum(n for _, n in hot))


def _hot_keys(df: DataFrame, keys: list[str], hot_key_rows: int,
              sample_fraction: float | None) -> tuple[DataFrame, float]:
    """Keys estimated to hold more than ``hot_key_rows`` rows, from a sample
    of the key columns only (the scan prunes every other column), and the
    estimated number of their rows. There are at most about rows /
    ``hot_key_rows`` such keys; they are written as a table, so Spark knows
    its size and broadcasts or shuffles it accordingly."""
    frac = sample_fraction if sample_fraction is not None else min(1.0, 2000.0 / hot_key_rows)
    min_hits = max(1, int(hot_key_rows * frac))
    hits = materialize(df.select(*keys).sample(fraction=frac, seed=17)
                       .groupBy(*keys).agg(F.count(F.lit(1)).alias("_hits")).filter(F.col("_hits") >= min_hits), "hot-keys")
    est = hits.agg(F.sum("_hits")).first()[0] or 0
    return hits.drop("_hits"), est / frac


def _given_hot_keys(df: DataFrame, keys: list[str], hot_keys, rows_per_task: int) -> tuple[DataFrame, float]:
    """Caller-supplied hot keys; without a sample the number of range
    partitions follows the shuffle partition setting."""
    spark = df.sparkSession
    if isinstance(hot_keys, DataFrame):
        hot_df = hot_keys.select(*keys).distinct()
    else:
        hot_df = spark.createDataFrame([tuple(k) for k in hot_keys], df.select(*keys).schema)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return hot_df, float(parts * rows_per_task)


def _split_repeated(base: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """The rows whose ``_k`` no other row has, and the others; None where the
    latter are too many to be treated apart."""
    seen = Observation()
    counted = base.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("n"))
    repeated = materialize(counted.filter(F.col("_n") > 1), "repeated")
    keys, rows = repeated.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if keys > MAX_REPEATED or (rows or 0) > (seen.get["n"] or 0) * REPEATED_SHARE:
        return None
    few = F.broadcast(repeated.select("_k"))
    return base.join(few, "_k", "left_anti"), base.join(few, "_k", "left_semi")


def _ranges(rows: float, rows_per_task: int) -> int:
    """Number of range partitions. It doesn't follow ``rows_per_task`` beyond
    ``MAX_RANGES``: the bounds of ranges are found on the driver, from sampled
    rows in proportion to their number."""
    return max(2, min(math.ceil(rows / rows_per_task), max(MAX_RANGES, math.ceil(rows / RANGE_ROWS))))


def _number_by_range(heavy: DataFrame, keys: list[str], ordering: list[Column],
                     column: str, n_parts: int) -> DataFrame:
    """Exact ``row_number`` for hot keys without one task per key.

    Range-partition on (keys, ordering) so a hot key spans several tasks, sort
    inside each partition, tag rows with partition id and a position. The
    tagged rows are written as a table so the position and the per-partition counts
    come from one and the same materialisation (a checkpoint would hold them
    unpacked, in several times the room). Row number = rows of the key
    in earlier partitions + position inside the partition.
    """
    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + ordering
    few = n_parts <= FEW_RANGES
    tagged = materialize(heavy.repartitionByRange(n_parts, *sort_cols)
                         .sortWithinPartitions(*sort_cols)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_pos", F.monotonically_increasing_id()), "ranges", "zstd", by="_pid" if few else None)
    if few:
        tagged = reduce(DataFrame.unionByName, [tagged.where(F.col("_pid") == i) for i in range(n_parts)])
    stats = (tagged.groupBy(*keys, "_pid")
             .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    stats = stats.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # One stats row per (hot key, partition it touches): at most
    # hot keys + partitions rows, so the broadcast has a known bound.
    bound = 10 * n_parts + 100_000
    if bounded_rows(stats, bound):
        stats = F.broadcast(stats)
    s = stats.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_pid", "_offset", "_first")
    cond = None
    for k in keys:
        c = tagged[k].eqNullSafe(s[f"_k_{k}"])
        cond = c if cond is None else cond & c
    cond = cond & (tagged["_pid"] == s["_pid"])
    numbered = tagged.join(s, cond).withColumn(
        column, (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("int"))
    return numbered.select(*heavy.columns, column)


def drop_duplicates_latest(df: DataFrame, keys: list[str] | None = None,
                           order: list[str] | str = "sourcets", **kw) -> DataFrame:
    """Keep the newest row per key (``keep="latest"``), drop the number."""
    return mark_duplicates(df, keys, order, keep="latest", **kw).drop(kw.get("column", "rownumber"))
