"""Duplicate marks: reference semantics, determinism, and the hot-key path."""

from pyspark.sql import functions as F

from kassa.operators.dedup import mark_duplicates

KEYS = ["k1", "k2"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k1 string, k2 long, ts string, v long, w string")


def test_marks_do_not_filter(spark):
    rows = [("a", 1, "2024-01-02", 1, "x"), ("a", 1, "2024-01-03", 2, "y"),
            ("a", 1, "2024-01-01", 3, "z"), ("b", 2, "2024-01-01", 4, "q")]
    out = mark_duplicates(frame(spark, rows), KEYS, "ts", skew="off")
    got = {r.v: r.rownumber for r in out.collect()}
    assert got == {2: 1, 1: 2, 3: 3, 4: 1}


def test_ties_broken_by_other_columns(spark):
    rows = [("a", 1, "t", 2, "b"), ("a", 1, "t", 1, "a"), ("a", 1, "t", 1, "b")]
    out = mark_duplicates(frame(spark, rows), KEYS, "ts", skew="off")
    got = sorted((r.rownumber, r.v, r.w) for r in out.collect())
    assert got == [(1, 1, "a"), (2, 1, "b"), (3, 2, "b")]


def test_null_keys_form_one_group(spark):
    rows = [(None, None, "1", 1, "a"), (None, None, "2", 2, "a")]
    out = mark_duplicates(frame(spark, rows), KEYS, "ts", skew="off")
    assert sorted((r.v, r.rownumber) for r in out.collect()) == [(1, 2), (2, 1)]


def test_keep_latest(spark):
    rows = [("a", 1, "1", 1, "a"), ("a", 1, "3", 2, "a"), ("b", 1, "2", 3, "a")]
    out = mark_duplicates(frame(spark, rows), KEYS, "ts", keep="latest")
    assert sorted(r.v for r in out.collect()) == [2, 3]


def test_hot_key_path_equals_plain_window(spark):
    # one key holds ~45% of the rows, a NULL-keyed group another share
    df = spark.range(20000).select(
        F.when(F.col("id") % 20 < 9, F.lit("hot")).when(F.col("id") % 20 == 9, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k1"),
        F.when(F.col("id") % 20 < 10, F.lit(1)).otherwise(F.col("id") % 3).alias("k2"),
        (F.col("id") % 101).cast("string").alias("ts"),
        F.col("id").alias("v"),
        (F.col("id") % 7).cast("string").alias("w"))
    plain = mark_duplicates(df, KEYS, "ts", skew="off")
    split = mark_duplicates(df, KEYS, "ts", hot_key_rows=500, sample_fraction=0.2,
                            rows_per_task=2000)
    a = sorted(tuple(str(x) for x in r) for r in plain.collect())
    b = sorted(tuple(str(x) for x in r) for r in split.collect())
    assert len(b) == 20000 and a == b
    hot = split.filter(F.col("k1") == "hot").agg(F.min("rownumber"), F.max("rownumber")).first()
    assert tuple(hot) == (1, 9000)


def test_hot_key_path_is_used(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k1"), F.lit(1).cast("long").alias("k2"),
                                  F.col("id").cast("string").alias("ts"), F.col("id").alias("v"),
                                  F.lit("x").alias("w"))
    out = mark_duplicates(df, KEYS, "ts", hot_key_rows=100, sample_fraction=0.5, rows_per_task=1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan
    assert sorted(r.rownumber for r in out.collect()) == list(range(1, 5001))


def test_given_hot_keys_skip_sampling(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, F.lit("NaN")).otherwise(F.col("id").cast("string")).alias("k1"),
        F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).cast("long").alias("k2"),
        (F.col("id") % 50).cast("string").alias("ts"), F.col("id").alias("v"), F.lit("x").alias("w"))
    plain = mark_duplicates(df, KEYS, "ts", skew="off")
    given = mark_duplicates(df, KEYS, "ts", hot_keys=[("NaN", -1)], rows_per_task=500)
    assert "Union" in given._jdf.queryExecution().executedPlan().toString()
    a = sorted(tuple(str(x) for x in r) for r in plain.collect())
    b = sorted(tuple(str(x) for x in r) for r in given.collect())
    assert a == b


def test_identical_rows_spread_over_partitions(spark):
    df = spark.range(8000).select(F.lit("hot").alias("k1"), F.lit(1).cast("long").alias("k2"), F.lit("t").alias("ts"),
                                  F.lit(1).cast("long").alias("v"), F.lit("x").alias("w"))
    out = mark_duplicates(df, KEYS, "ts", hot_key_rows=100, sample_fraction=0.5, rows_per_task=1000)
    assert sorted(r.rownumber for r in out.collect()) == list(range(1, 8001))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 4000


def test_many_hot_keys_all_take_the_range_path(spark):
    df = spark.range(30000).select((F.col("id") % 12000).cast("string").alias("k1"), F.lit(1).cast("long").alias("k2"),
                                   F.col("id").cast("string").alias("ts"), F.lit(1).cast("long").alias("v"), F.lit("x").alias("w"))
    plain = mark_duplicates(df, KEYS, "ts", skew="off")
    split = mark_duplicates(df, KEYS, "ts", hot_key_rows=1, sample_fraction=1.0, rows_per_task=5000)
    assert plain.exceptAll(split).count() == 0 and split.count() == 30000


def test_hot_keys_are_observed_in_one_evaluation(spark):
    """The input is evaluated once, with and without hot keys, and the marks
    are those of the plain window."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    df = spark.range(0, 20000, numPartitions=4).select(
        F.when(F.col("id") % 20 < 9, F.lit("hot")).when(F.col("id") % 20 == 9, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k1"), (F.col("id") % 20 < 10).cast("long").alias("k2"),
        (F.col("id") % 101).cast("string").alias("ts"), F.col("id").alias("v"), F.lit("x").alias("w"))
    want = sorted(tuple(map(str, r)) for r in mark_duplicates(df, KEYS, "ts", skew="off").collect())
    for hot_key_rows in (500, 50_000):
        seen.value = 0
        out = mark_duplicates(df.mapInPandas(counted, df.schema), KEYS, "ts", hot_key_rows=hot_key_rows, rows_per_task=2000)
        assert ("Union" in out._jdf.queryExecution().executedPlan().toString()) == (hot_key_rows == 500)
        assert sorted(tuple(map(str, r)) for r in out.collect()) == want
        assert seen.value == 20000


def test_coarse_sketch_counts_the_written_keys(spark, monkeypatch):
    from kassa.operators import dedup
    monkeypatch.setattr(dedup, "SKETCH_ERROR", 4096 * 4096)
    df = spark.range(6000).select((F.col("id") % 7).cast("string").alias("k1"), F.lit(1).cast("long").alias("k2"),
                                  F.col("id").cast("string").alias("ts"), F.lit(1).cast("long").alias("v"), F.lit("x").alias("w"))
    plain = mark_duplicates(df, KEYS, "ts", skew="off")
    split = mark_duplicates(df, KEYS, "ts", hot_key_rows=100, rows_per_task=1000)
    assert "Union" in split._jdf.queryExecution().executedPlan().toString()
    assert plain.exceptAll(split).count() == 0 and split.count() == 6000


def test_observed_marks_of_an_empty_table(spark):
    assert mark_duplicates(frame(spark, []), KEYS, "ts").count() == 0


def test_number_of_ranges_is_bounded(spark, monkeypatch):
    """However small ``rows_per_task``, the driver samples for a bounded number
    of ranges, and the marks stay those of the plain window."""
    from kassa.operators import dedup
    assert dedup._ranges(36_000_000, 2000) == dedup.MAX_RANGES
    assert dedup._ranges(20_000_000_000, 2000) == 5000 and dedup._ranges(10, 2000) == 2
    ranges, real = [], type(spark.range(1)).repartitionByRange

    def kept(df, n, *cols):
        ranges.append(n)
        return real(df, n, *cols)
    monkeypatch.setattr(dedup, "MAX_RANGES", 4)
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", kept)
    df = spark.range(3000).select((F.col("id") % 3).cast("string").alias("k1"), F.lit(1).cast("long").alias("k2"),
                                  (F.col("id") % 50).cast("string").alias("ts"), F.col("id").alias("v"), F.lit("x").alias("w"))
    split = mark_duplicates(df, KEYS, "ts", hot_key_rows=10, rows_per_task=10)
    plain = mark_duplicates(df, KEYS, "ts", skew="off")
    assert plain.exceptAll(split).count() == 0 and split.count() == 3000
    assert ranges == [4]


def _some_repeated(spark, share):
    """Keys of which ``share`` percent of the rows have one that comes twice,
    some of them NULL, and rows that are the same in full."""
    odd = F.col("id") % 100 < share
    return spark.range(4000).select(
        F.when(odd & (F.col("id") % 100 == 0), F.lit(None)).when(odd, (F.col("id") % 50).cast("string"))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k1"), F.lit(1).cast("long").alias("k2"),
        (F.col("id") % 7).cast("string").alias("ts"), (F.col("id") % 3).alias("v"), F.lit("x").alias("w"))


def test_only_repeated_keys_are_ranked(spark):
    """Rows alone with their key stay where they lie; the marks and the latest
    rows are those of the plain window, with few and with many repeated keys."""
    from kassa.session import materialize
    for share in (0, 5, 60):
        df = materialize(_some_repeated(spark, share), "some-repeated")
        plain = mark_duplicates(df, KEYS, "ts", skew="off")
        got = mark_duplicates(df, KEYS, "ts")
        assert plain.exceptAll(got).count() == 0 and got.count() == 4000
        assert got.schema["rownumber"].dataType == plain.schema["rownumber"].dataType
        latest = mark_duplicates(df, KEYS, "ts", keep="latest", written=True)
        want = plain.filter("rownumber = 1")
        assert latest.exceptAll(want).count() == 0 and latest.count() == want.count()
        for frame in (got, latest):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert ("LeftAnti" in plan and "Union" in plan) == (share < 60)
    none = materialize(_some_repeated(spark, 5).limit(0), "none")
    assert mark_duplicates(none, KEYS, "ts", keep="latest", written=True).count() == 0
