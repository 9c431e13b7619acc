"""MERGE as anti join + union, and the partition-aware upsert on disk."""

import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from kassa.operators.merge import merge_frames
from kassa.sinks.bucketed import co_located, create_bucketed, merge_bucketed
from kassa.sinks.tables import bucket_column, read_table, table_exists, upsert_partitioned, with_key_bucket

SCHEMA = "k long, region string, invoice_year int, v string, sourcets string"
KEYS = ["k", "region"]
PARTS = ["region", "invoice_year"]


def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(frame):
    return sorted(tuple(str(x) for x in r) for r in frame.select("k", "region", "invoice_year", "v",
                                                                  "sourcets").collect())


def test_matched_unmatched_untouched(spark):
    t = df(spark, [(1, "A", 2020, "old", "1"), (2, "A", 2020, "keep", "1"), (3, "B", 2021, "x", "1")])
    u = df(spark, [(1, "A", 2020, "new", "2"), (4, "B", 2021, "ins", "2")])
    out = merge_frames(t, u, KEYS)
    assert rows_of(out) == sorted([("1", "A", "2020", "new", "2"), ("2", "A", "2020", "keep", "1"),
                                   ("3", "B", "2021", "x", "1"), ("4", "B", "2021", "ins", "2")])


def test_null_key_never_matches_unless_null_safe(spark):
    t = df(spark, [(None, "A", 2020, "old", "1")])
    u = df(spark, [(None, "A", 2020, "new", "2")])
    assert len(rows_of(merge_frames(t, u, KEYS))) == 2
    assert rows_of(merge_frames(t, u, KEYS, null_safe=True)) == [("None", "A", "2020", "new", "2")]


def test_ambiguous_source_rows(spark):
    t = df(spark, [(1, "A", 2020, "old", "1")])
    u = df(spark, [(1, "A", 2020, "n1", "2"), (1, "A", 2020, "n2", "3")])
    with pytest.raises(ValueError):
        merge_frames(t, u, KEYS)
    assert rows_of(merge_frames(t, u, KEYS, on_ambiguous="latest")) == [("1", "A", "2020", "n2", "3")]
    # several source rows with a key absent from the target are plain inserts
    t2 = df(spark, [(9, "A", 2020, "old", "1")])
    assert len(rows_of(merge_frames(t2, u, KEYS))) == 3


def test_empty_updates_and_column_check(spark):
    t = df(spark, [(1, "A", 2020, "old", "1")])
    assert rows_of(merge_frames(t, df(spark, []), KEYS)) == [("1", "A", "2020", "old", "1")]
    with pytest.raises(ValueError):
        merge_frames(t, t.drop("v"), KEYS)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from("AB")), max_size=8, unique=True),
       st.lists(st.tuples(st.integers(0, 6), st.sampled_from("AB")), max_size=8, unique=True))
def test_merge_matches_dict_model(spark, target_keys, update_keys):
    t = [(k, r, 2020, f"t{k}{r}", "1") for k, r in target_keys]
    u = [(k, r, 2020, f"u{k}{r}", "2") for k, r in update_keys]
    model = {(k, r): row for (k, r, *_), row in ((x, x) for x in t)}
    model.update({(k, r): row for (k, r, *_), row in ((x, x) for x in u)})
    want = sorted(tuple(str(x) for x in row) for row in model.values())
    got = rows_of(merge_frames(df(spark, t), df(spark, u), KEYS))
    assert got == want
    # idempotent: merging the same updates again changes nothing
    again = merge_frames(merge_frames(df(spark, t), df(spark, u), KEYS), df(spark, u), KEYS)
    assert rows_of(again) == want


def test_upsert_on_disk(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "curated")
    first = df(spark, [(1, "A", 2020, "a1", "1"), (2, "B", 2020, "b2", "1"),
                       (3, None, 2021, "n3", "1")])
    keys = KEYS + ["invoice_year"]  # partition columns follow from the key
    assert upsert_partitioned(spark, first, path, keys, PARTS) == "created"
    upd = df(spark, [(1, "A", 2020, "a1-new", "2"), (5, "A", 2020, "a5", "2")])
    assert upsert_partitioned(spark, upd, path, keys, PARTS) == "merged"
    got = rows_of(spark.read.parquet(path))
    # partition B and the NULL-region partition are untouched and still there
    assert got == sorted([("1", "A", "2020", "a1-new", "2"), ("5", "A", "2020", "a5", "2"),
                          ("2", "B", "2020", "b2", "1"), ("3", "None", "2021", "n3", "1")])
    # rerun of the same update is idempotent
    upsert_partitioned(spark, upd, path, keys, PARTS)
    assert rows_of(spark.read.parquet(path)) == got


def test_upsert_refuses_keys_that_do_not_fix_the_partition(spark, tmpdir_path):
    with pytest.raises(ValueError):
        upsert_partitioned(spark, df(spark, [(1, "A", 2020, "a", "1")]), os.path.join(tmpdir_path, "t"), ["k"], PARTS)


def test_moving_rows_replace_old_and_new_in_one_overwrite(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "moving")
    first = df(spark, [(1, "A", 2020, "a", "1"), (2, "B", 2020, "b", "1"), (3, "C c/%:", 2021, "c", "1"), (4, None, 2021, "n", "1"),
                       (5, "", 2021, "blank", "1"), (6, "A", None, "y", "1")])
    assert upsert_partitioned(spark, first, path, ["k"], PARTS, key_buckets=8) == "created"
    files = {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    moved = df(spark, [(1, "B", 2020, "moved", "2"), (4, "C c/%:", 2021, "moved", "2")])
    want = sorted([("1", "B", "2020", "moved", "2"), ("2", "B", "2020", "b", "1"), ("3", "C c/%:", "2021", "c", "1"),
                   ("4", "C c/%:", "2021", "moved", "2"), ("5", "None", "2021", "blank", "1"), ("6", "A", "None", "y", "1")])
    for _ in range(2):  # the second time changes nothing
        assert upsert_partitioned(spark, moved, path, ["k"], PARTS, key_buckets=8) == "merged"
        assert rows_of(read_table(spark, path, first.schema)) == want
    touched = {r[0] for r in with_key_bucket(moved, ["k"], 8).select(bucket_column(8)).distinct().collect()}
    kept = [f for f in files if int(f.split("key_bucket_of_8=")[1].split("/")[0]) not in touched]
    assert kept and all(os.path.exists(f) for f in kept)  # other buckets aren't rewritten
    with pytest.raises(ValueError):  # another number of buckets would miss the old rows
        upsert_partitioned(spark, moved, path, ["k"], PARTS, key_buckets=16)


def test_files_of_a_key_bucketed_table_are_sorted(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sorted")
    rows = df(spark, [(i, "ABC"[i % 3], 2020 + i % 2, str(i), "1") for i in range(300)])
    upsert_partitioned(spark, rows, path, ["k"], PARTS, key_buckets=2)
    for d, _, names in os.walk(path):
        for f in names:
            if f.endswith(".parquet"):
                got = [tuple(r) for r in spark.read.parquet(os.path.join(d, f)).select(*PARTS).collect()]
                assert got == sorted(got)


@pytest.mark.parametrize("null_safe", [False, True])
def test_bucketed_merge(spark, tmpdir_path, null_safe):
    name = "bucketed_t" + str(null_safe).lower()
    first = df(spark, [(i, "ABC"[i % 3], 2020, "old", "1") for i in range(60)] + [(None, "A", 2020, "null", "1")])
    create_bucketed(first, name, 4, ["k", "region"], ["region"], os.path.join(tmpdir_path, "t"))
    updates = df(spark, [(i, "AB"[i % 2], 2021, "new", "2") for i in range(0, 90, 7)] + [(None, "A", 2020, "null", "2")])
    for _ in range(1 if not null_safe else 2):
        merge_bucketed(spark, updates, name, ["k", "region"], ["region"], null_safe=null_safe)
    got = rows_of(spark.table(name).select(*first.columns))
    assert got == rows_of(merge_frames(first, updates, ["k", "region"], null_safe))
    with pytest.raises(ValueError):
        merge_bucketed(spark, updates.unionByName(updates), name, ["k", "region"], ["region"])


def test_bucketed_merge_does_not_shuffle_the_target(spark, tmpdir_path):
    """Exchanges stand over the updates only, also with more shuffle
    partitions than buckets."""
    first = df(spark, [(i, "A", 2020, "old", "1") for i in range(50)])
    create_bucketed(first, "bucketed_plan", 4, ["k", "region"], ["region"], os.path.join(tmpdir_path, "t"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with co_located(spark):
            merged = merge_frames(spark.table("bucketed_plan"), first, ["k", "region"], on_ambiguous="allow", dealt=(4, ["k"]))
            plan = merged._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    scan = next(i for i, line in enumerate(plan) if "bucketed_plan" in line and "Scan parquet" in line)
    assert "Bucketed: true" in plan[scan]
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    level, above = depth(plan[scan]), []
    for line in reversed(plan[:scan]):  # the operators that the scan's rows pass
        if depth(line) < level:
            level = depth(line)
            above.append(line)
    assert any("LeftAnti" in line for line in above) and not any("Exchange" in line for line in above)
    assert sum("Exchange hashpartitioning" in line for line in plan) >= 1


ALL = KEYS + ["invoice_year"]


def test_blank_and_null_partitions_lose_nothing(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "blank")
    upsert_partitioned(spark, df(spark, [(1, "", 2020, "a", "1"), (2, "A", 2020, "b", "1"), (7, None, None, "c", "1")]), path, ALL, PARTS)
    upsert_partitioned(spark, df(spark, [(9, "", 2020, "x", "2"), (3, "A", 2020, "y", "2"), (7, "", None, "z", "2")]), path, ALL, PARTS,
                       null_safe=True)
    got = rows_of(read_table(spark, path, df(spark, []).schema))
    assert got == sorted([("1", "None", "2020", "a", "1"), ("2", "A", "2020", "b", "1"), ("9", "None", "2020", "x", "2"),
                          ("3", "A", "2020", "y", "2"), ("7", "None", "None", "z", "2")])


@pytest.mark.parametrize("regions", [("01", "02"), ("NaN", "B"), (None, "B"), ("", "1.0")])
def test_partition_values_keep_their_type(spark, tmpdir_path, regions):
    path = os.path.join(tmpdir_path, "typed")
    upsert_partitioned(spark, df(spark, [(1, regions[0], None, "a", "1")]), path, ALL, PARTS)
    upsert_partitioned(spark, df(spark, [(1, regions[0], None, "a2", "2"), (2, regions[1], 2021, "b", "2")]), path, ALL, PARTS, null_safe=True)
    assert rows_of(read_table(spark, path, df(spark, []).schema)) == sorted([
        ("1", str(regions[0] or None), "None", "a2", "2"), ("2", str(regions[1]), "2021", "b", "2")])


def test_leftovers_of_a_failed_first_load_are_no_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "left")
    os.makedirs(os.path.join(path, "_temporary", "0"))
    open(os.path.join(path, "_temporary", "0", "part-0.parquet"), "w").close()
    assert not table_exists(spark, path)
    assert upsert_partitioned(spark, df(spark, [(1, "A", 2020, "a", "1")]), path, ALL, PARTS) == "created"
    assert table_exists(spark, path)


def test_upserts_leave_no_scratch(spark, tmpdir_path):
    base = spark.conf.get("spark.checkpoint.dir")
    path, before = os.path.join(tmpdir_path, "scratch"), set(os.listdir(base))
    for v in "ab":
        upsert_partitioned(spark, df(spark, [(1, "A", 2020, v, "1")]), path, ALL, PARTS)
    assert set(os.listdir(base)) == before


def test_pruned_merge_joins_touched_values_only(spark):
    """Target rows of regions without updates take no part in the join; NULL
    keys stay and come again."""
    schema = "id long, region string, v string"
    target = spark.createDataFrame([(1, "a", "old"), (2, "a", "old"), (3, "b", "old"), (None, "a", "old"), (4, None, "old"), (5, "", "old")], schema)
    updates = spark.createDataFrame([(1, "a", "new"), (None, "a", "new"), (4, None, "new"), (6, "c", "new"), (3, "a", "new")], schema)
    for null_safe in (False, True):
        plain = merge_frames(target, updates, ["id", "region"], null_safe)
        pruned = merge_frames(target, updates, ["id", "region"], null_safe, prune=["region"])
        key = lambda r: tuple(map(str, r))
        assert sorted(map(key, pruned.collect())) == sorted(map(key, plain.collect()))
    none = merge_frames(target, updates.limit(0), ["id", "region"], prune=["region"])
    assert none.count() == 6
    with pytest.raises(ValueError):
        merge_frames(target, updates, ["id", "region"], prune=["v"])


def test_written_updates_are_not_written_again(spark, tmpdir_path, monkeypatch):
    from kassa.session import materialize
    from kassa.sinks import tables
    names, real = [], tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df, name, *more: names.append(name) or real(df, name, *more))
    rows = materialize(spark.createDataFrame([(1, "a", 2020, "x", "1"), (1, "a", 2020, "y", "2")],
                                             "id long, region string, invoice_year int, v string, sourcets string"), "rows")
    path = os.path.join(tmpdir_path, "t")
    for _ in range(2):
        tables.upsert_partitioned(spark, rows, path, ["id", "region", "invoice_year"], on_ambiguous="latest", written=True)
    assert names == [] and [r.v for r in spark.read.parquet(path).collect()] == ["y"]
