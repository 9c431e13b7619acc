"""Room on disk: what a job leaves behind, and what lies there while it runs."""

import glob
import os
import time

from pyspark.sql import functions as F

from kassa import session
from kassa.operators import dedup
from kassa.operators.nested import base64_text
from kassa.plans import batch, queries
from kassa.sinks import stream_files
from kassa.sources import testmap
from kassa.streaming.ingest import start_ingest


def shuffle_files(spark):
    names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return [n for n in names if os.path.basename(n).startswith("shuffle_")]


def folders(spark, name):
    return glob.glob(f"{session.run_folder(spark)}/{name}-*")


def star(spark, at, orders=60):
    """Star schema tables of a few hundred line items."""
    def write(name, sql, n):
        spark.range(n).selectExpr(*sql).coalesce(1).write.mode("overwrite").parquet(f"{at}/{name}.parquet")
    write("region", ["id AS r_regionkey", "concat('R', id) AS r_name"], 2)
    write("nation", ["id AS n_nationkey", "concat('Nation ', id) AS n_name", "id % 2 AS n_regionkey"], 4)
    write("customer", ["id AS c_custkey", "concat('Customer ', id) AS c_name"], 9)
    write("supplier", ["id AS s_suppkey", "id % 4 AS s_nationkey"], 5)
    write("part", ["id AS p_partkey", "concat('part ', id) AS p_name", "id + 0.5D AS p_retailprice"], 11)
    write("orders", ["id AS o_orderkey", "id % 9 AS o_custkey", "date_add(DATE'1995-01-01', CAST(id * 20 AS int)) AS o_orderdate"], orders)
    write("lineitem", ["id DIV 7 AS l_orderkey", "id % 11 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 7 + 1 AS int) AS l_linenumber",
                       "CAST(id % 50 AS double) AS l_quantity", "id * 1.25D AS l_extendedprice", "(id % 10) / 100D AS l_discount",
                       "date_add(DATE'1995-02-01', CAST(id AS int)) AS l_shipdate"], orders * 7)
    return at


def test_shuffle_files_go_when_a_job_ends(spark, tmpdir_path):
    before = set(shuffle_files(spark))
    rows = spark.range(5000).withColumn("x", F.col("id") % 7).repartition(8, "x")
    rows.write.parquet(f"{tmpdir_path}/rows")
    for _ in range(50):
        left = set(shuffle_files(spark)) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and spark.read.parquet(f"{tmpdir_path}/rows").count() == 5000


def test_tables_are_written_packed(spark):
    rows = session.materialize(spark.range(10), "packed")
    assert [f for f in os.listdir(rows.scratch) if f.endswith(".zstd.parquet") or f.endswith(".zst.parquet")]


def test_short_lived_tables_go_with_their_block(spark):
    with session.short_lived() as scratch:
        gone = session.materialize(spark.range(3), "short")
        kept = session.materialize(gone, "short")
        scratch.remove(kept)
    assert not os.path.exists(gone.scratch) and kept.count() == 3
    assert session.materialize(spark.range(1), "short").count() == 1


def test_ranges_are_numbered_without_a_checkpoint(spark):
    rows = spark.range(3000).selectExpr("CAST(id % 3 AS string) AS k", "CAST(id % 100 AS string) AS ts", "id AS v")
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/*/rdd-*"))
    got = dedup.mark_duplicates(rows, ["k"], "ts", hot_key_rows=100, rows_per_task=500)
    want = dedup.mark_duplicates(rows, ["k"], "ts", skew="off")
    assert got.exceptAll(want).count() == 0 and got.count() == 3000
    assert set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/*/rdd-*")) == before


def test_load_leaves_no_marked_rows(spark, tmpdir_path):
    d = star(spark, f"{tmpdir_path}/star")
    before = set(folders(spark, "marked")) | set(folders(spark, "repeated"))
    summary = batch.load_job(spark, queries.staged(spark, d), *testmap.dims(spark, d), f"{tmpdir_path}/curated", on_ambiguous="latest")
    assert summary.agg(F.sum("total_quantity")).first()[0] == queries.staged(spark, d).agg(
        F.sum(F.col("RetailTxnData_LineItem_Quantity").cast("double"))).first()[0]
    assert set(folders(spark, "marked")) | set(folders(spark, "repeated")) == before


def archive_rows(spark, n, payload="p"):
    return spark.range(n).selectExpr("concat('k', id) AS archive_key", "if(id % 2 = 0, 'N', 'S') AS Region", "CAST(id % 3 AS string) AS StoreNo",
                                     "'2020-01-01' AS invoiceprocess_date", "CAST(if(id < 6, 0, id) AS string) AS InvoiceNo",
                                     f"concat('{payload}', id) AS payload", "CAST(id % 4 AS string) AS arrival")


def test_only_repeated_archive_rows_are_ranked(spark):
    rows = session.materialize(archive_rows(spark, 400).unionByName(archive_rows(spark, 3, "q")), "rows")
    got, want = stream_files.archive_latest(rows, written=True), stream_files.archive_latest(rows)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() < 403
    sent = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in sent and "LeftAnti" in sent


def test_compaction_merges_some_buckets_at_a_time(spark, tmpdir_path, monkeypatch):
    real, calls = stream_files.write_partitioned, []
    monkeypatch.setattr(stream_files, "write_partitioned", lambda *a, **kw: (calls.append(1), real(*a, **kw)))
    monkeypatch.setattr(stream_files, "MERGE_BYTES", 1)
    for n in range(2):
        stream_files.write_archive_batch(archive_rows(spark, 100 + 20 * n, f"b{n}-"), f"{tmpdir_path}/archive", n, "r")
        assert stream_files.compact_archive(spark, f"{tmpdir_path}/archive", f"{tmpdir_path}/state", 4) == 1
    assert len(calls) == 8
    got = stream_files.read_archive_compacted(spark, f"{tmpdir_path}/state")
    want = stream_files.read_archive_latest(spark, f"{tmpdir_path}/archive").select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_bounded_batches_consume_their_records(spark, tmpdir_path):
    text = F.concat(F.lit('{"RetailTxnData":{"InvoiceNo":"'), F.col("id").cast("string"),
                    F.lit('","InvoiceDateTime":"2020-01-01 00:00:00","StoreNo":"1","Region":"N","LineItem":{"StockCode":"7"}}}'))
    records = spark.range(300).select(F.col("id").cast("string").alias("recordId"), F.lit("2020-01-02").alias("arrival"), base64_text(text).alias("data"))
    records.repartition(6).write.json(f"{tmpdir_path}/src")
    out = [f"{tmpdir_path}/{x}" for x in ("archive", "stage", "quarantine", "ckpt")]
    start_ingest(spark, f"{tmpdir_path}/src", *out, max_bytes=1, consume=True).awaitTermination()
    staged = spark.read.parquet(out[1])
    assert staged.select("batch_id").distinct().count() == 6
    assert staged.select("RetailTxnData_InvoiceNo").distinct().count() == 300 == staged.count()
    for _ in range(50):
        left = glob.glob(f"{tmpdir_path}/src/*.json")
        if len(left) <= 1:
            break
        time.sleep(0.2)
    assert len(left) <= 1  # those of the last batch


def test_files_between_steps_are_packed(spark, tmpdir_path, monkeypatch):
    d = star(spark, f"{tmpdir_path}/star")
    scratch = f"{tmpdir_path}/scratch"
    monkeypatch.setattr(queries, "scratch_path", lambda s, name: f"{scratch}/{name}")
    monkeypatch.setattr(queries, "FILE_RECORDS", 50)
    assert queries.q_files_round_trip(spark, d).count() == 420
    lines = glob.glob(f"{scratch}/files/deep/lines/part-*")
    assert len(lines) > 4 and all(f.endswith(".json.gz") for f in lines)
    got = queries.q_json_array_split(spark, d)
    want = queries.staged(spark, d).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == 420
    arrays = glob.glob(f"{scratch}/arrays/part-*")
    assert arrays and all(f.endswith(".txt.gz") for f in arrays)


def test_records_go_once_ingested(spark, tmpdir_path, monkeypatch):
    d = star(spark, f"{tmpdir_path}/star")
    paths = []
    monkeypatch.setattr(queries, "scratch_path", lambda s, name: paths.append(f"{tmpdir_path}/{len(paths)}/{name}") or paths[-1])
    before = set(folders(spark, "staged")) | set(folders(spark, "envelopes"))
    assert queries.q_ingest_staged(spark, d).count() > 420
    assert queries.q_ingest_native_sink(spark, d).count() == 420
    assert queries.q_archive_from_publish(spark, d).count() > 0
    copies = [p for p in paths if p.endswith(("/records", "/published"))]
    assert len(copies) == 2 and not any(os.path.exists(p) for p in copies)
    n = queries.q_raw_archive_latest(spark, d).count()
    assert n > 0 and set(folders(spark, "staged")) | set(folders(spark, "envelopes")) == before
