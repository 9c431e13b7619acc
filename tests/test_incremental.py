"""Incremental load, Spark's own file sink, split array files, order on disk."""

import json
import os

import pytest
from pyspark.sql import functions as F

from kassa.plans.incremental import load_incremental
from kassa.plans.queries import staged
from kassa.schemas import STAGING_SCHEMA
from kassa.sinks.ordered import read_ordered, write_ordered
from kassa.sources import testmap
from kassa.sources.files import read_json_arrays_split, read_json_documents, read_json_lines, read_csv
from kassa.streaming.ingest import start_native_ingest

SF = "/root/testdata/sf0.001"


def test_only_new_files_are_loaded(spark, tmpdir_path):
    st, dims = staged(spark, SF).limit(400).cache(), testmap.dims(spark, SF)
    paths = [os.path.join(tmpdir_path, x) for x in ("target", "summary", "ckpt")]

    def load():
        q = load_incremental(spark, os.path.join(tmpdir_path, "stage"), dims, *paths, money="decimal", on_ambiguous="latest")
        q.awaitTermination()
        return {d: spark.read.parquet(os.path.join(paths[1], d)).agg(F.sum("total_quantity")).first()[0]
                for d in os.listdir(paths[1]) if d.startswith("batch_id")}

    def quantity(rows):
        return rows.agg(F.sum(F.col("RetailTxnData_LineItem_Quantity").cast("double"))).first()[0]
    first, second = st.filter("RetailTxnData_InvoiceNo % 2 = 0"), st.filter("RetailTxnData_InvoiceNo % 2 = 1")
    first.write.parquet(os.path.join(tmpdir_path, "stage", "a"))
    assert load() == {"batch_id=0": quantity(first)}
    second.write.parquet(os.path.join(tmpdir_path, "stage", "deeper", "b"))
    both = {"batch_id=0": quantity(first), "batch_id=1": quantity(second)}  # the second batch is the new drop alone
    assert load() == both and load() == both
    rows = spark.read.parquet(paths[0])
    keys = ["invoiceno", "storeno", "lineitem_stockcode", "invoicedate", "region"]
    assert rows.count() == rows.select(*keys).distinct().count()


def test_native_sink_stages_once(spark, tmpdir_path):
    src, out, ckpt = (os.path.join(tmpdir_path, x) for x in ("src", "out", "ckpt"))
    st = staged(spark, SF).limit(300).cache()
    for part in (0, 1):
        testmap.envelopes(st.filter(F.col("RetailTxnData_StorePos").cast("int") % 2 == part)).repartition(3).write.mode("append").json(src)
        start_native_ingest(spark, src, out, ckpt, max_files=1).awaitTermination()
    st.limit(5).write.mode("append").parquet(out + "-other")
    leftover = next(f for f in os.listdir(out + "-other") if f.endswith(".parquet"))
    with open(os.path.join(out + "-other", leftover), "rb") as a, open(os.path.join(out, "part-of-a-failed-batch.parquet"), "wb") as b:
        b.write(a.read())  # not in the commit log, so no reader sees it
    got = spark.read.schema(STAGING_SCHEMA).parquet(out)
    assert got.exceptAll(st).count() == 0 and got.count() == st.count()


def array_file(path, n):
    docs = [{"RetailTxnData": {"InvoiceNo": str(i), "Region": 'a }, {"x" ] [ ' + "é" * (i % 5), "Customer": {"FirstName": "{\"RetailTxnData\""}}} for i in range(n)]
    with open(path, "w") as f:
        f.write("[" + ",\n ".join(json.dumps(d, separators=(",", ":"), ensure_ascii=False) for d in docs) + "]\n")


def test_one_array_file_is_read_by_several_tasks(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "big.json")
    array_file(path, 4000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        rows = read_json_arrays_split(spark, path)
        assert rows.rdd.getNumPartitions() > 5
        whole = read_json_documents(spark, path)
        assert rows.exceptAll(whole).count() == 0 and rows.count() == whole.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_split_arrays_report_bad_elements(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "bad.json")
    with open(path, "w") as f:
        f.write('[{"RetailTxnData":{"InvoiceNo":"1"}},\n{"RetailTxnData":{"InvoiceNo":"2"},]')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_arrays_split(spark, path).collect()
    rows = read_json_arrays_split(spark, path, mode="PERMISSIVE").collect()
    assert [r["_corrupt_record"] is None for r in rows] == [True, False]


def test_recursive_lines_and_inferred_csv(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "a", "b"))
    for name in ("a/x.JSON", "a/b/y.json"):
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write('{"RetailTxnData":{"InvoiceNo":"1"}}\n')
    assert read_json_lines(spark, tmpdir_path).count() == 2
    with open(os.path.join(tmpdir_path, "tax.csv"), "w") as f:
        f.write("country,rate,since\nfr,0.2,2020-01-01\nde,0.19,2021-01-01\n")
    assert read_csv(spark, os.path.join(tmpdir_path, "tax.csv")).dtypes == [("country", "string"), ("rate", "double"), ("since", "date")]


def test_order_is_read_back(spark, tmpdir_path):
    df = spark.range(5000).select((F.hash("id") % 1000).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered(df.repartition(7), tmpdir_path + "/o", F.col("k").desc(), F.col("id"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = sorted(read_ordered(spark, tmpdir_path + "/o").collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(5000))
    assert [(r.k, r.id) for r in rows] == sorted(((r.k, r.id) for r in rows), key=lambda x: (-x[0], x[1]))
    assert len([f for f in os.listdir(tmpdir_path + "/o") if f.endswith(".parquet")]) > 1
