"""Nested payloads: decode, parse, flatten/explode, encode, JSON documents."""

import base64
import json
import os

from pyspark.sql import functions as F

from kassa.operators import nested
from kassa.schemas import ENVELOPE_SCHEMA, STAGING_COLUMNS, transaction_schema
from kassa.sources.files import read_json_documents


def doc(inv=1, items=None, region="North America "):
    d = {"RetailTxnData": {
        "InvoiceNo": inv, "InvoiceDateTime": "2024-05-06 07:08:09", "StoreNo": 12,
        "StorePos": "#ABC12345678", "Region": region, "StoreCountry": "India",
        "LineItem": items if items is not None else {"StockCode": "123456", "Description": "Mug",
                                                     "Quantity": 2, "UnitPrice": "$1.50",
                                                     "SalePrice": "$3.00"},
        "Customer": {"CustomerID": 7, "Country": "India"},
        "Discount": {"DiscountCode": "ABCDEFG12"},
        "SourceTimestamp": "2024-05-06 07:08:09"}}
    return d


def b64(obj) -> str:
    text = obj if isinstance(obj, str) else json.dumps(obj)
    return base64.b64encode(text.encode()).decode()


def test_decode_parse_flatten(spark):
    env = spark.createDataFrame([("r1", b64(doc())), ("r2", b64("{not json")), ("r3", "@@@")],
                                ENVELOPE_SCHEMA)
    parsed = nested.parse_json(nested.decode_payload(env), transaction_schema())
    valid, bad = nested.split_valid(parsed)
    assert sorted(r.recordId for r in bad.collect()) == ["r2", "r3"]
    flat = nested.flatten(valid.select(F.col("doc.RetailTxnData").alias("RetailTxnData")))
    assert flat.columns == STAGING_COLUMNS
    r = flat.collect()[0]
    assert r.RetailTxnData_InvoiceNo == "1" and r.RetailTxnData_LineItem_Quantity == "2"
    assert r.RetailTxnData_Customer_Country == "India" and r.RetailTxnData_Customer_EmailId is None


def test_explode_items_keeps_empty_and_missing(spark):
    items = [{"StockCode": "1", "Description": "a", "Quantity": 1, "UnitPrice": "1", "SalePrice": "1"},
             {"StockCode": "2", "Description": "b", "Quantity": 2, "UnitPrice": "1", "SalePrice": "2"}]
    texts = [json.dumps(doc(1, items)), json.dumps(doc(2, [])), json.dumps(doc(3, None) | {}),
             json.dumps({"RetailTxnData": {"InvoiceNo": 4}})]
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    parsed = nested.parse_json(df, transaction_schema(line_items_as_array=True))
    flat = nested.flatten(parsed.select(F.col("doc.RetailTxnData").alias("RetailTxnData")))
    got = [(r.RetailTxnData_InvoiceNo, r.RetailTxnData_LineItem_StockCode) for r in flat.collect()]
    # doc 3 has a struct, not an array, for LineItem: it does not fit the array schema
    assert ("1", "1") in got and ("1", "2") in got and ("2", None) in got and ("4", None) in got


def test_nest_flatten_round_trip(spark):
    row = tuple(f"v{i}" for i in range(len(STAGING_COLUMNS)))
    df = spark.createDataFrame([row], ",".join(f"{c} string" for c in STAGING_COLUMNS))
    back = nested.flatten(nested.nest_staging(df))
    assert back.columns == STAGING_COLUMNS and tuple(back.first()) == row


def test_to_json_records_base64_single_line(spark):
    df = spark.createDataFrame([("id1", "x" * 200, None)], "recordId string, a string, b string")
    out = nested.to_json_records(df).first()
    assert out.result == "Ok" and "\n" not in out.data
    assert json.loads(base64.b64decode(out.data)) == {"a": "x" * 200, "b": None}


def test_json_documents_array_and_extension_case(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "sub"))
    with open(os.path.join(tmpdir_path, "a.json"), "w") as f:
        json.dump([doc(1), doc(2)], f)
    with open(os.path.join(tmpdir_path, "sub", "b.JSON"), "w") as f:
        json.dump([doc(3)], f)
    with open(os.path.join(tmpdir_path, "skip.txt"), "w") as f:
        f.write("[]")
    df = read_json_documents(spark, tmpdir_path)
    assert sorted(r.InvoiceNo for r in df.select("RetailTxnData.InvoiceNo").collect()) == ["1", "2", "3"]


def test_failfast_raises_on_malformed(spark):
    import pytest
    df = spark.createDataFrame([("{bad",)], "payload string")
    with pytest.raises(Exception):
        nested.parse_json(df, transaction_schema(), mode="FAILFAST").collect()


def test_base64_text_on_one_line_without_a_search_for_breaks(spark):
    import base64
    from kassa.session import CHUNKED_BASE64, RECOMMENDED_CONF
    texts = ["", "é" * 200, "x" * 57, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    want = [None if t is None else base64.b64encode(t.encode()).decode() for t in texts]
    before = spark.conf.get(CHUNKED_BASE64)
    try:
        for chunked in ("true", RECOMMENDED_CONF[CHUNKED_BASE64]):
            spark.conf.set(CHUNKED_BASE64, chunked)
            out = df.select("id", nested.base64_text(F.col("t")).alias("b"))
            assert [r["b"] for r in out.orderBy("id").collect()] == want
            assert ("replace(" in out._jdf.queryExecution().analyzed().toString()) == (chunked == "true")
    finally:
        spark.conf.set(CHUNKED_BASE64, before)
