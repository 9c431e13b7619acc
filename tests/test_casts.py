"""Lenient casts give the non-ANSI result in both ANSI modes."""

from pyspark.sql import functions as F

from kassa.functions import casts

PROBES = ["5", " 5 ", "12.0", "12.9", "-3.7", "+5", ".5", "-.5", "5.", "1e3", "NaN", "abc", "",
          "99999999999999999999", "9223372036854775807", "-9223372036854775808", "1.2.3",
          "+", "-", ".", None]


def test_lenient_long_matches_non_ansi_cast(spark, ansi):
    df = spark.createDataFrame([(p,) for p in PROBES], "s string")
    got = [r[0] for r in df.select(casts.lenient_long("s")).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    want = [r[0] for r in df.select(F.trim("s").cast("bigint")).collect()]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    assert got == want


def test_lenient_double_and_float(spark, ansi):
    df = spark.createDataFrame([("1e3",), (" 2.5 ",), ("NaN",), ("abc",), ("",), (None,)], "s string")
    got = [tuple(r) for r in df.select(casts.lenient_double("s"), casts.lenient_float("s")).collect()]
    assert got[0] == (1000.0, 1000.0)
    assert got[1] == (2.5, 2.5)
    assert got[2][0] != got[2][0]  # NaN
    assert got[3:] == [(None, None)] * 3


def test_money(spark, ansi):
    df = spark.createDataFrame([("$99.99",), ("$1,234.50",), (" $ 5 ",), ("12",), (None,)], "s string")
    rows = df.select(casts.money("s", "float").alias("f"),
                     casts.money("s", "decimal").cast("string").alias("d")).collect()
    assert abs(rows[0].f - 99.99) < 1e-4 and rows[0].d == "99.99"
    assert rows[1].f is None and rows[1].d is None  # thousands separator not handled
    assert rows[2].f == 5.0 and rows[2].d == "5.00"
    assert rows[3].d == "12.00"
    assert rows[4].f is None


def test_timestamp(spark, ansi):
    df = spark.createDataFrame([("2024-01-31 10:11:12",), (" 2024-01-31 ",), ("31/01/2024",), ("",)],
                               "s string")
    got = [r[0] for r in df.select(casts.lenient_timestamp("s").cast("string")).collect()]
    assert got == ["2024-01-31 10:11:12", "2024-01-31 00:00:00", None, None]


def test_sql_functions_agree_with_the_column_expressions(spark, ansi):
    from kassa.functions import sql
    from kassa.functions.casts import lenient_double, lenient_long, money
    sql.register(spark, tables=False)
    values = ["12", " 12.9 ", "-3.7", "+4", "1e3", ".5", "5.", ".", "-", "+.5", "", "abc", None, "99999999999999999999", "$12.50", "$1,234.50", "NaN"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    rows = df.selectExpr("x", "kassa_long(x) AS l", "kassa_double(x) AS d", "kassa_money(x) AS m").collect()
    want = df.select("x", lenient_long("x").alias("l"), lenient_double("x").alias("d"), money("x", "decimal").alias("m")).collect()
    assert [str(r) for r in rows] == [str(r) for r in want]


def test_texts_that_are_no_number_are_not_cast(spark, ansi):
    """Plain casts of the same texts give the same, also for odd numbers."""
    texts = ["", "many", "Zed", "_1", "{1", "inf", "-Infinity", "nan", "iffy", "0x1p3", "5d", "5f", "\t5", "5\t", "\x7f5", "é", "1,2", ",", "1e400",
             "99999999999999999999", "00000000000000000007", "+0000000000000000000007", "12345678901234567890.5", "5" + "\t" * 20 + "5", "-99999999999999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    plain = F.trim("s")
    got = df.select(casts.lenient_long("s").alias("l"), casts.lenient_double("s").alias("d"), casts.lenient_float("s").alias("f"), casts.money("s", "decimal").alias("m"))
    want = df.select(plain.try_cast("double").alias("d"), plain.try_cast("float").alias("f"), plain.try_cast("decimal(12,2)").alias("m"))
    assert [tuple(map(str, r[1:])) for r in got.collect()] == [tuple(map(str, r)) for r in want.collect()]
    longs = [r.l for r in got.collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert longs == [r[0] for r in df.select(plain.cast("bigint")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    assert "contains" in got._jdf.queryExecution().optimizedPlan().toString().lower()


def test_code_is_generated_in_methods_that_are_compiled(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
