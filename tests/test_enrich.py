"""Lookups: normalised keys, defaults, chained conversion, fan-out."""

import pytest

from kassa.operators import enrich


def facts(spark):
    return spark.createDataFrame(
        [("India", "DISC05", 100.0), ("Mars", "NOPE", 10.0), ("japan", "disc10 ", 50.0)],
        "storecountry string, discountcode string, lineitem_saleprice double")


def dims(spark, extra_currency=()):
    cur = spark.createDataFrame([(" india ", "INR"), ("Japan", "jpy"), *extra_currency],
                                "country string, currency_cd string")
    conv = spark.createDataFrame([("inr ", 0.012), ("USD", 7.0)],
                                 "source_currency string, conversion_rate double")
    disc = spark.createDataFrame([(" disc05", 10.0)], "discount_cd string, discount_per double")
    return cur, conv, disc


def test_full_enrichment(spark):
    cur, conv, disc = dims(spark)
    out = {r.storecountry: r for r in enrich.enrich(facts(spark), cur, conv, disc).collect()}
    assert out["India"].currency_code == "INR" and out["India"].conversion_rate == 0.012
    assert out["India"].discount_value == 0.1
    assert out["India"].lineitem_finalsaleprice == round((100 - 10) * 0.012, 2)
    # unknown country: USD but rate 1 (the rate is keyed on the looked-up code)
    assert out["Mars"].currency_code == "USD" and out["Mars"].conversion_rate == 1.0
    assert out["Mars"].discount_value == 0.05 and out["Mars"].lineitem_finalsaleprice == 9.5
    # code found, no rate -> 1; fact-side code is not trimmed, so 'disc10 ' misses
    assert out["japan"].currency_code == "jpy" and out["japan"].conversion_rate == 1.0
    assert out["japan"].discount_value == 0.05


def test_decimal_mode(spark):
    cur, conv, disc = dims(spark)
    f = facts(spark).selectExpr("storecountry", "discountcode",
                                "cast(lineitem_saleprice as decimal(12,2)) lineitem_saleprice")
    out = {r.storecountry: r for r in enrich.enrich(f, cur, conv, disc, money="decimal").collect()}
    assert str(out["India"].lineitem_finalsaleprice) == "1.08"
    assert str(out["Mars"].lineitem_finalsaleprice) == "9.50"


def test_duplicate_dimension_keys_fan_out(spark):
    cur, conv, disc = dims(spark, extra_currency=[("INDIA", "INR2")])
    out = enrich.enrich_currency(facts(spark), cur)
    assert out.count() == 4
    with pytest.raises(ValueError):
        enrich.enrich_currency(facts(spark), cur, unique_dims=True).count()


def test_dimensions_are_broadcast(spark):
    cur, conv, disc = dims(spark)
    plan = enrich.enrich(facts(spark), cur, conv, disc)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
