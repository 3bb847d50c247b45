import pytest
from pyspark.sql import functions as F

from shopledger.functions import business as rule


def labels(spark, build, values, type_name="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
    return [r.x for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_amounts(spark):
    values = [1000.0, 999.99, 300.0, 299.99, None]
    assert labels(spark, rule.amount_band, values) == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    assert labels(spark, rule.is_high_value, values) == [True, False, False, False, None]


def test_stock(spark):
    values = [-1, 0, 1, 19, 20, None]
    assert labels(spark, rule.stock_status, values, "int") == [
        "OUT_OF_STOCK", "OUT_OF_STOCK", "LOW_STOCK", "LOW_STOCK", "IN_STOCK", "IN_STOCK",
    ]
    assert labels(spark, rule.stock_risk, values, "int") == ["OOS", "OOS", "LOW", "LOW", "OK", "OK"]


def test_tenure(spark):
    values = [-5, 29, 30, 179, 180, None]
    assert labels(spark, rule.tenure_bucket, values, "int") == [
        "NEW", "NEW", "GROWING", "GROWING", "ESTABLISHED", "ESTABLISHED",
    ]


def test_segments(spark):
    values = [5000.01, 5000.0, 1000.01, 1000.0, 0.01, 0.0, None]
    assert labels(spark, rule.customer_segment, values) == [
        "high_value", "medium_value", "medium_value", "low_value", "low_value", "no_purchases",
        "no_purchases",
    ]


@pytest.mark.parametrize(
    ("price", "catalog", "flag", "mismatch"),
    [
        (10.0, 10.0, "MATCH", False),
        (10.01, 10.00, "MATCH", False),
        (1.01, 1.00, "MISMATCH", True),  # doubles: the difference is a little over a cent
        (10.0, 15.0, "MISMATCH", True),
        (10.0, None, "MISMATCH", None),
    ],
)
def test_prices(spark, price, catalog, flag, mismatch):
    df = spark.createDataFrame([(price, catalog)], "p double, c double")
    got = df.select(
        rule.price_match(F.col("p"), F.col("c")), rule.is_price_mismatch(F.col("p"), F.col("c"))
    ).first()
    assert tuple(got) == (flag, mismatch)
