"""Amounts far beyond today's, and rates of six decimals, keep their digits."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import MILLION, MILLIONTH, rescale
from ledgerloom.operators.currency import fx_divide, fx_multiply, rate_lookup


def one(df):
    return df.select(F.col("value").cast("decimal(38,10)")).first()[0]


@pytest.fixture
def amount(spark):
    def frame(text, kind="decimal(18,2)"):
        return spark.sql(f"SELECT CAST('{text}' AS {kind}) AS value, DATE'2024-05-06' AS date, 'actual' AS source, 'D' AS rate_department")

    return frame


@pytest.fixture
def rates(spark):
    def lookup(rate):
        rows = spark.sql(f"SELECT DATE'2024-05-01' AS accounting_date, CAST('{rate}' AS DECIMAL(18,6)) AS rate_value, 'D' AS department_code, 'actual' AS source")
        return rate_lookup(rows, "D")

    return lookup


def test_rescaled_amounts(amount):
    assert one(rescale(amount("200000000.00"), "value", MILLION)) == Decimal("200000000000000")
    assert one(rescale(amount("99999999999999.99"), "value", -MILLION)) == Decimal("-99999999999999990000")
    assert one(rescale(amount("1234567890123456.78"), "value", MILLIONTH)) == Decimal("1234567890.1234567800")
    assert one(rescale(amount("99999999999999999999.5", "decimal(38,10)"), "value", MILLIONTH)) == Decimal("99999999999999.9999995000")
    assert one(rescale(amount("0.01"), "value", MILLIONTH)) == Decimal("0.0000000100")


def test_rates_of_six_decimals(amount, rates):
    large = rescale(amount("200000000.00"), "value", MILLION)
    assert one(fx_multiply(large, rates("23456.123457"), "date", "value")) == Decimal("200000000000000") * Decimal("23456.123457")
    assert one(fx_multiply(amount("0.03"), rates("0.000001"), "date", "value")) == Decimal("0.0000000300")
    single = rates("23456.123457")
    quotient = one(fx_divide(amount("9999999999999999.99"), single, "date", "value"))
    assert abs(quotient - Decimal("9999999999999999.99") / Decimal("23456.123457")) <= Decimal("0.0000000001")
    assert one(fx_divide(large, rates("0.000100"), "date", "value")) == Decimal("2000000000000000000")
