"""Table-driven edge cases for the cleaning expressions (the scalar semantic gaps)."""

import pytest
from pyspark.sql import functions as F

from staylake.functions import cleaning as C
from staylake.functions.keys import date_attributes, surrogate_key
from staylake.functions.rules import property_group_py, property_group_sql


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,expected", [
    ("$1,234.00", 1234.0), ("", None), ("N/A", None), ("1-2", None), ("0", 0.0), (None, None), ("-5", -5.0),
    ("฿ 2,500", 2500.0),
])
def test_clean_money(spark, raw, expected):
    assert one(spark, raw, C.clean_money) == expected


@pytest.mark.parametrize("raw,expected", [("95%", 0.95), ("N/A", None), ("100%", 1.0), (None, None)])
def test_clean_percent(spark, raw, expected):
    got = one(spark, raw, C.clean_percent)
    assert got == pytest.approx(expected) if expected is not None else got is None


@pytest.mark.parametrize("raw,expected", [
    ("t", True), ("F", False), ("YES", True), ("0", False), ("maybe", None), (" y ", True), (None, None), ("", None),
])
def test_clean_boolean(spark, raw, expected):
    assert one(spark, raw, C.clean_boolean) == expected


@pytest.mark.parametrize("raw,expected", [("t", 1), ("TRUE", 1), ("y", 0), ("f", 0), (None, 0)])
def test_to_binary(spark, raw, expected):
    assert one(spark, raw, C.to_binary) == expected


@pytest.mark.parametrize("raw,expected", [("  ", None), (" a ", "a"), ("", None), (None, None)])
def test_clean_text(spark, raw, expected):
    assert one(spark, raw, C.clean_text) == expected


@pytest.mark.parametrize("raw,expected", [
    ("3", 3), ("3.0", 3), ("3.7", 4), ("2.5", 3), ("-2.5", -3), ("1e3", 1000), (" 12 ", 12), ("abc", None),
    ("9007199254740993", 9007199254740993), ("", None),
])
def test_safe_cast_bigint(spark, raw, expected):
    assert one(spark, raw, lambda c: C.safe_cast(c, "bigint")) == expected


def test_round_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,)], "x double")
    assert [r.y for r in df.select(C.round_half_even_int("x").alias("y")).collect()] == [2, 4, -2]


@pytest.mark.parametrize("raw,ok", [("2024-01-02", True), ("02/01/2024", False), ("", False)])
def test_safe_cast_date(spark, raw, ok):
    assert (one(spark, raw, lambda c: C.safe_cast(c, "date")) is not None) == ok


@pytest.mark.parametrize("raw,expected", [("1.5 baths", 1.5), ("Half-bath", None), ("2 shared baths", 2.0), (None, None)])
def test_first_number(spark, raw, expected):
    assert one(spark, raw, C.first_number) == expected


@pytest.mark.parametrize("raw,null_mode,split_mode", [
    ('["Wifi", "Kitchen"]', 2, 2), ("[]", 0, 0), ("{}", 0, 0), ("{Wifi,,TV}", None, 2), ('{"a":1}', 0, 0),
    ("not json", None, 1), (None, None, 0), ("", None, 0),
])
def test_count_json_items(spark, raw, null_mode, split_mode):
    assert one(spark, raw, lambda c: C.count_json_items(c, "null")) == null_mode
    assert one(spark, raw, lambda c: C.count_json_items(c, "split")) == split_mode


def test_resolve_column(spark):
    df = spark.createDataFrame([(1,)], "ID int")
    assert df.select(C.resolve_column(df, "id")).first()[0] == 1
    assert df.select(C.resolve_column(df, "missing", default=F.lit(None).cast("string"))).first()[0] is None
    with pytest.raises(ValueError):
        C.resolve_column(df, "missing")


def test_surrogate_key_null_propagates(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    keys = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert keys[0] is None and len(keys[1]) == 32


def test_date_attributes(spark):
    df = spark.createDataFrame([("2024-01-07",)], "d string").select(F.col("d").cast("date").alias("d"))
    r = df.select(*[v.alias(k) for k, v in date_attributes("d").items()]).first()
    assert r.date_key == 20240107 and r.day_of_week == "Sunday" and r.month_name == "January"
    assert r.is_weekend and r.week_of_year == 1 and r.quarter == 1


@pytest.mark.parametrize("raw,sql_label,py_label", [
    ("Entire serviced apartment", "Serviced Apartment / Aparthotel", "Serviced Apartment / Aparthotel"),
    ("Private room", "Unspecified Property Type", "Other"),
    ("Entire loft", "Apartment / Condo", "Loft"),
    ("Tiny home", "Niche / Special Stay", "Unique Stay"),
    ("Entire townhouse", "House / Home", "House / Home"),
    ("Shipping container", "Niche / Special Stay", "Unique Stay"),
    (None, "Unspecified Property Type", "Unknown"),
])
def test_property_groups(spark, raw, sql_label, py_label):
    assert one(spark, raw, property_group_sql) == sql_label
    assert one(spark, raw, property_group_py) == py_label
