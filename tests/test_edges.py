"""Inputs on the edge: constant, tied, empty, not finite, ungrouped, unlisted."""

from pyspark.sql import functions as F

from staylake.functions.cleaning import count_json_items, safe_cast
from staylake.operators import profile
from staylake.operators.errors import error_frame, regression_metrics
from staylake.operators.stats import kruskal_wallis


def test_constant_target(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p double")
    assert regression_metrics(df, "y", "p").first().r2 == 0.0
    assert regression_metrics(df, "y", "y").first().r2 == 1.0


def test_all_values_tied(spark):
    df = spark.range(80).select(F.lit(1.0).alias("v"), (F.col("id") % 2).alias("g"))
    row = kruskal_wallis(df, "v", "g").first()
    assert row.h is None and row.n == 80


def test_column_quality_of_an_empty_table(spark):
    row = profile.column_quality(spark.createDataFrame([], "a int")).first()
    assert row.missing_rate is None and row.unique_count == 0


def test_crosstab_counts_unlisted_values(spark):
    df = spark.createDataFrame([("r", "A"), ("r", "Z"), ("s", None)], "g string, c string")
    got = {r.g: (r.A, r.B) for r in profile.crosstab_normalized(df, "g", "c", ["A", "B"]).collect()}
    assert got == {"r": (0.5, 0.0), "s": (0.0, 0.0)}


def test_histogram_ignores_values_that_are_not_finite(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    rows = profile.histogram(df, "v", 2).collect()
    assert [(r.lower, r.upper, r["count"]) for r in rows] == [(0.0, 0.5, 1), (0.5, 1.0, 1)]


def test_box_stats_without_groups(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "v double")
    row = profile.box_stats(df, "v").first()
    assert (row["count"], row["median"], row.whisker_high, row.outliers) == (5, 3.0, 4.0, 1)


def test_only_full_dates(spark):
    df = spark.createDataFrame([("2024",), ("2024-05",), (" 2024-05-06 ",), ("2024-05-06 10:00:00",), ("x",)], "t string")
    assert [str(r.d) for r in df.select(safe_cast("t", "date").alias("d")).collect()] == ["None", "None", "2024-05-06", "2024-05-06", "None"]


def test_error_frame_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 0.0, -1.0)], "id int, y double, p double")
    got = {r.id: r for r in error_frame(df, "y", "p").collect()}
    assert got[1].error_direction == "underprediction" and got[1].residual > 0
    assert got[2].predicted_price == 0.0 and got[2].percentage_error is None


def test_only_strict_json_counts_as_json(spark):
    cases = {"['a','b, c']": (None, 3), '["a"] x': (None, 1), '{"a":1} zz': (None, 1), '["a", "it\'s", "x]y"]': (3, 3),
             '[["a"], {"b": [1, 2]}, "q\\"r"]': (3, 3), '[1, 2] [3]': (None, 2), '{"a": 1}': (0, 0), "[]": (0, 0), "12": (0, 0), "12 x": (None, 1), None: (None, 0)}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: (r.a, r.b) for r in df.select("t", count_json_items("t", "null").alias("a"), count_json_items("t", "split").alias("b")).collect()}
    assert got == cases
