"""Order statistics, rank tests and row numbers against numpy, tabled values and brute force."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylake.operators import impute, profile, ranks, stats, topk

PROBS = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
SHAPES = {
    "spread": np.random.default_rng(1).lognormal(0, 30, 1500),
    "narrow": np.round(np.random.default_rng(2).normal(950, 1, 1500), 3),
    "hot": np.r_[np.zeros(900), np.full(50, 7.5), np.arange(100)],
    "signed": np.r_[-np.random.default_rng(3).lognormal(0, 5, 700), np.random.default_rng(4).lognormal(0, 5, 700), [-0.0, 0.0, 5e-324, -5e-324]],
    "huge": np.r_[[1e308, -1e308, 1.7e308], np.arange(20) * 1e300],
    "one": np.array([3.25]),
    "few": np.array([1.0, 2.0]),
}


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [(k, float(v)) for k, values in SHAPES.items() for v in values]
    rows += [("spread", None), ("few", float("nan")), (None, 4.0), (None, 8.0), ("empty", None), ("empty", float("nan"))]
    np.random.default_rng(5).shuffle(rows)
    return spark.createDataFrame([(g if isinstance(g, str) else None, None if v is None else float(v)) for g, v in rows], "g string, v double")


@pytest.mark.parametrize("partitions", [1, 13])
def test_quantiles_by_refinement(shapes, partitions):
    names = [f"q{k}" for k in range(len(PROBS))]
    got = {r["g"]: [r[n] for n in names] for r in ranks.quantiles(shapes.repartition(partitions), "v", PROBS, ["g"], names).collect()}
    assert set(got) == {*SHAPES, None, "empty"} and got["empty"] == [None] * len(PROBS)
    for g, values in {**SHAPES, None: np.array([4.0, 8.0])}.items():
        np.testing.assert_allclose(got[g], np.quantile(values, PROBS), rtol=1e-12)
    everything = np.concatenate([*SHAPES.values(), [4.0, 8.0]])
    row = ranks.quantiles(shapes.repartition(partitions), "v", PROBS, [], names).first()
    np.testing.assert_allclose(list(row), np.quantile(everything, PROBS), rtol=1e-12)


def test_quantiles_run_nothing_while_they_are_built(spark, shapes):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    frame = ranks.quantiles(shapes, "v", [0.5], ["g"], ["m"])
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert "rangepartitioning" not in frame._jdf.queryExecution().executedPlan().toString()


def test_buckets_never_decrease(spark):
    rng = np.random.default_rng(6)
    v = np.unique(np.r_[rng.lognormal(0, 100, 4000), -rng.lognormal(0, 100, 4000), 0.0, 5e-324, 1.79e308, -1.79e308, np.inf, -np.inf, np.nextafter(1.0, 2), 1.0, np.nextafter(1.0, 0)])
    got = [r["b"] for r in spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "i int, v double").select("i", ranks.bucket_of(F.col("v")).alias("b")).orderBy("i").collect()]
    assert all(a <= b for a, b in zip(got, got[1:]))


def test_box_stats_leave_nan_out(spark):
    rows = [("a", float(k)) for k in range(1, 10)] + [("a", float("nan")), ("a", None), ("a", 100.0)]
    row = profile.box_stats(spark.createDataFrame(rows, "g string, v double"), "v", ["g"]).first()
    assert (row["q1"], row["median"], row["q3"]) == tuple(np.quantile([*range(1, 10), 100.0], [0.25, 0.5, 0.75]))
    assert (row["whisker_low"], row["whisker_high"], row["count"], row["outliers"]) == (1.0, 9.0, 10, 1)


def rank_of(values):
    order = sorted(values)
    return [np.mean([i + 1 for i, x in enumerate(order) if x == v]) for v in values]


def test_spearman_with_p(spark):
    tabled = spark.createDataFrame(list(zip([1, 2, 3, 4, 5], [5, 6, 7, 8, 7])), "x int, y int")
    row = stats.spearman(tabled, "x", "y").first()
    assert (row["spearman"], row["n"], row["p_value"]) == (pytest.approx(0.8207826816681233), 5, pytest.approx(0.08858700531354381))
    rng = np.random.default_rng(9)
    rows = [("hot" if k % 3 else None, float(rng.integers(0, 4)), float(rng.integers(0, 30))) for k in range(600)] + [("hot", None, 1.0), ("hot", 2.0, float("nan")), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0), ("flat", 1.0, 9.0)]
    got = {r["g"]: r for r in stats.spearman(spark.createDataFrame(rows, "g string, x double, y double"), "x", "y", ["g"]).collect()}
    for g in ("hot", None):
        xy = [(x, y) for k, x, y in rows if k == g and x is not None and not math.isnan(y)]
        expected = np.corrcoef(rank_of([x for x, _ in xy]), rank_of([y for _, y in xy]))[0, 1]
        assert got[g]["spearman"] == pytest.approx(expected, abs=1e-12) and got[g]["n"] == len(xy)
    assert got["flat"]["spearman"] is None and (got["flat"]["p_value"] is None or math.isnan(got["flat"]["p_value"]))
    both = stats.spearman_matrix(tabled.withColumn("z", -F.col("x")), ["x", "y", "z"]).collect()
    assert [(r["col_a"], r["col_b"]) for r in both] == [("x", "y"), ("x", "z"), ("y", "z")] and both[1]["spearman"] == -1.0 and both[1]["p_value"] == 0.0


@pytest.mark.parametrize("dof, t, p", [(1, 1.0, 0.5), (2, 4.302653, 0.05), (10, 2.228139, 0.05), (30, 2.749996, 0.01), (120, 1.979930, 0.05)])
def test_student_tail_tables(dof, t, p):
    assert stats.incomplete_beta(dof / 2, 0.5, dof / (dof + t * t)) == pytest.approx(p, rel=1e-5)


def test_kruskal_with_p(spark):
    rows = [("x", v) for v in (1.0, 3.0, 5.0, 7.0, 9.0)] + [("y", v) for v in (2.0, 4.0, 6.0, 8.0, 10.0)]
    row = stats.kruskal_wallis(spark.createDataFrame(rows, "g string, v double"), "v", "g", 1).first()
    assert (row["h"], row["p_value"]) == (pytest.approx(0.2727272727272734), pytest.approx(0.6015081344405895))
    one = stats.kruskal_wallis(spark.createDataFrame(rows[:5], "g string, v double"), "v", "g", 1).first()
    assert one["h"] is None and (one["p_value"] is None or math.isnan(one["p_value"]))


def test_row_numbers_in_one_huge_group_and_many_small_ones(spark):
    rng = np.random.default_rng(10)
    rows = [(i, "huge" if i % 10 else (None if i % 30 else f"g{i % 70}"), int(rng.integers(0, 50))) for i in range(3000)]
    frame = spark.createDataFrame(rows, "id int, g string, v int").repartition(7)
    got = {r["id"]: r["rank"] for r in topk.rank_within(frame, [F.col("v").desc(), F.col("id")], ["g"]).collect()}
    groups = {}
    for i, g, v in rows:
        groups.setdefault(g, []).append((-v, i))
    assert got == {i: k + 1 for members in groups.values() for k, (_, i) in enumerate(sorted(members))}
    assert topk.rank_within(frame.where("id < 0"), [F.col("id")], ["g"]).columns == ["id", "g", "v", "rank"]
    sizes = [r["count"] for r in topk.rank_within(frame.withColumn("g", F.lit("one")), [F.col("v"), F.col("id")], ["g"]).withColumn("s", F.spark_partition_id()).groupBy("s").count().collect()]
    assert len(sizes) > 4 and max(sizes) <= 2 * np.median(sizes)


@pytest.mark.parametrize("limit", [100_000, 1])
def test_group_fill(spark, monkeypatch, limit):
    monkeypatch.setattr(impute, "BROADCAST_GROUPS", limit)
    rows = [(1, "a", 1.0), (2, "a", 4.0), (3, "a", None), (4, None, 10.0), (5, None, None), (6, "b", None), (7, "c", 7.0)]
    frame = impute.impute_group_median(spark.createDataFrame(rows, "id int, g string, v double"), ["v"], ["g"])
    assert {r["id"]: r["v"] for r in frame.collect()} == {1: 1.0, 2: 4.0, 3: 2.5, 4: 10.0, 5: 10.0, 6: 5.5, 7: 7.0}
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert bool(re.search(r"Join LeftOuter.*rightHint=\(strategy=broadcast\)", plan)) == (limit > 1)
