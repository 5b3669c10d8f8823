"""End-to-end: generated raw CSV drop -> bronze -> silver -> gold -> contracts."""

import uuid

import pytest
from pyspark.sql import functions as F

from rawdrop import write_drop
from staylake.operators.quality import assert_suite_passes
from staylake.plans import jobs
from staylake.sources.bronze import missing_required, read_raw_csv, resolve_sources


@pytest.fixture(scope="module")
def clean_build(spark, tmp_path_factory):
    raw = str(tmp_path_factory.mktemp("raw_clean"))
    write_drop(raw)
    sfx = uuid.uuid4().hex[:6]
    res = jobs.build_lakehouse(spark, raw, bronze_schema=f"b_{sfx}", silver_schema=f"s_{sfx}", gold_schema=f"g_{sfx}")
    return res, sfx


def test_manifest_and_sources(spark, tmp_path):
    write_drop(str(tmp_path))
    assert missing_required(spark, str(tmp_path)).count() == 0
    assert set(resolve_sources(spark, str(tmp_path))) == {"listings", "calendar", "reviews", "neighbourhoods"}


def test_multiline_quoted_comments(spark, tmp_path):
    write_drop(str(tmp_path))
    df = read_raw_csv(spark, str(tmp_path / "reviews.csv"))
    assert df.count() == 750
    assert df.where(F.col("comments").contains('"really"')).count() > 0


def test_clean_drop_passes_every_contract(spark, clean_build):
    res, sfx = clean_build
    failed = res.where(F.col("status") != "pass").collect()
    assert not failed, [(r.table_name, r.check_name, r.column_name, r.violations) for r in failed]
    assert res.count() >= 100
    assert_suite_passes(res)
    with pytest.raises(AssertionError, match="bronze_listings.unique"):
        assert_suite_passes(spark.table(f"b_{sfx}.dq_source_results"))


def test_source_contracts_see_the_repeated_raw_rows(spark, clean_build):
    _, sfx = clean_build
    res = spark.table(f"b_{sfx}.dq_source_results").collect()
    assert len(res) == 11
    assert {(r.table_name, r.check_name, r.violations) for r in res if r.status != "pass"} == {
        ("bronze_listings", "unique", 2), ("bronze_calendar", "unique_combination_of_columns", 1)}


def test_silver_semantics(spark, clean_build):
    _, sfx = clean_build
    l = spark.table(f"s_{sfx}.silver_listings")
    assert l.count() == 250
    r1 = l.where("listing_id = 1").first()
    assert r1.listing_name == "Listing 1" and r1.price == 1234.0 or r1.price > 0
    assert spark.table(f"s_{sfx}.silver_neighbourhoods").count() == 6
    assert l.where("listing_id = 9007199254740993").count() == 1
    cal = spark.table(f"s_{sfx}.silver_calendar")
    assert cal.count() == 250 * 7
    dup = cal.where("listing_id = 1 AND calendar_date = DATE'2024-07-01'").first()
    assert dup.minimum_nights == 1  # the complete row won over the conflicting sparse one
    loc = spark.table(f"g_{sfx}.dim_location")
    assert loc.where("neighbourhood = 'UNKNOWN'").count() == 1


def test_seeded_faults_are_counted(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write_drop(raw, faults=True)
    sfx = uuid.uuid4().hex[:6]
    res = jobs.build_lakehouse(spark, raw, bronze_schema=f"b_{sfx}", silver_schema=f"s_{sfx}", gold_schema=f"g_{sfx}")
    got = {(r.table_name, r.check_name, r.column_name): r.violations
           for r in res.where(F.col("status") == "fail").collect()}
    assert got[("silver_listings", "accepted_values", "room_type")] == 1
    assert got[("silver_listings", "less_than_or_equal_or_null", "minimum_nights")] == 1
    assert got[("silver_listings", "relationships", "neighbourhood")] == 1
    assert got[("silver_reviews", "relationships", "listing_id")] == 1
    assert got[("fact_review", "row_count_matches", None)] == 1


def test_fact_join_reads_colocated_buckets(spark, clean_build):
    """silver_calendar and silver_listings are bucketed on listing_id: the fact join shuffles neither side."""
    _, sfx = clean_build
    from staylake.plans import gold
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.fact_availability_daily(spark.table(f"s_{sfx}.silver_calendar"), spark.table(f"s_{sfx}.silver_listings"))
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan
    assert "Exchange hashpartitioning" not in plan, plan
