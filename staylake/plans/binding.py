"""Binding of the rental schema onto the driver (TPC-H-like) tables.

The library's operators take column names, so the driver tables can play the
rental roles: an *order* is a listing, its *customer* the host, the customer's
*nation* the neighbourhood, a *lineitem* a calendar day, an *event* a review
and a *part* a priced listing for the feature marts. Each binding is a list of
``(name, SQL expression)`` pairs evaluated by Spark (``selectExpr``) and by the
SQL oracle alike, so both sides start from identical inputs. NULLs, which the
driver tables do not have, are made with ``nullif`` on real values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylake.ml.prep import spread

# The member turned into a NULL neighbourhood, and the city name.
NULLED_NATION = "NATION_7"
CITY = "Bangkok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LISTING_BINDING: list[tuple[str, str]] = [
    ("listing_id", "o_orderkey"),
    ("listing_name", "o_orderpriority"),
    ("host_id", "o_custkey"),
    ("host_name", "c_name"),
    ("host_since", "CAST(NULL AS DATE)"),
    ("host_location", "c_mktsegment"),
    ("host_response_time", "o_orderstatus"),
    ("host_response_rate", "c_acctbal / 10000.0"),
    ("host_acceptance_rate", "CAST(NULL AS DOUBLE)"),
    ("host_is_superhost", "c_acctbal > 5000"),
    ("host_identity_verified", "o_orderstatus = 'F'"),
    ("host_listings_count", "c_nationkey"),
    ("host_total_listings_count", "c_nationkey + 1"),
    ("neighbourhood", f"NULLIF(n_name, '{NULLED_NATION}')"),
    ("latitude", "CAST(NULL AS DOUBLE)"),
    ("longitude", "CAST(NULL AS DOUBLE)"),
    ("property_type", "c_mktsegment"),
    ("room_type", "o_orderstatus"),
    ("accommodates", "c_nationkey"),
    ("bathrooms", "CAST(NULL AS DOUBLE)"),
    ("bedrooms", "CAST(NULL AS DOUBLE)"),
    ("beds", "CAST(NULL AS DOUBLE)"),
    ("price", "o_totalprice"),
    ("minimum_nights", "c_nationkey"),
    ("maximum_nights", "n_regionkey"),
    ("availability_30", "CAST(NULL AS INTEGER)"),
    ("availability_60", "CAST(NULL AS INTEGER)"),
    ("availability_90", "CAST(NULL AS INTEGER)"),
    ("availability_365", "CAST(NULL AS INTEGER)"),
    ("instant_bookable", "o_orderstatus = 'O'"),
    ("number_of_reviews", "n_regionkey"),
    ("number_of_reviews_ltm", "CAST(NULL AS INTEGER)"),
    ("last_review", "CAST(NULL AS DATE)"),
    ("review_scores_rating", "c_acctbal"),
    ("review_scores_accuracy", "CAST(NULL AS DOUBLE)"),
    ("review_scores_cleanliness", "CAST(NULL AS DOUBLE)"),
    ("review_scores_checkin", "CAST(NULL AS DOUBLE)"),
    ("review_scores_communication", "CAST(NULL AS DOUBLE)"),
    ("review_scores_location", "CAST(NULL AS DOUBLE)"),
    ("review_scores_value", "CAST(NULL AS DOUBLE)"),
    ("reviews_per_month", "CAST(NULL AS DOUBLE)"),
    ("calculated_host_listings_count", "c_nationkey"),
    ("last_scraped", "CAST(o_orderdate AS DATE)"),
]
LISTING_FROM = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"

CALENDAR_BINDING: list[tuple[str, str]] = [
    ("listing_id", "l_orderkey"),
    ("calendar_date", "CAST(l_shipdate AS DATE)"),
    ("is_available", "CASE WHEN l_linestatus = 'F' THEN false END"),
    ("minimum_nights", "l_linenumber"),
    ("maximum_nights", "CAST(l_quantity AS INTEGER)"),
]
CALENDAR_FROM = "lineitem"

REVIEW_BINDING: list[tuple[str, str]] = [
    ("review_id", "event_id"),
    ("listing_id", "user_id"),
    ("review_date", "CAST(ts AS DATE)"),
    ("reviewer_id", "user_id"),
    ("reviewer_name", "event_type"),
    ("comments", "NULLIF(event_type, 'error')"),
    ("has_comment", "NULLIF(event_type, 'error') IS NOT NULL"),
]
REVIEW_FROM = "events"

# part as a priced listing for the feature marts (amenities in every stored form)
PART_LISTING_BINDING: list[tuple[str, str]] = [
    ("listing_id", "p_partkey"),
    ("host_id", "CAST(p_size AS BIGINT)"),
    ("neighbourhood", "p_brand"),
    ("property_type", "NULLIF(p_name, 'red plate')"),
    ("room_type", "NULLIF(p_type, 'STANDARD')"),
    ("price", "NULLIF(p_retailprice, 900.0)"),
    # the one feature with a real, partial relation to the price: a coarse step of it plus noise
    ("accommodates", "CAST(floor((p_partkey % 1000) / 250.0) AS INTEGER) + p_size % 3"),
    ("bathrooms", "NULLIF(CAST(p_size AS DOUBLE) / 10.0, 1.0)"),
    ("bedrooms", "CASE WHEN p_type = 'LARGE' THEN NULL ELSE NULLIF(CAST(p_size % 4 AS DOUBLE), 0.0) END"),
    ("beds", "NULLIF(CAST(p_size % 3 AS DOUBLE), 1.0)"),
    ("minimum_nights", "p_size - 25"),
    ("maximum_nights", "p_size + 30"),
    ("instant_bookable", "p_size > 25"),
    ("host_response_time", "p_type"),
    ("host_response_rate", "CAST(p_size AS DOUBLE) / 50.0"),
    ("host_acceptance_rate", "NULLIF(CAST(p_size AS DOUBLE) / 60.0, 0.5)"),
    ("host_is_superhost", "p_size > 40"),
    ("host_listings_count", "p_size"),
    ("host_total_listings_count", "p_size"),
    ("calculated_host_listings_count", "p_size"),
    ("number_of_reviews", "p_size - 10"),
    ("number_of_reviews_ltm", "p_size - 20"),
    ("reviews_per_month", "CAST((p_partkey * 7) % 50 AS DOUBLE) / 10.0"),
    ("review_scores_rating", "NULLIF(CAST(p_size AS DOUBLE), 20.0)"),
    ("review_scores_accuracy", "CAST(NULL AS DOUBLE)"),
    ("review_scores_cleanliness", "CAST(NULL AS DOUBLE)"),
    ("review_scores_checkin", "CAST(NULL AS DOUBLE)"),
    ("review_scores_communication", "CAST(NULL AS DOUBLE)"),
    ("review_scores_location", "NULLIF(CAST((p_partkey * 13) % 11 AS DOUBLE) / 2.0, 0.0)"),
    ("review_scores_value", "CAST(NULL AS DOUBLE)"),
    ("amenities", "CASE p_type WHEN 'ECONOMY' THEN NULL WHEN 'PROMO' THEN '{}' "
                  "WHEN 'SMALL' THEN '{' || replace(p_name, ' ', ',,') || '}' "
                  "WHEN 'LARGE' THEN 'not json, ' || p_name "
                  "WHEN 'MEDIUM' THEN '{\"a\": 1}' "
                  "ELSE '[\"' || replace(p_name, ' ', '\", \"') || '\"]' END"),
]
PART_LISTING_FROM = "part"


def bound_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.selectExpr(*[f"{expr} AS {name}" for name, expr in LISTING_BINDING])


def bound_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in CALENDAR_BINDING])


def bound_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {n}" for n, e in REVIEW_BINDING])


def bound_part_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*[f"{e} AS {n}" for n, e in PART_LISTING_BINDING])


def spread_part_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bound_part_listings`` for model fits: the table's rows are spread over tasks before anything is computed from them."""
    return spread(table(spark, sf_dir, "part"), "p_partkey").selectExpr(*[f"{e} AS {n}" for n, e in PART_LISTING_BINDING])


def binding_sql(binding: list[tuple[str, str]], from_sql: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in binding) + " FROM " + from_sql


def listing_cte() -> str:
    return f"listings AS ({binding_sql(LISTING_BINDING, LISTING_FROM)})"


def calendar_cte(dedup: bool = True) -> str:
    raw = binding_sql(CALENDAR_BINDING, CALENDAR_FROM)
    if not dedup:
        return f"calendar AS ({raw})"
    rest = "listing_id, calendar_date, is_available, minimum_nights, maximum_nights"
    return (
        f"calendar_raw AS ({raw}), calendar AS (SELECT {rest} FROM (SELECT *, row_number() OVER ("
        "PARTITION BY listing_id, calendar_date ORDER BY "
        "CASE WHEN is_available IS NOT NULL THEN 1 ELSE 0 END DESC, "
        "CASE WHEN minimum_nights IS NOT NULL THEN 1 ELSE 0 END DESC, "
        "CASE WHEN maximum_nights IS NOT NULL THEN 1 ELSE 0 END DESC, "
        "is_available ASC NULLS LAST, minimum_nights ASC NULLS LAST, maximum_nights ASC NULLS LAST) AS rn "
        "FROM calendar_raw WHERE listing_id IS NOT NULL AND calendar_date IS NOT NULL) WHERE rn = 1)"
    )


def review_cte() -> str:
    return f"reviews AS ({binding_sql(REVIEW_BINDING, REVIEW_FROM)})"


def part_listing_cte() -> str:
    return f"plistings AS ({binding_sql(PART_LISTING_BINDING, PART_LISTING_FROM)})"
