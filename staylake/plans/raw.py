"""The driver tables as raw drops: every column as text, the way a rental marketplace publishes it.

The silver models read all-text tables. Here the driver tables are written as such text - money with currency
signs and thousands separators, percentages, yes / no spellings, padded names, integers with decimals, repeated
scrapes, unreadable keys and dates - so that the silver models run on whole tables whose right, typed result is
known from the table itself. The oracles state that typed result and never parse the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.plans import binding as B


def _money(c: str) -> str:
    return f"concat('$', format_number({c}, 2))"


def _flag(c: str) -> str:
    return f"CASE WHEN {c} THEN ' T ' ELSE 'no' END"


# ---------------------------------------------------------------- calendar: a lineitem is a listing's day

CALENDAR_TEXT = {
    "listing_id": "CASE WHEN l_tax = 0.08 AND l_linenumber = 7 THEN 'n/a' ELSE concat(' ', l_orderkey, ' ') END",
    "date": "date_format(l_shipdate, CASE WHEN l_discount = 0.1 AND l_linenumber = 1 THEN 'dd/MM/yyyy' ELSE 'yyyy-MM-dd' END)",
    "available": f"CASE WHEN l_returnflag = 'R' THEN 'maybe' ELSE {_flag('l_linestatus = ' + chr(39) + 'F' + chr(39))} END",
    "price": _money("l_extendedprice"),
    "adjusted_price": f"CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE {_money('l_extendedprice - 1000000')} END",
    "minimum_nights": "concat(l_linenumber, '.0')",
    "maximum_nights": "CASE WHEN l_quantity = 13 THEN 'thirteen' ELSE concat(CAST(l_quantity AS INT), '.5') END",
}

SILVER_CALENDAR_SQL = """
WITH typed AS (
  SELECT CASE WHEN l_tax = 0.08 AND l_linenumber = 7 THEN NULL ELSE l_orderkey END AS listing_id,
    CASE WHEN l_discount = 0.1 AND l_linenumber = 1 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS calendar_date,
    CASE WHEN l_returnflag <> 'R' THEN l_linestatus = 'F' END AS is_available, round(l_extendedprice, 2) AS price,
    CASE WHEN l_linenumber % 2 = 1 THEN round(l_extendedprice - 1000000, 2) END AS adjusted_price,
    l_linenumber AS minimum_nights, CASE WHEN l_quantity <> 13 THEN CAST(l_quantity AS INTEGER) + 1 END AS maximum_nights
  FROM lineitem)
SELECT DISTINCT ON (listing_id, calendar_date) listing_id, calendar_date, is_available, price, adjusted_price,
  minimum_nights, maximum_nights
FROM typed WHERE listing_id IS NOT NULL AND calendar_date IS NOT NULL
ORDER BY listing_id, calendar_date, is_available IS NULL, minimum_nights IS NULL, maximum_nights IS NULL,
  is_available NULLS LAST, price NULLS LAST, adjusted_price NULLS LAST, minimum_nights NULLS LAST, maximum_nights NULLS LAST"""

# ---------------------------------------------------------------- reviews: an event is a review

REVIEW_TEXT = {
    "id": "CASE WHEN event_id % 97 = 5 THEN concat('#', event_id) ELSE concat(event_id, '') END",
    "listing_id": "CASE WHEN event_id % 89 = 5 THEN '' ELSE concat(user_id, '.0') END",
    "date": "CASE event_type WHEN 'click' THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") WHEN 'signup' THEN date_format(ts, 'yyyy-MM') "
            "ELSE date_format(ts, 'yyyy-M-d') END",
    "reviewer_id": "concat(9007199254740993 + user_id, '')",
    "reviewer_name": "concat('  ', upper(event_type), ' ')",
    "comments": "CASE WHEN value < 10 THEN '   ' ELSE concat(' ', props, '  ') END",
}

SILVER_REVIEWS_SQL = """
SELECT event_id AS review_id, user_id AS listing_id, CASE WHEN event_type <> 'signup' THEN CAST(ts AS DATE) END AS review_date,
  9007199254740993 + user_id AS reviewer_id, upper(event_type) AS reviewer_name,
  CASE WHEN NOT value < 10 THEN trim(props) END AS comments, CASE WHEN NOT value < 10 THEN trim(props) END IS NOT NULL AS has_comment
FROM events WHERE event_id % 97 <> 5 AND event_id % 89 <> 5"""

# ---------------------------------------------------------------- neighbourhoods: a brand, spelled in several ways

NEIGHBOURHOOD_TEXT = {"neighbourhood": "CASE p_partkey % 4 WHEN 0 THEN upper(p_brand) WHEN 1 THEN concat(' ', lower(p_brand), '  ') "
                                       "WHEN 2 THEN '  ' ELSE p_brand END"}

SILVER_NEIGHBOURHOODS_SQL = """
SELECT min(CASE p_partkey % 4 WHEN 0 THEN upper(p_brand) WHEN 1 THEN lower(p_brand) ELSE p_brand END) AS neighbourhood
FROM part WHERE p_partkey % 4 <> 2 AND p_brand IS NOT NULL GROUP BY lower(p_brand)"""

# ---------------------------------------------------------------- listings: an order with its customer and nation

LISTING_TEXT = {
    "id": "concat(o_orderkey, '')", "name": "concat(' ', o_orderpriority, ' ')", "host_id": "concat(o_custkey, '.0')",
    "host_name": "concat(c_name, '  ')", "host_since": "date_format(o_orderdate, 'yyyy-MM-dd')", "host_location": "c_mktsegment",
    "host_response_time": "CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderstatus END",
    "host_response_rate": "concat(c_nationkey, '%')", "host_acceptance_rate": "'N/A'",
    "host_is_superhost": _flag("c_acctbal > 5000"), "host_listings_count": "concat(c_nationkey, '.4')",
    "host_total_listings_count": "concat(c_nationkey, '.6')", "host_identity_verified": "CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN '0' ELSE '?' END",
    # the cleansed column wins where it has text
    "neighbourhood_cleansed": "CASE WHEN n_regionkey = 2 THEN ' ' ELSE n_name END", "neighbourhood": "lower(n_name)",
    "latitude": "concat(c_acctbal / 1000, '')", "longitude": "'east'", "property_type": "c_mktsegment", "room_type": "o_orderstatus",
    "accommodates": "concat(' ', c_nationkey)", "bathrooms": "CASE WHEN c_nationkey < 5 THEN '1.5' ELSE '' END",
    "bathrooms_text": "concat(c_nationkey, '.5 shared baths')", "bedrooms": "concat(' ', n_regionkey, ' ')", "beds": "''",
    "amenities": "concat('[\"', o_orderstatus, '\"] ')", "price": _money("o_totalprice"), "minimum_nights": "concat(c_nationkey, '')",
    "maximum_nights": "'99999999999'", "availability_30": "concat(n_regionkey, '')", "availability_60": "'x'", "availability_90": "'-'",
    "availability_365": "concat(n_regionkey, '00')", "instant_bookable": _flag("o_orderstatus = 'O'"),
    "number_of_reviews": "concat(n_regionkey, '')", "number_of_reviews_ltm": "NULL", "last_review": "'2024-02-30'",
    "review_scores_rating": "concat(n_regionkey, '.25')", "review_scores_accuracy": "' 4.75 '", "review_scores_cleanliness": "'four'",
    "review_scores_checkin": "''", "review_scores_communication": "'1e1'", "review_scores_location": "'.5'", "review_scores_value": "'5'",
    "reviews_per_month": "concat(n_regionkey, '.5')", "calculated_host_listings_count": "concat(c_nationkey, '')",
    "last_scraped": "date_format(o_orderdate, 'yyyy-MM-dd')",
}

SILVER_LISTINGS_SQL = """
SELECT o_orderkey AS listing_id, o_orderpriority AS listing_name, o_custkey AS host_id, c_name AS host_name,
  CAST(o_orderdate AS DATE) AS host_since, c_mktsegment AS host_location, nullif(o_orderstatus, 'P') AS host_response_time,
  round(c_nationkey / 100.0, 6) AS host_response_rate, CAST(NULL AS DOUBLE) AS host_acceptance_rate,
  c_acctbal > 5000 AS host_is_superhost, c_nationkey AS host_listings_count, c_nationkey + 1 AS host_total_listings_count,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus = 'F' END AS host_identity_verified,
  CASE WHEN n_regionkey = 2 THEN lower(n_name) ELSE n_name END AS neighbourhood, CAST(NULL AS VARCHAR) AS neighbourhood_group,
  round(c_acctbal / 1000, 6) AS latitude, CAST(NULL AS DOUBLE) AS longitude, c_mktsegment AS property_type, o_orderstatus AS room_type,
  c_nationkey AS accommodates, CASE WHEN c_nationkey < 5 THEN 1.5 ELSE c_nationkey + 0.5 END::DOUBLE AS bathrooms,
  CAST(n_regionkey AS DOUBLE) AS bedrooms, CAST(NULL AS DOUBLE) AS beds, '["' || o_orderstatus || '"]' AS amenities,
  round(o_totalprice, 6) AS price, c_nationkey AS minimum_nights, CAST(NULL AS INTEGER) AS maximum_nights,
  n_regionkey AS availability_30, CAST(NULL AS INTEGER) AS availability_60, CAST(NULL AS INTEGER) AS availability_90,
  n_regionkey * 100 AS availability_365, o_orderstatus = 'O' AS instant_bookable, n_regionkey AS number_of_reviews,
  CAST(NULL AS INTEGER) AS number_of_reviews_ltm, CAST(NULL AS DATE) AS last_review, n_regionkey + 0.25::DOUBLE AS review_scores_rating,
  4.75::DOUBLE AS review_scores_accuracy, CAST(NULL AS DOUBLE) AS review_scores_cleanliness, CAST(NULL AS DOUBLE) AS review_scores_checkin,
  10.0::DOUBLE AS review_scores_communication, 0.5::DOUBLE AS review_scores_location, 5.0::DOUBLE AS review_scores_value,
  n_regionkey + 0.5::DOUBLE AS reviews_per_month, c_nationkey AS calculated_host_listings_count, CAST(o_orderdate AS DATE) AS last_scraped
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def _as_text(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"CAST({e} AS STRING) AS {n}" for n, e in columns.items()])


def raw_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(B.table(spark, sf_dir, "lineitem"), CALENDAR_TEXT)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(B.table(spark, sf_dir, "events"), REVIEW_TEXT)


def raw_neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(B.table(spark, sf_dir, "part"), NEIGHBOURHOOD_TEXT)


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each listing's scrape, with an older one of some that must lose, one without a date, and the same day's
    scrape under a later name."""
    o, c, n = (B.table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = _as_text(o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey), LISTING_TEXT)
    key = F.col("id").cast("bigint")
    older = rows.where(key % 10 == 0).withColumn("last_scraped", F.lit("1970-01-01")).withColumn("price", F.lit("$1.00"))
    undated = rows.where(key % 10 == 1).withColumn("last_scraped", F.lit("soon")).withColumn("name", F.lit("0"))
    renamed = rows.where(key % 10 == 2).withColumn("name", F.concat("name", F.lit("z"))).withColumn("price", F.lit("N/A"))
    return rows.unionByName(older).unionByName(undated).unionByName(renamed)
