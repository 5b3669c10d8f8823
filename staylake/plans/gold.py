"""Gold star schema: dimensions with md5 surrogate keys and three facts.

Every surrogate key is a hash of its natural key, and every dimension is
built from the same de-duplicated silver listings. So the fact builders do not
shuffle the (large) fact side through four dimension joins: they compute the
keys in place and make ONE equi-join from the fact to a listing -> keys map
(one row per listing that has a host, which is exactly the set of rows the
inner joins to ``dim_listing`` / ``dim_host`` / ``dim_location`` keep).
AQE broadcasts that map when its runtime size is small and splits skewed
listing partitions otherwise.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.functions.keys import date_attributes, date_key, surrogate_key
from staylake.operators.dedup import latest_per_key
from staylake.operators.quality import UNKNOWN_MEMBER

# Fixed value: the default city of the location dimension.
DEFAULT_CITY = "Bangkok"


def dim_listing(listings: DataFrame) -> DataFrame:
    return listings.select(
        surrogate_key("listing_id").alias("listing_key"), "listing_id", "listing_name", "latitude", "longitude",
        "property_type", "room_type", "accommodates", "bathrooms", "bedrooms", "beds",
        F.col("minimum_nights").alias("listing_default_minimum_nights"),
        F.col("maximum_nights").alias("listing_default_maximum_nights"), "instant_bookable")


def dim_host(listings: DataFrame) -> DataFrame:
    """SCD1 host: attributes of the host's most recently scraped listing (ties -> smaller listing id)."""
    latest = latest_per_key(listings, ["host_id"],
                            [F.col("last_scraped").desc_nulls_last(), F.col("listing_id").asc_nulls_last()])
    return latest.select(
        surrogate_key("host_id").alias("host_key"), "host_id", "host_name", "host_since",
        F.col("host_location").alias("host_reported_location"), "host_response_time", "host_response_rate",
        "host_acceptance_rate", "host_is_superhost", "host_identity_verified", "host_listings_count",
        "host_total_listings_count", F.col("last_scraped").alias("source_last_scraped_date"))


def location_key(city: str, neighbourhood) -> "F.Column":
    nb = F.col(neighbourhood) if isinstance(neighbourhood, str) else neighbourhood
    return surrogate_key(F.lit(city), nb)


def dim_location(listings: DataFrame, city: str = DEFAULT_CITY) -> DataFrame:
    """Distinct known neighbourhoods plus the UNKNOWN member (distinct after the union,
    so a neighbourhood literally named UNKNOWN does not duplicate it)."""
    spark = listings.sparkSession
    known = listings.where(F.col("neighbourhood").isNotNull()).select("neighbourhood")
    unknown = spark.range(1).select(F.lit(UNKNOWN_MEMBER).alias("neighbourhood"))
    members = known.unionByName(unknown).distinct()
    return members.select(location_key(city, "neighbourhood").alias("location_key"),
                          F.lit(city).alias("city"), "neighbourhood")


def dim_date(date_columns: Sequence[DataFrame]) -> DataFrame:
    """Union-distinct of single-column date frames -> calendar attributes."""
    dates = [d.select(F.col(d.columns[0]).cast("date").alias("date_day")) for d in date_columns]
    days = reduce(lambda a, b: a.unionByName(b), dates).where(F.col("date_day").isNotNull()).distinct()
    attrs = date_attributes("date_day")
    return days.select(*[v.alias(k) for k, v in attrs.items()])


def dim_date_from_silver(listings: DataFrame, calendar: DataFrame, reviews: DataFrame) -> DataFrame:
    return dim_date([calendar.select("calendar_date"), reviews.select("review_date"),
                     listings.select("last_scraped"), listings.select("host_since"), listings.select("last_review")])


def listing_key_map(listings: DataFrame, city: str = DEFAULT_CITY) -> DataFrame:
    """listing_id -> (listing_key, host_key, location_key) for listings that have a host."""
    return listings.where(F.col("host_id").isNotNull() & F.col("listing_id").isNotNull()).select(
        "listing_id",
        surrogate_key("listing_id").alias("listing_key"),
        surrogate_key("host_id").alias("host_key"),
        location_key(city, F.coalesce(F.col("neighbourhood"), F.lit(UNKNOWN_MEMBER))).alias("location_key"))


def fact_availability_daily(calendar: DataFrame, listings: DataFrame, city: str = DEFAULT_CITY) -> DataFrame:
    keys = listing_key_map(listings, city)
    j = calendar.join(keys, "listing_id", "inner")
    return j.select(
        surrogate_key("listing_id", F.col("calendar_date").cast("date")).alias("availability_daily_key"),
        "listing_key", "host_key", "location_key", date_key("calendar_date").alias("calendar_date_key"),
        "listing_id", "is_available", F.col("minimum_nights").alias("calendar_minimum_nights"),
        F.col("maximum_nights").alias("calendar_maximum_nights"))


def fact_review(reviews: DataFrame, listings: DataFrame, city: str = DEFAULT_CITY) -> DataFrame:
    keys = listing_key_map(listings, city)
    j = reviews.join(keys, "listing_id", "inner")
    return j.select(
        surrogate_key("review_id").alias("review_key"), "listing_key", "host_key", "location_key",
        date_key("review_date").alias("review_date_key"), "review_id", "listing_id", "reviewer_id", "has_comment",
        F.lit(1).alias("review_count"))


SNAPSHOT_MEASURES = [
    "availability_30", "availability_60", "availability_90", "availability_365", "number_of_reviews",
    "number_of_reviews_ltm", "reviews_per_month", "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication", "review_scores_location",
    "review_scores_value", "calculated_host_listings_count",
]


def fact_listing_current_snapshot(listings: DataFrame, city: str = DEFAULT_CITY) -> DataFrame:
    """One row per listing with a host; the snapshot key is NULL when last_scraped is NULL
    (the not-null test on it is the guard)."""
    l = listings.where(F.col("host_id").isNotNull() & F.col("listing_id").isNotNull())
    return l.select(
        surrogate_key("listing_id", F.col("last_scraped").cast("date")).alias("listing_snapshot_key"),
        surrogate_key("listing_id").alias("listing_key"), surrogate_key("host_id").alias("host_key"),
        location_key(city, F.coalesce(F.col("neighbourhood"), F.lit(UNKNOWN_MEMBER))).alias("location_key"),
        date_key("last_scraped").alias("snapshot_date_key"), date_key("last_review").alias("last_review_date_key"),
        "listing_id", F.col("price").alias("listing_snapshot_price"), *SNAPSHOT_MEASURES,
        F.lit(1).alias("listing_count"))
