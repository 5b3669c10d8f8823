"""Silver models: typed, cleaned, de-duplicated tables from the raw (all-text) bronze drop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.functions.cleaning import (clean_boolean, clean_money, clean_percent, clean_text, first_number,
                                         resolve_column, safe_cast)
from staylake.operators.dedup import casefold_distinct, latest_per_key, most_complete_per_key

LISTING_INT_COLUMNS = [
    "host_listings_count", "host_total_listings_count", "accommodates", "minimum_nights", "maximum_nights",
    "availability_30", "availability_60", "availability_90", "availability_365", "number_of_reviews",
    "number_of_reviews_ltm", "calculated_host_listings_count",
]
REVIEW_SCORE_COLUMNS = [
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
    "review_scores_communication", "review_scores_location", "review_scores_value",
]


def silver_listings_columns(src: DataFrame) -> list[Column]:
    """The typed projection of a raw listings drop (45 columns)."""
    col = lambda name, **kw: resolve_column(src, name, **kw)
    null_text = F.lit(None).cast("string")
    opt = lambda name: col(name, default=null_text)
    return [
        safe_cast(col("id"), "bigint").alias("listing_id"),
        clean_text(col("name")).alias("listing_name"),
        safe_cast(col("host_id"), "bigint").alias("host_id"),
        clean_text(col("host_name")).alias("host_name"),
        safe_cast(col("host_since"), "date").alias("host_since"),
        clean_text(col("host_location")).alias("host_location"),
        clean_text(col("host_response_time")).alias("host_response_time"),
        clean_percent(col("host_response_rate")).alias("host_response_rate"),
        clean_percent(col("host_acceptance_rate")).alias("host_acceptance_rate"),
        clean_boolean(col("host_is_superhost")).alias("host_is_superhost"),
        safe_cast(col("host_listings_count"), "int").alias("host_listings_count"),
        safe_cast(col("host_total_listings_count"), "int").alias("host_total_listings_count"),
        clean_boolean(col("host_identity_verified")).alias("host_identity_verified"),
        F.coalesce(clean_text(opt("neighbourhood_cleansed")), clean_text(opt("neighbourhood"))).alias("neighbourhood"),
        F.coalesce(clean_text(opt("neighbourhood_group_cleansed")), clean_text(opt("neighbourhood_group"))).alias("neighbourhood_group"),
        safe_cast(col("latitude"), "double").alias("latitude"),
        safe_cast(col("longitude"), "double").alias("longitude"),
        clean_text(col("property_type")).alias("property_type"),
        clean_text(col("room_type")).alias("room_type"),
        safe_cast(col("accommodates"), "int").alias("accommodates"),
        F.coalesce(safe_cast(F.trim(opt("bathrooms")), "double"), first_number(opt("bathrooms_text"))).alias("bathrooms"),
        safe_cast(F.trim(col("bedrooms")), "double").alias("bedrooms"),
        safe_cast(F.trim(col("beds")), "double").alias("beds"),
        clean_text(col("amenities")).alias("amenities"),
        clean_money(col("price")).alias("price"),
        *[safe_cast(col(c), "int").alias(c) for c in LISTING_INT_COLUMNS[3:5]],
        *[safe_cast(col(c), "int").alias(c) for c in LISTING_INT_COLUMNS[5:9]],
        clean_boolean(col("instant_bookable")).alias("instant_bookable"),
        safe_cast(col("number_of_reviews"), "int").alias("number_of_reviews"),
        safe_cast(col("number_of_reviews_ltm"), "int").alias("number_of_reviews_ltm"),
        safe_cast(col("last_review"), "date").alias("last_review"),
        *[safe_cast(F.trim(col(c)), "double").alias(c) for c in REVIEW_SCORE_COLUMNS],
        safe_cast(F.trim(col("reviews_per_month")), "double").alias("reviews_per_month"),
        safe_cast(col("calculated_host_listings_count"), "int").alias("calculated_host_listings_count"),
        safe_cast(col("last_scraped"), "date").alias("last_scraped"),
    ]


def silver_listings(bronze: DataFrame) -> DataFrame:
    """One row per listing: the latest scrape, ties broken by listing name."""
    typed = bronze.select(*silver_listings_columns(bronze))
    return latest_per_key(typed, ["listing_id"],
                          [F.col("last_scraped").desc_nulls_last(), F.col("listing_name").asc_nulls_last()],
                          cluster_by=["listing_id"])


def silver_calendar(bronze: DataFrame, dedup: bool = True) -> DataFrame:
    """One row per (listing_id, calendar_date); with ``dedup`` the most complete row wins.

    ``dedup=False`` keeps every valid-key row (use the duplicate profile to
    see what that leaves in).
    """
    col = lambda name: resolve_column(bronze, name)
    typed = bronze.select(
        safe_cast(col("listing_id"), "bigint").alias("listing_id"),
        safe_cast(col("date"), "date").alias("calendar_date"),
        clean_boolean(col("available")).alias("is_available"),
        clean_money(resolve_column(bronze, "price", default=F.lit(None).cast("string"))).alias("price"),
        clean_money(resolve_column(bronze, "adjusted_price", default=F.lit(None).cast("string"))).alias("adjusted_price"),
        safe_cast(col("minimum_nights"), "int").alias("minimum_nights"),
        safe_cast(col("maximum_nights"), "int").alias("maximum_nights"),
    ).where(F.col("listing_id").isNotNull() & F.col("calendar_date").isNotNull())
    if not dedup:
        return typed
    # clustered by listing_id: the dedup, the bucketed write and the fact join share one partitioning
    return most_complete_per_key(typed, ["listing_id", "calendar_date"],
                                 ["is_available", "minimum_nights", "maximum_nights"], cluster_by=["listing_id"])


def silver_reviews(bronze: DataFrame) -> DataFrame:
    col = lambda name: resolve_column(bronze, name)
    return bronze.select(
        safe_cast(col("id"), "bigint").alias("review_id"),
        safe_cast(col("listing_id"), "bigint").alias("listing_id"),
        safe_cast(col("date"), "date").alias("review_date"),
        safe_cast(col("reviewer_id"), "bigint").alias("reviewer_id"),
        clean_text(col("reviewer_name")).alias("reviewer_name"),
        clean_text(col("comments")).alias("comments"),
    ).where(F.col("review_id").isNotNull() & F.col("listing_id").isNotNull()) \
     .withColumn("has_comment", F.col("comments").isNotNull())


def silver_neighbourhoods(bronze: DataFrame) -> DataFrame:
    cleaned = bronze.select(clean_text(resolve_column(bronze, "neighbourhood")).alias("neighbourhood"))
    return casefold_distinct(cleaned, "neighbourhood")
