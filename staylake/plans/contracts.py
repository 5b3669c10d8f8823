"""Declared table contracts (the warehouse tests), replayed by ``quality.run_suite``.

Row-level expectations of one table run as one fused scan; key, relationship
and count expectations run as one job each.
"""

from __future__ import annotations

from staylake.operators.quality import Expectation as E

# Accepted labels used by the contracts.
ROOM_TYPES = ["Entire home/apt", "Private room", "Shared room", "Hotel room"]
PROPERTY_BASE_GROUPS = ["Serviced Apartment / Aparthotel", "Hostel", "Guesthouse / B&B", "Hotel / Resort", "Villa",
                        "Apartment / Condo", "House / Home", "Niche / Special Stay", "Unspecified Property Type"]


def _rel(col, to, field):
    return E("relationships", col, {"to": to, "field": field})


def _between(col, lo, hi):
    return E("between_or_null", col, {"min_value": lo, "max_value": hi})


def _fact_common(grain, compare, date_col):
    return [
        E("unique_combination_of_columns", None, {"columns": grain}),
        E("row_count_matches", None, {"compare_model": compare}),
        E("unknown_member_ratio_below", None, {"dimension": "dim_location"}),
        E("not_null", "listing_key"), _rel("listing_key", "dim_listing", "listing_key"),
        E("not_null", "host_key"), _rel("host_key", "dim_host", "host_key"),
        E("not_null", "location_key"), _rel("location_key", "dim_location", "location_key"),
        E("not_null", date_col), _rel(date_col, "dim_date", "date_key"),
        E("not_null", "listing_id"), _rel("listing_id", "dim_listing", "listing_id"),
    ]


CONTRACTS: dict[str, list[E]] = {
    "bronze_listings": [E("not_null", "id"), E("unique", "id"), E("not_null", "host_id")],
    "bronze_calendar": [E("unique_combination_of_columns", None, {"columns": ["listing_id", "date"]}),
                        E("not_null", "listing_id"), E("not_null", "date")],
    "bronze_reviews": [E("not_null", "id"), E("unique", "id"), E("not_null", "listing_id")],
    "bronze_neighbourhoods": [E("not_null", "neighbourhood"), E("unique", "neighbourhood")],
    "silver_listings": [
        E("not_null", "listing_id"), E("unique", "listing_id"), E("not_null", "host_id"),
        E("positive_or_null", "price"), _between("host_response_rate", 0, 1), _between("host_acceptance_rate", 0, 1),
        _between("availability_365", 0, 365), E("accepted_values", "room_type", {"values": ROOM_TYPES}),
        _between("latitude", -90, 90), _between("longitude", -180, 180),
        _rel("neighbourhood", "silver_neighbourhoods", "neighbourhood"), E("positive_or_null", "minimum_nights"),
        E("less_than_or_equal_or_null", "minimum_nights", {"right_column": "maximum_nights"}),
        E("positive_or_null", "maximum_nights"),
    ],
    "silver_neighbourhoods": [E("not_null", "neighbourhood"), E("unique", "neighbourhood")],
    "silver_calendar": [
        E("unique_combination_of_columns", None, {"columns": ["listing_id", "calendar_date"]}),
        E("not_null", "listing_id"), _rel("listing_id", "silver_listings", "listing_id"), E("not_null", "calendar_date"),
        E("positive_or_null", "price"), E("positive_or_null", "adjusted_price"),
        E("less_than_or_equal_or_null", "minimum_nights", {"right_column": "maximum_nights"}),
    ],
    "silver_reviews": [
        E("not_null", "review_id"), E("unique", "review_id"), E("not_null", "listing_id"),
        _rel("listing_id", "silver_listings", "listing_id"), E("not_null", "review_date"),
    ],
    "dim_listing": [E("not_null", "listing_key"), E("unique", "listing_key"), E("not_null", "listing_id"),
                    E("unique", "listing_id"), _between("latitude", -90, 90), _between("longitude", -180, 180)],
    "dim_host": [E("not_null", "host_key"), E("unique", "host_key"), E("not_null", "host_id"), E("unique", "host_id"),
                 E("not_null", "source_last_scraped_date")],
    "dim_location": [
        E("unique_combination_of_columns", None, {"columns": ["city", "neighbourhood"]}),
        E("member_exists", None, {"conditions": {"neighbourhood": "UNKNOWN"}}),
        E("not_null", "location_key"), E("unique", "location_key"), E("not_null", "city"), E("not_null", "neighbourhood"),
    ],
    "dim_date": [E("not_null", "date_key"), E("unique", "date_key"), E("not_null", "date_day"), E("unique", "date_day")],
    "fact_listing_current_snapshot": _fact_common(["listing_key", "snapshot_date_key"], "silver_listings",
                                                  "snapshot_date_key") + [
        E("not_null", "listing_snapshot_key"), E("unique", "listing_snapshot_key"),
        _rel("last_review_date_key", "dim_date", "date_key"), E("positive_or_null", "listing_snapshot_price"),
        E("accepted_values", "listing_count", {"values": [1]}),
    ],
    "fact_availability_daily": _fact_common(["listing_key", "calendar_date_key"], "silver_calendar",
                                            "calendar_date_key") + [
        E("not_null", "availability_daily_key"), E("unique", "availability_daily_key"),
    ],
    "fact_review": _fact_common(["review_id"], "silver_reviews", "review_date_key") + [
        E("not_null", "review_key"), E("unique", "review_key"), E("not_null", "review_id"), E("unique", "review_id"),
        E("accepted_values", "review_count", {"values": [1]}),
    ],
    "gold_cluster_model_features": [
        E("not_empty"), E("not_null", "listing_id"), E("unique", "listing_id"), E("not_null", "price"),
        E("greater_than", "price", {"value": 0}), E("not_null", "room_type"), E("not_null", "property_base_group"),
        E("accepted_values", "property_base_group", {"values": PROPERTY_BASE_GROUPS}),
        *[e for c in ["accommodates", "bedrooms", "bathrooms", "beds", "amenities_count", "minimum_nights_log"]
          for e in (E("not_null", c), E("non_negative", c))],
    ],
    "gold_price_model_features": [E("not_null", "listing_id"), E("unique", "listing_id"), E("not_null", "price"),
                                  E("positive_or_null", "price"), E("not_null", "log_price")],
}
