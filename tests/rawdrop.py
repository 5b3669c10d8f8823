"""Seeded synthetic raw CSV drop (listings, calendar, reviews, neighbourhoods)
with the edge cases the silver layer must survive. Built from a rule, not from
reference data."""

from __future__ import annotations

import csv
import os
import random

LISTING_COLS = [
    "id", "name", "host_id", "host_name", "host_since", "host_location", "host_response_time", "host_response_rate",
    "host_acceptance_rate", "host_is_superhost", "host_listings_count", "host_total_listings_count",
    "host_identity_verified", "neighbourhood_cleansed", "latitude", "longitude", "property_type", "room_type",
    "accommodates", "bathrooms_text", "bedrooms", "beds", "amenities", "price", "minimum_nights", "maximum_nights",
    "availability_30", "availability_60", "availability_90", "availability_365", "instant_bookable",
    "number_of_reviews", "number_of_reviews_ltm", "last_review", "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication", "review_scores_location",
    "review_scores_value", "reviews_per_month", "calculated_host_listings_count", "last_scraped",
]
NEIGHBOURHOODS = ["Bang Rak", "Khlong Toei", "Sathon", "Watthana", "Ratchathewi"]
ROOMS = ["Entire home/apt", "Private room", "Shared room", "Hotel room"]
PROPS = ["Entire rental unit", "Private room in condo", "Entire villa", "Room in boutique hotel", "Tiny home",
         "Entire serviced apartment", "Shared room in hostel", "Entire townhouse"]
AMENITIES = ['["Wifi", "Kitchen"]', "[]", "{}", "{Wifi,,TV}", '{"a":1}', "not json", ""]


BIG_ID = "9007199254740993"  # above 2**53


def _lid(i: int) -> str:
    return BIG_ID if i == 8 else str(i)


def write_drop(folder: str, n_listings: int = 250, seed: int = 42, faults: bool = False) -> dict:
    rng = random.Random(seed)
    os.makedirs(folder, exist_ok=True)
    listings = []
    for i in range(1, n_listings + 1):
        host = 1000 + (i % 17)
        price = rng.choice([f"${rng.randint(500, 9000):,}.00", f"{rng.randint(300, 5000)}", "$1,234.00"])
        mn = rng.randint(1, 30)
        listings.append({
            "id": str(i), "name": f"Listing {i}", "host_id": str(host), "host_name": f"Host {host}",
            "host_since": "2019-05-0%d" % (1 + i % 9), "host_location": "Bangkok", "host_response_time": "within an hour",
            "host_response_rate": rng.choice(["95%", "100%", "N/A"]), "host_acceptance_rate": rng.choice(["80%", "N/A"]),
            "host_is_superhost": rng.choice(["t", "f", "YES", "0", "maybe"]), "host_listings_count": rng.choice(["3", "3.0"]),
            "host_total_listings_count": "4", "host_identity_verified": "t",
            "neighbourhood_cleansed": NEIGHBOURHOODS[i % 5], "latitude": "13.7", "longitude": "100.5",
            "property_type": PROPS[i % len(PROPS)], "room_type": ROOMS[i % 4], "accommodates": str(1 + i % 6),
            "bathrooms_text": rng.choice(["1.5 baths", "1 bath", "Half-bath", ""]),
            "bedrooms": "" if i % 7 == 0 else str(1 + i % 3), "beds": str(1 + i % 4),
            "amenities": AMENITIES[i % len(AMENITIES)], "price": price, "minimum_nights": str(mn),
            "maximum_nights": str(mn + 30), "availability_30": "10", "availability_60": "20", "availability_90": "30",
            "availability_365": "200", "instant_bookable": "f", "number_of_reviews": str(i % 4),
            "number_of_reviews_ltm": "1", "last_review": "2024-01-0%d" % (1 + i % 9),
            **{c: "4.5" for c in LISTING_COLS if c.startswith("review_scores")},
            "reviews_per_month": "0.5", "calculated_host_listings_count": "2", "last_scraped": "2024-06-16",
        })
    # a listing without neighbourhood (-> UNKNOWN member) and one literally named UNKNOWN (must not duplicate it)
    listings[5]["neighbourhood_cleansed"] = ""
    listings[6]["neighbourhood_cleansed"] = "UNKNOWN"
    # an id above 2**53 written as text must keep every digit
    listings[7]["id"] = BIG_ID
    # an older duplicate scrape of listing 1 (must lose) and one with a NULL scrape date
    listings.append({**listings[0], "name": "Listing 1 old", "last_scraped": "2024-03-01"})
    listings.append({**listings[1], "name": "Listing 2 undated", "last_scraped": ""})
    if faults:
        listings[2]["room_type"] = "Castle room"          # accepted_values
        listings[3]["minimum_nights"] = "40"               # > maximum_nights
        listings[3]["maximum_nights"] = "35"
        listings[4]["neighbourhood_cleansed"] = "Atlantis"  # relationship to neighbourhoods
    with open(os.path.join(folder, "listings.csv"), "w", newline="") as f:
        w = csv.DictWriter(f, LISTING_COLS)
        w.writeheader()
        w.writerows(listings)
    cal_rows = []
    for i in range(1, n_listings + 1):
        for day in range(1, 8):
            cal_rows.append([_lid(i), f"2024-07-0{day}", rng.choice(["t", "f"]), "$100.00", "", "1", "30"])
    # duplicate calendar keys with conflicting values; the complete row must win
    cal_rows.append(["1", "2024-07-01", "", "$120.00", "", "", ""])
    with open(os.path.join(folder, "calendar.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["listing_id", "date", "available", "price", "adjusted_price", "minimum_nights", "maximum_nights"])
        w.writerows(cal_rows)
    rev = []
    for r in range(1, 3 * n_listings + 1):
        rev.append([str(r), _lid(1 + r % n_listings), "2024-05-01", str(50 + r), f"Guest {r}",
                    rng.choice(['Great, "really" great\nwould stay again', "  ", "ok", ""])])
    if faults:
        rev.append([str(10 ** 6), str(10 ** 6), "2024-05-01", "1", "Ghost", "orphan review"])
    with open(os.path.join(folder, "reviews.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["id", "listing_id", "date", "reviewer_id", "reviewer_name", "comments"])
        w.writerows(rev)
    with open(os.path.join(folder, "neighbourhoods.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["neighbourhood_group", "neighbourhood"])
        for nb in NEIGHBOURHOODS + ["bang rak", "  ", "UNKNOWN"]:
            w.writerow(["", nb])
    with open(os.path.join(folder, "neighbourhoods.geojson"), "w") as f:
        f.write('{"type": "FeatureCollection", "features": []}')
    return {"listings": n_listings, "calendar": n_listings * 7, "reviews": 3 * n_listings}
