"""Raw listings: one ordinary row, and variations that each prove something."""

import datetime
from decimal import Decimal

from starmart.plans.listings import RAW_COLUMNS, RAW_SCHEMA

D = datetime.date
ORDINARY = {c.name: None for c in RAW_COLUMNS} | {
    "listing_url": "https://example.org/rooms/1",
    "scrape_id": 20231226,
    "last_scraped": D(2023, 12, 26),
    "latitude": Decimal("39.960000000000001"),
    "longitude": Decimal("-82.900000000000000"),
    "source": "city scrape",
    "name": "Home",
    "description": "unused",
    "neighborhood_overview": "Quiet",
    "picture_url": "https://example.org/p",
    "host_id": 7,
    "host_url": "https://example.org/users/7",
    "host_name": "Sam",
    "host_since": D(2015, 1, 2),
    "host_about": "Hello",
    "host_response_time": "within an hour",
    "host_response_rate": "97%",
    "host_acceptance_rate": "100%",
    "host_is_superhost": "t",
    "host_listings_count": 1,
    "host_total_listings_count": 2,
    "host_verifications": "['email', 'phone']",
    "host_has_profile_pic": "t",
    "host_identity_verified": "f",
    "neighbourhood": "Springfield",
    "neighbourhood_cleansed": "Hilltop",
    "property_type": "Entire home",
    "room_type": "Entire home/apt",
    "accommodates": "4",
    "bathrooms_text": "1 bath",
    "beds": "2.0",
    "amenities": "[]",
    "price": "$85.00",
    "minimum_nights": 2,
    "maximum_nights": 30,
    "minimum_nights_avg_ntm": 2,
    "maximum_nights_avg_ntm": 30,
    "has_availability": "t",
    "availability_30": "1",
    "availability_60": "2",
    "availability_90": "3",
    "availability_365": "4",
    "number_of_reviews": "10",
    "number_of_reviews_ltm": 3,
    "number_of_reviews_l30d": 1,
    "first_review": D(2020, 1, 1),
    "last_review": D(2023, 1, 1),
    "review_scores_rating": "4.91",
    "license": "2023-1",
    "instant_bookable": "f",
    "calculated_host_listings_count": "1",
    "reviews_per_month": "0.55",
}
NEVER_REVIEWED = {
    "number_of_reviews": "0",
    "first_review": None,
    "last_review": None,
    "review_scores_rating": None,
    "reviews_per_month": None,
}
VARIATIONS = {
    1: {},
    2: {"host_id": 8, "host_response_time": "within a day"},
    3: {"host_id": 9, "host_response_time": "a few days or more"},
    4: {
        "host_id": 10,
        "host_response_time": "N/A",
        "host_response_rate": "N/A",
        "host_acceptance_rate": "N/A",
    },
    6: {"host_id": 11, "host_verifications": "['work_email']"},
    7: {"host_id": 12, "host_verifications": None},
    71: {"host_id": 13, "host_verifications": "[]"},
    8: {"host_id": 14, "host_is_superhost": None, "host_has_profile_pic": "f"},
    9: {"price": "$1,200.00"},
    10: {"price": None},
    11: NEVER_REVIEWED,
    111: NEVER_REVIEWED,
    12: {"bathrooms_text": None},
    121: {"bathrooms_text": "Half-bath"},
    122: {"bathrooms_text": "Private half-bath"},
    123: {"bathrooms_text": "Shared half-bath"},
    124: {"bathrooms_text": "1.5 shared baths"},
    13: {"reviews_per_month": "12.34"},
    14: {"neighborhood_overview": "Loud"},
    15: {"room_type": "Private room"},
    17: {"name": 'Line one,\n"quoted" and more'},
    18: {"license": "a very long license"},
    19: {"neighbourhood_cleansed": "Elsewhere"},
}
SECOND_HOST_VERSION = {161: {"host_about": "Hello again"}}


def raw_rows(spark, *variations):
    names = [c.name for c in RAW_COLUMNS]
    data = [
        tuple((ORDINARY | changes | {"id": id_})[n] for n in names)
        for group in (variations or (VARIATIONS,))
        for id_, changes in group.items()
    ]
    return spark.createDataFrame(data, RAW_SCHEMA)
