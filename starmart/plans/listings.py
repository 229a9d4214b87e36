"""The short-stay listings star: cleaning rules, nine dimensions, one fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import (
    code_map,
    flag,
    labels_to_bits,
    number_and_description,
    percent_fraction,
    replace_text,
    when_contains,
)
from starmart.functions import rules as R
from starmart.operators.casting import cast_schema, fill_nulls
from starmart.operators.columns import rename
from starmart.plans.star import build_star
from starmart.sources.store import Store
from starmart.spec import Dimension, Reference, Star, columns, struct_of

# Table and column names, types and widths of source and target.

RAW_COLUMNS = columns(
    """id bigint, listing_url varchar(255), scrape_id bigint, last_scraped date,
    source varchar(255), name varchar(255), description string, neighborhood_overview string,
    picture_url varchar(255), host_id int, host_url varchar(255), host_name varchar(255),
    host_since date, host_location varchar(255), host_about string,
    host_response_time varchar(50), host_response_rate varchar(10),
    host_acceptance_rate varchar(10), host_is_superhost char(1),
    host_thumbnail_url varchar(255), host_picture_url varchar(255),
    host_neighbourhood varchar(255), host_listings_count int, host_total_listings_count int,
    host_verifications varchar(255), host_has_profile_pic char(1),
    host_identity_verified char(1), neighbourhood varchar(255),
    neighbourhood_cleansed varchar(255), neighbourhood_group_cleansed varchar(255),
    latitude decimal(18,15), longitude decimal(18,15), property_type varchar(255),
    room_type varchar(255), accommodates varchar(255), bathrooms varchar(255),
    bathrooms_text varchar(255), bedrooms varchar(255), beds varchar(10),
    amenities varchar(255), price varchar(10), minimum_nights int, maximum_nights int,
    minimum_minimum_nights int, maximum_minimum_nights int, minimum_maximum_nights int,
    maximum_maximum_nights int, minimum_nights_avg_ntm int, maximum_nights_avg_ntm int,
    calendar_updated varchar(1), has_availability char(1), availability_30 varchar(10),
    availability_60 varchar(10), availability_90 varchar(10), availability_365 varchar(10),
    calendar_last_scraped date, number_of_reviews varchar(10), number_of_reviews_ltm int,
    number_of_reviews_l30d int, first_review date, last_review date,
    review_scores_rating varchar(10), review_scores_accuracy varchar(10),
    review_scores_cleanliness varchar(10), review_scores_checkin varchar(10),
    review_scores_communication varchar(10), review_scores_location varchar(10),
    review_scores_value varchar(10), license varchar(20), instant_bookable char(1),
    calculated_host_listings_count varchar(10),
    calculated_host_listings_count_entire_homes int,
    calculated_host_listings_count_private_rooms int,
    calculated_host_listings_count_shared_rooms int, reviews_per_month varchar(10)"""
)

UNUSED_COLUMNS = (
    "calendar_last_scraped",
    "description",
    "calendar_updated",
    "bedrooms",
    "bathrooms",
    "neighbourhood_group_cleansed",
    "amenities",
)

RENAMED_COLUMNS = {
    "id": "listing_id",
    "neighborhood_overview": "neighbourhood_overview",
    "price": "daily_price",
}

FLAG_COLUMNS = (
    "host_is_superhost",
    "host_has_profile_pic",
    "host_identity_verified",
    "has_availability",
    "instant_bookable",
)

FILLS: Mapping[str, object] = {
    "host_about": R.MISSING_TEXT,
    "host_location": R.MISSING_TEXT,
    "host_neighbourhood": R.MISSING_TEXT,
    "host_response_time": R.MISSING_CODE,
    "host_response_rate": R.MISSING_NUMBER,
    "host_acceptance_rate": R.MISSING_NUMBER,
    "host_is_superhost": R.MISSING_NUMBER,
    "beds": R.MISSING_NUMBER,
    "daily_price": R.MISSING_NUMBER,
    "review_scores_rating": R.MISSING_NUMBER,
    "review_scores_accuracy": R.MISSING_NUMBER,
    "review_scores_cleanliness": R.MISSING_NUMBER,
    "review_scores_checkin": R.MISSING_NUMBER,
    "review_scores_communication": R.MISSING_NUMBER,
    "review_scores_location": R.MISSING_NUMBER,
    "review_scores_value": R.MISSING_NUMBER,
    "reviews_per_month": R.MISSING_NUMBER,
    "neighbourhood": R.MISSING_TEXT,
    "neighbourhood_overview": R.MISSING_TEXT,
    "neighbourhood_cleansed": R.MISSING_TEXT,
    "has_availability": R.MISSING_NUMBER,
    "license": R.MISSING_TEXT,
}

NEIGHBOURHOODS = (
    "Clintonville",
    "Downtown",
    "Eastland/Brice",
    "Eastmoor/Walnut Ridge",
    "Far East",
    "Far North",
    "Far Northwest",
    "Far South",
    "Far West",
    "Franklinton",
    "Greenlawn/Frank Road",
    "Hayden Run",
    "Hilltop",
    "Near East",
    "Near North/University",
    "Near South",
    "Northeast",
    "Northland",
    "North Linden",
    "Northwest",
    "Rickenbacker",
    "Rocky Fork-Blacklick",
    "Southeast",
    "South Linden",
    "Westland",
    "West Olentangy",
    "West Scioto",
)

LISTINGS_STAR = Star(
    dimensions=(
        Dimension(
            "host_quals_diags",
            "host_quals_id",
            columns(
                """host_response_time varchar(3), host_response_rate decimal(3,2),
                host_acceptance_rate decimal(3,2), host_is_superhost int,
                host_listings_count int, host_total_listings_count int,
                host_verifications varchar(3), host_has_profile_pic int,
                host_identity_verified int"""
            ),
        ),
        Dimension(
            "host_listings_diags",
            "host_listings_diags_id",
            columns(
                """calculated_host_listings_count int,
                calculated_host_listings_count_entire_homes int,
                calculated_host_listings_count_private_rooms int,
                calculated_host_listings_count_shared_rooms int"""
            ),
        ),
        Dimension(
            "property",
            "property_id",
            columns(
                """latitude decimal(18,15), longitude decimal(18,15), property_type varchar(255),
                room_type varchar(100), accommodates int, bathrooms decimal(5,1),
                bathroom_desc varchar(50), beds int, daily_price decimal(10,2)"""
            ),
        ),
        Dimension(
            "reviews_diagnostics",
            "rev_diag_id",
            columns(
                """number_of_reviews int, number_of_reviews_ltm int, number_of_reviews_l30d int,
                first_review date, last_review date, review_scores_rating decimal(3,2),
                review_scores_accuracy decimal(3,2), review_scores_cleanliness decimal(3,2),
                review_scores_checkin decimal(3,2), review_scores_communication decimal(3,2),
                review_scores_location decimal(3,2), review_scores_value decimal(3,2),
                reviews_per_month decimal(3,2)"""
            ),
        ),
        Dimension(
            "scrapings",
            "scraping_id",
            columns("scrape_id bigint, last_scraped date, source varchar(20)"),
        ),
        Dimension(
            "neighbourhoods",
            "neighbourhood_id",
            columns(
                """neighbourhood varchar(255), neighbourhood_overview varchar(2000),
                neighbourhood_cleansed varchar(255)"""
            ),
        ),
        Dimension(
            "minmax_insights",
            "minmax_insights_id",
            columns(
                """maximum_nights int, minimum_nights int, minimum_minimum_nights int,
                maximum_minimum_nights int, minimum_maximum_nights int,
                maximum_maximum_nights int, minimum_nights_avg_ntm numeric,
                maximum_nights_avg_ntm numeric"""
            ),
        ),
        Dimension(
            "availability_info",
            "avail_id",
            columns(
                """has_availability int, availability_30 int, availability_60 int,
                availability_90 int, availability_365 int"""
            ),
        ),
        Dimension(
            "host",
            "host_id",
            columns(
                """host_id bigint, host_url varchar(50), host_name varchar(255), host_since date,
                host_location varchar(255), host_about varchar(10000),
                host_thumbnail_url varchar(255), host_picture_url varchar(255),
                host_neighbourhood varchar(255)"""
            ),
            natural_key=True,
            references=(
                Reference("host_listings_diags_id", "host_listings_diags"),
                Reference("host_quals_id", "host_quals_diags"),
            ),
        ),
    ),
    fact=Dimension(
        "listings",
        "listing_id",
        columns(
            """listing_id bigint, listing_url varchar(100), name varchar(255),
            picture_url varchar(255), license varchar(10), instant_bookable int"""
        ),
        natural_key=True,
        references=(
            Reference("scraping_id", "scrapings"),
            Reference("host_id", "host"),
            Reference("neighbourhood_id", "neighbourhoods"),
            Reference("property_id", "property"),
            Reference("minmax_insights_id", "minmax_insights"),
            Reference("avail_info_id", "availability_info"),
            Reference("rev_diag_id", "reviews_diagnostics"),
        ),
    ),
)

# The shorter column lists by which the published rules find keys.
PARTIAL_KEYS = {
    "property": (
        "latitude",
        "longitude",
        "daily_price",
        "beds",
        "bathroom_desc",
        "accommodates",
    ),
    "scrapings": ("last_scraped", "source"),
    "neighbourhoods": ("neighbourhood", "neighbourhood_cleansed"),
}

# The other column pair by which one published variant finds neighbourhoods.
OVERVIEW_KEY = ("neighbourhood_overview", "neighbourhood_cleansed")

RAW_SCHEMA = struct_of(RAW_COLUMNS)


def with_partial_keys(star: Star, keys: Mapping[str, Sequence[str]]) -> Star:
    """The same star, with the fact's keys into the named tables found by fewer columns."""
    references = tuple(
        replace(r, on=tuple(keys.get(r.table, ()))) for r in star.fact.references
    )
    return replace(star, fact=replace(star.fact, references=references))


@dataclass(frozen=True)
class Rules:
    """How texts are read. The defaults are the corrected rules."""

    response_codes: Mapping[str, str]
    half_baths: Mapping[str, str]
    half_bath_ignore_case: bool = True
    label_match: str = "member"
    flag_match: str = "exact"
    null_flag: int | None = 0
    money_strip: Sequence[str] = ("$", ",")


CORRECTED = Rules(R.RESPONSE_TIME_CODES, R.HALF_BATH_TEXTS)

# The rules exactly as published: misspelt day code, case-sensitive bath texts,
# labels and flags found anywhere in the text, thousands commas left in prices.
AS_PUBLISHED = Rules(
    R.RESPONSE_TIME_CODES_AS_PUBLISHED,
    R.HALF_BATH_TEXTS_AS_PUBLISHED,
    half_bath_ignore_case=False,
    label_match="substring",
    flag_match="contains",
    money_strip=("$",),
)


def read_texts(df: DataFrame, rules: Rules = CORRECTED) -> DataFrame:
    """Recode the coded texts that ``df`` has; other columns stay as they are."""
    have = set(df.columns)
    derived: dict[str, SparkColumn] = {}
    if "host_response_time" in have:
        derived["host_response_time"] = code_map(
            F.col("host_response_time"), rules.response_codes
        )
    for name in ("host_response_rate", "host_acceptance_rate"):
        if name in have:
            derived[name] = percent_fraction(F.col(name))
    if "host_verifications" in have:
        derived["host_verifications"] = labels_to_bits(
            F.col("host_verifications"), R.VERIFICATION_LABELS, rules.label_match
        )
    for name in FLAG_COLUMNS:
        if name in have:
            derived[name] = flag(F.col(name), rules.flag_match, rules.null_flag)
    if "bathrooms_text" in have:
        text = when_contains(
            F.col("bathrooms_text"), rules.half_baths, rules.half_bath_ignore_case
        )
        derived["bathrooms"], derived["bathroom_desc"] = number_and_description(text)
    if "daily_price" in have:
        derived["daily_price"] = replace_text(F.col("daily_price"), *rules.money_strip)
    return df.withColumns(derived)


def clean_listings(raw: DataFrame, rules: Rules = CORRECTED, fills=None) -> DataFrame:
    """Raw 75-column listings -> typed wide table: drop, rename, recode, cast, fill.

    All steps are projections of built-in expressions; Catalyst merges them into
    one. Rows are neither dropped nor moved.
    """
    return (
        raw.drop(*UNUSED_COLUMNS)
        .transform(rename, RENAMED_COLUMNS)
        .transform(read_texts, rules)
        .transform(cast_schema, LISTINGS_STAR.wide_columns, keep_others=False)
        .transform(fill_nulls, FILLS if fills is None else fills)
    )


def load_listings(
    raw: DataFrame,
    store: Store | None = None,
    rules: Rules = CORRECTED,
    star: Star = LISTINGS_STAR,
    **options,
) -> dict[str, DataFrame]:
    """Source rows -> ten written tables, read back."""
    return build_star(clean_listings(raw, rules), star, store, **options)
