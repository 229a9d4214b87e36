"""Text cleaning, casts and fills over the messy view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import (
    code_map,
    first_word_class,
    flag,
    labels_to_bits,
    money,
    number_and_description,
    percent_fraction,
    replace_text,
    sharing,
    to_date,
    when_contains,
)
from starmart.functions import rules as R
from starmart.operators.casting import cast_rejects, cast_schema, fill_nulls
from starmart.operators.quarantine import load_typed
from starmart.plans.listings import AS_PUBLISHED, CORRECTED, read_texts
from starmart.queries import oracle as O
from starmart.queries.inputs import MESSY_SQL, RAW_LISTINGS_SQL, messy, raw_listings, table
from starmart.queries.registry import query
from starmart.sources.store import workspace
from starmart.spec import columns


@query(f"SELECT id, price, replace(price, '$', '') AS bare, {O.money('price')} AS amount FROM ({MESSY_SQL}) m")
def clean_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("price")
    return messy(spark, sf_dir).select(
        "id", price, replace_text(price, "$").alias("bare"), money(price).alias("amount")
    )


@query(f"SELECT id, {O.percent('host_response_rate')} AS rate FROM ({MESSY_SQL}) m")
def clean_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy(spark, sf_dir).select(
        "id", percent_fraction(F.col("host_response_rate")).alias("rate")
    )


@query(
    f"SELECT id, try_cast(first_review AS DATE) AS reviewed, try_cast(price AS DATE) AS nonsense"
    f" FROM ({MESSY_SQL}) m"
)
def clean_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy(spark, sf_dir).select(
        "id",
        to_date(F.col("first_review")).alias("reviewed"),
        to_date(F.col("price")).alias("nonsense"),
    )


@query(
    f"""SELECT id, {O.codes('host_response_time', R.RESPONSE_TIME_CODES)} AS code,
    {O.codes('host_response_time', R.RESPONSE_TIME_CODES_AS_PUBLISHED)} AS code_as_published,
    CAST({O.codes('source', {'O': 1, 'F': 0})} AS INTEGER) AS source_code FROM ({MESSY_SQL}) m"""
)
def map_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    response = F.col("host_response_time")
    return messy(spark, sf_dir).select(
        "id",
        code_map(response, R.RESPONSE_TIME_CODES).alias("code"),
        code_map(response, R.RESPONSE_TIME_CODES_AS_PUBLISHED).alias("code_as_published"),
        code_map(F.col("source"), {"O": 1, "F": 0}).alias("source_code"),
    )


@query(
    f"SELECT id, CAST({O.codes('source', R.SCRAPE_SOURCE_CODES)} AS INTEGER) AS from_city"
    f" FROM ({RAW_LISTINGS_SQL}) r"
)
def map_scrape_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_listings(spark, sf_dir).select(
        "id", code_map(F.col("source"), R.SCRAPE_SOURCE_CODES).alias("from_city")
    )


@query(
    f"""SELECT id, {O.half_bath('bathrooms_text', R.HALF_BATH_TEXTS)} AS baths,
    {O.half_bath('bathrooms_text', R.HALF_BATH_TEXTS_AS_PUBLISHED, False)} AS baths_as_published,
    CAST(instr(bathrooms_text, 'bath') AS INTEGER) AS place FROM ({MESSY_SQL}) m"""
)
def case_instr(spark: SparkSession, sf_dir: str) -> DataFrame:
    baths = F.col("bathrooms_text")
    return messy(spark, sf_dir).select(
        "id",
        when_contains(baths, R.HALF_BATH_TEXTS).alias("baths"),
        when_contains(baths, R.HALF_BATH_TEXTS_AS_PUBLISHED, ignore_case=False).alias(
            "baths_as_published"
        ),
        F.instr(baths, "bath").alias("place"),
    )


_CLASS_SQL = " ".join(
    f"WHEN lower(split_part(property_type, ' ', 1)) = '{k.lower()}' THEN '{v}'"
    for k, v in R.PROPERTY_CLASSES.items()
)


@query(
    f"SELECT id, property_type, CASE WHEN property_type IS NULL THEN NULL {_CLASS_SQL}"
    f" ELSE '{R.OTHER_PROPERTY_CLASS}' END AS property_class FROM ({RAW_LISTINGS_SQL}) r"
)
def classify_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("property_type")
    return raw_listings(spark, sf_dir).select(
        "id",
        kind,
        first_word_class(kind, R.PROPERTY_CLASSES, R.OTHER_PROPERTY_CLASS).alias("property_class"),
    )


@query(
    "SELECT p_partkey, p_type, CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'sized'"
    " ELSE 'other' END AS type_class FROM part"
)
def classify_part_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = {"small": "sized", "medium": "sized", "large": "sized"}
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", first_word_class(F.col("p_type"), sized, "other").alias("type_class")
    )


@query(
    f"SELECT id, CASE WHEN bathrooms_text IS NULL THEN NULL WHEN instr(lower(bathrooms_text), 'private') > 0"
    f" THEN 'private' ELSE 'shared' END AS sharing FROM ({MESSY_SQL}) m"
)
def bath_sharing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared unless the text says otherwise."""
    return messy(spark, sf_dir).select("id", sharing(F.col("bathrooms_text")).alias("sharing"))


_BATHS_SQL = O.half_bath("bathrooms_text", R.HALF_BATH_TEXTS)


@query(
    f"""SELECT id, try_cast({O.before_blank('baths')} AS DECIMAL(5,1)) AS bathrooms,
    {O.after_blank('baths')} AS bathroom_desc
    FROM (SELECT id, {_BATHS_SQL} AS baths FROM ({MESSY_SQL}) m) b"""
)
def split_number_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = when_contains(F.col("bathrooms_text"), R.HALF_BATH_TEXTS)
    number, description = number_and_description(text)
    return messy(spark, sf_dir).select(
        "id", number.alias("bathrooms"), description.alias("bathroom_desc")
    )


@query(
    f"""SELECT id, CAST({O.flag('host_is_superhost')} AS INTEGER) AS as_zero,
    CAST({O.flag('host_is_superhost', 'NULL')} AS INTEGER) AS kept_null,
    CAST(CASE WHEN instr(room_type, 't') > 0 THEN 1 ELSE 0 END AS INTEGER) AS any_t FROM ({MESSY_SQL}) m"""
)
def flag_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    superhost = F.col("host_is_superhost")
    return messy(spark, sf_dir).select(
        "id",
        flag(superhost).alias("as_zero"),
        flag(superhost, null_as=None).alias("kept_null"),
        flag(F.col("room_type"), match="contains").alias("any_t"),
    )


@query(
    f"""SELECT id, {O.member_bits('host_verifications', R.VERIFICATION_LABELS)} AS bits,
    {O.substring_bits('host_verifications', R.VERIFICATION_LABELS)} AS bits_by_substring FROM ({MESSY_SQL}) m""",
    "labels_to_bits",
)
def _labels_to_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("host_verifications")
    return messy(spark, sf_dir).select(
        "id",
        labels_to_bits(text, R.VERIFICATION_LABELS).alias("bits"),
        labels_to_bits(text, R.VERIFICATION_LABELS, "substring").alias("bits_by_substring"),
    )


_CASTS = columns(
    """id bigint, host_id int, price decimal(10,2), first_review date,
    reviews_per_month decimal(3,2), host_response_rate int"""
)
_CASTS_SQL = f"""SELECT id, CAST(host_id AS INTEGER) AS host_id,
  try_cast(price AS DECIMAL(10,2)) AS price, try_cast(first_review AS DATE) AS first_review,
  try_cast(reviews_per_month AS DECIMAL(3,2)) AS reviews_per_month,
  {O.integer('host_response_rate')} AS host_response_rate
  FROM (SELECT id, host_id, substr(price, 2) AS price, first_review, reviews_per_month,
    replace(host_response_rate, '%', '.0') AS host_response_rate FROM ({MESSY_SQL}) m) s"""


def _uncast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy(spark, sf_dir).select(
        "id",
        "host_id",
        F.substr(F.col("price"), F.lit(2)).alias("price"),
        "first_review",
        "reviews_per_month",
        F.replace("host_response_rate", F.lit("%"), F.lit(".0")).alias("host_response_rate"),
    )


@query(_CASTS_SQL, "cast_schema")
def _cast_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_schema(_uncast(spark, sf_dir), _CASTS)


@query(
    f"""SELECT 'price' AS column_name, 'decimal(10,2)' AS type, count(price) AS n_values,
      count(*) FILTER (WHERE price IS NOT NULL AND p IS NULL) AS n_rejects FROM t
    UNION ALL SELECT 'reviews_per_month', 'decimal(3,2)', count(rpm),
      count(*) FILTER (WHERE rpm IS NOT NULL AND r IS NULL) FROM t
    UNION ALL SELECT 'host_response_rate', 'int', count(hrr),
      count(*) FILTER (WHERE hrr IS NOT NULL AND h IS NULL) FROM t""".replace(
        "FROM t",
        f"""FROM (SELECT substr(price, 2) AS price, try_cast(substr(price, 2) AS DECIMAL(10,2)) AS p,
          reviews_per_month AS rpm, try_cast(reviews_per_month AS DECIMAL(3,2)) AS r,
          replace(host_response_rate, '%', '.0') AS hrr,
          {O.integer("replace(host_response_rate, '%', '.0')")} AS h FROM ({MESSY_SQL}) m) t""",
    ),
    "cast_rejects",
)
def _cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    watched = [c for c in _CASTS if c.name in ("price", "reviews_per_month", "host_response_rate")]
    return cast_rejects(_uncast(spark, sf_dir), watched)


def _reason_sql(column: str, typed: str, why: str) -> str:
    return f"SELECT id, '{column}' AS column_name, {column} AS text, {why} AS reason FROM s WHERE {column} IS NOT NULL AND {typed} IS NULL"


_NOT_A_NUMBER = "CASE WHEN try_cast({c} AS DOUBLE) IS NULL THEN 'not a number' ELSE 'out of range' END"
_QUARANTINE_SQL = f"""WITH s AS (SELECT id, host_id, substr(price, 2) AS price, first_review, reviews_per_month,
    replace(host_response_rate, '%', '.0') AS host_response_rate FROM ({MESSY_SQL}) m) """ + " UNION ALL ".join(
    [
        _reason_sql("price", "try_cast(price AS DECIMAL(10,2))", _NOT_A_NUMBER.format(c="price")),
        _reason_sql("first_review", "try_cast(first_review AS DATE)", "'not a date'"),
        _reason_sql("reviews_per_month", "try_cast(reviews_per_month AS DECIMAL(3,2))", _NOT_A_NUMBER.format(c="reviews_per_month")),
        _reason_sql("host_response_rate", O.integer("host_response_rate"), _NOT_A_NUMBER.format(c="host_response_rate")),
    ]
)


@query(_QUARANTINE_SQL)
def load_with_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values set aside by the pass that types the rows, with their row and the reason."""
    store = workspace(spark)
    return load_typed(_uncast(spark, sf_dir), _CASTS, "id", store, "messy").quarantine


@query(
    f"""WITH t AS ({_CASTS_SQL}), s AS (SELECT id, host_id, substr(price, 2) AS price, first_review, reviews_per_month,
      replace(host_response_rate, '%', '.0') AS host_response_rate FROM ({MESSY_SQL}) m) """
    + " UNION ALL ".join(
        f"SELECT '{c.name}' AS column_name, '{c.type}' AS type, (SELECT count({c.name}) FROM s) AS n_values,"
        f" (SELECT count({c.name}) FROM s) - (SELECT count({c.name}) FROM t) AS n_rejects"
        for c in _CASTS
    ),
)
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values and rejects of every column, observed by the pass that types the rows."""
    store = workspace(spark)
    return load_typed(_uncast(spark, sf_dir), _CASTS, "id", store, "messy").counts


@query(
    f"""SELECT id, coalesce({O.codes('host_response_time', R.RESPONSE_TIME_CODES)}, 'NA') AS host_response_time,
    coalesce({O.percent('host_response_rate')}, CAST(-1 AS DECIMAL(3,2))) AS host_response_rate,
    coalesce({O.money('price')}, CAST(-1 AS DECIMAL(10,2))) AS price,
    coalesce(try_cast(first_review AS DATE), DATE '1900-01-01') AS first_review,
    coalesce(bathrooms_text, 'N/A') AS bathrooms_text FROM ({MESSY_SQL}) m""",
    "fill_nulls",
)
def _fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = messy(spark, sf_dir).select(
        "id",
        code_map(F.col("host_response_time"), R.RESPONSE_TIME_CODES).alias("host_response_time"),
        percent_fraction(F.col("host_response_rate")).alias("host_response_rate"),
        money(F.col("price")).alias("price"),
        to_date(F.col("first_review")).alias("first_review"),
        "bathrooms_text",
    )
    return fill_nulls(
        typed,
        {
            "host_response_time": R.MISSING_CODE,
            "host_response_rate": R.MISSING_NUMBER,
            "price": R.MISSING_NUMBER,
            "first_review": "1900-01-01",
            "bathrooms_text": R.MISSING_TEXT,
        },
    )


_MESSY_TYPES = columns(
    """id bigint, host_id bigint, host_response_time string, host_response_rate decimal(3,2),
    host_is_superhost int, host_verifications string, bathrooms decimal(5,1), bathroom_desc string,
    daily_price decimal(10,2), first_review date, reviews_per_month decimal(3,2), source string,
    room_type string"""
)
_MESSY_FILLS = {
    "host_response_time": R.MISSING_CODE,
    "host_response_rate": R.MISSING_NUMBER,
    "daily_price": R.MISSING_NUMBER,
    "reviews_per_month": R.MISSING_NUMBER,
}


def clean_messy_sql(published: bool) -> str:
    codes = R.RESPONSE_TIME_CODES_AS_PUBLISHED if published else R.RESPONSE_TIME_CODES
    texts = R.HALF_BATH_TEXTS_AS_PUBLISHED if published else R.HALF_BATH_TEXTS
    bits = (O.substring_bits if published else O.member_bits)(
        "host_verifications", R.VERIFICATION_LABELS
    )
    price = "try_cast(replace(price, '$', '') AS DECIMAL(10,2))" if published else O.money("price")
    baths = O.half_bath("bathrooms_text", texts, not published)
    missing = "CAST(-1 AS DECIMAL(10,2))"
    return f"""SELECT id, host_id, coalesce({O.codes('host_response_time', codes)}, 'NA') AS host_response_time,
      coalesce({O.percent('host_response_rate')}, CAST(-1 AS DECIMAL(3,2))) AS host_response_rate,
      CAST({O.flag('host_is_superhost')} AS INTEGER) AS host_is_superhost, {bits} AS host_verifications,
      try_cast({O.before_blank('baths')} AS DECIMAL(5,1)) AS bathrooms,
      {O.after_blank('baths')} AS bathroom_desc, coalesce({price}, {missing}) AS daily_price,
      try_cast(first_review AS DATE) AS first_review,
      coalesce(try_cast(reviews_per_month AS DECIMAL(3,2)), CAST(-1 AS DECIMAL(3,2))) AS reviews_per_month,
      source, room_type
      FROM (SELECT *, {baths} AS baths FROM ({MESSY_SQL}) m) b"""


def _clean_messy(spark: SparkSession, sf_dir: str, rules) -> DataFrame:
    return (
        messy(spark, sf_dir)
        .withColumnRenamed("price", "daily_price")
        .transform(read_texts, rules)
        .drop("bathrooms_text")
        .transform(cast_schema, _MESSY_TYPES, keep_others=False)
        .transform(fill_nulls, _MESSY_FILLS)
    )


@query(clean_messy_sql(published=False))
def clean_messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cleaning steps in order, with the corrected rules."""
    return _clean_messy(spark, sf_dir, CORRECTED)


@query(clean_messy_sql(published=True))
def clean_messy_as_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cleaning steps in order, with the rules as published."""
    return _clean_messy(spark, sf_dir, AS_PUBLISHED)
