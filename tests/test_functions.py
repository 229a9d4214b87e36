from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from starmart.functions import (
    code_map,
    first_word_class,
    flag,
    labels_to_bits,
    money,
    number_and_description,
    percent_fraction,
    text_width,
    to_date,
    when_contains,
)
from starmart.functions import rules as R


def apply(spark, make, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def test_money(spark):
    got = apply(spark, money, "$85.00", "$1,200.00", "$", "N/A", None, "-$3.5", "99999999999")
    assert got == [Dec("85.00"), Dec("1200.00"), None, None, None, Dec("-3.50"), None]
    kept = apply(spark, lambda c: money(c, strip=("$",)), "$1,200.00", "$85.00")
    assert kept == [None, Dec("85.00")]


def test_percent(spark):
    got = apply(spark, percent_fraction, "97%", "0%", "100%", "N/A", None, "", "1200%")
    assert got == [Dec("0.97"), Dec("0.00"), Dec("1.00"), None, None, None, None]


def test_date(spark):
    assert [str(d) for d in apply(spark, to_date, "2023-12-26", "00-00-00", None, "x")] == [
        "2023-12-26",
        "None",
        "None",
        "None",
    ]


def test_codes(spark):
    got = apply(
        spark,
        lambda c: code_map(c, R.RESPONSE_TIME_CODES),
        "within an hour",
        "within a few hours",
        "within a day",
        "a few days or more",
        "N/A",
        None,
    )
    assert got == ["H", "FH", "D", "D+", None, None]
    assert apply(spark, lambda c: code_map(c, R.SCRAPE_SOURCE_CODES, -1), "city scrape", "x") == [1, -1]


def test_half_baths(spark):
    texts = ("Half-bath", "Private half-bath", "Shared half-bath", "1.5 shared baths", None, "bath")

    def number(c):
        return number_and_description(when_contains(c, R.HALF_BATH_TEXTS))[0]

    def words(c):
        return number_and_description(when_contains(c, R.HALF_BATH_TEXTS))[1]

    assert apply(spark, number, *texts) == [
        Dec("0.5"), Dec("0.5"), Dec("0.5"), Dec("1.5"), None, None,
    ]
    assert apply(spark, words, *texts) == [
        "bath", "private bath", "shared bath", "shared baths", None, None,
    ]


def test_half_baths_as_published(spark):
    def text(c):
        return when_contains(c, R.HALF_BATH_TEXTS_AS_PUBLISHED, ignore_case=False)

    assert apply(spark, text, "Shared half-bath", "Private half-bath", "Half-bath") == [
        "Shared half-bath", "0.5 private bath", "0.5 bath",
    ]


def test_flags(spark):
    texts = ("t", "f", None, "", "not")
    assert apply(spark, flag, *texts) == [1, 0, 0, 0, 0]
    assert apply(spark, lambda c: flag(c, null_as=None), *texts) == [1, 0, None, 0, 0]
    assert apply(spark, lambda c: flag(c, "contains"), *texts) == [1, 0, 0, 0, 1]


def test_labels(spark):
    texts = ("['email', 'phone']", "['work_email']", "[]", None, '["phone"]', "None")
    member = apply(spark, lambda c: labels_to_bits(c, R.VERIFICATION_LABELS), *texts)
    assert member == ["110", "001", "000", None, "010", "000"]
    loose = apply(spark, lambda c: labels_to_bits(c, R.VERIFICATION_LABELS, "substring"), *texts)
    assert loose == ["110", "101", "000", None, "010", "000"]
    with pytest.raises(ValueError):
        labels_to_bits(F.col("x"), R.VERIFICATION_LABELS, "fuzzy")


def test_property_class(spark):
    got = apply(
        spark,
        lambda c: first_word_class(c, R.PROPERTY_CLASSES, R.OTHER_PROPERTY_CLASS),
        "Entire home", "Private room in loft", "Room in hotel", "Shared room", "Tiny home", None,
    )
    assert got == [
        "Entire property", "Private room", "Private room", "Shared room", "Miscellaneous", None,
    ]


def test_text_width(spark):
    assert apply(spark, lambda c: text_width(c.try_cast("decimal(18,15)")), "39.5", None) == [18, None]
