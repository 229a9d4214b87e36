"""Rule tables for short-stay listing data."""

# Codes, labels, texts and fill-ins that results depend on.

RESPONSE_TIME_CODES = {
    "within an hour": "H",
    "within a few hours": "FH",
    "within a day": "D",
    "a few days or more": "D+",
}

# The same table with the misspelt day key of the published rule set.
RESPONSE_TIME_CODES_AS_PUBLISHED = {
    "within an hour": "H",
    "within a few hours": "FH",
    "within a dat": "D",
    "a few days or more": "D+",
}

VERIFICATION_LABELS = ("email", "phone", "work_email")

HALF_BATH_TEXTS = {
    "Private half-bath": "0.5 private bath",
    "Shared half-bath": "0.5 shared bath",
    "Half-bath": "0.5 bath",
}

HALF_BATH_TEXTS_AS_PUBLISHED = {
    "Private half-bath": "0.5 private bath",
    "Half-bath": "0.5 bath",
}

SCRAPE_SOURCE_CODES = {"city scrape": 1, "previous scrape": 0}

PROPERTY_CLASSES = {
    "Entire": "Entire property",
    "Room": "Private room",
    "Private": "Private room",
    "Shared": "Shared room",
}
OTHER_PROPERTY_CLASS = "Miscellaneous"

MISSING_TEXT = "N/A"
MISSING_CODE = "NA"
MISSING_NUMBER = -1
