"""Column expressions that turn messy text into typed values."""

from starmart.functions.text import (
    code_map,
    first_word_class,
    flag,
    labels_to_bits,
    money,
    number_and_description,
    percent_fraction,
    replace_text,
    sharing,
    text_width,
    to_date,
    when_contains,
)

__all__ = [
    "code_map",
    "first_word_class",
    "flag",
    "labels_to_bits",
    "money",
    "number_and_description",
    "percent_fraction",
    "replace_text",
    "sharing",
    "text_width",
    "to_date",
    "when_contains",
]
