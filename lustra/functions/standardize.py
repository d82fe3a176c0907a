"""Standardizers: bring dirty spellings to one canonical form.

All are null-in, null-out built-in expressions, so they stay inside
whole-stage code generation and work on batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lustra.functions.codes import COUNTRY_ALIASES, CURRENCY_ALIASES, GENDERS

POSTAL_DIGITS = 6
HOME_PREFIX = "+65"
LOCAL_PHONE_DIGITS = 8


def upper_trim(value: Column) -> Column:
    """Upper case without surrounding spaces (tabs stay, as Spark's trim keeps them)."""
    return F.upper(F.trim(value))


def recode(value: Column, aliases: Mapping[str, str]) -> Column:
    """Upper-trim, then swap every alias for its code; other values pass through."""
    key = upper_trim(value)
    swapped = key
    for alias, code in aliases.items():
        swapped = F.when(key == alias, code).otherwise(swapped)
    return swapped


def postal_code(value: Column) -> Column:
    """Drop whitespace and zero-pad all-digit codes to six places."""
    packed = F.regexp_replace(value, r"\s+", "")
    short_number = packed.rlike(rf"^\d{{1,{POSTAL_DIGITS}}}\z")
    return F.when(short_number, F.lpad(packed, POSTAL_DIGITS, "0")).otherwise(packed)


def postal_from_address(address: Column) -> Column:
    """First free-standing six-digit number of an address, or an empty string."""
    return F.regexp_extract(address, rf"\b(\d{{{POSTAL_DIGITS}}})\b", 1)


def nric(value: Column) -> Column:
    return upper_trim(value)


def person_name(value: Column) -> Column:
    return upper_trim(value)


def currency(value: Column) -> Column:
    return recode(value, CURRENCY_ALIASES)


def country(value: Column) -> Column:
    return recode(value, COUNTRY_ALIASES)


def gender(value: Column) -> Column:
    """One of the known letters, or NULL."""
    letter = upper_trim(value)
    return F.when(letter.isin(*GENDERS), letter)


def phone(value: Column) -> Column:
    """Keep digits and plus signs and add the home country prefix where it is implied.

    The first rule that fits wins, so an eight-digit local number that happens
    to start with the country digits only gains the plus sign.
    """
    dial = F.regexp_replace(value, r"[^\d+]", "")
    home_digits = HOME_PREFIX[1:]
    rules = (
        (dial.startswith(HOME_PREFIX), dial),
        (dial.startswith(home_digits), F.concat(F.lit("+"), dial)),
        (dial.startswith("0"), F.concat(F.lit(HOME_PREFIX), dial.substr(F.lit(2), F.length(dial)))),
        (F.length(dial) == LOCAL_PHONE_DIGITS, F.concat(F.lit(HOME_PREFIX), dial)),
    )
    return F.coalesce(*(F.when(test, form) for test, form in rules), dial)


def none_text(value: Column) -> Column:
    """NULL becomes the text ``None``; other types are rendered as text first."""
    return F.coalesce(value.cast("string"), F.lit("None"))
