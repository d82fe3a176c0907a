"""Validators: boolean columns with three-valued logic.

NULL input gives NULL (unknown) unless a validator says otherwise. Patterns end
in ``\\z`` because Java's ``$`` would let a trailing newline through.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lustra.functions.codes import (
    COUNTRIES,
    CURRENCIES,
    GENDERS,
    NRIC_LETTERS,
    NRIC_OFFSET,
    NRIC_OFFSET_PREFIXES,
    NRIC_WEIGHTS,
)

# Accepted shapes.
POSTAL_SHAPE = r"^\d{6}\z"
NRIC_SHAPE = r"^[STFGM]\d{7}[A-Z]\z"
NINE_CHAR_SHAPE = r"^[A-Z0-9]{9}\z"
EMAIL_SHAPE = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"


def one_of(value: Column, codes: Iterable[str]) -> Column:
    """Case-insensitive membership, without trimming."""
    return F.upper(value).isin(*codes)


def is_postal_code(value: Column) -> Column:
    return F.regexp_replace(value, r"\s+", "").rlike(POSTAL_SHAPE)


def is_nric(value: Column) -> Column:
    """Shape only; see :func:`nric_check_letter` for the checksum."""
    return value.rlike(NRIC_SHAPE)


def is_nine_char_id(value: Column) -> Column:
    return value.rlike(NINE_CHAR_SHAPE)


def is_currency(value: Column) -> Column:
    return one_of(value, CURRENCIES)


def is_country(value: Column) -> Column:
    return one_of(value, COUNTRIES)


def is_gender(value: Column) -> Column:
    return one_of(value, GENDERS)


def is_email(value: Column) -> Column:
    """Never NULL: a missing address is a failed check."""
    return F.coalesce(value.rlike(EMAIL_SHAPE), F.lit(False))


def nric_check_letter(value: Column, mode: str = "literal") -> Column:
    """Check letter expected for an identity number, NULL if none is defined.

    ``literal`` reads the letter table at ``10 - sum % 11``; ``forward`` reads it
    at ``sum % 11``, which agrees with published sample numbers.
    """
    if mode not in ("literal", "forward"):
        raise ValueError(f"mode must be 'literal' or 'forward', not {mode!r}")
    prefix = F.upper(value.substr(1, 1))
    digit_sum = sum(
        (value.substr(place, 1).try_cast("int") * weight for place, weight in enumerate(NRIC_WEIGHTS, start=2)),
        start=F.when(prefix.isin(*NRIC_OFFSET_PREFIXES), NRIC_OFFSET).otherwise(0),
    )
    remainder = digit_sum % 11
    place = remainder + 1 if mode == "forward" else 11 - remainder
    letters = F.lit(None).cast("string")
    for start, table in NRIC_LETTERS.items():
        letters = F.when(prefix == start, table).otherwise(letters)
    return F.when(value.rlike(r"^.\d{7}.\z"), letters.substr(place, F.lit(1)))


def has_valid_nric_checksum(value: Column, mode: str = "forward") -> Column:
    """True if the last letter is the expected one; an opt-in stricter rule."""
    return F.upper(value.substr(-1, 1)) == nric_check_letter(value, mode)
