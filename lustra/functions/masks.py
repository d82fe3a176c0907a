"""Masks: show a value in clear, in part or not at all, depending on a level column.

Anything but the two named levels hides the value, NULL and unknown levels
included. With ``strict`` (the default) a value too malformed to be partly
shown without giving it away is hidden as well; ``strict=False`` applies the
partial form to whatever is there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lustra.functions.codes import FULL_LEVEL, PARTIAL_LEVEL
from lustra.functions.standardize import HOME_PREFIX, postal_from_address

# What a hidden value looks like and the fillers of partial forms.
HIDDEN = "***"
HIDDEN_EMAIL = "***@***"
EMAIL_FILLER = "***@"
PHONE_FILLER = " ****"
NRIC_FILLER = "****"
ADDRESS_FILLER = "*** Singapore "
SSN_FILLER = "***-**-"

SHORTEST_PHONE = 8


def by_level(level: Column, clear: Column, partial: Column, hidden: str) -> Column:
    """Pick the form of a value that an access level may see."""
    return F.when(level == FULL_LEVEL, clear).when(level == PARTIAL_LEVEL, partial).otherwise(F.lit(hidden))


def _last(value: Column, n: int) -> Column:
    return value.substr(-n, n)


#: Lengths and shapes a whole value has.
NRIC_LENGTH = 9
SSN_SHAPE = "^([0-9]{9}|[0-9]{3}-[0-9]{2}-[0-9]{4})$"


def _shown_if(fits: Column, partial: Column, hidden: str) -> Column:
    return F.when(fits, partial).otherwise(F.lit(hidden))


def mask_email(email: Column, level: Column, strict: bool = True) -> Column:
    """First letter and domain; a value without ``@`` has no partial form."""
    domain = F.get(F.split(email, "@"), F.lit(1))
    partial = F.concat(F.substring_index(email, "@", 1).substr(1, 1), F.lit(EMAIL_FILLER), domain)
    if strict:
        partial = F.coalesce(partial, F.lit(HIDDEN_EMAIL))
    return by_level(level, email, partial, HIDDEN_EMAIL)


def mask_phone(phone: Column, level: Column, strict: bool = True) -> Column:
    """Country prefix and last four digits.

    The literal form shows the first four characters, which for a standardized
    number is one subscriber digit more than the prefix; the strict form does not.
    """
    if strict:
        prefix = F.when(phone.startswith(HOME_PREFIX), HOME_PREFIX + PHONE_FILLER).otherwise(PHONE_FILLER.strip())
        partial = _shown_if(F.length(phone) >= SHORTEST_PHONE, F.concat(prefix, _last(phone, 4)), HIDDEN)
    else:
        partial = F.concat(phone.substr(1, 4), F.lit(PHONE_FILLER), _last(phone, 4))
    return by_level(level, phone, partial, HIDDEN)


def mask_nric(nric: Column, level: Column, strict: bool = True) -> Column:
    """First letter and last three characters; strict hides what has not the nine characters of a number."""
    partial = F.concat(nric.substr(1, 1), F.lit(NRIC_FILLER), _last(nric, 3))
    if strict:
        partial = _shown_if(F.length(nric) == NRIC_LENGTH, partial, HIDDEN)
    return by_level(level, nric, partial, HIDDEN)


def mask_ssn(ssn: Column, level: Column, strict: bool = True) -> Column:
    """Last four digits; strict hides what has not the shape of a number."""
    partial = F.concat(F.lit(SSN_FILLER), _last(ssn, 4))
    if strict:
        partial = _shown_if(ssn.rlike(SSN_SHAPE), partial, HIDDEN)
    return by_level(level, ssn, partial, HIDDEN)


def mask_address(address: Column, level: Column, postal: Column | None = None) -> Column:
    """Postal code only, taken from the address or from a column of its own."""
    code = postal_from_address(address) if postal is None else postal
    return by_level(level, address, F.concat(F.lit(ADDRESS_FILLER), code), HIDDEN)
