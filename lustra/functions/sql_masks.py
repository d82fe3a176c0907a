"""The masks as SQL functions, for readers who query with SQL.

``SELECT mask_email(email), mask_address(address, postal_code) FROM customers``
then shows each reader what the grants allow at that moment. The level sits in a
one-row view that the functions read as a scalar subquery, so it is resolved once
per query, whatever the number of masked columns and rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from lustra.functions.codes import FULL_LEVEL, PARTIAL_LEVEL
from lustra.functions.masks import (
    ADDRESS_FILLER,
    EMAIL_FILLER,
    HIDDEN,
    HIDDEN_EMAIL,
    NRIC_FILLER,
    NRIC_LENGTH,
    PHONE_FILLER,
    SHORTEST_PHONE,
    SSN_FILLER,
    SSN_SHAPE,
)
from lustra.functions.standardize import HOME_PREFIX
from lustra.operators.grants import resolve_level

LEVEL_VIEW = "lustra_reader_level"

# Per function: its arguments (the first is the masked value), its partial form
# and its hidden form.
_FUNCTIONS = {
    "mask_email": (
        ["email"],
        f"coalesce(concat(left(substring_index(email, '@', 1), 1), '{EMAIL_FILLER}', get(split(email, '@'), 1)),"
        f" '{HIDDEN_EMAIL}')",
        HIDDEN_EMAIL,
    ),
    "mask_phone": (
        ["phone"],
        f"if(length(phone) >= {SHORTEST_PHONE}, concat(if(startswith(phone, '{HOME_PREFIX}'),"
        f" '{HOME_PREFIX}{PHONE_FILLER}', '{PHONE_FILLER.strip()}'), right(phone, 4)), '{HIDDEN}')",
        HIDDEN,
    ),
    "mask_nric": (
        ["nric"],
        f"if(length(nric) = {NRIC_LENGTH}, concat(left(nric, 1), '{NRIC_FILLER}', right(nric, 3)), '{HIDDEN}')",
        HIDDEN,
    ),
    "mask_address": (["address", "postal_code"], f"concat('{ADDRESS_FILLER}', postal_code)", HIDDEN),
    "mask_ssn": (["ssn"], f"if(ssn RLIKE '{SSN_SHAPE}', concat('{SSN_FILLER}', right(ssn, 4)), '{HIDDEN}')", HIDDEN),
}


def register_sql_masks(
    spark: SparkSession,
    grants: DataFrame,
    user: Column | None = None,
    as_of: Column | None = None,
    suffix: str = "",
) -> None:
    """Create the mask functions in this session, for one reader (the current user by default).

    Several readers share a session when each has a ``suffix`` of its own: their functions
    (``mask_email<suffix>`` and so on) read a view of their own, and one query may use both.
    """
    view = f"{LEVEL_VIEW}{suffix}"
    resolve_level(grants, user, as_of).createOrReplaceTempView(view)
    _create(spark, suffix, f"(SELECT access_level FROM {view})")


def register_level_masks(spark: SparkSession) -> None:
    """Create the mask functions with the level as first argument: ``mask_email_at(access_level, email)``.

    They serve rows of many readers at once: join the readers' levels
    (:func:`resolve_all_levels`), which resolves each once, and hand them on. NULL hides.
    """
    _create(spark, "_at", "access_level", ["access_level"])


def _create(spark: SparkSession, suffix: str, level: str, first: Sequence[str] = ()) -> None:
    for name, (arguments, partial, hidden) in _FUNCTIONS.items():
        declared = ", ".join(f"{a} STRING" for a in (*first, *arguments))
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{suffix}({declared}) RETURNS STRING"
            f" RETURN CASE {level} WHEN '{FULL_LEVEL}' THEN {arguments[0]} WHEN '{PARTIAL_LEVEL}' THEN {partial}"
            f" ELSE '{hidden}' END"
        )
