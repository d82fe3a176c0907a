"""Gold customers: masked for one reader, stored at refresh or evaluated per query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lustra.functions import masks
from lustra.operators.grants import level_of
from lustra.operators.history import current_versions
from lustra.operators.masking import apply_policy

# The published columns, in order.
GOLD_COLUMNS = (
    "customer_id",
    "full_name",
    "email",
    "phone",
    "nric",
    "dob",
    "address",
    "postal_code",
    "country",
    "gender",
    "signup_ts",
    "last_login_ts",
    "status",
    "segment",
    "credit_score",
    "annual_income",
    "data_quality_flags",
    "quality_score",
    "masked_at",
    "masked_for_user",
)


def _for_reader(
    silver: DataFrame, grants: DataFrame, user: Column | None, now: Column | None, versions: str
) -> tuple[DataFrame, Column]:
    if versions not in ("all", "current"):
        raise ValueError(f"versions must be 'all' or 'current', not {versions!r}")
    chosen = current_versions(silver) if versions == "current" else silver
    level = level_of(grants, user, now)
    stamped = chosen.withColumns(
        {
            "masked_at": F.current_timestamp() if now is None else now,
            "masked_for_user": F.current_user() if user is None else user,
            "applied_access_level": level,
        }
    )
    return stamped, F.col("applied_access_level")


def gold_customers(
    silver: DataFrame,
    grants: DataFrame,
    user: Column | None = None,
    now: Column | None = None,
    versions: str = "all",
    strict: bool = True,
) -> DataFrame:
    """Gold rows for storing: masked by the level of the user who refreshes."""
    stamped, level = _for_reader(silver, grants, user, now, versions)
    masked = stamped.withColumns(
        {
            "email": masks.mask_email(F.col("email"), level, strict),
            "phone": masks.mask_phone(F.col("phone"), level, strict),
            "nric": masks.mask_nric(F.col("nric"), level, strict),
            "address": masks.mask_address(F.col("address"), level),
        }
    )
    return masked.select(*GOLD_COLUMNS)


def gold_customer_view(
    silver: DataFrame,
    grants: DataFrame,
    user: Column | None = None,
    now: Column | None = None,
    versions: str = "all",
) -> DataFrame:
    """Gold rows for querying: masked by the level of whoever reads, which is shown too."""
    stamped, level = _for_reader(silver, grants, user, now, versions)
    return apply_policy(stamped, "customers", level).select(*GOLD_COLUMNS, "applied_access_level")
