"""Table-level masking: by well-known column names, or by a policy per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lustra.functions import masks

KNOWN_PII: Mapping[str, Callable[..., Column]] = {
    "email": masks.mask_email,
    "phone": masks.mask_phone,
    "nric": masks.mask_nric,
    "address": masks.mask_address,
    "ssn": masks.mask_ssn,
}

_LEVEL = "__level"


@dataclass(frozen=True)
class ColumnMask:
    """A mask function and the further columns it reads, by argument name."""

    fn: Callable[..., Column]
    using: Mapping[str, str] | None = None

    def apply(self, column: str, level: Column) -> Column:
        extra = {arg: F.col(name) for arg, name in (self.using or {}).items()}
        return self.fn(F.col(column), level, **extra)


def _under_level(df: DataFrame, level: str | Column, chosen: Mapping[str, ColumnMask]) -> DataFrame:
    """Mask the chosen columns in one projection.

    A level given as an expression is projected first, so that a subquery behind
    it is planned once and not once per mask.
    """
    if isinstance(level, str):
        return df.withColumns({name: mask.apply(name, F.col(level)) for name, mask in chosen.items()})
    held = df.withColumn(_LEVEL, level)
    return held.withColumns({name: mask.apply(name, F.col(_LEVEL)) for name, mask in chosen.items()}).drop(_LEVEL)


def mask_known_columns(df: DataFrame, level: str | Column = "access_level") -> DataFrame:
    """Mask every well-known PII column the frame has, in one projection."""
    return _under_level(df, level, {name: ColumnMask(fn) for name, fn in KNOWN_PII.items() if name in df.columns})


MaskPolicy = Mapping[str, Mapping[str, ColumnMask]]

DEFAULT_POLICY: MaskPolicy = {
    "customers": {
        "email": ColumnMask(masks.mask_email),
        "phone": ColumnMask(masks.mask_phone),
        "nric": ColumnMask(masks.mask_nric),
        "address": ColumnMask(masks.mask_address, using={"postal": "postal_code"}),
    }
}


def policy_key(table_name: str) -> str:
    """``catalog.schema.customers_silver`` falls under the policy for ``customers``."""
    return table_name.rpartition(".")[2].replace("_silver", "")


def apply_policy(
    df: DataFrame,
    table_name: str,
    level: str | Column = "access_level",
    policy: MaskPolicy = DEFAULT_POLICY,
    on_missing: str = "raise",
) -> DataFrame:
    """Mask a table's columns as its policy says.

    A table no policy covers raises, so nothing is shown by oversight;
    ``on_missing="keep"`` returns it unmasked.
    """
    key = policy_key(table_name)
    if key not in policy:
        if on_missing == "keep":
            return df
        raise LookupError(f"no mask policy covers {table_name}")
    return _under_level(df, level, policy[key])
