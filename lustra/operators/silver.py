"""Config-driven cleansing of one table.

A :class:`SilverSpec` lists what to do per column; :func:`build_silver` applies
it in a fixed order: prefix, transforms, upper case, null fill, rules, flags,
score. Parts of a spec whose column is absent are skipped, so one spec serves a
family of similar tables; :func:`unmatched` reports what was skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lustra.functions import standardize, validate
from lustra.operators.columns import prefix_columns
from lustra.operators.quality import add_flags_and_score

ColumnFn = Callable[[Column], Column]


@dataclass(frozen=True)
class SilverSpec:
    """Immutable recipe; the methods return extended copies."""

    prefix: str | None = None
    transforms: Mapping[str, ColumnFn] = field(default_factory=dict)
    rules: Mapping[str, ColumnFn] = field(default_factory=dict)
    uppercase: tuple[str, ...] = ()
    none_filled: tuple[str, ...] = ()

    def transform(self, **fns: ColumnFn) -> SilverSpec:
        return replace(self, transforms={**self.transforms, **fns})

    def check(self, **fns: ColumnFn) -> SilverSpec:
        """Add rules; a rule is named after the column it reads."""
        return replace(self, rules={**self.rules, **fns})

    def upper(self, *columns: str) -> SilverSpec:
        return replace(self, uppercase=self.uppercase + columns)

    def fill_none(self, *columns: str) -> SilverSpec:
        return replace(self, none_filled=self.none_filled + columns)

    def column_in(self, name: str, columns: list[str]) -> str | None:
        """The table's name for a spec column: as written, or with the prefix."""
        for candidate in (name, f"{self.prefix or ''}{name}"):
            if candidate in columns:
                return candidate
        return None


def unmatched(columns: list[str], spec: SilverSpec) -> dict[str, list[str]]:
    """Spec entries that find no column, by kind; empty if all apply."""
    if spec.prefix:
        columns = [c if c.startswith(spec.prefix) else spec.prefix + c for c in columns]
    kinds = {
        "transforms": spec.transforms,
        "rules": spec.rules,
        "uppercase": spec.uppercase,
        "none_filled": spec.none_filled,
    }
    missing = {kind: [n for n in names if spec.column_in(n, columns) is None] for kind, names in kinds.items()}
    return {kind: names for kind, names in missing.items() if names}


def clean_values(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """Transforms, upper-casing and null fill, composed into one expression per column."""
    steps: dict[str, Column] = {}

    def then(name: str, fn: ColumnFn) -> None:
        actual = spec.column_in(name, df.columns)
        if actual is not None:
            steps[actual] = fn(steps.get(actual, F.col(actual)))

    for name, fn in spec.transforms.items():
        then(name, fn)
    for name in spec.uppercase:
        then(name, standardize.upper_trim)
    for name in spec.none_filled:
        then(name, standardize.none_text)
    return df.withColumns(steps) if steps else df


def bound_rules(df: DataFrame, spec: SilverSpec) -> dict[str, Column]:
    """The spec's rules as columns of this frame, in spec order."""
    found = ((name, spec.column_in(name, df.columns), fn) for name, fn in spec.rules.items())
    return {name: fn(F.col(actual)) for name, actual, fn in found if actual is not None}


def build_silver(
    df: DataFrame,
    spec: SilverSpec,
    flags: bool = True,
    score: bool = True,
    null_is_failure: bool = False,
) -> DataFrame:
    """Clean, check and score one table; narrow, so it plans the same on a stream."""
    if spec.prefix:
        df = prefix_columns(df, spec.prefix)
    cleaned = clean_values(df, spec)
    return add_flags_and_score(cleaned, bound_rules(cleaned, spec), flags, score, null_is_failure)


def customer_spec() -> SilverSpec:
    """The standard recipe for customer tables."""
    return (
        SilverSpec()
        .transform(
            nric=standardize.nric,
            gender=standardize.gender,
            country=standardize.country,
            phone=standardize.phone,
        )
        .check(
            nric=validate.is_nric,
            email=validate.is_email,
            gender=validate.is_gender,
            country=validate.is_country,
        )
        .upper("full_name", "nric", "gender", "country")
        .fill_none("email", "phone", "address")
    )


def add_postal(df: DataFrame, address: str = "address") -> DataFrame:
    """Extract the postal code of an address and say whether it is valid."""
    code = standardize.postal_code(standardize.postal_from_address(F.col(address)))
    return df.withColumn("postal_code", code).withColumn(
        "is_valid_postal_code", validate.is_postal_code(F.col("postal_code"))
    )


def silver_customers(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Bronze customers to cleaned, scored and stamped silver rows."""
    stamped = F.current_timestamp() if processed_at is None else processed_at
    return add_postal(build_silver(bronze, customer_spec())).withColumn("silver_processed_ts", stamped)
