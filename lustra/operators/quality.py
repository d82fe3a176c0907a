"""Rule-set operators: flags, score, per-rule columns and a one-pass summary.

A rule set is an ordered mapping from rule name to a boolean column. A rule that
evaluates to NULL has neither failed nor passed: it raises no flag but earns no
score. ``null_is_failure=True`` treats it as failed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lustra.functions.standardize import none_text

Rules = Mapping[str, Column]

FLAG_COLUMN = "data_quality_flags"
SCORE_COLUMN = "quality_score"
_VERDICT = "__verdict_"


def failed_rule_names(rules: Rules, null_is_failure: bool = False) -> Column:
    """Names of the failed rules in rule order, comma separated; NULL if none failed."""
    marks = []
    for name, passed in rules.items():
        failed = ~F.coalesce(passed, F.lit(False)) if null_is_failure else ~passed
        marks.append(F.when(failed, name))
    if not marks:
        return F.lit(None).cast("string")
    return F.nullif(F.concat_ws(", ", *marks), F.lit(""))


def passed_share(rules: Rules) -> Column:
    """Percentage of passed rules, two decimals; NULL for an empty rule set."""
    if not rules:
        return F.lit(None).cast("double")
    passed = sum((F.when(rule, 1).otherwise(0) for rule in rules.values()), start=F.lit(0))
    return F.round(passed / F.lit(len(rules)) * 100, 2)


def add_flags(df: DataFrame, rules: Rules, flag_column: str = FLAG_COLUMN, null_is_failure: bool = False) -> DataFrame:
    return df.withColumn(flag_column, failed_rule_names(rules, null_is_failure))


def add_score(df: DataFrame, rules: Rules, score_column: str = SCORE_COLUMN) -> DataFrame:
    return df.withColumn(score_column, passed_share(rules))


def add_flags_and_score(
    df: DataFrame,
    rules: Rules,
    flags: bool = True,
    score: bool = True,
    null_is_failure: bool = False,
) -> DataFrame:
    """Flags and score from one evaluation of each rule.

    The verdicts are projected once and reused, so a regular expression runs
    once per row however many outputs need it.
    """
    if not rules or not (flags or score):
        return df
    held = {name: f"{_VERDICT}{i}" for i, name in enumerate(rules)}
    judged = df.withColumns({held[name]: rule for name, rule in rules.items()})
    verdicts = {name: F.col(column) for name, column in held.items()}
    added = {}
    if flags:
        added[FLAG_COLUMN] = failed_rule_names(verdicts, null_is_failure)
    if score:
        added[SCORE_COLUMN] = passed_share(verdicts)
    return judged.withColumns(added).drop(*held.values())


def add_rule_columns(df: DataFrame, rules: Rules, prefix: str = "is_valid_") -> DataFrame:
    """One boolean column per rule."""
    return df.withColumns({prefix + name: rule for name, rule in rules.items()})


def fill_none(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Write ``None`` as text over NULLs in those of the columns that exist."""
    return df.withColumns({name: none_text(F.col(name)) for name in columns if name in df.columns})


def summarize_rules(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: rows seen, passed, failed, unknown and the pass rate.

    All counters are partial aggregates of a single scan; only one row per task
    is shuffled.
    """
    if not rules:
        raise ValueError("a summary needs at least one rule")
    counters = [F.count(F.lit(1)).alias("rows")]
    for i, rule in enumerate(rules.values()):
        counters += [F.count_if(rule).alias(f"passed{i}"), F.count_if(~rule).alias(f"failed{i}")]
    totals = df.agg(*counters)
    lines = F.array(
        *(
            F.struct(
                F.lit(name).alias("rule"),
                F.col("rows").alias("n_rows"),
                F.col(f"passed{i}").alias("n_passed"),
                F.col(f"failed{i}").alias("n_failed"),
                (F.col("rows") - F.col(f"passed{i}") - F.col(f"failed{i}")).alias("n_unknown"),
                F.round(F.try_divide(F.col(f"passed{i}") * 100.0, F.col("rows")), 2).alias("pass_rate"),
            )
            for i, name in enumerate(rules)
        )
    )
    return totals.select(F.inline(lines))
