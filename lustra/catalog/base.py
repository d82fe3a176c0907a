"""What a registered query is, and oracle SQL shared by several of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lustra.plans.fixtures import fixture_sql

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A Spark query and the SQL an independent engine runs to check it."""

    run: Run
    sql: str | None = None


def over(name: str, select: str, *more: str) -> str:
    """Oracle text: ``select`` with the named fixtures as common table expressions."""
    ctes = ",\n".join(f"{n} AS (\n{fixture_sql(n)}\n)" for n in (name, *more))
    return f"WITH {ctes}\n{select}"


# --- oracle expressions ----------------------------------------------------

NRIC_OK = r"regexp_matches({0}, '^[STFGM]\d{{7}}[A-Z]$')"
EMAIL_OK = r"coalesce(regexp_matches({0}, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}$'), false)"
GENDER_OK = "upper({0}) IN ('M', 'F', 'X')"
COUNTRY_OK = "upper({0}) IN ('USA', 'US', 'UK', 'GB', 'SG', 'CN', 'TW', 'FR', 'DK')"
CURRENCY_OK = "upper({0}) IN ('USD', 'RMB', 'YEN', 'SGD', 'CNY', 'JPY')"
POSTAL_OK = r"regexp_matches(regexp_replace({0}, '\s+', '', 'g'), '^\d{{6}}$')"
GENDER = "CASE WHEN upper(trim({0})) IN ('M', 'F', 'X') THEN upper(trim({0})) END"
COUNTRY = (
    "CASE upper(trim({0})) WHEN 'USA' THEN 'US' WHEN 'UK' THEN 'GB' WHEN 'SINGAPORE' THEN 'SG' WHEN 'CHINA' THEN 'CN'"
    " WHEN 'TAIWAN' THEN 'TW' WHEN 'FRANCE' THEN 'FR' WHEN 'DENMARK' THEN 'DK' ELSE upper(trim({0})) END"
)
CURRENCY = "CASE upper(trim({0})) WHEN 'RMB' THEN 'CNY' WHEN 'YEN' THEN 'JPY' ELSE upper(trim({0})) END"
_DIAL = r"regexp_replace({0}, '[^\d+]', '', 'g')"
PHONE = (
    f"CASE WHEN {_DIAL} LIKE '+65%' THEN {_DIAL} WHEN {_DIAL} LIKE '65%' THEN '+' || {_DIAL}"
    f" WHEN {_DIAL} LIKE '0%' THEN '+65' || substr({_DIAL}, 2)"
    f" WHEN length({_DIAL}) = 8 THEN '+65' || {_DIAL} ELSE {_DIAL} END"
)
_PACKED = r"regexp_replace({0}, '\s+', '', 'g')"
POSTAL = (
    rf"CASE WHEN regexp_matches({_PACKED}, '^\d+$') AND length({_PACKED}) <= 6 THEN lpad({_PACKED}, 6, '0')"
    rf" ELSE {_PACKED} END"
)
POSTAL_OF = r"regexp_extract({0}, '\b(\d{{6}})\b', 1)"


def flags_sql(rules: Sequence[tuple[str, str]]) -> str:
    """Failed rule names from boolean columns: pairs of rule name and column."""
    return "nullif(concat_ws(', ', " + ", ".join(f"CASE WHEN NOT {c} THEN '{n}' END" for n, c in rules) + "), '')"


def score_sql(columns: Sequence[str]) -> str:
    passed = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in columns)
    return f"round(({passed}) / CAST({len(columns)} AS DOUBLE) * 100, 2)"


def silver_sql(source: str) -> str:
    """Standard customer cleansing of a relation, with postal code columns."""
    rules = [("nric", "v1"), ("email", "v2"), ("gender", "v3"), ("country", "v4")]
    return f"""
SELECT *, {POSTAL_OK.format('postal_code')} AS is_valid_postal_code FROM (
 SELECT * EXCLUDE (v1, v2, v3, v4), {flags_sql(rules)} AS data_quality_flags,
  {score_sql([c for _, c in rules])} AS quality_score,
  {POSTAL.format(POSTAL_OF.format('address'))} AS postal_code
 FROM (
  SELECT *, {NRIC_OK.format('nric')} AS v1, {EMAIL_OK.format('email')} AS v2, {GENDER_OK.format('gender')} AS v3,
   {COUNTRY_OK.format('country')} AS v4
  FROM (
   SELECT * REPLACE (upper(trim(nric)) AS nric, {GENDER.format('gender')} AS gender,
    {COUNTRY.format('country')} AS country, coalesce({PHONE.format('phone')}, 'None') AS phone,
    upper(trim(full_name)) AS full_name, coalesce(email, 'None') AS email, coalesce(address, 'None') AS address)
   FROM {source}
  ) AS cleaned
 ) AS judged
) AS scored"""


def history_sql(
    changes: str,
    key: str,
    seq: str,
    ties: Sequence[str],
    tracked: Sequence[str],
    untracked: Sequence[str] = (),
    deletes: str | None = None,
    ignore_null: bool = True,
    show_seq: bool = False,
) -> str:
    """Versions of a relation by life segmentation, an algorithm of its own."""
    columns = [*tracked, *untracked]
    names = ", ".join(columns)
    ignoring = ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in columns)
    same = " AND ".join(f"lag({c}) OVER w IS NOT DISTINCT FROM {c}" for c in tracked)
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ties)
    return f"""
WITH changes AS ({changes}),
one AS (SELECT *, coalesce({deletes or 'false'}, false) AS gone FROM changes
 WHERE {key} IS NOT NULL AND {seq} IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY {key}, {seq} ORDER BY {order}) = 1),
lives AS (SELECT *, coalesce(sum(CASE WHEN gone THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY {seq}
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life FROM one),
ends AS (SELECT *, min(CASE WHEN gone THEN {seq} END) OVER (PARTITION BY {key}, life) AS gone_at FROM lives),
filled AS (SELECT {key}, {seq}, life, gone_at, {ignoring if ignore_null else names} FROM ends WHERE NOT gone
 WINDOW w AS (PARTITION BY {key}, life ORDER BY {seq} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
marked AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 1 WHEN {same} THEN 0 ELSE 1 END AS opens FROM filled
 WINDOW w AS (PARTITION BY {key}, life ORDER BY {seq})),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY {key}, life ORDER BY {seq}
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS version FROM marked),
spans AS (SELECT *, min({seq}) OVER (PARTITION BY {key}, life, version) AS begun FROM numbered
 QUALIFY row_number() OVER (PARTITION BY {key}, life, version ORDER BY {seq} DESC) = 1)
SELECT {key}, {names}{f', {seq}' if show_seq else ''}, begun AS "__START_AT",
 coalesce(lead(begun) OVER (PARTITION BY {key}, life ORDER BY begun), gone_at) AS "__END_AT"
FROM spans"""
