"""Names, standardizers, validators, quality and silver builds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lustra.catalog.base import (
    COUNTRY,
    COUNTRY_OK,
    CURRENCY,
    CURRENCY_OK,
    EMAIL_OK,
    GENDER,
    GENDER_OK,
    NRIC_OK,
    PHONE,
    POSTAL,
    POSTAL_OF,
    POSTAL_OK,
    Query,
    flags_sql,
    over,
    score_sql,
    silver_sql,
)
from lustra.functions import standardize, validate
from lustra.operators.columns import normalize_columns, prefix_columns
from lustra.operators.quality import (
    add_flags,
    add_flags_and_score,
    add_rule_columns,
    add_score,
    fill_none,
    summarize_rules,
)
from lustra.operators.silver import (
    SilverSpec,
    add_postal,
    build_silver,
    clean_values,
    customer_spec,
    silver_customers,
)
from lustra.plans.fixtures import fixture, table

PROCESSED_AT = "2024-06-30 00:00:00"


def _fixed_time(text: str = PROCESSED_AT) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _column_query(source: str, key: str, column: str, fn: Callable[[Column], Column], sql: str) -> Query:
    """One expression over a whole fixture: the key, its input and its output."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fixture(spark, sf_dir, source).select(key, column, fn(F.col(column)).alias("result"))

    return Query(run, over(source, f"SELECT {key}, {column}, {sql.format(column)} AS result FROM {source}"))


def _crm(column: str, fn: Callable[[Column], Column], sql: str) -> Query:
    return _column_query("crm_customers", "customer_id", column, fn, sql)


def _money(column: str, fn: Callable[[Column], Column], sql: str) -> Query:
    return _column_query("crm_money", "id", column, fn, sql)


# --- names -----------------------------------------------------------------

# Raw headers in, clean names out.
_RAW_NAMES = ("  Customer ID  ", "Full Name", "phone", "Date  Of   Birth", "A   B")


def _dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "customer")
    return source.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey").toDF(*_RAW_NAMES)


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_columns(_dirty_customers(spark, sf_dir))


def _suffixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    clashing = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment").toDF("id", "A B", " a b")
    return normalize_columns(clashing, on_collision="suffix")


def _prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_columns(fixture(spark, sf_dir, "crm_money").withColumnRenamed("id", "src_id"), "src_")


def _transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SilverSpec().transform(country=standardize.country, phone=standardize.phone, absent=standardize.nric)
    return clean_values(fixture(spark, sf_dir, "crm_customers").select("customer_id", "country", "phone"), spec)


def _uppercased(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SilverSpec().upper("full_name", "country", "absent")
    return clean_values(fixture(spark, sf_dir, "crm_customers").select("customer_id", "full_name", "country"), spec)


# --- quality ---------------------------------------------------------------


def _raw_rules() -> dict[str, Column]:
    return {
        "valid_nric": validate.is_nric(F.col("nric")),
        "valid_email": validate.is_email(F.col("email")),
        "valid_gender": validate.is_gender(F.col("gender")),
        "valid_country": validate.is_country(F.col("country")),
        "valid_nine": validate.is_nine_char_id(F.col("nric")),
    }


_RAW_VERDICTS = f"""
SELECT customer_id, {NRIC_OK.format('nric')} AS v1, {EMAIL_OK.format('email')} AS v2,
 {GENDER_OK.format('gender')} AS v3, {COUNTRY_OK.format('country')} AS v4,
 length(nric) = 9 AND regexp_matches(nric, '^[A-Z0-9]{{9}}$') AS v5
FROM crm_customers"""
_RULE_NAMES = [
    ("valid_nric", "v1"),
    ("valid_email", "v2"),
    ("valid_gender", "v3"),
    ("valid_country", "v4"),
    ("valid_nine", "v5"),
]


def _judged(select: str) -> str:
    return over("crm_customers", f"SELECT {select} FROM ({_RAW_VERDICTS}) AS judged")


def _with_rules(build: Callable[[DataFrame, dict[str, Column]], DataFrame], *columns: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        judged = build(fixture(spark, sf_dir, "crm_customers"), _raw_rules())
        return judged.select("customer_id", *columns)

    return run


def _rule_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = add_rule_columns(fixture(spark, sf_dir, "crm_customers"), _raw_rules(), prefix="is_")
    return judged.select("customer_id", *(f"is_{name}" for name, _ in _RULE_NAMES))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize_rules(fixture(spark, sf_dir, "crm_customers"), _raw_rules())


_SUMMARY_SQL = over(
    "crm_customers",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, count(*) AS n_rows, count(*) FILTER (WHERE {v}) AS n_passed,
 count(*) FILTER (WHERE NOT {v}) AS n_failed, count(*) FILTER (WHERE {v} IS NULL) AS n_unknown,
 round(count(*) FILTER (WHERE {v}) * CAST(100 AS DOUBLE) / count(*), 2) AS pass_rate
FROM ({_RAW_VERDICTS}) AS judged"""
        for name, v in _RULE_NAMES
    ),
)


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = fixture(spark, sf_dir, "crm_customers").select("customer_id", "email", "last_login_ts", "address")
    return fill_none(some.withColumn("last_login_ts", F.col("last_login_ts").cast("date")), ("email", "last_login_ts"))


def _postal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_postal(fixture(spark, sf_dir, "crm_customers").select("customer_id", "address"))


# --- silver ----------------------------------------------------------------


def money_spec() -> SilverSpec:
    """A small recipe of its own: postal codes and currencies."""
    return (
        SilverSpec()
        .transform(currency=standardize.currency, postal_code=standardize.postal_code)
        .check(currency=validate.is_currency, postal_code=validate.is_postal_code)
        .upper("postal_code")
        .fill_none("postal_code")
    )


_MONEY_SQL = over(
    "crm_money",
    f"""SELECT id, currency, postal_code, {flags_sql([('currency', 'v1'), ('postal_code', 'v2')])} AS data_quality_flags,
 {score_sql(['v1', 'v2'])} AS quality_score
FROM (SELECT *, {CURRENCY_OK.format('currency')} AS v1, {POSTAL_OK.format('postal_code')} AS v2 FROM (
 SELECT id, {CURRENCY.format('currency')} AS currency,
  coalesce(upper(trim({POSTAL.format('postal_code')})), 'None') AS postal_code FROM crm_money) AS c) AS j""",
)


def _money_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(fixture(spark, sf_dir, "crm_money"), money_spec())


def _prefixed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SilverSpec(prefix="src_", rules={"currency": validate.is_currency}).upper("currency")
    return build_silver(fixture(spark, sf_dir, "crm_money"), spec)


def customer_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: standard cleansing, flags and score of all customers."""
    return build_silver(fixture(spark, sf_dir, "crm_customers"), customer_spec())


def _silver_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_customers(fixture(spark, sf_dir, "crm_customers"), _fixed_time())


_SILVER = silver_sql("crm_customers")

_CHECK_LETTER = """
CASE WHEN regexp_matches({0}, '^.[0-9]{{7}}.$') THEN substr(
 CASE WHEN upper(substr({0}, 1, 1)) IN ('S', 'T') THEN 'JZIHGFEDCBA' WHEN upper(substr({0}, 1, 1)) IN ('F', 'G')
  THEN 'XWUTRQPNMLK' WHEN upper(substr({0}, 1, 1)) = 'M' THEN 'KLJNPQRTUWX' END,
 CAST({1} AS BIGINT), 1) END"""
_CHECK_SUM = (
    "("
    + " + ".join(f"coalesce(try_cast(substr(n, {i}, 1) AS INT), 0) * {w}" for i, w in enumerate((2, 7, 6, 5, 4, 3, 2), 2))
    + " + CASE WHEN upper(substr(n, 1, 1)) IN ('T', 'G', 'M') THEN 4 ELSE 0 END) % 11"
)


def _check_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    nric = standardize.nric(F.col("nric"))
    return fixture(spark, sf_dir, "crm_customers").select(
        "customer_id",
        validate.nric_check_letter(nric).alias("literal"),
        validate.nric_check_letter(nric, mode="forward").alias("forward"),
        validate.has_valid_nric_checksum(nric).alias("is_valid"),
    )


QUERIES = {
    "col_normalize": Query(
        _normalized,
        "SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS phone, c_acctbal AS date_of_birth,"
        " c_nationkey AS a_b FROM customer",
    ),
    "col_normalize_suffix": Query(
        _suffixed, "SELECT c_custkey AS id, c_name AS a_b, c_mktsegment AS a_b_2 FROM customer"
    ),
    "col_prefix": Query(
        _prefixed,
        over("crm_money", "SELECT id AS src_id, currency AS src_currency, postal_code AS src_postal_code FROM crm_money"),
    ),
    "col_transform": Query(
        _transformed,
        over(
            "crm_customers",
            f"SELECT customer_id, {COUNTRY.format('country')} AS country, {PHONE.format('phone')} AS phone"
            " FROM crm_customers",
        ),
    ),
    "col_upper": Query(
        _uppercased,
        over(
            "crm_customers",
            "SELECT customer_id, upper(trim(full_name)) AS full_name, upper(trim(country)) AS country FROM crm_customers",
        ),
    ),
    "std_postal": _money("postal_code", standardize.postal_code, POSTAL),
    "std_nric": _crm("nric", standardize.nric, "upper(trim({0}))"),
    "std_currency": _money("currency", standardize.currency, CURRENCY),
    "std_country": _crm("country", standardize.country, COUNTRY),
    "std_gender": _crm("gender", standardize.gender, GENDER),
    "std_name": _crm("full_name", standardize.person_name, "upper(trim({0}))"),
    "extract_postal": _crm("address", standardize.postal_from_address, POSTAL_OF),
    "std_phone": _crm("phone", standardize.phone, PHONE),
    "fill_none_col": _crm("email", standardize.none_text, "coalesce({0}, 'None')"),
    "val_postal": _money("postal_code", validate.is_postal_code, POSTAL_OK),
    "val_nric": _crm("nric", validate.is_nric, NRIC_OK),
    "val_currency": _money("currency", validate.is_currency, CURRENCY_OK),
    "val_country": _crm("country", validate.is_country, COUNTRY_OK),
    "val_gender": _crm("gender", validate.is_gender, GENDER_OK),
    "val_email": _crm("email", validate.is_email, EMAIL_OK),
    "val_nric9": _crm("nric", validate.is_nine_char_id, "length({0}) = 9 AND regexp_matches({0}, '^[A-Z0-9]{{9}}$')"),
    "nric_checksum": Query(
        _check_letters,
        over(
            "crm_customers",
            f"""SELECT customer_id, {_CHECK_LETTER.format('n', f'11 - {_CHECK_SUM}')} AS literal,
 {_CHECK_LETTER.format('n', f'1 + {_CHECK_SUM}')} AS forward,
 upper(substr(n, -1, 1)) = {_CHECK_LETTER.format('n', f'1 + {_CHECK_SUM}')} AS is_valid
FROM (SELECT customer_id, upper(trim(nric)) AS n FROM crm_customers) AS c""",
        ),
    ),
    "dq_flags": Query(
        _with_rules(add_flags, "data_quality_flags"),
        _judged(f"customer_id, {flags_sql(_RULE_NAMES)} AS data_quality_flags"),
    ),
    "dq_flags_null_fails": Query(
        _with_rules(lambda df, rules: add_flags(df, rules, null_is_failure=True), "data_quality_flags"),
        _judged(
            "customer_id, "
            + flags_sql([(n, f"coalesce({v}, false)") for n, v in _RULE_NAMES])
            + " AS data_quality_flags"
        ),
    ),
    "dq_score": Query(
        _with_rules(add_score, "quality_score"),
        _judged(f"customer_id, {score_sql([v for _, v in _RULE_NAMES])} AS quality_score"),
    ),
    "dq_flags_and_score": Query(
        _with_rules(add_flags_and_score, "data_quality_flags", "quality_score"),
        _judged(
            f"customer_id, {flags_sql(_RULE_NAMES)} AS data_quality_flags,"
            f" {score_sql([v for _, v in _RULE_NAMES])} AS quality_score"
        ),
    ),
    "dq_fill_none": Query(
        _filled,
        over(
            "crm_customers",
            "SELECT customer_id, coalesce(email, 'None') AS email,"
            " coalesce(CAST(CAST(last_login_ts AS DATE) AS VARCHAR), 'None') AS last_login_ts, address FROM crm_customers",
        ),
    ),
    "dq_columns": Query(
        _rule_columns, _judged("customer_id, " + ", ".join(f"{v} AS is_{name}" for name, v in _RULE_NAMES))
    ),
    "dq_summary_rows": Query(
        _with_rules(add_rule_columns, *(f"is_valid_{name}" for name, _ in _RULE_NAMES)),
        _judged("customer_id, " + ", ".join(f"{v} AS is_valid_{name}" for name, v in _RULE_NAMES)),
    ),
    "dq_summary": Query(_summary, _SUMMARY_SQL),
    "postal_pipeline": Query(
        _postal,
        over(
            "crm_customers",
            f"""SELECT *, {POSTAL_OK.format('postal_code')} AS is_valid_postal_code FROM (
 SELECT customer_id, address, {POSTAL.format(POSTAL_OF.format('address'))} AS postal_code FROM crm_customers) AS p""",
        ),
    ),
    "silver_build": Query(_money_silver, _MONEY_SQL),
    "silver_config": Query(
        _prefixed_silver,
        over(
            "crm_money",
            f"""SELECT *, {flags_sql([('currency', 'v')])} AS data_quality_flags, {score_sql(['v'])} AS quality_score
FROM (SELECT *, {CURRENCY_OK.format('src_currency')} AS v FROM (SELECT id AS src_id,
 upper(trim(currency)) AS src_currency, postal_code AS src_postal_code FROM crm_money) AS p) AS j""".replace(
                "SELECT *, nullif", "SELECT * EXCLUDE (v), nullif"
            ),
        ),
    ),
    "silver_customer": Query(
        customer_silver,
        over("crm_customers", f"SELECT * EXCLUDE (postal_code, is_valid_postal_code) FROM ({_SILVER}) AS s"),
    ),
    "silver_source": Query(
        _silver_source,
        over("crm_customers", f"SELECT *, TIMESTAMP '{PROCESSED_AT}' AS silver_processed_ts FROM ({_SILVER}) AS s"),
    ),
}
