"""Naming, quality, silver, grants, masking and gold over frames."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lustra.functions import standardize, validate
from lustra.operators import quality
from lustra.operators.columns import clean_name, normalize_columns, prefix_columns
from lustra.operators.grants import level_of, resolve_all_levels, resolve_level, seed_grants
from lustra.operators.masking import apply_policy, mask_known_columns, policy_key
from lustra.operators.silver import SilverSpec, build_silver, customer_spec, silver_customers, unmatched
from lustra.plans.fixtures import fixture
from lustra.plans.gold import GOLD_COLUMNS, gold_customer_view, gold_customers

SF_DIR = "/root/testdata/sf0.001"
def now():
    return F.lit("2024-07-01 00:00:00").cast("timestamp_ntz")


# --- names -----------------------------------------------------------------


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("  Customer ID  ", "customer_id"),
        ("Full Name", "full_name"),
        ("Email  Address", "email_address"),
        ("phone", "phone"),
        ("Date Of Birth", "date_of_birth"),
        ("A   B", "a_b"),
        ("a__b", "a_b"),
    ],
)
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_normalize_keeps_data_and_order(spark):
    df = spark.createDataFrame([(1, "John", "+65 1")], ["  Customer ID  ", "Full Name", "phone"])
    out = normalize_columns(df)
    assert out.columns == ["customer_id", "full_name", "phone"]
    assert out.first() == (1, "John", "+65 1")


def test_colliding_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A B", "a b", "a_b_2"])
    with pytest.raises(ValueError, match="a_b"):
        normalize_columns(df)
    assert normalize_columns(df, on_collision="suffix").columns == ["a_b", "a_b_3", "a_b_2"]
    with pytest.raises(ValueError):
        normalize_columns(df, on_collision="drop")


def test_prefix_is_added_once(spark):
    df = spark.createDataFrame([(1, 2)], ["c_id", "name"])
    assert prefix_columns(df, "c_").columns == ["c_id", "c_name"]


# --- quality ---------------------------------------------------------------


@pytest.fixture
def judged(spark):
    return spark.createDataFrame(
        [(1, True, True), (2, False, True), (3, False, False), (4, None, True), (5, None, None)],
        "id int, a boolean, b boolean",
    )


def rules():
    return {"a": F.col("a"), "b": F.col("b")}


def column(df, name):
    return [row[name] for row in df.orderBy("id").collect()]


def test_flags(judged):
    assert column(quality.add_flags(judged, rules()), "data_quality_flags") == [None, "a", "a, b", None, None]
    strict = quality.add_flags(judged, rules(), null_is_failure=True)
    assert column(strict, "data_quality_flags") == [None, "a", "a, b", "a", "a, b"]


def test_flag_order_is_rule_order(judged):
    flipped = {"b": F.col("b"), "a": F.col("a")}
    assert column(quality.add_flags(judged, flipped, "f"), "f")[2] == "b, a"


def test_score(judged):
    assert column(quality.add_score(judged, rules()), "quality_score") == [100.0, 50.0, 0.0, 50.0, 0.0]
    third = {**rules(), "c": F.col("id") > 0}
    assert column(quality.add_score(judged, third, "s"), "s") == [100.0, 66.67, 33.33, 66.67, 33.33]


def test_no_rules(judged):
    assert column(quality.add_score(judged, {}), "quality_score") == [None] * 5
    assert column(quality.add_flags(judged, {}), "data_quality_flags") == [None] * 5
    assert quality.add_flags_and_score(judged, {}).columns == judged.columns
    with pytest.raises(ValueError):
        quality.summarize_rules(judged, {})


def test_joint_flags_and_score_equal_the_single_ones(judged):
    both = quality.add_flags_and_score(judged, rules())
    single = quality.add_score(quality.add_flags(judged, rules()), rules())
    assert both.columns == single.columns
    assert both.orderBy("id").collect() == single.orderBy("id").collect()


def test_summary(judged):
    rows = {r["rule"]: r for r in quality.summarize_rules(judged, rules()).collect()}
    assert tuple(rows["a"])[1:] == (5, 1, 2, 2, 20.0)
    assert tuple(rows["b"])[1:] == (5, 3, 1, 1, 60.0)


def test_summary_of_no_rows(judged):
    empty = quality.summarize_rules(judged.filter("id > 9"), rules()).collect()
    assert [tuple(r)[1:] for r in empty] == [(0, 0, 0, 0, None)] * 2


def test_fill_none_renders_other_types(judged):
    out = quality.fill_none(judged, ["a", "absent"])
    assert column(out, "a") == ["true", "false", "false", "None", "None"]


# --- silver ----------------------------------------------------------------


def test_silver_steps_run_in_order(spark):
    df = spark.createDataFrame([(1, " s1 ", None)], "id int, code string, note string")
    spec = (
        SilverSpec()
        .transform(code=lambda c: F.concat(c, F.lit("x")))
        .upper("code")
        .fill_none("note", "code")
        .check(code=lambda c: c == "S1 X", note=lambda c: c == "None")
    )
    row = build_silver(df, spec).first()
    assert (row["code"], row["note"], row["data_quality_flags"], row["quality_score"]) == ("S1 X", "None", None, 100.0)


def test_specs_are_immutable():
    base = SilverSpec()
    assert base.upper("a").fill_none("b") != base
    assert base == SilverSpec()


def test_absent_columns_are_skipped_and_reported(spark):
    df = spark.createDataFrame([(1, "usa")], "id int, country string")
    out = build_silver(df, customer_spec())
    assert out.columns == ["id", "country", "data_quality_flags", "quality_score"]
    assert unmatched(df.columns, customer_spec())["rules"] == ["nric", "email", "gender"]
    assert unmatched(["id"], SilverSpec()) == {}


def test_no_matching_rule_adds_no_quality_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert build_silver(df, customer_spec()).columns == ["id"]


def test_prefixed_columns_are_found(spark):
    df = spark.createDataFrame([("usa",)], "country string")
    spec = SilverSpec(prefix="c_").transform(country=standardize.country).check(country=validate.is_country)
    row = build_silver(df, spec).first()
    assert row["c_country"] == "US" and row["data_quality_flags"] is None
    assert unmatched(df.columns, spec) == {}


def test_flags_and_score_can_be_left_out(spark):
    df = spark.createDataFrame([("usa",)], "country string")
    assert build_silver(df, customer_spec(), flags=False, score=False).columns == ["country"]
    assert build_silver(df, customer_spec(), flags=False).columns == ["country", "quality_score"]


def test_invalid_gender_costs_score_but_is_not_flagged(spark):
    df = spark.createDataFrame([("q",)], "gender string")
    row = build_silver(df, customer_spec()).first()
    assert row["gender"] is None and row["data_quality_flags"] is None and row["quality_score"] == 0.0


def test_silver_keeps_every_row(spark):
    bronze = fixture(spark, SF_DIR, "crm_customers")
    assert silver_customers(bronze).count() == bronze.count()


# --- grants ----------------------------------------------------------------


def grants_of(spark, *rows):
    schema = "user_email string, access_level string, is_active boolean, expires_at timestamp_ntz"
    return spark.createDataFrame(list(rows), schema)


def test_levels_resolve_by_precedence_and_time(spark):
    at = datetime(2024, 7, 1)
    grants = grants_of(
        spark,
        ("two", "partial_access", True, None),
        ("two", "full_access", True, datetime(2024, 7, 2)),
        ("edge", "full_access", True, at),
        ("off", "full_access", False, None),
        ("odd", "everything", True, None),
    )
    expected = {"two": "full_access", "edge": "masked_only", "off": "masked_only", "odd": "masked_only"}
    assert {r[0]: r[1] for r in resolve_all_levels(grants, now()).collect()} == expected
    for user, level in {**expected, "nobody": "masked_only"}.items():
        assert [r[0] for r in resolve_level(grants, F.lit(user), now()).collect()] == [level]


def test_current_user_and_clock_are_the_defaults(spark):
    me = spark.sql("SELECT current_user()").first()[0]
    grants = grants_of(spark, (me, "partial_access", True, None), (me, "full_access", True, datetime(2000, 1, 1)))
    assert resolve_level(grants).first()[0] == "partial_access"


def test_seed_grants(spark):
    levels = {r["user_group"]: r["access_level"] for r in seed_grants(spark, datetime(2024, 1, 1)).collect()}
    assert levels == {
        "analyst": "masked_only",
        "scientist": "partial_access",
        "governance_officer": "full_access",
    }


# --- masking and gold ------------------------------------------------------


def test_policy_key():
    assert policy_key("main.crm.customers_silver") == "customers"
    assert policy_key("orders") == "orders"


def test_table_without_policy(spark):
    df = spark.createDataFrame([("a@b.co", "full_access")], "email string, access_level string")
    with pytest.raises(LookupError):
        apply_policy(df, "main.crm.orders_silver")
    assert apply_policy(df, "main.crm.orders_silver", on_missing="keep").first()["email"] == "a@b.co"


def test_masking_skips_absent_columns(spark):
    df = spark.createDataFrame([("a@b.co", "masked_only")], "email string, access_level string")
    assert mask_known_columns(df).first()["email"] == "***@***"


def gold_inputs(spark):
    silver = silver_customers(fixture(spark, SF_DIR, "crm_customers"), now())
    history = silver.withColumns({"__START_AT": F.col("signup_ts"), "__END_AT": F.expr("if(customer_id % 3 = 0, signup_ts, NULL)")})
    return history, fixture(spark, SF_DIR, "pii_grants")


def test_gold_columns_and_rows(spark):
    history, grants = gold_inputs(spark)
    gold = gold_customers(history, grants, F.lit("scientist@company.com"), now())
    assert tuple(gold.columns) == GOLD_COLUMNS
    assert gold.count() == history.count()
    current = gold_customers(history, grants, F.lit("scientist@company.com"), now(), versions="current")
    assert current.count() == history.filter("__END_AT IS NULL").count()
    with pytest.raises(ValueError):
        gold_customers(history, grants, versions="some")


@pytest.mark.parametrize("user", ["analyst", "expired", "edge", "revoked", "stranger"])
def test_no_raw_pii_without_access(spark, user):
    history, grants = gold_inputs(spark)
    shown = gold_customer_view(history, grants, F.lit(f"{user}@company.com"), now())
    values = shown.select("email", "phone", "nric", "address", "applied_access_level").distinct().collect()
    assert [tuple(v) for v in values] == [("***@***", "***", "***", "***", "masked_only")]


def test_view_follows_the_grants(spark):
    history, _ = gold_inputs(spark)
    one = history.limit(1)
    for level, expected in (("full_access", one.first()["ssn"]), ("masked_only", "***")):
        grants = grants_of(spark, ("me", level, True, None))
        seen = mask_known_columns(one, level_of(grants, F.lit("me"), now()))
        assert seen.first()["ssn"] == expected
        assert seen.columns == one.columns
