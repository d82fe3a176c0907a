"""Input and expected output of every column expression."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lustra.functions import masks, standardize, validate


def results(spark, fn, inputs):
    """The expression over a column of inputs (not over literals, so nothing folds away)."""
    rows = [(i, value) for i, value in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", fn(F.col("v")).alias("r"))
    return [row["r"] for row in df.orderBy("i").collect()]


STANDARDIZED = [
    (
        standardize.postal_code,
        [
            (None, None),
            ("", ""),
            (" 1 2 3 ", "000123"),
            ("123456", "123456"),
            ("1234567", "1234567"),
            ("AB12", "AB12"),
            ("0", "000000"),
            ("\t99\n", "000099"),
        ],
    ),
    (standardize.nric, [(None, None), (" s1234567d ", "S1234567D"), ("", "")]),
    (standardize.person_name, [("  jane Doe ", "JANE DOE"), ("\tjane", "\tJANE")]),
    (
        standardize.currency,
        [(" usd ", "USD"), ("rmb", "CNY"), ("Cny", "CNY"), ("yen", "JPY"), ("JPY", "JPY"), ("eur", "EUR"), (None, None)],
    ),
    (
        standardize.country,
        [
            ("usa", "US"),
            ("US", "US"),
            ("uk", "GB"),
            ("gb", "GB"),
            ("Singapore", "SG"),
            ("china", "CN"),
            (" taiwan ", "TW"),
            ("FRANCE", "FR"),
            ("denmark", "DK"),
            ("Brazil", "BRAZIL"),
            ("", ""),
            (None, None),
        ],
    ),
    (standardize.gender, [("m", "M"), (" F", "F"), ("x ", "X"), ("unknown", None), ("", None), (None, None)]),
    (
        standardize.postal_from_address,
        [
            ("Blk 1 S(123456)", "123456"),
            ("1234567 Road 654321", "654321"),
            ("111111 then 222222", "111111"),
            ("no code", ""),
            ("None", ""),
            (None, None),
        ],
    ),
    (
        standardize.phone,
        [
            ("+65 8123 4567", "+6581234567"),
            ("65-81234567", "+6581234567"),
            ("081234567", "+6581234567"),
            ("81234567", "+6581234567"),
            ("65123456", "+65123456"),
            ("+1 (743) 555-3824", "+17435553824"),
            ("123", "123"),
            ("", ""),
            ("0", "+65"),
            (None, None),
        ],
    ),
    (standardize.none_text, [(None, "None"), ("", ""), ("x", "x")]),
]

VALIDATED = [
    (
        validate.is_postal_code,
        [("123456", True), (" 12 34 56", True), ("12345", False), ("1234567", False), ("12345a", False), (None, None)],
    ),
    (
        validate.is_nric,
        [
            ("S1234567D", True),
            ("M0000000A", True),
            ("A1234567D", False),
            ("s1234567d", False),
            ("S1234567D\n", False),
            ("S123456D", False),
            (None, None),
        ],
    ),
    (validate.is_currency, [("usd", True), ("CNY", True), ("eur", False), (" usd", False), (None, None)]),
    (validate.is_country, [("usa", True), ("gb", True), ("SINGAPORE", False), (" us", False), (None, None)]),
    (validate.is_gender, [("m", True), ("Q", False), ("m ", False), (None, None)]),
    (
        validate.is_email,
        [
            ("a.b+c@mail.example.com", True),
            ("a@b", False),
            ("a b@x.com", False),
            ("a@x.com\n", False),
            ("None", False),
            ("", False),
            (None, False),
        ],
    ),
    (validate.is_nine_char_id, [("ABC123456", True), ("abc123456", False), ("ABC12345", False), (None, None)]),
    (
        validate.nric_check_letter,
        [
            ("S1234567D", "H"),
            ("s1234567x", "H"),
            ("X1234567D", None),
            ("S12345D", None),
            ("S12x4567D", None),
            ("", None),
            (None, None),
        ],
    ),
    (lambda c: validate.nric_check_letter(c, "forward"), [("S1234567D", "D"), ("F1234567N", "N"), (None, None)]),
    (validate.has_valid_nric_checksum, [("S1234567D", True), ("S1234567A", False), ("bad", None)]),
]


@pytest.mark.parametrize("fn, cases", STANDARDIZED + VALIDATED)
def test_expression(spark, fn, cases):
    assert results(spark, fn, [given for given, _ in cases]) == [expected for _, expected in cases]


def check_letter_model(nric, forward=False):
    """The checksum, step by step."""
    letters = {"S": "JZIHGFEDCBA", "F": "XWUTRQPNMLK", "M": "KLJNPQRTUWX"}
    letters |= {"T": letters["S"], "G": letters["F"]}
    total = 0
    for digit, weight in zip(nric[1:8], (2, 7, 6, 5, 4, 3, 2)):
        total += int(digit) * weight
    if nric[0] in "TGM":
        total += 4
    return letters[nric[0]][total % 11 if forward else 10 - total % 11]


@pytest.mark.parametrize("mode", ["literal", "forward"])
def test_check_letters_agree_with_model(spark, mode):
    numbers = [f"{prefix}{n * 7919 % 10_000_000:07d}A" for n in range(40) for prefix in "STFGM"]
    found = results(spark, lambda c: validate.nric_check_letter(c, mode), numbers)
    assert found == [check_letter_model(n, mode == "forward") for n in numbers]


def test_check_letter_mode_is_checked():
    with pytest.raises(ValueError):
        validate.nric_check_letter(F.lit("S1234567D"), "backward")


MASKED = [
    # mask, value, partial form, hidden form
    (masks.mask_email, "user@domain.com", "u***@domain.com", "***@***"),
    (masks.mask_email, "None", "***@***", "***@***"),
    (masks.mask_email, None, "***@***", "***@***"),
    (masks.mask_phone, "+6512345678", "+65 ****5678", "***"),
    (masks.mask_phone, "+17435553824", "****3824", "***"),
    (masks.mask_phone, "123", "***", "***"),
    (masks.mask_phone, "None", "***", "***"),
    (masks.mask_nric, "S1234567D", "S****67D", "***"),
    (masks.mask_nric, "S1D", "***", "***"),
    (masks.mask_ssn, "123-45-6789", "***-**-6789", "***"),
    (masks.mask_ssn, "6789", "***", "***"),
    (masks.mask_address, "1 Road Singapore 123456", "*** Singapore 123456", "***"),
    (masks.mask_address, "no code", "*** Singapore ", "***"),
]


@pytest.mark.parametrize("mask, value, partial, hidden", MASKED)
def test_mask_by_level(spark, mask, value, partial, hidden):
    levels = ["full_access", "partial_access", "masked_only", "superuser", None]
    rows = [(i, value, level) for i, level in enumerate(levels)]
    df = spark.createDataFrame(rows, "i int, v string, level string")
    shown = [r["m"] for r in df.select("i", mask(F.col("v"), F.col("level")).alias("m")).orderBy("i").collect()]
    assert shown == [value, partial, hidden, hidden, hidden]


@pytest.mark.parametrize(
    "mask, value, partial",
    [
        (masks.mask_email, "None", None),
        (masks.mask_email, "a@", "a***@"),
        (masks.mask_phone, "+6512345678", "+651 ****5678"),
        (masks.mask_phone, "123", "123 ****123"),
        (masks.mask_nric, "S1D", "S****S1D"),
        (masks.mask_ssn, "89", "***-**-89"),
    ],
)
def test_literal_partial_forms(spark, mask, value, partial):
    assert results(spark, lambda c: mask(c, F.lit("partial_access"), strict=False), [value]) == [partial]


def test_address_mask_with_postal_column(spark):
    df = spark.createDataFrame([("1 Road", "123456"), ("1 Road", None)], "a string, p string")
    shown = df.select(masks.mask_address(F.col("a"), F.lit("partial_access"), F.col("p")).alias("m")).collect()
    assert [r["m"] for r in shown] == ["*** Singapore 123456", None]
