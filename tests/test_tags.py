"""Tags through renames, joins, stored tables; computed copies raise; lists of tables."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lustra.functions import masks
from lustra.operators.masking import ColumnMask, apply_policy
from lustra.operators.tags import Uncovered, declassify, derived_columns, mask_tagged, tag_columns, tag_tables

POLICY = {
    "customers": {
        "email": ColumnMask(masks.mask_email),
        "address": ColumnMask(masks.mask_address, using={"postal": "postal_code"}),
    },
    "leads": {"phone": ColumnMask(masks.mask_phone)},
}
ROWS = [(1, "ann@x.com", "Blk 1 S(123456)", "123456", "partial_access"), (2, "bob@y.com", "Blk 2", "654321", "full_access"), (3, None, None, None, None)]
FIELDS = "id int, email string, address string, postal_code string, access_level string"


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(ROWS, FIELDS)


def test_renamed_twice_is_still_masked_as_by_the_policy(spark, customers):
    tagged = tag_columns(customers, "main.crm.customers_silver", POLICY)
    moved = tagged.withColumnRenamed("email", "contact").filter("id > 0").select(
        F.col("contact").alias("mail to"), "address", F.col("postal_code").alias("zip"), "id", "access_level"
    )
    want = apply_policy(customers, "customers", policy=POLICY)
    have = mask_tagged(moved, policy=POLICY)
    assert have.columns == ["mail to", "address", "zip", "id", "access_level"]
    assert {(r["mail to"], r["address"], r["id"]) for r in have.collect()} == {
        (r.email, r.address, r.id) for r in want.collect()
    }
    assert all("pii" not in str(f.metadata) for f in have.schema)


def test_copies_are_masked_and_computed_ones_raise(customers):
    tagged = tag_columns(customers, "customers", POLICY)
    copied = tagged.withColumn("copy", F.col("email")).withColumn("again", F.col("copy"))
    assert {r.again for r in mask_tagged(copied, policy=POLICY).collect()} == {"a***@x.com", "bob@y.com", "***@***"}
    for made in (
        tagged.withColumn("loud", F.upper("email")),
        tagged.withColumn("loud", F.concat("id", "email")).withColumn("more", F.col("loud")).drop("loud"),
        tagged.groupBy("id").agg(F.max("email").alias("top")),
        tagged.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("email"))),
        tagged.select("id", F.explode(F.split("email", "@"))),
        tagged.select("id", F.upper("email").alias("e")).unionByName(tagged.select("id", F.lit("x").alias("e"))),
        tagged.select("id").join(tagged.groupBy("id").agg(F.first("email").alias("f")), "id"),
    ):
        with pytest.raises(Uncovered):
            mask_tagged(made, F.lit("full_access"), POLICY)
    assert derived_columns(tagged.withColumn("loud", F.upper("email")).drop("loud")) == []
    fine = tagged.withColumn("next", F.col("id") + 1).filter(F.length("email") > 3)
    assert derived_columns(fine) == []


def test_declassified_values_are_shown(customers):
    tagged = tag_columns(customers, "customers", POLICY)
    domain = declassify(tagged.withColumn("domain", F.substring_index("email", "@", -1)), "domain")
    shown = mask_tagged(domain.withColumn("site", F.concat(F.lit("www."), "domain")), policy=POLICY)
    assert {(r.email, r.domain, r.site) for r in shown.collect()} == {
        ("a***@x.com", "x.com", "www.x.com"), ("bob@y.com", "y.com", "www.y.com"), ("***@***", None, None)
    }
    with pytest.raises(ValueError):
        declassify(tagged, "email")


def test_tags_survive_storage_and_joins(spark, customers, tmp_path):
    leads = spark.createDataFrame([(1, "+6581234567"), (3, "123")], "id int, phone string")
    both = tag_tables({"crm.customers": customers, "crm.leads_silver": leads}, POLICY)
    both["crm.customers"].write.parquet(str(tmp_path / "c"))
    joined = spark.read.parquet(str(tmp_path / "c")).join(both["crm.leads_silver"], "id", "left").drop("access_level")
    rows = mask_tagged(joined, F.lit("partial_access"), POLICY).orderBy("id").collect()
    assert [r.email for r in rows] == ["a***@x.com", "b***@y.com", "***@***"]
    assert rows[0].phone == "+65 ****4567" and "123" not in str([r.phone for r in rows[1:]])
    assert "pii_mask" not in str(joined.schema["id"].metadata)


def test_everything_uncovered_is_raised_at_once(spark, customers):
    tables = {"a.orders": customers, "customers": customers.drop("postal_code", "email"), "leads": customers, "x": customers}
    with pytest.raises(Uncovered) as caught:
        tag_tables(tables, POLICY)
    for part in ("a.orders", "email, postal_code", "leads lacks phone", "covers x"):
        assert part in str(caught.value)
    kept = tag_tables({"x": customers}, POLICY, on_missing="keep")["x"]
    assert kept.collect() == customers.collect() and mask_tagged(kept, policy=POLICY).collect() == customers.collect()
    with pytest.raises(Uncovered):
        mask_tagged(tag_columns(customers, "customers", POLICY), policy={"leads": {}})


def test_masking_is_one_narrow_projection(customers):
    tagged = tag_columns(customers, "customers", POLICY)
    plan = mask_tagged(tagged, policy=POLICY)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
