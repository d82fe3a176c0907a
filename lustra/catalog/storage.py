"""Sources, sinks and the many-table job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lustra.catalog.base import COUNTRY, COUNTRY_OK, CURRENCY, CURRENCY_OK, Query, fixture_sql, over
from lustra.functions import standardize, validate
from lustra.operators.silver import SilverSpec
from lustra.plans.fixtures import MANY_TABLES, fixture, table
from lustra.plans.many import TableJob, run_silver
from lustra.plans.packed import silver_packed
from lustra.sources.named_csv import NamedCsv
from lustra.sources.readers import add_lineage, read_table, stream_csv, stream_table
from lustra.sources.sinks import publish_view, store, write_stream_table
from lustra.sources.workspace import fresh_folder

_CRM_SHOWN = ["customer_id", "full_name", "email", "phone", "ssn", "dob", "status", "credit_score", "annual_income"]


def _crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "crm_customers").select(*_CRM_SHOWN)


_CRM_SQL = over("crm_customers", f"SELECT {', '.join(_CRM_SHOWN)} FROM crm_customers")


def _csv_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV with untidy headers, then ingested as a stream."""
    landing = fresh_folder(spark, "landing")
    raw = _crm(spark, sf_dir).withColumnsRenamed({"customer_id": " Customer ID ", "full_name": "Full  Name"})
    raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(landing)
    bronze = fresh_folder(spark, "bronze")
    stream = stream_csv(spark, landing, max_files_per_batch=4)
    write_stream_table(stream, bronze, fresh_folder(spark, "bronze-checkpoint")).awaitTermination()
    stored = read_table(spark, bronze)
    return stored.withColumns(
        {
            "ingested_file": F.col("ingested_file").startswith("file:") | F.col("ingested_file").contains(landing),
            "ingestion_ts": F.col("ingestion_ts").isNotNull(),
            "customer_id": F.col("customer_id").cast("long"),
        }
    )


def _csv_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers from three exporters: all columns, another order with some missing, another with one more."""
    landing = fresh_folder(spark, "exports")
    crm = _crm(spark, sf_dir)
    text = [F.col(c).cast("string").alias(c) for c in _CRM_SHOWN]
    names = {"customer_id": " Customer ID ", "full_name": "FULL  Name", "annual_income": "annual income"}
    exports = (
        crm.filter("customer_id % 3 = 0").select(*text),
        crm.filter("customer_id % 3 = 1").select(*text[:2:-1], *text[:2]).drop("status", "dob"),
        crm.filter("customer_id % 3 = 2").select(*text[4:], F.lit("b").alias("Branch Code"), *text[:4]),
    )
    for i, export in enumerate(exports):
        raw = export.withColumnsRenamed(names) if i else export
        untrimmed = raw.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        untrimmed.option("ignoreTrailingWhiteSpace", False).csv(f"{landing}/part={i}")
    bronze = NamedCsv(fresh_folder(spark, "bronze-named"), crm.schema, files_per_batch=5)
    bronze.start(spark, f"{landing}/*", fresh_folder(spark, "bronze-named-checkpoint")).awaitTermination()
    stored = bronze.read(spark)
    return stored.withColumns(
        {name: F.col(name).isNotNull() for name in ("ingested_file", "ingestion_ts")}
    )


def _lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_lineage(table(spark, sf_dir, "customer"))
    return rows.select(
        "c_custkey",
        F.col("ingested_file").endswith("customer.parquet").alias("from_file"),
        F.col("ingestion_ts").isNotNull().alias("stamped"),
    )


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/customer.parquet").select("c_custkey", "c_acctbal")


def _table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table read as a stream and cleansed on the way."""
    stored = fresh_folder(spark, "stored")
    store(_crm(spark, sf_dir), stored)
    out = fresh_folder(spark, "streamed")
    stream = stream_table(spark, stored).withColumn("phone", standardize.phone(F.col("phone")))
    write_stream_table(stream, out, fresh_folder(spark, "streamed-checkpoint")).awaitTermination()
    return read_table(spark, out).select("customer_id", "phone")


# Order priorities and the days they allow.
_PRIORITY_DAYS = (("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 5), ("4-NOT SPECIFIED", None), ("5-LOW", 10))


def _literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal table with a declared schema, used to label every order."""
    schema = T.StructType(
        [T.StructField("o_orderpriority", T.StringType(), False), T.StructField("days", T.IntegerType(), True)]
    )
    days = spark.createDataFrame(_PRIORITY_DAYS, schema)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return orders.join(F.broadcast(days), "o_orderpriority", "left")


def _stream_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change table appended to a streaming table, file by file."""
    landing = fresh_folder(spark, "changes")
    changes = fixture(spark, sf_dir, "user_changes")
    changes.write.parquet(landing)
    out = fresh_folder(spark, "changes-table")
    stream = stream_table(spark, landing, changes.schema)
    write_stream_table(stream, out, fresh_folder(spark, "changes-checkpoint")).awaitTermination()
    return spark.read.schema(changes.schema).parquet(out)


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(_crm(spark, sf_dir), fresh_folder(spark, "materialized"), partition_by=["status"]).select(*_CRM_SHOWN)


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    publish_view(_crm(spark, sf_dir), "lustra_crm_view")
    return spark.sql("SELECT status, count(*) AS n, sum(credit_score) AS score FROM lustra_crm_view GROUP BY status")


# --- many tables -----------------------------------------------------------

MANY_SPEC = (
    SilverSpec()
    .transform(country=standardize.country, currency=standardize.currency)
    .check(country=validate.is_country, currency=validate.is_currency)
    .upper("name")
)


def _many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recipe over four tables, each written by its own job, then read back together."""
    root = fresh_folder(spark, "many")
    jobs = [TableJob(name, MANY_SPEC) for name in MANY_TABLES]
    run_silver(
        jobs,
        read=lambda name: fixture(spark, sf_dir, f"dirty_{name}"),
        write=lambda name, df: df.write.mode("overwrite").parquet(f"{root}/{name}"),
    )
    shown = ["id", "name", "data_quality_flags", "quality_score"]
    parts = [
        spark.read.parquet(f"{root}/{name}").select(F.lit(name).alias("source"), *shown) for name in MANY_TABLES
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _many_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same four tables in packs: two writes, read back one by one."""
    jobs = [TableJob(name, MANY_SPEC) for name in MANY_TABLES]
    run = silver_packed(spark, jobs, lambda name: fixture(spark, sf_dir, f"dirty_{name}"), packs=2)
    run.raise_failed()
    shown = ["id", "name", "data_quality_flags", "quality_score"]
    parts = [t.read(spark).select(F.lit(name).alias("source"), *shown) for name, t in run.tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _many_sql() -> str:
    lines = []
    for name, text in MANY_TABLES.items():
        rules = [
            (rule, ok.format(clean.format(rule)))
            for rule, ok, clean in (("country", COUNTRY_OK, COUNTRY), ("currency", CURRENCY_OK, CURRENCY))
            if f"AS {rule}" in text
        ]
        flags = ", ".join(f"CASE WHEN NOT ({ok}) THEN '{rule}' END" for rule, ok in rules)
        passed = " + ".join(f"CASE WHEN {ok} THEN 1 ELSE 0 END" for _, ok in rules)
        lines.append(
            f"SELECT '{name}' AS source, id, upper(trim(name)) AS name, nullif(concat_ws(', ', {flags}), '')"
            f" AS data_quality_flags, round(({passed}) / CAST({len(rules)} AS DOUBLE) * 100, 2) AS quality_score"
            f" FROM ({fixture_sql(f'dirty_{name}')}) AS t_{name}"
        )
    return "\nUNION ALL\n".join(lines)


_DAYS_SQL = ", ".join(f"('{p}', {'NULL' if d is None else d})" for p, d in _PRIORITY_DAYS)

QUERIES = {
    "src_csv_stream": Query(
        _csv_stream,
        over(
            "crm_customers",
            f"SELECT {', '.join(_CRM_SHOWN)}, true AS ingested_file, true AS ingestion_ts,"
            " CAST(NULL AS VARCHAR) AS misfit_line FROM crm_customers",
        ),
    ),
    "src_csv_by_header": Query(
        _csv_by_header,
        over(
            "crm_customers",
            f"SELECT {', '.join(c for c in _CRM_SHOWN if c not in ('email', 'status', 'dob'))},"
            " CASE WHEN customer_id % 3 <> 1 THEN email END AS email,"
            " CASE WHEN customer_id % 3 <> 1 THEN status END AS status, CASE WHEN customer_id % 3 <> 1 THEN dob END AS dob,"
            " true AS ingested_file, true AS ingestion_ts, CAST(NULL AS VARCHAR) AS misfit_line,"
            """ CASE WHEN customer_id % 3 = 2 THEN '{"branch_code":"b"}' END AS rescued_values FROM crm_customers""",
        ),
    ),
    "src_lineage": Query(_lineage, "SELECT c_custkey, true AS from_file, true AS stamped FROM customer"),
    "src_table": Query(_table, "SELECT c_custkey, c_acctbal FROM customer"),
    "src_table_stream": Query(
        _table_stream,
        over(
            "crm_customers",
            r"""SELECT customer_id, CASE WHEN d LIKE '+65%' THEN d WHEN d LIKE '65%' THEN '+' || d WHEN d LIKE '0%'
 THEN '+65' || substr(d, 2) WHEN length(d) = 8 THEN '+65' || d ELSE d END AS phone
FROM (SELECT customer_id, regexp_replace(phone, '[^\d+]', '', 'g') AS d FROM crm_customers) AS c""",
        ),
    ),
    "src_rows": Query(
        _literal_rows,
        "SELECT o.o_orderkey, o.o_orderpriority, d.days FROM orders AS o"
        f" LEFT JOIN (VALUES {_DAYS_SQL}) AS d(p, days) ON d.p = o.o_orderpriority",
    ),
    "sink_stream_table": Query(_stream_sink, fixture_sql("user_changes")),
    "sink_mv": Query(_stored, _CRM_SQL),
    "sink_view": Query(
        _view,
        over(
            "crm_customers",
            "SELECT status, count(*) AS n, CAST(sum(credit_score) AS BIGINT) AS score FROM crm_customers GROUP BY status",
        ),
    ),
    "silver_many": Query(_many, _many_sql()),
    "silver_many_packed": Query(_many_packed, _many_sql()),
}
