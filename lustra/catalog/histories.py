"""History builds, presets and lookups."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lustra.catalog.base import Query, fixture_sql, history_sql, silver_sql
from lustra.functions import standardize, validate
from lustra.operators.as_of import as_of_join
from lustra.operators.history import (
    CUSTOMER_UNTRACKED,
    HistorySpec,
    SkewPolicy,
    build_history,
    by_start,
    current_versions,
    customer_history,
    history_of,
    history_with_quality,
    key_history,
    product_history,
    rejected_changes,
    transaction_history,
    versions_as_of,
)
from lustra.operators.layout import HistoryLayout
from lustra.operators.measures import MeasuredIncrements
from lustra.operators.silver import SilverSpec, build_silver, silver_customers
from lustra.plans.fixtures import fixture
from lustra.plans.packed import HistoryJob, history_packed
from lustra.sources.sinks import store
from lustra.sources.workspace import fresh_folder
from lustra.streaming.history_stream import StreamedHistory
from lustra.streaming.quality_flow import QualityFlow

AS_OF = "2024-01-10 12:00:00"

USERS = history_of(
    "users",
    ["user_id"],
    "ts",
    track=("band",),
    deletes="is_deleted",
    tie_break=("event_id",),
    transient=("event_id", "is_deleted"),
)
_USERS_SHOWN = ("user_id", "band", "last_value", "__START_AT", "__END_AT")


def _users_sql(
    source: str = "user_changes",
    tracked: tuple[str, ...] = ("band",),
    untracked: tuple[str, ...] = ("last_value",),
    deletes: str | None = "is_deleted",
    ignore_null: bool = True,
) -> str:
    return history_sql(
        fixture_sql(source), "user_id", "ts", ("event_id",), tracked, untracked, deletes, ignore_null
    )


def _users(spec: HistorySpec, source: str = "user_changes", skew: SkewPolicy | None = SkewPolicy()):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_history(fixture(spark, sf_dir, source), spec, skew).select(*_USERS_SHOWN)

    return run


def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(USERS)(spark, sf_dir)


_SHARDS = 5


def _many_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change logs of five shards of the users, built together and written in one pack."""

    def read(name: str) -> DataFrame:
        return fixture(spark, sf_dir, "user_changes").filter(F.col("user_id") % _SHARDS == int(name[-1]))

    run = history_packed(spark, [HistoryJob(f"users_{i}", USERS) for i in range(_SHARDS)], read)
    run.raise_failed()
    parts = [t.read(spark).select(F.lit(name).alias("source"), *_USERS_SHOWN) for name, t in run.tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all rows under one key, cut into ranges like any key above a tenth of the rows."""
    changes = fixture(spark, sf_dir, "skewed_changes")
    policy = SkewPolicy(hot_rows=1000, range_rows=500)
    return build_history(changes, USERS, policy).select(*_USERS_SHOWN)


def _orders(spec: HistorySpec):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_history(fixture(spark, sf_dir, "order_changes"), spec)

    return run


_ORDERS = history_of(
    "orders", ["o_custkey"], "o_orderdate", tie_break=("o_orderkey",), transient=("o_orderkey",), ignore_null=False
)


def _orders_sql(tracked: tuple[str, ...], untracked: tuple[str, ...] = (), deletes: str | None = None) -> str:
    return history_sql(
        fixture_sql("order_changes"),
        "o_custkey",
        "o_orderdate",
        ("o_orderkey",),
        tracked,
        untracked,
        deletes,
        ignore_null=False,
        show_seq=True,
    )


# --- presets ---------------------------------------------------------------


def _transactions(status_only: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        changes = fixture(spark, sf_dir, "order_changes").withColumnsRenamed(
            {"o_custkey": "transaction_id", "o_orderdate": "transaction_ts"}
        )
        preset = transaction_history("orders", status_only=status_only)
        return build_history(changes, replace(preset, tie_break=("o_orderkey",), transient=("o_orderkey",)))

    return run


def _transactions_sql(tracked: tuple[str, ...], untracked: tuple[str, ...]) -> str:
    changes = (
        "SELECT * RENAME (o_custkey AS transaction_id, o_orderdate AS transaction_ts)"
        f" FROM ({fixture_sql('order_changes')}) AS o"
    )
    return history_sql(
        changes, "transaction_id", "transaction_ts", ("o_orderkey",), tracked, untracked, show_seq=True
    )


_LINE = ("l_orderkey", "l_linenumber")
_PRICED = ("price", "cost", "availability", "status")


def _products(price_changes: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        preset = product_history(price_changes=price_changes)
        return build_history(fixture(spark, sf_dir, "price_changes"), replace(preset, transient=_LINE))

    return run


def _products_sql(tracked: tuple[str, ...], untracked: tuple[str, ...]) -> str:
    ties = (*_LINE, *_PRICED, "tax")
    return history_sql(
        fixture_sql("price_changes"), "product_id", "updated_at", ties, tracked, untracked, show_seq=True
    )


_CRM_STORED = (
    "full_name email phone nric gender country address segment status annual_income postal_code is_valid_postal_code "
    "data_quality_flags quality_score"
).split()


def customer_versions(track_all: bool = False):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = silver_customers(fixture(spark, sf_dir, "crm_changes"), F.col("changed_at"))
        preset = customer_history(track_all=track_all)
        spec = replace(preset, tie_break=("change_id",), transient=("change_id", "changed_at"))
        return build_history(silver, spec)

    return run


def _customers_sql(track_all: bool) -> str:
    silver = f"SELECT *, changed_at AS silver_processed_ts FROM ({silver_sql('crm')}) AS s"
    changes = f"WITH crm AS ({fixture_sql('crm_changes')}) {silver}"
    untracked = () if track_all else tuple(c for c in _CRM_STORED if c in CUSTOMER_UNTRACKED)
    tracked = tuple(c for c in _CRM_STORED if c not in untracked)
    return history_sql(
        changes, "customer_id", "silver_processed_ts", ("change_id",), tracked, untracked, show_seq=True
    )


_QUALITY = (
    SilverSpec()
    .transform(gender=standardize.gender, country=standardize.country)
    .check(gender=validate.is_gender, country=validate.is_country, email=validate.is_email)
)


_CRM_HISTORY = history_of(
    "crm", ["customer_id"], "changed_at", tie_break=("change_id",), transient=("change_id",), ignore_null=True
)


def _quality_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "crm_changes").select(
        "customer_id", "changed_at", "change_id", "gender", "country", "email"
    )


def _quality_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_with_quality(_quality_changes(spark, sf_dir), _CRM_HISTORY, _QUALITY)


def _in_three_batches(spark: SparkSession, changes: DataFrame, purpose: str, by: str) -> DataFrame:
    """Changes as a stream of three micro-batches in no order of time, of a file a core each."""
    files = spark.sparkContext.defaultParallelism
    folder = fresh_folder(spark, purpose)
    changes.repartition(3 * files, by).write.parquet(folder)
    return spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _streamed_quality(spark: SparkSession, sf_dir: str, required: tuple[str, ...]) -> tuple[QualityFlow, DataFrame]:
    """Dirty changes streamed in three batches, not in order of time, through checks into a history."""
    changes = _quality_changes(spark, sf_dir)
    stream = _in_three_batches(spark, changes, "crm-changes", "change_id")
    flow = QualityFlow(fresh_folder(spark, "crm-flow"), _CRM_HISTORY, _QUALITY, required, buckets=8)
    flow.start(stream, fresh_folder(spark, "crm-flow-checkpoint")).awaitTermination()
    return flow, changes


def _quality_stream(required: tuple[str, ...] = ()):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        flow, changes = _streamed_quality(spark, sf_dir, required)
        return flow.read(spark, changes.schema)

    return run


def _quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow, changes = _streamed_quality(spark, sf_dir, ("gender", "email"))
    return flow.quarantined(spark, changes.schema).drop("batch_id")


def _stream_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow, _ = _streamed_quality(spark, sf_dir, ())
    names = ("n_rows", "n_passed", "n_failed", "n_unknown")
    return flow.rule_counts(spark).groupBy("rule").agg(*(F.sum(n).alias(n) for n in names))


def _measured(spark: SparkSession, sf_dir: str) -> MeasuredIncrements:
    """Cleansed change rows measured in four increments."""
    silver = build_silver(_quality_changes(spark, sf_dir), _QUALITY, flags=False, score=False)
    rules = {name: (lambda fn=fn, name=name: fn(F.col(name))) for name, fn in _QUALITY.rules.items()}
    measures = MeasuredIncrements(fresh_folder(spark, "crm-measures"), rules, ("customer_id", "email"), ("change_id",))
    for i in range(4):
        measures.add(silver.filter(F.col("change_id") % 4 == i), i)
    return measures


def _span_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(spark, sf_dir).rule_summary(spark, first=1, last=2)


def _span_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether distinct counts and medians of the whole, merged from increments, are within their errors."""
    measures, rows = _measured(spark, sf_dir), _quality_changes(spark, sf_dir)
    true = rows.agg(*(F.count_distinct(c).alias(c) for c in measures.distinct))
    true = true.select(F.explode(F.create_map(*(x for c in measures.distinct for x in (F.lit(c), F.col(c))))).alias("column", "n"))
    counts = measures.distinct_summary(spark).join(true, "column")
    counts = counts.select("column", "n_known", (F.abs(F.col("n_distinct") - F.col("n")) <= 0.08 * F.col("n")).alias("close"))
    medians = measures.quantile_summary(spark, (0.5,)).select("n_numbers", F.get("values", F.lit(0)).alias("median"))
    below = F.avg((F.col("change_id") <= medians.select("median").scalar()).cast("int"))
    share = rows.agg(below.alias("share")).select(
        F.lit("change_id").alias("column"),
        medians.select("n_numbers").scalar().alias("n_known"),
        (F.abs(F.col("share") - 0.5) <= 0.05).alias("close"),
    )
    return counts.unionByName(share)


_JUDGED_SQL = f"""SELECT customer_id, changed_at, change_id, gender, country, email,
 nullif(concat_ws(', ', CASE WHEN NOT v1 THEN 'gender' END, CASE WHEN NOT v2 THEN 'country' END,
  CASE WHEN NOT v3 THEN 'email' END), '') AS data_quality_flags,
 round((CASE WHEN v1 THEN 1 ELSE 0 END + CASE WHEN v2 THEN 1 ELSE 0 END + CASE WHEN v3 THEN 1 ELSE 0 END)
  / CAST(3 AS DOUBLE) * 100, 2) AS quality_score
FROM (SELECT *, gender IN ('M', 'F', 'X') AS v1, country IN ('US', 'GB') AS v2,
 coalesce(email LIKE '%@%', false) AS v3
 FROM (SELECT customer_id, changed_at, change_id, email,
  CASE WHEN upper(trim(gender)) = 'M' THEN 'M' END AS gender,
  CASE country WHEN 'usa' THEN 'US' WHEN 'UK' THEN 'GB' END AS country
  FROM ({fixture_sql('crm_changes')}) AS c) AS t) AS j"""


def _quality_sql(where: str = "true") -> str:
    return history_sql(
        f"SELECT * FROM ({_JUDGED_SQL}) AS judged WHERE {where}",
        "customer_id",
        "changed_at",
        ("change_id",),
        ("gender", "country", "email", "data_quality_flags", "quality_score"),
        show_seq=True,
    )


_FIT = "gender IS NOT NULL AND coalesce(email LIKE '%@%', false)"
_QUARANTINE_SQL = f"""SELECT *, concat_ws(', ', CASE WHEN gender IS NULL THEN 'gender' END,
 CASE WHEN NOT coalesce(email LIKE '%@%', false) THEN 'email' END) AS quarantine_reasons
FROM ({_JUDGED_SQL}) AS judged WHERE NOT ({_FIT})"""


def _rule_counts_sql(where: str = "true", rate: str = "") -> str:
    lines = (
        f"SELECT '{rule}' AS rule, count(*) AS n_rows, count(*) FILTER ({ok}) AS n_passed,"
        f" count(*) FILTER (NOT {ok}) AS n_failed, count(*) FILTER (({ok}) IS NULL) AS n_unknown"
        f"{rate.format(ok)} FROM judged WHERE {where}"
        for rule, ok in (
            ("gender", "gender IN ('M', 'F', 'X')"),
            ("country", "country IN ('US', 'GB')"),
            ("email", "coalesce(email LIKE '%@%', false)"),
        )
    )
    return f"WITH judged AS ({_JUDGED_SQL})\n" + "\nUNION ALL\n".join(lines)


# --- lookups ---------------------------------------------------------------


def _lookup(pick: Callable[[DataFrame], DataFrame]):
    """A lookup on stored history, so that its filter reaches the scan."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pick(store(user_history(spark, sf_dir), fresh_folder(spark, "users-history")))

    return run


def _laid_out(pick: Callable[[HistoryLayout, SparkSession], DataFrame]):
    """A lookup on a history stored by eras and key slots."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        layout = HistoryLayout(fresh_folder(spark, "users-layout"), ("user_id",), eras=4, slots=8)
        layout.write(user_history(spark, sf_dir))
        return pick(layout, spark)

    return run


def _facts(source: str):
    """Every event half an hour later, as a fact about its user."""

    def of(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fixture(spark, sf_dir, source).select(
            F.col("event_id").alias("fact_id"), "user_id", F.expr("ts + INTERVAL 30 MINUTES").alias("at")
        )

    return of


def _as_of_join(source: str, skew: SkewPolicy):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        history = build_history(fixture(spark, sf_dir, source), USERS).select(*_USERS_SHOWN)
        return as_of_join(_facts(source)(spark, sf_dir), history, ["user_id"], "at", skew=skew)

    return run


def _as_of_join_sql(source: str) -> str:
    valid = 'h."__END_AT" IS NULL OR h."__END_AT" > f.at'
    shown = ", ".join(f'CASE WHEN {valid} THEN h."{c}" END AS "{c}"' for c in _USERS_SHOWN[1:])
    return f"""SELECT f.fact_id, f.user_id, f.at, {shown}
FROM (SELECT event_id AS fact_id, user_id, ts + INTERVAL 30 MINUTE AS at FROM ({fixture_sql(source)}) AS c) AS f
ASOF LEFT JOIN ({_users_sql(source)}) AS h ON f.user_id = h.user_id AND f.at >= h."__START_AT\""""


# --- stream ----------------------------------------------------------------


def streamed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user history fed by a stream of files in no order of time, a third of them per micro-batch."""
    changes = fixture(spark, sf_dir, "user_changes")
    stream = _in_three_batches(spark, changes, "users-changes", "event_id")
    target = StreamedHistory(fresh_folder(spark, "users-streamed"), USERS, buckets=8)
    target.start(stream, fresh_folder(spark, "users-checkpoint")).awaitTermination()
    return target.read(spark, changes.schema).select(*_USERS_SHOWN)


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = fixture(spark, sf_dir, "user_changes").withColumns(
        {
            "user_id": F.when(F.col("event_id") % 50 != 0, F.col("user_id")),
            "ts": F.when(F.col("event_id") % 70 != 0, F.col("ts")),
        }
    )
    return rejected_changes(holed, USERS).select("event_id", "user_id", "ts", "band")


_AS_OF_SQL = f"""SELECT * FROM ({_users_sql()}) AS h WHERE "__START_AT" <= TIMESTAMP '{AS_OF}'
 AND ("__END_AT" IS NULL OR "__END_AT" > TIMESTAMP '{AS_OF}')"""
_KEY_SQL = f'SELECT * FROM ({_users_sql()}) AS h WHERE user_id = 7 ORDER BY "__START_AT"'

QUERIES = {
    "scd2_build": Query(user_history, _users_sql()),
    "scd2_build_ties": Query(
        _orders(replace(_ORDERS, track=("status",), deletes="priority = '1-URGENT'")),
        _orders_sql(("status",), ("amount", "priority"), "priority = '1-URGENT'"),
    ),
    "scd2_many": Query(
        _many_histories, f"SELECT concat('users_', user_id % {_SHARDS}) AS source, * FROM ({_users_sql()}) AS h"
    ),
    "scd2_build_hot_key": Query(_ranged, _users_sql("skewed_changes")),
    "scd2_track_only": Query(_orders(replace(_ORDERS, track=("status",))), _orders_sql(("status",), ("amount", "priority"))),
    "scd2_track_except": Query(
        _orders(replace(_ORDERS, track_except=("amount",))), _orders_sql(("status", "priority"), ("amount",))
    ),
    "scd2_track_all": Query(_orders(_ORDERS), _orders_sql(("status", "amount", "priority"))),
    "scd2_ignore_null": Query(_users(replace(USERS, deletes=None)), _users_sql(deletes=None)),
    "scd2_keep_null": Query(_users(replace(USERS, ignore_null=False)), _users_sql(ignore_null=False)),
    "scd2_delete": Query(
        _users(replace(USERS, track=("band", "last_value"), deletes="is_deleted = true")),
        _users_sql(tracked=("band", "last_value"), untracked=()),
    ),
    "scd2_rejects": Query(
        _rejects,
        f"""SELECT * FROM (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN user_id END AS user_id,
 CASE WHEN event_id % 70 <> 0 THEN ts END AS ts, band FROM ({fixture_sql('user_changes')}) AS c) AS h
WHERE user_id IS NULL OR ts IS NULL""",
    ),
    "scd2_config": Query(
        _users(HistorySpec("t", "s", ("user_id",), "ts", track=("band",), transient=("event_id", "is_deleted"))),
        _users_sql(deletes=None),
    ),
    "scd2_generic": Query(
        _users(
            history_of("users", ["user_id"], "ts", track_except=("last_value",), transient=("event_id", "is_deleted"))
        ),
        _users_sql(deletes=None),
    ),
    "scd2_customer": Query(customer_versions(), _customers_sql(track_all=False)),
    "scd2_customer_track_all": Query(customer_versions(track_all=True), _customers_sql(track_all=True)),
    "scd2_transaction": Query(_transactions(False), _transactions_sql(("status", "amount", "priority"), ())),
    "scd2_transaction_status": Query(_transactions(True), _transactions_sql(("status", "amount"), ("priority",))),
    "scd2_product": Query(_products(True), _products_sql(_PRICED, ("tax",))),
    "scd2_product_all": Query(_products(False), _products_sql((*_PRICED, "tax"), ())),
    "scd2_quality_flow": Query(_quality_flow, _quality_sql()),
    "scd2_quality_stream": Query(_quality_stream(), _quality_sql()),
    "scd2_quality_stream_required": Query(_quality_stream(("gender", "email")), _quality_sql(_FIT)),
    "scd2_quarantine": Query(_quarantined, _QUARANTINE_SQL),
    "dq_stream_counts": Query(_stream_rule_counts, _rule_counts_sql()),
    "dq_increments": Query(
        _span_summary,
        _rule_counts_sql("change_id % 4 IN (1, 2)", ", round(count(*) FILTER ({0}) * 100.0 / count(*), 2) AS pass_rate"),
    ),
    "dq_increment_sketches": Query(
        _span_sketches,
        "SELECT 'customer_id' AS \"column\", count(*) AS n_known, true AS close FROM orders"
        f" UNION ALL SELECT 'email', count(email), true FROM ({fixture_sql('crm_changes')}) AS c"
        " UNION ALL SELECT 'change_id', count(*), true FROM orders",
    ),
    "scd2_current": Query(
        _lookup(current_versions), f'SELECT * FROM ({_users_sql()}) AS h WHERE "__END_AT" IS NULL'
    ),
    "scd2_as_of_layout": Query(_laid_out(lambda layout, spark: layout.as_of(spark, AS_OF)), _AS_OF_SQL),
    "scd2_history_layout": Query(_laid_out(lambda layout, spark: layout.key_history(spark, {"user_id": 7})), _KEY_SQL),
    "scd2_layout": Query(_laid_out(lambda layout, spark: layout.read(spark)), _users_sql()),
    "scd2_as_of_join": Query(_as_of_join("user_changes", SkewPolicy()), _as_of_join_sql("user_changes")),
    "scd2_as_of_join_hot_key": Query(
        _as_of_join("skewed_changes", SkewPolicy(hot_rows=1000, range_rows=500)), _as_of_join_sql("skewed_changes")
    ),
    "scd2_as_of": Query(
        _lookup(lambda history: versions_as_of(history, AS_OF)),
        _AS_OF_SQL,
    ),
    "scd2_history": Query(
        _lookup(lambda history: key_history(history, {"user_id": 7})),
        _KEY_SQL,
    ),
    "sort_history": Query(
        lambda spark, sf_dir: by_start(user_history(spark, sf_dir), USERS), _users_sql()
    ),
    "scd2_stream": Query(streamed_users, _users_sql()),
}
