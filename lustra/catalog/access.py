"""Grants, level resolution, masks and gold."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lustra.catalog.base import Query, fixture_sql, over, silver_sql
from lustra.functions import masks
from lustra.functions.sql_masks import register_level_masks, register_sql_masks
from lustra.operators.columns import stamp
from lustra.operators.grants import (
    active_grants,
    in_force,
    level_of,
    level_with_default,
    resolve_all_levels,
    resolve_level,
    seed_grants,
    strongest_grants,
)
from lustra.operators.masking import DEFAULT_POLICY, ColumnMask, apply_policy, mask_known_columns
from lustra.operators.silver import add_postal, build_silver, clean_values, customer_spec, silver_customers
from lustra.operators.skew import SkewPolicy
from lustra.operators.tags import mask_tagged, tag_tables
from lustra.operators.timeline import access_timeline
from lustra.plans.fixtures import AS_OF, fixture, table
from lustra.plans.gold import GOLD_COLUMNS, gold_customer_view, gold_customers

# Users that cover every outcome: each level, two grants, expired, expiring at
# the very moment, revoked, and not known at all.
USERS = ("analyst", "scientist", "governance", "both", "expired", "edge", "revoked", "stranger")


def _address(user: str) -> str:
    return f"{user}@company.com"


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


_LIVE = f"is_active AND (expires_at IS NULL OR expires_at > TIMESTAMP '{AS_OF}')"
_RANK = "CASE access_level WHEN 'full_access' THEN 2 WHEN 'partial_access' THEN 1 ELSE 0 END"
_NAME = "CASE {0} WHEN 2 THEN 'full_access' WHEN 1 THEN 'partial_access' ELSE 'masked_only' END"


def _level_sql(user: str) -> str:
    rank = f"(SELECT max({_RANK}) FROM pii_grants WHERE user_email = '{_address(user)}' AND {_LIVE})"
    return _NAME.format(rank)


# --- grants ----------------------------------------------------------------


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    grants = fixture(spark, sf_dir, "pii_grants")
    mine = [active_grants(grants, F.lit(_address(u)), _as_of()) for u in ("both", "edge", "user2", "stranger")]
    found = mine[0]
    for more in mine[1:]:
        found = found.unionByName(more)
    return found


_ACTIVE_SQL = over(
    "pii_grants",
    f"SELECT * FROM pii_grants WHERE {_LIVE} AND user_email IN"
    f" ({', '.join(repr(_address(u)) for u in ('both', 'edge', 'user2', 'stranger'))})",
)


def _expiry(respect_granted_at: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        grants = fixture(spark, sf_dir, "pii_grants")
        live = in_force(_as_of(), respect_granted_at)
        return grants.select("user_email", "access_level", "granted_at", "expires_at", "is_active", live.alias("live"))

    return run


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_all_levels(fixture(spark, sf_dir, "pii_grants"), _as_of())


def _resolved_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scalar level per named user, looked up for every customer."""
    grants = fixture(spark, sf_dir, "pii_grants")
    levels = {f"as_{u}": level_of(grants, F.lit(_address(u)), _as_of()) for u in USERS}
    return table(spark, sf_dir, "customer").select("c_custkey", *(level.alias(n) for n, level in levels.items()))


def _seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed grants, given to customers by the group each belongs to."""
    group = F.array(*(F.lit(g) for g in ("analyst", "scientist", "governance_officer", "engineer")))
    members = table(spark, sf_dir, "customer").select(
        "c_custkey", F.get(group, (F.col("c_custkey") % 4).cast("int")).alias("user_group")
    )
    seeds = seed_grants(spark, datetime(2024, 1, 1)).drop("granted_at", "expires_at")
    return members.join(F.broadcast(seeds), "user_group", "left")


_SEED_SQL = """
SELECT m.c_custkey, m.user_group, s.* FROM (
 SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'analyst' WHEN 1 THEN 'scientist' WHEN 2 THEN 'governance_officer'
  ELSE 'engineer' END AS user_group FROM customer) AS m
LEFT JOIN (SELECT user_email, g, access_level, 'system' AS granted_by, true AS is_active,
 'Default group access' AS reason, CAST(NULL AS VARCHAR) AS approval_ticket_id
 FROM (VALUES ('analyst@company.com', 'analyst', 'masked_only'), ('scientist@company.com', 'scientist',
 'partial_access'), ('governance@company.com', 'governance_officer', 'full_access')) AS t(user_email, g, access_level)
) AS s ON s.g = m.user_group"""


def _one_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strongest_grants(fixture(spark, sf_dir, "pii_grants"), _as_of())


def _with_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grants in force and, for each granted user, the default they fall back to."""
    grants = fixture(spark, sf_dir, "pii_grants")
    own = grants.filter(in_force(_as_of())).select("user_email", "access_level")
    return own.unionAll(grants.select("user_email", F.lit("masked_only").alias("access_level")))


# --- level applied to data ---------------------------------------------------


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_values(fixture(spark, sf_dir, "crm_customers"), customer_spec())


def _levelled(user: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        level = level_of(fixture(spark, sf_dir, "pii_grants"), F.lit(_address(user)), _as_of())
        return fixture(spark, sf_dir, "crm_customers").select("customer_id", level.alias("access_level"))

    return run


def _for_each_user(shown: Callable[[Column], Column], level_for=level_of) -> Callable[[SparkSession, str], DataFrame]:
    """Something the level decides, for all users side by side, over all customers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        grants = fixture(spark, sf_dir, "pii_grants")
        levels = {f"as_{u}": shown(level_for(grants, F.lit(_address(u)), _as_of())) for u in USERS}
        return fixture(spark, sf_dir, "crm_customers").select("customer_id", *(c.alias(n) for n, c in levels.items()))

    return run


def _for_each_user_sql(shown: str) -> str:
    columns = ", ".join(f"{shown.format(f'({_level_sql(u)})')} AS as_{u}" for u in USERS)
    return over("crm_customers", f"SELECT customer_id, {columns} FROM crm_customers", "pii_grants")


# --- masks -----------------------------------------------------------------

_VIEWS = {
    "as_full": "full_access",
    "as_partial": "partial_access",
    "as_masked": "masked_only",
    "as_unknown": "superuser",
    "as_null": None,
}


def _mask_query(column: str, fn: Callable[[Column, Column], Column], partial: str, hidden: str) -> Query:
    """A mask at every level, known or not, over all cleaned customers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shown = add_postal(_cleaned(spark, sf_dir).select("customer_id", column, F.col("address").alias("__address")), "__address")
        views = {n: fn(F.col(column), F.lit(level).cast("string")) for n, level in _VIEWS.items()}
        return shown.select("customer_id", *(view.alias(n) for n, view in views.items()))

    cleaned = silver_sql("crm_customers")
    return Query(
        run,
        over(
            "crm_customers",
            f"SELECT customer_id, {column} AS as_full, {partial} AS as_partial, '{hidden}' AS as_masked,"
            f" '{hidden}' AS as_unknown, '{hidden}' AS as_null FROM ({cleaned}) AS s",
        ),
    )


_EMAIL_LITERAL = (
    "CASE WHEN contains(email, '@') THEN substr(split_part(email, '@', 1), 1, 1) || '***@' || split_part(email, '@', 2)"
    " END"
)
_EMAIL = f"coalesce({_EMAIL_LITERAL}, '***@***')"
_PHONE_LITERAL = "substring(phone, 1, 4) || ' ****' || substring(phone, -4, 4)"
_PHONE = (
    "CASE WHEN length(phone) < 8 THEN '***' WHEN phone LIKE '+65%' THEN '+65 ****' || right(phone, 4)"
    " ELSE '****' || right(phone, 4) END"
)
_NRIC_LITERAL = "substr(nric, 1, 1) || '****' || substr(nric, -3, 3)"
_NRIC = f"CASE WHEN length(nric) = 9 THEN {_NRIC_LITERAL} ELSE '***' END"
_SSN_LITERAL = "'***-**-' || substr(ssn, -4, 4)"
_SSN = f"CASE WHEN regexp_matches(ssn, '^([0-9]{{9}}|[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}})$') THEN {_SSN_LITERAL} ELSE '***' END"
_ADDRESS = r"'*** Singapore ' || regexp_extract(address, '\b(\d{6})\b', 1)"
_ADDRESS_POSTAL = "'*** Singapore ' || postal_code"

_ROW_LEVEL = (
    "CASE customer_id % 4 WHEN 0 THEN 'masked_only' WHEN 1 THEN 'partial_access' WHEN 2 THEN 'full_access' END"
)


def _masked_sql(column: str, partial: str, hidden: str, level: str = "access_level") -> str:
    return (
        f"CASE {level} WHEN 'full_access' THEN {column} WHEN 'partial_access' THEN {partial} ELSE '{hidden}' END"
        f" AS {column}"
    )


def _all_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _cleaned(spark, sf_dir).withColumn("access_level", F.expr(_ROW_LEVEL))
    return mask_known_columns(rows).select("customer_id", "email", "phone", "nric", "address", "ssn", "access_level")


def _policy_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_postal(_cleaned(spark, sf_dir)).withColumn("access_level", F.expr(_ROW_LEVEL))
    masked = apply_policy(rows, "main.crm.customers_silver")
    return masked.select("customer_id", "email", "phone", "nric", "address", "ssn", "postal_code")


def _tag_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables tagged by policy, columns renamed twice, joined, and masked at the end."""
    rows = add_postal(_cleaned(spark, sf_dir)).withColumn("access_level", F.expr(_ROW_LEVEL))
    policy = {**DEFAULT_POLICY, "accounts": {"ssn": ColumnMask(masks.mask_ssn)}}
    tagged = tag_tables(
        {
            "main.crm.customers_silver": rows.select("customer_id", "email", "phone", "address", "nric", "postal_code"),
            "main.crm.accounts": rows.select("customer_id", "ssn", "access_level"),
        },
        policy,
    )
    contacts = tagged["main.crm.customers_silver"].withColumnRenamed("email", "contact").filter("customer_id > 0")
    contacts = contacts.select(F.col("contact").alias("reach"), F.col("phone").alias("tel"), "*").drop("contact", "phone")
    contacts = contacts.withColumnsRenamed({"postal_code": "zip", "address": "home"})
    joined = contacts.join(tagged["main.crm.accounts"], "customer_id")
    return mask_tagged(joined, "access_level", policy).drop("access_level")


def _sql_masked(user: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_sql_masks(spark, fixture(spark, sf_dir, "pii_grants"), F.lit(_address(user)), _as_of())
        return spark.sql(
            "SELECT customer_id, mask_email(email) AS email, mask_phone(phone) AS phone, mask_nric(nric) AS nric,"
            " mask_address(address, postal_code) AS address, mask_ssn(ssn) AS ssn FROM {silver}",
            silver=add_postal(_cleaned(spark, sf_dir)),
        )

    return run


def _sql_masked_sql(user: str) -> str:
    shown = [
        _masked_sql("email", _EMAIL, "***@***"),
        _masked_sql("phone", _PHONE, "***"),
        _masked_sql("nric", _NRIC, "***"),
        _masked_sql("address", _ADDRESS_POSTAL, "***"),
        _masked_sql("ssn", _SSN, "***"),
    ]
    return over(
        "crm_customers",
        f"SELECT customer_id, {', '.join(shown)} FROM (SELECT *, {_level_sql(user)} AS access_level"
        f" FROM ({silver_sql('crm_customers')}) AS s) AS l",
        "pii_grants",
    )


_SQL_MASKS = (
    ("email", "email", _EMAIL, "***@***"),
    ("phone", "phone", _PHONE, "***"),
    ("nric", "nric", _NRIC, "***"),
    ("address", "address, postal_code", _ADDRESS_POSTAL, "***"),
    ("ssn", "ssn", _SSN, "***"),
)
_READERS = ("scientist", "governance", "stranger")


def _sql_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three readers side by side in one query, each under functions of their own."""
    grants = fixture(spark, sf_dir, "pii_grants")
    for user in _READERS:
        register_sql_masks(spark, grants, F.lit(_address(user)), _as_of(), suffix=f"_{user}")
    shown = ", ".join(
        f"mask_{name}_{user}({arguments}) AS {name}_{user}" for user in _READERS for name, arguments, *_ in _SQL_MASKS
    )
    return spark.sql(f"SELECT customer_id, {shown} FROM {{silver}}", silver=add_postal(_cleaned(spark, sf_dir)))


def _sql_readers_sql() -> str:
    levels = ", ".join(f"{_level_sql(user)} AS l_{user}" for user in _READERS)
    shown = ", ".join(
        f"CASE l_{user} WHEN 'full_access' THEN {name} WHEN 'partial_access' THEN {partial} ELSE '{hidden}' END"
        f" AS {name}_{user}"
        for user in _READERS
        for name, _, partial, hidden in _SQL_MASKS
    )
    rows = f"SELECT *, {levels} FROM ({silver_sql('crm_customers')}) AS s"
    return over("crm_customers", f"SELECT customer_id, {shown} FROM ({rows}) AS l", "pii_grants")


def _sql_row_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer row as its own user sees it: all levels resolved once and joined."""
    register_level_masks(spark)
    shown = ", ".join(f"mask_{name}_at(access_level, {arguments}) AS {name}" for name, arguments, *_ in _SQL_MASKS)
    return spark.sql(
        f"SELECT customer_id, {shown} FROM {{silver}} AS s LEFT JOIN {{levels}} AS l"
        " ON l.user_email = concat('user', s.customer_id, '@company.com')",
        silver=add_postal(_cleaned(spark, sf_dir)),
        levels=resolve_all_levels(fixture(spark, sf_dir, "pii_grants"), _as_of()),
    )


def _sql_row_readers_sql() -> str:
    rank = (
        f"(SELECT max({_RANK}) FROM pii_grants WHERE user_email = 'user' || s.customer_id || '@company.com' AND {_LIVE})"
    )
    shown = ", ".join(
        f"CASE level WHEN 2 THEN {name} WHEN 1 THEN {partial} ELSE '{hidden}' END AS {name}"
        for name, _, partial, hidden in _SQL_MASKS
    )
    rows = f"SELECT *, {rank} AS level FROM ({silver_sql('crm_customers')}) AS s"
    return over("crm_customers", f"SELECT customer_id, {shown} FROM ({rows}) AS l", "pii_grants")


def _timeline(name: str, skew: SkewPolicy = SkewPolicy()):
    return lambda spark, sf_dir: access_timeline(fixture(spark, sf_dir, name), skew)


def _timeline_sql(name: str) -> str:
    """The level at every start or end, from all grants that cover it; rows that change nothing fall out."""
    live = "g.granted_at <= p.t AND (g.expires_at IS NULL OR g.expires_at > p.t)"
    return f"""WITH counted AS (SELECT * FROM ({fixture_sql(name)}) AS all_grants
 WHERE is_active AND (expires_at IS NULL OR expires_at > granted_at)),
points AS (SELECT user_email, granted_at AS t FROM counted
 UNION SELECT user_email, expires_at FROM counted WHERE expires_at IS NOT NULL),
levels AS (SELECT p.user_email, p.t, coalesce(max({_RANK}) FILTER ({live}), 0) AS r
 FROM points AS p JOIN counted AS g USING (user_email) GROUP BY ALL),
steps AS (SELECT *, lag(r) OVER (PARTITION BY user_email ORDER BY t) AS before FROM levels)
SELECT user_email, {_NAME.format('r')} AS access_level, t AS "__START_AT",
 lead(t) OVER (PARTITION BY user_email ORDER BY t) AS "__END_AT"
FROM steps WHERE before IS DISTINCT FROM r"""


# --- gold ------------------------------------------------------------------

# Gold reads history; these bounds give every third customer a closed version.
_SPANS = {"__START_AT": "signup_ts", "__END_AT": "CASE WHEN customer_id % 3 = 0 THEN last_login_ts END"}


def silver_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_customers(fixture(spark, sf_dir, "crm_customers"), _as_of())
    return silver.withColumns({name: F.expr(text) for name, text in _SPANS.items()})


def _gold(user: str, versions: str = "all", strict: bool = True):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        grants = fixture(spark, sf_dir, "pii_grants")
        return gold_customers(
            silver_with_history(spark, sf_dir), grants, F.lit(_address(user)), _as_of(), versions, strict
        )

    return run


def _gold_view(user: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        grants = fixture(spark, sf_dir, "pii_grants")
        return gold_customer_view(silver_with_history(spark, sf_dir), grants, F.lit(_address(user)), _as_of())

    return run


def _gold_sql(
    user: str,
    current: bool = False,
    email: str = _EMAIL,
    phone: str = _PHONE,
    nric: str = _NRIC,
    address: str = _ADDRESS,
    show_level: bool = False,
) -> str:
    masked = {
        "email": _masked_sql("email", email, "***@***"),
        "phone": _masked_sql("phone", phone, "***"),
        "nric": _masked_sql("nric", nric, "***"),
        "address": _masked_sql("address", address, "***"),
        "masked_at": f"TIMESTAMP '{AS_OF}' AS masked_at",
        "masked_for_user": f"'{_address(user)}' AS masked_for_user",
    }
    shown = ", ".join(masked.get(c, c) for c in GOLD_COLUMNS) + (
        ", access_level AS applied_access_level" if show_level else ""
    )
    where = f" WHERE ({_SPANS['__END_AT']}) IS NULL" if current else ""
    return (
        f"WITH crm_customers AS ({fixture_sql('crm_customers')}), pii_grants AS ({fixture_sql('pii_grants')})\n"
        f"SELECT {shown} FROM (SELECT *, {_level_sql(user)} AS access_level FROM ({silver_sql('crm_customers')}) AS s"
        f"{where}) AS l"
    )


def _projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_with_history(spark, sf_dir)
    stamped = stamp(silver, masked_at=_as_of(), masked_for_user=F.lit("reader"))
    return stamped.select(*GOLD_COLUMNS)


_PLAIN_GOLD = ", ".join(
    {"masked_at": f"TIMESTAMP '{AS_OF}' AS masked_at", "masked_for_user": "'reader' AS masked_for_user"}.get(c, c)
    for c in GOLD_COLUMNS
)


def _stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "crm_customers").select("customer_id", "status")
    given = stamp(
        rows, silver_processed_ts=_as_of(), masked_for_user=F.lit("reader"), applied_access_level=F.lit("masked_only")
    )
    clock = stamp(given, test_timestamp=None)
    return clock.withColumn("test_timestamp", F.col("test_timestamp").isNotNull())


QUERIES = {
    "filter_active_grants": Query(_active, _ACTIVE_SQL),
    "grants_expiry": Query(
        _expiry(False),
        over(
            "pii_grants",
            f"SELECT user_email, access_level, granted_at, expires_at, is_active, {_LIVE} AS live FROM pii_grants",
        ),
    ),
    "grants_expiry_respect_granted": Query(
        _expiry(True),
        over(
            "pii_grants",
            f"SELECT user_email, access_level, granted_at, expires_at, is_active,"
            f" {_LIVE} AND granted_at <= TIMESTAMP '{AS_OF}' AS live FROM pii_grants",
        ),
    ),
    "grants_seed": Query(_seeded, _SEED_SQL.replace("s.* FROM", "s.* EXCLUDE (g) FROM")),
    "grants_resolve": Query(
        _resolved,
        over(
            "pii_grants",
            f"SELECT user_email, {_NAME.format(f'max(CASE WHEN {_LIVE} THEN {_RANK} END)')} AS access_level"
            " FROM pii_grants GROUP BY user_email",
        ),
    ),
    "grants_resolve_users": Query(
        _resolved_users,
        over(
            "pii_grants", "SELECT c_custkey, " + ", ".join(f"{_level_sql(u)} AS as_{u}" for u in USERS) + " FROM customer"
        ),
    ),
    "limit_one": Query(
        _one_each,
        over(
            "pii_grants",
            f"""SELECT user_email, access_level, granted_by, granted_at, approval_ticket_id FROM pii_grants WHERE {_LIVE}
QUALIFY row_number() OVER (PARTITION BY user_email ORDER BY {_RANK} DESC, granted_at DESC,
 approval_ticket_id DESC NULLS LAST) = 1""",
        ),
    ),
    "set_union_all": Query(
        _with_defaults,
        over(
            "pii_grants",
            f"SELECT user_email, access_level FROM pii_grants WHERE {_LIVE}"
            " UNION ALL SELECT user_email, 'masked_only' FROM pii_grants",
        ),
    ),
    "join_access_cross": Query(_for_each_user(lambda level: level), _for_each_user_sql("{0}")),
    "join_access_no_grant": Query(
        _levelled("stranger"),
        over(
            "crm_customers",
            f"SELECT customer_id, {_level_sql('stranger')} AS access_level FROM crm_customers",
            "pii_grants",
        ),
    ),
    "join_access_union_default": Query(
        _for_each_user(lambda level: level, level_with_default), _for_each_user_sql("{0}")
    ),
    "exists_access": Query(
        _for_each_user(lambda level: masks.mask_ssn(F.col("ssn"), level, strict=False)),
        _for_each_user_sql(
            f"CASE {{0}} WHEN 'full_access' THEN ssn WHEN 'partial_access' THEN {_SSN_LITERAL} ELSE '***' END"
        ),
    ),
    "cte": Query(
        _for_each_user(lambda level: masks.by_level(level, F.col("status"), F.col("status").substr(1, 1), "***")),
        _for_each_user_sql(
            "CASE {0} WHEN 'full_access' THEN status WHEN 'partial_access' THEN substr(status, 1, 1) ELSE '***' END"
        ),
    ),
    "mask_email": _mask_query("email", masks.mask_email, _EMAIL, "***@***"),
    "mask_email_literal": _mask_query(
        "email", lambda c, level: masks.mask_email(c, level, strict=False), _EMAIL_LITERAL, "***@***"
    ),
    "mask_phone": _mask_query("phone", masks.mask_phone, _PHONE, "***"),
    "mask_phone_literal": _mask_query(
        "phone", lambda c, level: masks.mask_phone(c, level, strict=False), _PHONE_LITERAL, "***"
    ),
    "mask_nric": _mask_query("nric", masks.mask_nric, _NRIC, "***"),
    "mask_nric_literal": _mask_query(
        "nric", lambda c, level: masks.mask_nric(c, level, strict=False), _NRIC_LITERAL, "***"
    ),
    "mask_ssn": _mask_query("ssn", masks.mask_ssn, _SSN, "***"),
    "mask_ssn_literal": _mask_query("ssn", lambda c, level: masks.mask_ssn(c, level, strict=False), _SSN_LITERAL, "***"),
    "mask_address": _mask_query("address", masks.mask_address, _ADDRESS, "***"),
    "mask_address_postal": _mask_query(
        "address", lambda c, level: masks.mask_address(c, level, F.col("postal_code")), _ADDRESS_POSTAL, "***"
    ),
    "mask_all": Query(
        _all_masked,
        over(
            "crm_customers",
            "SELECT customer_id, "
            + ", ".join(
                [
                    _masked_sql("email", _EMAIL, "***@***"),
                    _masked_sql("phone", _PHONE, "***"),
                    _masked_sql("nric", _NRIC, "***"),
                    _masked_sql("address", _ADDRESS, "***"),
                    _masked_sql("ssn", _SSN, "***"),
                ]
            )
            + f", access_level FROM (SELECT *, {_ROW_LEVEL} AS access_level"
            + f" FROM ({silver_sql('crm_customers')}) AS s) AS l",
        ),
    ),
    "mask_policy": Query(
        _policy_masked,
        over(
            "crm_customers",
            "SELECT customer_id, "
            + ", ".join(
                [
                    _masked_sql("email", _EMAIL, "***@***"),
                    _masked_sql("phone", _PHONE, "***"),
                    _masked_sql("nric", _NRIC, "***"),
                    _masked_sql("address", _ADDRESS_POSTAL, "***"),
                ]
            )
            + f", ssn, postal_code FROM (SELECT *, {_ROW_LEVEL} AS access_level"
            + f" FROM ({silver_sql('crm_customers')}) AS s) AS l",
        ),
    ),
    "mask_tags": Query(
        _tag_masked,
        over(
            "crm_customers",
            "SELECT customer_id, email AS reach, phone AS tel, nric, address AS home, ssn, postal_code AS zip FROM"
            " (SELECT customer_id, postal_code, "
            + ", ".join(
                [
                    _masked_sql("email", _EMAIL, "***@***"),
                    _masked_sql("phone", _PHONE, "***"),
                    _masked_sql("nric", _NRIC, "***"),
                    _masked_sql("address", _ADDRESS_POSTAL, "***"),
                    _masked_sql("ssn", _SSN, "***"),
                ]
            )
            + f" FROM (SELECT *, {_ROW_LEVEL} AS access_level FROM ({silver_sql('crm_customers')}) AS s) AS l) AS m"
            " WHERE customer_id > 0",
        ),
    ),
    "grants_timeline": Query(_timeline("pii_grants"), _timeline_sql("pii_grants")),
    "grants_timeline_hot_user": Query(
        _timeline("order_grants", SkewPolicy(hot_rows=100, range_rows=2000)), _timeline_sql("order_grants")
    ),
    "mask_sql_readers": Query(_sql_readers, _sql_readers_sql()),
    "mask_sql_row_readers": Query(_sql_row_readers, _sql_row_readers_sql()),
    "mask_sql_functions": Query(_sql_masked("scientist"), _sql_masked_sql("scientist")),
    "mask_sql_functions_full": Query(_sql_masked("governance"), _sql_masked_sql("governance")),
    "mask_sql_functions_masked": Query(_sql_masked("expired"), _sql_masked_sql("expired")),
    "proj_gold": Query(_projected, over("crm_customers", f"SELECT {_PLAIN_GOLD} FROM ({silver_sql('crm_customers')}) AS s")),
    "meta_stamp": Query(
        _stamped,
        over(
            "crm_customers",
            f"SELECT customer_id, status, TIMESTAMP '{AS_OF}' AS silver_processed_ts, 'reader' AS masked_for_user,"
            " 'masked_only' AS applied_access_level, true AS test_timestamp FROM crm_customers",
        ),
    ),
    "mask_gold": Query(_gold("scientist"), _gold_sql("scientist")),
    "mask_gold_full": Query(_gold("governance"), _gold_sql("governance")),
    "mask_gold_stranger": Query(_gold("stranger"), _gold_sql("stranger")),
    "mask_gold_expired": Query(_gold("expired"), _gold_sql("expired")),
    "mask_gold_current": Query(_gold("scientist", versions="current"), _gold_sql("scientist", current=True)),
    "mask_gold_literal": Query(
        _gold("scientist", strict=False),
        _gold_sql("scientist", email=_EMAIL_LITERAL, phone=_PHONE_LITERAL, nric=_NRIC_LITERAL),
    ),
    "mask_gold_view": Query(
        _gold_view("scientist"), _gold_sql("scientist", address=_ADDRESS_POSTAL, show_level=True)
    ),
    "mask_gold_view_edge": Query(_gold_view("edge"), _gold_sql("edge", address=_ADDRESS_POSTAL, show_level=True)),
}
