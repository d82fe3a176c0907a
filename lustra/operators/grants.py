"""Access grants: who may see how much, and until when.

Levels resolve by precedence (full over partial over masked), so the outcome
does not depend on row order, and a user without an active grant is masked.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lustra.functions.codes import ACCESS_LEVELS, DEFAULT_LEVEL

GRANT_SCHEMA = T.StructType(
    [
        T.StructField("user_email", T.StringType(), False),
        T.StructField("user_group", T.StringType(), False),
        T.StructField("access_level", T.StringType(), False),
        T.StructField("granted_by", T.StringType(), False),
        T.StructField("granted_at", T.TimestampType(), False),
        T.StructField("expires_at", T.TimestampType(), True),
        T.StructField("is_active", T.BooleanType(), False),
        T.StructField("reason", T.StringType(), True),
        T.StructField("approval_ticket_id", T.StringType(), True),
    ]
)

# The initial grants as user, group, level.
SEED_GRANTS = (
    ("analyst@company.com", "analyst", "masked_only"),
    ("scientist@company.com", "scientist", "partial_access"),
    ("governance@company.com", "governance_officer", "full_access"),
)


def seed_grants(spark: SparkSession, granted_at: datetime) -> DataFrame:
    """The default group grants: active, permanent, given by the system."""
    rows = [
        (user, group, level, "system", granted_at, None, True, "Default group access", None)
        for user, group, level in SEED_GRANTS
    ]
    return spark.createDataFrame(rows, GRANT_SCHEMA)


def _now(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def in_force(as_of: Column | None = None, respect_granted_at: bool = False) -> Column:
    """Condition for a grant that is active and not expired (expiry is exclusive)."""
    now = _now(as_of)
    live = F.col("is_active") & (F.col("expires_at").isNull() | (F.col("expires_at") > now))
    return live & (F.col("granted_at") <= now) if respect_granted_at else live


def active_grants(
    grants: DataFrame,
    user: Column | None = None,
    as_of: Column | None = None,
    respect_granted_at: bool = False,
) -> DataFrame:
    """The grants of one user (the current one by default) in force at a time."""
    who = F.current_user() if user is None else user
    return grants.filter((F.col("user_email") == who) & in_force(as_of, respect_granted_at))


def _rank(level: Column) -> Column:
    """Precedence of a level; unknown levels count as masked."""
    rank = F.lit(0)
    for i, name in enumerate(ACCESS_LEVELS):
        rank = F.when(level == name, i).otherwise(rank)
    return rank


def _strongest(level: Column) -> Column:
    """Aggregate: the highest level by precedence."""
    names = F.array(*(F.lit(name) for name in ACCESS_LEVELS))
    return F.coalesce(F.get(names, F.max(_rank(level))), F.lit(DEFAULT_LEVEL))


def resolve_level(
    grants: DataFrame,
    user: Column | None = None,
    as_of: Column | None = None,
    respect_granted_at: bool = False,
) -> DataFrame:
    """Exactly one row with one user's ``access_level``."""
    mine = active_grants(grants, user, as_of, respect_granted_at)
    return mine.agg(_strongest(F.col("access_level")).alias("access_level"))


def level_of(grants: DataFrame, user: Column | None = None, as_of: Column | None = None) -> Column:
    """One user's level as a scalar subquery: resolved once, then a constant per row."""
    return resolve_level(grants, user, as_of).scalar()


def level_with_default(
    grants: DataFrame, user: Column | None = None, as_of: Column | None = None, default: str = DEFAULT_LEVEL
) -> Column:
    """One user's level where everyone also holds a default: the strongest of grants and default."""
    mine = active_grants(grants, user, as_of).select("access_level")
    floor = grants.sparkSession.range(1).select(F.lit(default).alias("access_level"))
    return mine.unionByName(floor).agg(_strongest(F.col("access_level")).alias("access_level")).scalar()


def resolve_all_levels(grants: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The level of every user that appears in the grants."""
    level = F.when(in_force(as_of), F.col("access_level"))
    return grants.groupBy("user_email").agg(_strongest(level).alias("access_level"))


def strongest_grants(grants: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One grant in force per user: the strongest, of equals the latest.

    A combining aggregate, so a user with very many grants costs one row per task.
    """
    shown = ["access_level", "granted_by", "granted_at", "approval_ticket_id"]
    order = F.struct(_rank(F.col("access_level")).alias("rank"), "granted_at", "approval_ticket_id")
    best = grants.filter(in_force(as_of)).groupBy("user_email").agg(F.max_by(F.struct(*shown), order).alias("best"))
    return best.select("user_email", "best.*")
