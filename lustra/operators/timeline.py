"""What each user may see over time: the level that all of a user's grants give together, as a history.

A sweep over the starts and ends of grants. Each is a step up or down in the number of
grants of its level in force; the level is the highest one with any. Steps of a user at one time
are summed before they are shuffled, running sums give the numbers in force, and rows
where the level stays the same fall out. The result has the columns of a history, so its
lookups and as-of joins work on it: "what could this reader see when they read?"
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lustra.functions.codes import ACCESS_LEVELS, DEFAULT_LEVEL
from lustra.operators.history import END, START
from lustra.operators.skew import SkewPolicy, hot_keys
from lustra.sources.workspace import ensure_checkpoints

_USER, _AT, _RANGE = "user_email", "__at", "__range"
#: Levels above the default, which needs no grant.
_RAISED = ACCESS_LEVELS[1:]
_STEPS = [f"__step{i}" for i in range(len(_RAISED))] + ["__seen"]
_SUMS = [f"__sum{i}" for i in range(len(_STEPS))]


def access_timeline(grants: DataFrame, skew: SkewPolicy | None = SkewPolicy()) -> DataFrame:
    """``user_email``, ``access_level``, ``__START_AT``, ``__END_AT``: each user's level from the first grant on.

    Before their first grant, and without any, users have the default level. A grant
    counts from ``granted_at`` until before ``expires_at``. Inactive ones, ones without user or start,
    and ones that end before they begin never count. Unknown levels count as the default.
    Neighbouring rows of a user differ in level, the last has no end.
    """
    counts = F.col("is_active") & F.col(_USER).isNotNull() & F.col("granted_at").isNotNull()
    counts = counts & (F.col("expires_at").isNull() | (F.col("expires_at") > F.col("granted_at")))
    both = F.array(
        F.struct(F.col("granted_at").alias(_AT), F.lit(1).alias("by")),
        F.struct(F.col("expires_at").alias(_AT), F.lit(-1).alias("by")),
    )
    steps = grants.filter(counts).select(_USER, "access_level", F.inline(both)).filter(F.col(_AT).isNotNull())
    moved = [F.sum(F.when(F.col("access_level") == level, F.col("by")).otherwise(0)) for level in _RAISED]
    steps = steps.groupBy(_USER, _AT).agg(*(m.alias(s) for m, s in zip([*moved, F.lit(1).cast("long")], _STEPS)))

    hot, n_hot = hot_keys(steps, [_USER], skew) if skew else (None, 0)
    if hot is None:
        return _plain(steps)
    few = F.broadcast(hot)
    cold = _plain(steps.join(few, _USER, "left_anti"))
    return cold.unionByName(_ranged(steps.join(few, _USER, "left_semi"), math.ceil(n_hot / skew.range_rows) + 1))


def _level(number_of: list[Column]) -> Column:
    level = F.lit(DEFAULT_LEVEL)
    for name, number in zip(_RAISED, number_of):
        level = F.when(number > 0, name).otherwise(level)
    return level


def _changes(summed: DataFrame) -> DataFrame:
    """Steps that change the level, told from the sums with and without the step itself."""
    now = _level([F.col(s) for s in _SUMS])
    before = _level([F.col(total) - F.col(step) for total, step in zip(_SUMS, _STEPS)])
    kept = summed.withColumn("access_level", now).filter((F.col(_SUMS[-1]) == 1) | (now != before))
    return kept.withColumn(START, F.col(_AT)).drop(_AT, *_SUMS, *_STEPS)


def _running(by: list[str]) -> list[Column]:
    order = Window.partitionBy(*by).orderBy(_AT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return [F.sum(step).over(order).alias(total) for step, total in zip(_STEPS, _SUMS)]


def _plain(steps: DataFrame) -> DataFrame:
    changes = _changes(steps.select("*", *_running([_USER])))
    end = F.lead(START).over(Window.partitionBy(_USER).orderBy(START))
    return changes.select(_USER, "access_level", START, end.alias(END))


def _ranged(steps: DataFrame, ranges: int) -> DataFrame:
    """Users with very many grants, by ranges of time; one row per range carries sums forward and starts back."""
    ensure_checkpoints(steps.sparkSession)
    by = [_USER, _RANGE]
    cut = steps.repartitionByRange(ranges, _USER, _AT).withColumn(_RANGE, F.spark_partition_id()).checkpoint()
    in_order = Window.partitionBy(_USER).orderBy(_RANGE)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = cut.groupBy(*by).agg(*(F.sum(step).alias(step) for step in _STEPS))
    carried = [F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in _STEPS]
    summed = cut.select("*", *_running(by)).join(F.broadcast(whole.select(*by, *carried)), by)
    summed = summed.withColumns({t: F.col(t) + F.col(f"{s}_before") for t, s in zip(_SUMS, _STEPS)})
    changes = _changes(summed.drop(*(f"{s}_before" for s in _STEPS)))
    later = in_order.rowsBetween(1, Window.unboundedFollowing)
    firsts = changes.groupBy(*by).agg(F.min(START).alias("first"))
    ahead = whole.select(*by).join(firsts, by, "left").select(*by, F.min("first").over(later).alias("ahead"))
    end = F.lead(START).over(Window.partitionBy(*by).orderBy(START))
    told = changes.withColumn(END, end).join(F.broadcast(ahead), by)
    return told.select(_USER, "access_level", START, F.coalesce(END, "ahead").alias(END))
