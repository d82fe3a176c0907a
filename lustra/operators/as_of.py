"""Facts joined to the version of their key in force at each fact's own time.

No inequality join: facts and versions are laid into one sequence (keys, time, versions
before facts of the same time) and the latest version is carried forward along it. That is
one exchange and one sort, whatever the number of versions a key has. Keys with very many
facts or versions are cut into ranges of the sequence; a summary of one row per range says
which version is in force where a range begins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lustra.operators.history import END, START
from lustra.operators.skew import SkewPolicy, hot_keys
from lustra.sources.workspace import ensure_checkpoints

_AT, _KIND, _VERSION, _FACT, _RANGE, _IN_FORCE = "__at", "__kind", "__version", "__fact", "__range", "__in_force"


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    prefix: str = "",
    skew: SkewPolicy | None = SkewPolicy(),
) -> DataFrame:
    """Every fact with the version of its key for which ``start <= at < end``, or NULLs if there is none.

    ``keys`` and the time ``at`` are columns of the facts, keys also of the history; the
    history's other columns are added under ``prefix`` and must not clash. Facts that
    repeat are all kept; those with a NULL key or time have no version. A key's versions
    must not overlap, as those of a built history don't. ``skew=None`` skips the search
    for hot keys.
    """
    keys = list(keys)
    added = {c: prefix + c for c in history.columns if c not in keys}
    clash = sorted(set(added.values()) & set(facts.columns))
    if clash:
        raise ValueError(f"columns of facts and history clash: {', '.join(clash)}")
    placed = F.col(at).isNotNull()
    for key in keys:
        placed = placed & F.col(key).isNotNull()
    when = history.schema[START].dataType
    version = F.struct(*(F.col(c) for c in added))
    fact = F.struct(*(F.col(c) for c in facts.columns))
    rows = facts.filter(placed).select(
        *keys, F.col(at).cast(when).alias(_AT), F.lit(1).alias(_KIND), fact.alias(_FACT)
    )
    starts = history.select(*keys, F.col(START).alias(_AT), F.lit(0).alias(_KIND), version.alias(_VERSION))
    known = F.col(START).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    rows = rows.unionByName(starts.filter(known), allowMissingColumns=True)

    hot, n_hot = hot_keys(rows, keys, skew) if skew else (None, 0)
    if hot is None:
        seen = _plain(rows, keys)
    else:
        few = F.broadcast(hot)
        ranges = math.ceil(n_hot / skew.range_rows) + 1
        seen = _plain(rows.join(few, keys, "left_anti"), keys).unionByName(
            _ranged(rows.join(few, keys, "left_semi"), keys, ranges)
        )
    ended = F.col(f"{_IN_FORCE}.{END}") <= F.col(_AT)
    valid = F.when(~F.coalesce(ended, F.lit(False)), F.col(_IN_FORCE))
    joined = seen.filter(F.col(_KIND) == 1).select(f"{_FACT}.*", valid.alias(_IN_FORCE))
    shown = [*facts.columns, *(F.col(f"{_IN_FORCE}.{c}").alias(name) for c, name in added.items())]
    nothing = [F.lit(None).cast(history.schema[c].dataType).alias(name) for c, name in added.items()]
    return joined.select(*shown).unionByName(facts.filter(~placed).select("*", *nothing))


def _latest(by: list[str]) -> Column:
    order = Window.partitionBy(*by).orderBy(_AT, _KIND).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(_VERSION, ignorenulls=True).over(order)


def _plain(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select("*", _latest(keys).alias(_IN_FORCE)).drop(_VERSION)


def _ranged(rows: DataFrame, keys: list[str], ranges: int) -> DataFrame:
    """Hot keys: the checkpoint pins which range a row is in, so all uses see the same borders."""
    ensure_checkpoints(rows.sparkSession)
    # Facts of one key and time may themselves be too many for a task; their hash cuts these.
    cut = rows.repartitionByRange(ranges, *keys, _AT, _KIND, F.xxhash64(_FACT))
    cut = cut.withColumn(_RANGE, F.spark_partition_id()).checkpoint()
    last = cut.filter(F.col(_KIND) == 0).groupBy(*keys, _RANGE).agg(F.max_by(_VERSION, _AT).alias("last"))
    # Ranges without versions pass on what is in force before them.
    present = cut.select(*keys, _RANGE).distinct().join(last, [*keys, _RANGE], "left")
    before = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = present.select(*keys, _RANGE, F.last("last", ignorenulls=True).over(before).alias("carried"))
    seen = cut.join(F.broadcast(carried), [*keys, _RANGE]).withColumn(_IN_FORCE, _latest([*keys, _RANGE]))
    return seen.withColumn(_IN_FORCE, F.coalesce(_IN_FORCE, "carried")).drop(_VERSION, "carried", _RANGE)
