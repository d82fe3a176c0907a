"""SCD Type 2: change rows to versions ``[__START_AT, __END_AT)`` per key.

Semantics, for keys K and sequence S:

* rows with a NULL key or sequence are rejects (:func:`rejected_changes`);
* of rows with equal (K, S) the one greatest by the tie-break counts;
* a delete ends the open version and resets the key;
* with ``ignore_null`` a NULL keeps the value last seen since the last delete;
* a row opens a version if it is the first since a delete, or if any tracked
  column differs from the row before; otherwise it updates the version in place.

The build is a chain of running windows over one ordering, (K by S): fill, look
back, look ahead. A version's start is the latest opening so far, its end is the
sequence of the row after its last one. One ordering means one exchange and one
sort for the whole build.

A key with more rows than a task should take is cut into ranges of S. The
windows then run inside each range, and a summary of one row per range carries
what has to cross a border, so no key is ever held by one task.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lustra.operators.silver import SilverSpec, build_silver
from lustra.operators.skew import SkewPolicy, hot_keys
from lustra.sources.workspace import ensure_checkpoints

START, END = "__START_AT", "__END_AT"

# Working columns of callers that continue a history: on input SEED and WATCH,
# on output the others.
SEED = "__seed_start"
WATCH = "__watch"
DELETED = "__deleted"
LAST = "__last"
CLOSED = "__closed"
MARK = "__mark"

# Working columns of this module.
_RANGE = "__range"
_CARRY = "__carry"
_BORDER = "__border"
_OPENS = "__opens"
_NEXT = "__next"


@dataclass(frozen=True)
class HistorySpec:
    """What to keep history of.

    ``track`` or ``track_except`` choose the columns whose change opens a
    version; with neither, all but keys, sequence and transient ones do.
    ``transient`` columns serve ordering and deletes but are not stored.
    ``lenient`` drops tracked names the data lacks, with a warning, but raises if none is left.
    """

    target: str
    source: str
    keys: tuple[str, ...]
    sequence_by: str
    track: tuple[str, ...] | None = None
    track_except: tuple[str, ...] | None = None
    ignore_null: bool = True
    deletes: str | None = None
    tie_break: tuple[str, ...] = ()
    transient: tuple[str, ...] = ()
    lenient: bool = False

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("history needs at least one key column")
        if self.track is not None and self.track_except is not None:
            raise ValueError("give track or track_except, not both")

    def stored(self, columns: list[str]) -> list[str]:
        """Non-key columns of a history row."""
        return [c for c in columns if c not in self.keys and c not in self.transient]

    def tracked(self, columns: list[str]) -> list[str]:
        named = self.track if self.track is not None else self.track_except
        unknown = [c for c in (*self.keys, self.sequence_by, *(named or ())) if c not in columns]
        if unknown and not (self.lenient and set(unknown) <= set(named or ())):
            raise ValueError(f"{self.target}: no such columns: {', '.join(unknown)}")
        if self.track is not None:
            found = [c for c in self.track if c in columns]
            if not found:
                raise ValueError(f"{self.target}: none of the tracked columns is there: {', '.join(self.track)}")
            if unknown:
                warnings.warn(f"{self.target}: not there, so not tracked: {', '.join(unknown)}", stacklevel=2)
            return found
        skipped = {self.sequence_by, *(self.track_except or ())}
        return [c for c in self.stored(columns) if c not in skipped]

    def tie_order(self, columns: list[str]) -> list[str]:
        """The tie-break, made total by all remaining columns."""
        rest = [c for c in columns if c not in (*self.keys, self.sequence_by, *self.tie_break)]
        return [*self.tie_break, *rest]


# --- presets ---------------------------------------------------------------

# Customer bookkeeping columns that open no version.
CUSTOMER_UNTRACKED = (
    "ingested_file",
    "ingestion_ts",
    "silver_processed_ts",
    "data_quality_flags",
    "quality_score",
    "is_valid_postal_code",
)
# What the narrow transaction and product presets track.
TRANSACTION_TRACKED = ("status", "amount", "updated_at")
PRODUCT_TRACKED = ("price", "cost", "availability", "status")


def history_of(
    table: str,
    keys: tuple[str, ...] | list[str],
    sequence_by: str = "updated_at",
    **options: Any,
) -> HistorySpec:
    """A spec with the conventional names ``<table>_silver`` and ``<table>_silver_source``."""
    return HistorySpec(
        target=f"{table}_silver",
        source=f"{table}_silver_source",
        keys=tuple(keys),
        sequence_by=sequence_by,
        **options,
    )


def customer_history(
    table: str = "customers",
    keys: tuple[str, ...] = ("customer_id",),
    sequence_by: str = "silver_processed_ts",
    track_all: bool = False,
) -> HistorySpec:
    skipped = None if track_all else CUSTOMER_UNTRACKED
    return history_of(table, keys, sequence_by, track_except=skipped, lenient=True)


def transaction_history(
    table: str = "transactions",
    keys: tuple[str, ...] = ("transaction_id",),
    sequence_by: str = "transaction_ts",
    status_only: bool = False,
) -> HistorySpec:
    return history_of(table, keys, sequence_by, track=TRANSACTION_TRACKED if status_only else None, lenient=True)


def product_history(
    table: str = "products",
    keys: tuple[str, ...] = ("product_id",),
    sequence_by: str = "updated_at",
    price_changes: bool = True,
) -> HistorySpec:
    return history_of(table, keys, sequence_by, track=PRODUCT_TRACKED if price_changes else None, lenient=True)


# --- build -----------------------------------------------------------------


def identified(spec: HistorySpec) -> Column:
    """Condition for a change row that can be placed: keys and sequence are known."""
    whole = F.col(spec.sequence_by).isNotNull()
    for key in spec.keys:
        whole = whole & F.col(key).isNotNull()
    return whole


def rejected_changes(changes: DataFrame, spec: HistorySpec) -> DataFrame:
    """Change rows that cannot be placed: a key or the sequence is NULL."""
    return changes.filter(~identified(spec))


def build_history(
    changes: DataFrame,
    spec: HistorySpec,
    skew: SkewPolicy | None = SkewPolicy(),
) -> DataFrame:
    """All versions of all keys.

    With a skew policy one sketching job over the key columns runs first (:mod:`skew`);
    ``skew=None`` skips it where keys are known to be bounded.
    """
    columns = changes.columns
    rows = walk_changes(changes, spec, skew)
    return rows.filter(~F.col(DELETED)).select(*spec.keys, *spec.stored(columns), START, END)


def mark_deletes(changes: DataFrame, spec: HistorySpec) -> DataFrame:
    """Add ``__deleted`` from the spec's predicate, unless the rows carry it already."""
    if DELETED in changes.columns:
        return changes
    gone = F.coalesce(F.expr(spec.deletes), F.lit(False)) if spec.deletes else F.lit(False)
    return changes.withColumn(DELETED, gone)


def walk_changes(
    changes: DataFrame,
    spec: HistorySpec,
    skew: SkewPolicy | None = SkewPolicy(),
    counts: DataFrame | None = None,
) -> DataFrame:
    """The last row of every version and of every key, deletes included.

    Adds ``__START_AT``, ``__END_AT`` and ``__deleted``, and says of each row
    whether it is the key's ``__last``, whether a version is ``__closed`` with it,
    and whether it is a ``__mark``: the row before the sequence value that the
    input names in ``__watch``. An input column ``__seed_start`` tells rows that
    resume a version begun earlier. Rows per key, if the caller has them (as
    column ``n``), spare a counting pass.
    """
    job = _Walk.over(changes, spec)
    rows = mark_deletes(changes.filter(identified(spec)), spec)
    hot, hot_rows = hot_keys(rows, spec.keys, skew, counts) if skew else (None, 0)
    if hot is None:
        return job.plain(rows)
    keys = list(spec.keys)
    few = F.broadcast(hot)
    cold = job.plain(rows.join(few, keys, "left_anti"))
    ranges = math.ceil(hot_rows / skew.range_rows) + 1
    return cold.unionByName(job.ranged(rows.join(few, keys, "left_semi"), ranges))


@dataclass(frozen=True)
class _Walk:
    """The window chain, over whole keys or over ranges of hot keys."""

    spec: HistorySpec
    columns: tuple[str, ...]
    tracked: tuple[str, ...]
    filled: tuple[str, ...]
    tie_order: tuple[str, ...]
    seeded: bool

    @classmethod
    def over(cls, changes: DataFrame, spec: HistorySpec) -> _Walk:
        columns = [c for c in changes.columns if c not in (SEED, WATCH, DELETED)]
        stored = spec.stored(columns)
        return cls(
            spec=spec,
            columns=tuple(columns),
            tracked=tuple(spec.tracked(columns)),
            filled=tuple(c for c in stored if c != spec.sequence_by) if spec.ignore_null else (),
            tie_order=tuple(spec.tie_order(columns)),
            seeded=SEED in changes.columns,
        )

    # Whole keys: one exchange on the keys, one sort on (keys, sequence, tie-break).

    def plain(self, rows: DataFrame) -> DataFrame:
        by = list(self.spec.keys)
        return self._close(self._open(self._fill(self._settle_ties(rows, by), by), by), by)

    def _settle_ties(self, rows: DataFrame, by: list[str]) -> DataFrame:
        """Keep the greatest of rows with equal sequence: the one followed by another sequence."""
        seq = F.col(self.spec.sequence_by)
        tie = [F.col(c).asc_nulls_first() for c in self.tie_order]
        following = F.lead(seq).over(Window.partitionBy(*by).orderBy(seq, *tie))
        return (
            rows.withColumn(_NEXT, following).filter(F.col(_NEXT).isNull() | (F.col(_NEXT) != seq)).drop(_NEXT)
        )

    # Ranges of hot keys. Ties are settled by a combining aggregate, since a
    # single (key, sequence) may itself be hot.

    def ranged(self, rows: DataFrame, ranges: int) -> DataFrame:
        spec, by = self.spec, [*self.spec.keys, _RANGE]
        identity = [*spec.keys, spec.sequence_by]
        rest = [c for c in rows.columns if c not in identity]
        rank = F.struct(*(F.col(c) for c in self.tie_order), F.lit(0).alias("_"))
        settled = rows.groupBy(*identity).agg(F.max_by(F.struct(*rest), rank).alias("_row")).select(*identity, "_row.*")
        ensure_checkpoints(rows.sparkSession)
        # The checkpoint pins which range a row is in, so that every later use
        # of these rows, and any recomputation, sees the same borders.
        cut = (
            settled.repartitionByRange(ranges, *identity)
            .withColumn(_RANGE, F.spark_partition_id())
            .checkpoint()
        )
        carried = cut.join(self._carry_in(cut), by)
        opened = self._open(self._fill(carried, by), by)
        return self._close(opened.join(self._border(opened), by), by)

    def _carry_in(self, cut: DataFrame) -> DataFrame:
        """Per range: the key's state as the ranges before it leave it."""
        spec, seq = self.spec, F.col(self.spec.sequence_by)
        keys = list(spec.keys)
        by_range = Window.partitionBy(*keys).orderBy(_RANGE)
        before = by_range.rowsBetween(Window.unboundedPreceding, -1)
        ends, states = [], []
        for c in self.filled:
            seen = self._seen(c)
            ends.append(F.max_by(seen, F.when(seen.isNotNull(), seq)).alias(c))
            states.append(F.last(c, ignorenulls=True).over(before).alias(c))
        for c in (*(c for c in self.tracked if c not in self.filled), DELETED):
            ends.append(F.max_by(c, seq).alias(c))
            states.append(F.lag(c).over(by_range).alias(c))
        summary = cut.groupBy(*keys, _RANGE).agg(*ends)
        return summary.select(*keys, _RANGE, F.struct(*states).alias(_CARRY))

    def _border(self, opened: DataFrame) -> DataFrame:
        """Per range: the first row after it and the opening in force before it."""
        seq, keys = F.col(self.spec.sequence_by), list(self.spec.keys)
        ends = opened.groupBy(*keys, _RANGE).agg(
            F.min_by(self._step(), seq).alias("first"), F.max(self._opening()).alias("opening")
        )
        by_range = Window.partitionBy(*keys).orderBy(_RANGE)
        border = F.struct(
            F.lead("first").over(by_range).alias("next"),
            F.last("opening", ignorenulls=True)
            .over(by_range.rowsBetween(Window.unboundedPreceding, -1))
            .alias("opening"),
        )
        return ends.select(*keys, _RANGE, border.alias(_BORDER))

    # The chain itself.

    def _order(self, by: list[str]) -> WindowSpec:
        return Window.partitionBy(*by).orderBy(self.spec.sequence_by)

    def _so_far(self, by: list[str]) -> WindowSpec:
        return self._order(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def _seen(self, name: str) -> Column:
        """A column as the running fill reads it: NULL means "nothing new".

        With deletes the value is boxed, so that a delete can say "known to be
        NULL again" and the fill never reaches across it.
        """
        if not self.spec.deletes:
            return F.col(name)
        box = F.struct(F.when(~F.col(DELETED), F.col(name)).alias("v"))
        return F.when(F.col(DELETED) | F.col(name).isNotNull(), box)

    def _fill(self, rows: DataFrame, by: list[str]) -> DataFrame:
        if not self.filled:
            return rows
        carried = _CARRY in rows.columns

        def latest(name: str) -> Column:
            seen = F.last(self._seen(name), ignorenulls=True).over(self._so_far(by))
            if carried:
                seen = F.coalesce(seen, F.col(f"{_CARRY}.{name}"))
            return seen["v"] if self.spec.deletes else seen

        return rows.withColumns({name: latest(name) for name in self.filled})

    def _state(self, name_of: Any = F.col) -> Column:
        return F.struct(*(name_of(c).alias(f"t{i}") for i, c in enumerate(self.tracked)), F.lit(0).alias("_"))

    def _open(self, rows: DataFrame, by: list[str]) -> DataFrame:
        """Mark the rows that begin a version."""
        previous = F.lag(F.struct(F.col(DELETED).alias("gone"), self._state().alias("state"))).over(self._order(by))
        if _CARRY in rows.columns:
            boxed = self.filled if self.spec.deletes else ()
            carried = self._state(lambda c: F.col(f"{_CARRY}.{c}.v" if c in boxed else f"{_CARRY}.{c}"))
            gone = F.col(f"{_CARRY}.{DELETED}")
            previous = F.coalesce(
                previous, F.when(gone.isNotNull(), F.struct(gone.alias("gone"), carried.alias("state")))
            )
        looked = rows.withColumn("__prev", previous)
        fresh = F.col("__prev").isNull() | F.col("__prev.gone") | ~F.col("__prev.state").eqNullSafe(self._state())
        return looked.withColumn(_OPENS, ~F.col(DELETED) & fresh).drop("__prev", _CARRY)

    def _step(self) -> Column:
        """What a row means to the version before it."""
        return F.struct(
            F.col(self.spec.sequence_by).alias("at"), (F.col(_OPENS) | F.col(DELETED)).alias("ends_previous")
        )

    def _opening(self) -> Column:
        start = F.col(self.spec.sequence_by)
        if self.seeded:
            start = F.coalesce(F.col(SEED), start)
        return F.when(F.col(_OPENS), start)

    def _close(self, rows: DataFrame, by: list[str]) -> DataFrame:
        """Keep each version's last row and give it its start and end."""
        following = F.lead(self._step()).over(self._order(by))
        start = F.last(self._opening(), ignorenulls=True).over(self._so_far(by))
        if _BORDER in rows.columns:
            following = F.coalesce(following, F.col(f"{_BORDER}.next"))
            start = F.coalesce(start, F.col(f"{_BORDER}.opening"))
        seen = rows.withColumns({_NEXT: following, START: start})
        no, end = F.lit(False), F.col(f"{_NEXT}.at")
        told = seen.withColumns(
            {
                LAST: F.col(_NEXT).isNull(),
                CLOSED: F.coalesce(~F.col(DELETED) & F.col(f"{_NEXT}.ends_previous"), no),
                MARK: F.coalesce(end == F.col(WATCH), no) if WATCH in rows.columns else no,
            }
        )
        kept = told.filter(F.col(LAST) | F.col(CLOSED) | F.col(MARK))
        return kept.select(*self.columns, START, end.alias(END), DELETED, LAST, CLOSED, MARK)


def history_schema(changes: T.StructType, spec: HistorySpec) -> T.StructType:
    """Columns of the history that change rows of a schema produce."""
    at = changes[spec.sequence_by].dataType
    named = [changes[name] for name in (*spec.keys, *spec.stored(changes.names))]
    return T.StructType(named).add(START, at).add(END, at)


def history_with_quality(
    changes: DataFrame,
    spec: HistorySpec,
    silver: SilverSpec | None = None,
    view_name: str | None = None,
) -> DataFrame:
    """Clean and score change rows, publish them as a view, and build their history.

    The view is named ``<target>_with_quality`` unless told otherwise; without a
    silver spec the changes are used as they are and no view is made.
    """
    if silver is None:
        return build_history(changes, spec)
    checked = build_silver(changes, silver)
    checked.createOrReplaceTempView(view_name or f"{spec.target}_with_quality")
    return build_history(checked, spec)


# --- reading ---------------------------------------------------------------


def current_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END).isNull())


def versions_as_of(history: DataFrame, when: Any) -> DataFrame:
    """The version of each key valid at a point of the sequence."""
    at = (when if isinstance(when, Column) else F.lit(when)).cast(history.schema[START].dataType)
    return history.filter((F.col(START) <= at) & (F.col(END).isNull() | (F.col(END) > at)))


def key_history(history: DataFrame, key: Mapping[str, Any]) -> DataFrame:
    """All versions of one key, oldest first."""
    wanted = F.lit(True)
    for name, value in key.items():
        wanted = wanted & (F.col(name) == value)
    return history.filter(wanted).orderBy(START)


def by_start(history: DataFrame, spec: HistorySpec) -> DataFrame:
    """All versions in order of their start.

    Keys break ties, so that a start shared by very many versions (a bulk load)
    still sorts in more than one task.
    """
    return history.orderBy(START, *spec.keys)
