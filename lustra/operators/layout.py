"""Histories stored so that a lookup reads the files it needs: a grid of eras and key slots.

Time is cut into eras with about equally many version starts. A version is stored in every
era it is in force in, so that all versions in force at some time lie in that time's
era, however long ago they began; one of the copies is marked as the first. Within an
era, keys are spread over slots by hash, and files are sorted by key and start::

    eras                             era, begins
    versions/era=E/slot=S/*.parquet  the versions, with is_first

* as of a time: the files of one era, 1 / eras of them;
* the history of a key: the files of one slot, 1 / slots of them;
* a key as of a time: one folder.

A version that lasts through n eras takes n rows. Key slots that outweigh others (one key
with very many versions) are split over several tasks and files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lustra.operators.history import END, START, key_history, versions_as_of

ERA, SLOT, FIRST = "era", "slot", "is_first"


@dataclass(frozen=True)
class HistoryLayout:
    """A stored history of one table. ``eras`` and ``slots`` together bound the number of folders."""

    root: str
    keys: tuple[str, ...]
    eras: int = 8
    slots: int = 32

    def __post_init__(self) -> None:
        if self.eras < 1 or self.slots < 1 or not self.keys:
            raise ValueError("a layout needs a key, an era and a slot at least")

    # --- writing -----------------------------------------------------------

    def write(self, history: DataFrame) -> None:
        """Store a whole history; the folder must not hold one yet.

        Two passes over it: quantiles of the starts, which combine before their shuffle,
        and one shuffle by era and slot. Versions without a start belong to no era and
        are refused.
        """
        taken = sorted({ERA, SLOT, FIRST} & set(history.columns))
        if taken:
            raise ValueError(f"columns with reserved names: {', '.join(taken)}")
        bad = F.raise_error(F.lit("a version without a start")).cast("boolean")
        history = history.filter(F.when(F.col(START).isNull(), bad).otherwise(True))
        borders = self._borders(history)
        kind = history.schema[START].dataType
        rows = [(i + 1, b) for i, b in enumerate(borders)]
        eras = history.sparkSession.createDataFrame(rows, f"{ERA} int, begins string").coalesce(1)
        eras.select(ERA, F.col("begins").cast(kind)).write.parquet(f"{self.root}/eras")
        begins = F.array(*(F.lit(b).cast(kind) for b in borders)) if borders else F.array().cast(f"array<{kind.simpleString()}>")
        first = F.size(F.filter(begins, lambda b: b <= F.col(START)))
        last = F.when(F.col(END).isNull(), F.size(begins)).otherwise(F.size(F.filter(begins, lambda b: b < F.col(END))))
        placed = history.withColumn("__first", first)
        placed = placed.withColumn(ERA, F.explode(F.sequence("__first", F.greatest("__first", last))))
        placed = placed.withColumn(FIRST, F.col(ERA) == F.col("__first")).drop("__first").withColumn(SLOT, self._slot())
        spread = placed.hint("rebalance", ERA, SLOT).sortWithinPartitions(ERA, SLOT, *self.keys, START)
        spread.write.partitionBy(ERA, SLOT).parquet(f"{self.root}/versions")

    def _borders(self, history: DataFrame) -> list[str]:
        """Where eras after the first begin: quantiles of the starts, as text."""
        shares = [i / self.eras for i in range(1, self.eras)]
        if not shares:
            return []
        found = history.agg(F.percentile_approx(START, shares, 10_000).alias("q"))
        borders = found.select(F.transform(F.array_distinct("q"), lambda b: b.cast("string"))).first()[0]
        return borders or []

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.slots)).cast("int")

    # --- reading -----------------------------------------------------------

    def _stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/versions")

    def _era_of(self, spark: SparkSession, when: Any) -> int:
        eras = spark.read.parquet(f"{self.root}/eras")
        at = (when if isinstance(when, Column) else F.lit(when)).cast(eras.schema["begins"].dataType)
        return eras.filter(F.col("begins") <= at).count()

    def _slot_of(self, stored: DataFrame, key: Mapping[str, Any]) -> int:
        if set(key) != set(self.keys):
            raise ValueError(f"give a value for each of {', '.join(self.keys)}")
        values = [F.lit(key[name]).cast(stored.schema[name].dataType).alias(name) for name in self.keys]
        return stored.sparkSession.range(1).select(*values).select(self._slot()).first()[0]

    def read(self, spark: SparkSession) -> DataFrame:
        """Every version once."""
        return self._stored(spark).filter(FIRST).drop(ERA, SLOT, FIRST)

    def as_of(self, spark: SparkSession, when: Any, key: Mapping[str, Any] | None = None) -> DataFrame:
        """Versions in force at a time, of all keys or of one."""
        stored = self._stored(spark)
        found = stored.filter(F.col(ERA) == self._era_of(spark, when))
        if key is not None:
            found = found.filter(F.col(SLOT) == self._slot_of(stored, key))
            for name, value in key.items():
                found = found.filter(F.col(name) == F.lit(value))
        return versions_as_of(found, when).drop(ERA, SLOT, FIRST)

    def key_history(self, spark: SparkSession, key: Mapping[str, Any]) -> DataFrame:
        """All versions of one key, oldest first."""
        stored = self._stored(spark)
        found = stored.filter((F.col(SLOT) == self._slot_of(stored, key)) & F.col(FIRST))
        return key_history(found, key).drop(ERA, SLOT, FIRST)
