"""Many small tables in few Spark jobs: packed side by side, written at once, read back one by one.

A job, a shuffle and a file or more for each of hundreds of small tables cost more than the
data. Here tables are put into packs by size. A pack is one frame: each row has its
table's name and one typed struct, that of its table's columns; tables of equal columns
share a struct. A pack is one plan and one write, partitioned by table name::

    pack folder/table=NAME/*.parquet      columns row0, row1, ... (all but one NULL)

A reader names the one struct column it needs, so only that is scanned. Tables whose
histories are built alike (same columns, same spec) are built together too, with the
table's name as first key: one exchange for all of them.

A table that can't be planned is left out of its pack. If a pack fails while it runs, it is
halved until the tables at fault are alone; the others are written.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lustra.operators.history import HistorySpec, SkewPolicy, build_history
from lustra.operators.silver import build_silver
from lustra.plans.many import TableJob, TablesFailed
from lustra.sources.workspace import fresh_folder

TABLE = "table"


@dataclass(frozen=True)
class PackedTable:
    """Where one table's rows are."""

    name: str
    folder: str
    column: str
    schema: T.StructType

    def read(self, spark: SparkSession) -> DataFrame:
        found = T.StructType([T.StructField(self.column, self.schema), T.StructField(TABLE, T.StringType())])
        rows = spark.read.schema(found).parquet(self.folder).filter(F.col(TABLE) == self.name)
        return rows.select(f"{self.column}.*")


@dataclass
class PackedRun:
    """What a run wrote, what failed, and how many writes it took."""

    tables: dict[str, PackedTable]
    failed: dict[str, Exception]
    writes: int = 0

    def raise_failed(self) -> None:
        if self.failed:
            raise TablesFailed(self.failed)


def packs_of(sizes: Mapping[str, int], packs: int, largest: int) -> list[list[str]]:
    """Tables dealt into at most ``packs`` packs of about equal size; one over ``largest`` bytes has its own.

    The largest tables are dealt first, each to the lightest pack.
    """
    alone = [[name] for name, size in sorted(sizes.items()) if size > largest]
    rest = sorted(((size, name) for name, size in sizes.items() if size <= largest), reverse=True)
    heap: list[tuple[int, int, list[str]]] = [(0, i, []) for i in range(min(packs, len(rest)))]
    for size, name in rest:
        weight, i, names = heapq.heappop(heap)
        names.append(name)
        heapq.heappush(heap, (weight + size, i, names))
    return alone + [names for _, _, names in sorted(heap, key=lambda x: x[1])]


def _size(df: DataFrame) -> int:
    """Spark's own estimate from files and statistics; nothing is read for it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _shape(schema: T.StructType) -> str:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema]).json()


def write_packed(
    spark: SparkSession, frames: Mapping[str, DataFrame], packs: int = 4, largest: int = 1 << 30
) -> PackedRun:
    """Write frames, packed; each in full or, if it fails, not at all and with its error in ``failed``."""
    run = PackedRun({}, {})
    sizes: dict[str, int] = {}
    for name, df in frames.items():
        try:
            sizes[name] = _size(df)
        except Exception as error:
            run.failed[name] = error
    for names in packs_of(sizes, packs, largest):
        _write_pack(spark, {name: frames[name] for name in names}, run)
    return run


def _write_pack(spark: SparkSession, frames: Mapping[str, DataFrame], run: PackedRun) -> None:
    shapes: dict[str, str] = {}
    for df in frames.values():
        shapes.setdefault(_shape(df.schema), f"row{len(shapes)}")
    folder = fresh_folder(spark, "pack")
    parts = []
    for name, df in frames.items():
        row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(shapes[_shape(df.schema)])
        parts.append(df.select(F.lit(name).alias(TABLE), row))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    run.writes += 1
    try:
        # Rows of a table meet in few tasks, a large table is split: files fit the data, not the tables.
        rows.hint("rebalance", TABLE).write.partitionBy(TABLE).parquet(folder)
    except Exception as error:
        if len(frames) == 1:
            run.failed[next(iter(frames))] = error
            return
        names = list(frames)
        for half in (names[: len(names) // 2], names[len(names) // 2 :]):
            _write_pack(spark, {name: frames[name] for name in half}, run)
        return
    for name, df in frames.items():
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        run.tables[name] = PackedTable(name, folder, shapes[_shape(df.schema)], plain)


def silver_packed(
    spark: SparkSession,
    jobs: Iterable[TableJob],
    read: Callable[[str], DataFrame],
    packs: int = 4,
    largest: int = 1 << 30,
) -> PackedRun:
    """Cleanse, check and score many tables in few jobs."""
    frames, failed = {}, {}
    for job in jobs:
        try:
            frames[job.name] = build_silver(read(job.name), job.spec)
        except Exception as error:
            failed[job.name] = error
    run = write_packed(spark, frames, packs, largest)
    run.failed.update(failed)
    return run


@dataclass(frozen=True)
class HistoryJob:
    """A table of change rows and the history to build of it."""

    name: str
    spec: HistorySpec


def history_packed(
    spark: SparkSession,
    jobs: Iterable[HistoryJob],
    read: Callable[[str], DataFrame],
    packs: int = 4,
    largest: int = 1 << 30,
    skew: SkewPolicy | None = SkewPolicy(),
) -> PackedRun:
    """Build the histories of many tables in few jobs.

    Tables with equal columns and specs (but for their names) are one build, keyed by
    table and key, and hot keys are cut as in a build of one table.
    """
    changes, specs, failed = {}, {}, {}
    for job in jobs:
        try:
            df = read(job.name)
            job.spec.tracked([c for c in df.columns])
            changes[job.name], specs[job.name] = df, replace(job.spec, target="", source="")
        except Exception as error:
            failed[job.name] = error
    alike: dict[tuple, list[str]] = {}
    for name, df in changes.items():
        alike.setdefault((_shape(df.schema), specs[name]), []).append(name)
    frames = {}
    for (_, spec), names in alike.items():
        tag = "__table"
        tagged = [changes[name].withColumn(tag, F.lit(name)) for name in names]
        whole = build_history(reduce(DataFrame.unionByName, tagged), replace(spec, keys=(tag, *spec.keys)), skew)
        # One frame for each family: its tables are told apart when it is written.
        frames[tuple(names)] = whole
    run = _write_families(spark, frames, packs, largest)
    run.failed.update(failed)
    for name in [n for names in frames for n in names if n not in run.tables]:
        # A family that fails is built table by table, so that only those at fault are missing.
        one = write_packed(spark, {name: build_history(changes[name], specs[name], skew)}, 1, largest)
        run.tables.update(one.tables)
        run.failed.update(one.failed)
        run.writes += one.writes
    return run


def _write_families(spark: SparkSession, frames: Mapping[tuple, DataFrame], packs: int, largest: int) -> PackedRun:
    run = PackedRun({}, {})
    sizes = {str(i): _size(df) for i, df in enumerate(frames.values())}
    families = list(frames)
    for members in packs_of(sizes, packs, largest):
        folder, parts, told = fresh_folder(spark, "pack"), [], []
        for at, member in enumerate(members):
            names = families[int(member)]
            df = frames[names]
            row = F.struct(*(F.col(f"`{c}`") for c in df.columns if c != "__table")).alias(f"row{at}")
            parts.append(df.select(F.col("__table").alias(TABLE), row))
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema if f.name != "__table"])
            told += [PackedTable(name, folder, f"row{at}", schema) for name in names]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        run.writes += 1
        try:
            rows.hint("rebalance", TABLE).write.partitionBy(TABLE).parquet(folder)
        except Exception:
            continue
        run.tables.update({table.name: table for table in told})
    return run
