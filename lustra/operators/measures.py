"""Rule counts, distinct counts and quantiles of growing data, kept as states that merge.

Every increment leaves one small row: exact counters of each rule, and a sketch for each
measured column. Summaries of any span of increments merge these rows and never go back to
the data. Counters merge exactly; distinct counts (HyperLogLog, about 1.6 % off) and
quantiles (KLL, ranks about 1 % off) keep their error however many states are merged. An
increment that is measured again replaces its row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BATCH = "batch_id"
RuleSet = Mapping[str, Callable[[], Column]]


@dataclass(frozen=True)
class MeasuredIncrements:
    """Measures of one table under one folder.

    ``rules`` are named conditions, built anew for each increment. ``distinct`` columns may have any
    type, ``quantiles`` columns are numbers. Names of rules and columns may change over
    time only by a new folder.
    """

    root: str
    rules: RuleSet = field(default_factory=dict)
    distinct: tuple[str, ...] = ()
    quantiles: tuple[str, ...] = ()
    #: Registers of a distinct count, as a power of two, and the KLL size: errors fall with both.
    lg_registers: int = 12
    kll_size: int = 200

    # --- writing -----------------------------------------------------------

    def state(self, df: DataFrame) -> DataFrame:
        """The one row an increment leaves; partial aggregates send one row per task."""
        parts = [F.count(F.lit(1)).alias("n")]
        for i, rule in enumerate(self.rules.values()):
            parts += [F.count_if(rule()).alias(f"passed{i}"), F.count_if(~rule()).alias(f"failed{i}")]
        for i, name in enumerate(self.distinct):
            hashed = F.when(F.col(name).isNotNull(), F.xxhash64(name))
            parts += [F.hll_sketch_agg(hashed, F.lit(self.lg_registers)).alias(f"hll{i}"), F.count(name).alias(f"known{i}")]
        for i, name in enumerate(self.quantiles):
            number = F.col(name).cast("double").alias("number")
            usable = F.when(~F.isnan(number), number)
            parts += [
                F.kll_sketch_agg_double(usable, F.lit(self.kll_size)).alias(f"kll{i}"),
                F.count(usable).alias(f"numbers{i}"),
                F.min(usable).alias(f"least{i}"),
                F.max(usable).alias(f"most{i}"),
            ]
        return df.agg(*parts)

    def add(self, df: DataFrame, batch_id: int) -> None:
        """Measure an increment. In a stream: ``writeStream.foreachBatch(measures.add)``."""
        self.state(df).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{_BATCH}={batch_id}")

    # --- reading -----------------------------------------------------------

    def schema(self) -> T.StructType:
        fields = [("n", T.LongType())]
        for i in range(len(self.rules)):
            fields += [(f"passed{i}", T.LongType()), (f"failed{i}", T.LongType())]
        for i in range(len(self.distinct)):
            fields += [(f"hll{i}", T.BinaryType()), (f"known{i}", T.LongType())]
        for i in range(len(self.quantiles)):
            fields += [(f"kll{i}", T.BinaryType()), (f"numbers{i}", T.LongType())]
            fields += [(f"least{i}", T.DoubleType()), (f"most{i}", T.DoubleType())]
        return T.StructType([T.StructField(name, kind) for name, kind in [*fields, (_BATCH, T.LongType())]])

    def states(self, spark: SparkSession, first: int | None = None, last: int | None = None) -> DataFrame:
        """Stored rows of a span of increments, both ends included."""
        try:
            rows = spark.read.schema(self.schema()).parquet(self.root)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = spark.createDataFrame([], self.schema())
        if first is not None:
            rows = rows.filter(F.col(_BATCH) >= first)
        return rows if last is None else rows.filter(F.col(_BATCH) <= last)

    def rule_summary(self, spark: SparkSession, first: int | None = None, last: int | None = None) -> DataFrame:
        """One row per rule, as :func:`summarize_rules` gives it for the whole of the span's data."""
        if not self.rules:
            raise ValueError("a summary needs at least one rule")
        names = ["n", *(f"{kind}{i}" for i in range(len(self.rules)) for kind in ("passed", "failed"))]
        merged = self.states(spark, first, last).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names))
        lines = F.array(
            *(
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.col("n").alias("n_rows"),
                    F.col(f"passed{i}").alias("n_passed"),
                    F.col(f"failed{i}").alias("n_failed"),
                    (F.col("n") - F.col(f"passed{i}") - F.col(f"failed{i}")).alias("n_unknown"),
                    F.round(F.try_divide(F.col(f"passed{i}") * 100.0, F.col("n")), 2).alias("pass_rate"),
                )
                for i, rule in enumerate(self.rules)
            )
        )
        return merged.select(F.inline(lines))

    def distinct_summary(self, spark: SparkSession, first: int | None = None, last: int | None = None) -> DataFrame:
        """``column``, ``n_rows``, ``n_known`` (exact) and ``n_distinct`` (estimated, NULLs not counted)."""
        if not self.distinct:
            raise ValueError("no columns for distinct counts")
        parts = [F.coalesce(F.sum("n"), F.lit(0)).alias("n")]
        for i in range(len(self.distinct)):
            parts.append(F.coalesce(F.sum(f"known{i}"), F.lit(0)).alias(f"known{i}"))
            parts.append(F.hll_sketch_estimate(F.hll_union_agg(f"hll{i}")).alias(f"distinct{i}"))
        lines = F.array(
            *(
                F.struct(
                    F.lit(name).alias("column"),
                    F.col("n").alias("n_rows"),
                    F.col(f"known{i}").alias("n_known"),
                    F.coalesce(f"distinct{i}", F.lit(0)).alias("n_distinct"),
                )
                for i, name in enumerate(self.distinct)
            )
        )
        return self.states(spark, first, last).agg(*parts).select(F.inline(lines))

    def quantile_summary(
        self,
        spark: SparkSession,
        shares: tuple[float, ...] = (0.25, 0.5, 0.75),
        first: int | None = None,
        last: int | None = None,
    ) -> DataFrame:
        """``column``, ``n_numbers``, ``least``, ``most`` (exact) and ``values`` at the shares (estimated; NULL without numbers)."""
        if not self.quantiles:
            raise ValueError("no columns for quantiles")
        rows = self.states(spark, first, last)
        found = []
        for i, name in enumerate(self.quantiles):
            # Without numbers a sketch is empty and has no quantiles.
            merged = rows.filter(F.col(f"numbers{i}") > 0).agg(
                F.coalesce(F.sum(f"numbers{i}"), F.lit(0)).alias("n_numbers"),
                F.min(f"least{i}").alias("least"),
                F.max(f"most{i}").alias("most"),
                F.kll_merge_agg_double(f"kll{i}").alias("sketch"),
            )
            at = F.array(*(F.lit(float(share)) for share in shares))
            values = F.when(F.col("n_numbers") > 0, F.kll_sketch_get_quantile_double("sketch", at))
            found.append(merged.select(F.lit(name).alias("column"), "n_numbers", "least", "most", values.alias("values")))
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out
