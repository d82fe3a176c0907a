"""Cleansing, rule checks, quarantine and history of a stream of change rows, in one flow.

Every micro-batch is read once: its rows are cleansed, judged and written, those that go
on apart from those that don't, while counters of every rule are observed in the same
pass. What goes on feeds the history. Under the flow's folder::

    judged/batch_id=N/fate=0   cleansed and judged rows that go on to the history
    judged/batch_id=N/fate=1   quarantined rows, with the rules they failed
    rules/batch_id=N           rows seen, passed, failed and unknown, by rule
    history/...                the streamed history

A batch overwrites its own folders, so a replay ends in the same state. Readers see the
batches that the history has committed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lustra.operators.columns import prefix_columns
from lustra.operators.history import HistorySpec, identified
from lustra.operators.quality import add_flags_and_score, failed_rule_names
from lustra.operators.silver import SilverSpec, bound_rules, clean_values
from lustra.streaming.history_stream import StreamedHistory

BATCH = "batch_id"
REASONS = "quarantine_reasons"
_FATE = "fate"
_ON, _OUT = 0, 1
_COUNTS = "rule string, n_rows long, n_passed long, n_failed long, n_unknown long"


@dataclass(frozen=True)
class QualityFlow:
    """A history of the rows of a stream that are fit for it.

    ``required`` names rules of ``silver`` that a row must pass; a NULL verdict is no pass. Rows
    that fail one, or lack a key or the sequence, are quarantined. Without ``required``
    the history is that of all cleansed rows, as :func:`history_with_quality` builds it.
    """

    root: str
    spec: HistorySpec
    silver: SilverSpec
    required: tuple[str, ...] = ()
    buckets: int = 64
    lookback: int = 8

    def __post_init__(self) -> None:
        unknown = [name for name in self.required if name not in self.silver.rules]
        if unknown:
            raise ValueError(f"no such rules: {', '.join(unknown)}")

    @property
    def history(self) -> StreamedHistory:
        return StreamedHistory(f"{self.root}/history", self.spec, buckets=self.buckets, lookback=self.lookback)

    def start(self, changes: DataFrame, checkpoint: str, once: bool = True) -> StreamingQuery:
        writer = changes.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()

    # --- one micro-batch ---------------------------------------------------

    def judged(self, changes: DataFrame) -> tuple[DataFrame, dict[str, str]]:
        """Cleansed rows with flags, score, reasons and fate; and the columns of the rules' verdicts."""
        if self.silver.prefix:
            changes = prefix_columns(changes, self.silver.prefix)
        cleaned = clean_values(changes, self.silver)
        rules = bound_rules(cleaned, self.silver)
        absent = [name for name in self.required if name not in rules]
        if absent:
            raise ValueError(f"required rules find no column: {', '.join(absent)}")
        held = {name: f"__rule{i}" for i, name in enumerate(rules)}
        verdicts = cleaned.withColumns({held[name]: rule for name, rule in rules.items()})
        scored = add_flags_and_score(verdicts, {name: F.col(column) for name, column in held.items()})
        must = {name: F.col(held[name]) for name in self.required}
        must["identity"] = identified(self.spec)
        scored = scored.withColumn(REASONS, failed_rule_names(must, null_is_failure=True))
        fate = F.when(F.col(REASONS).isNull(), _ON).otherwise(_OUT)
        return scored.withColumn(_FATE, fate), held

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Judge a batch, store it, and bring the history up to it."""
        spark = batch.sparkSession
        rows, held = self.judged(batch)
        seen = Observation()
        counters = [F.count(F.lit(1)).alias("rows")]
        for i, column in enumerate(held.values()):
            counters += [F.count_if(column).alias(f"passed{i}"), F.count_if(~F.col(column)).alias(f"failed{i}")]
        folder = f"{self.root}/judged/{BATCH}={batch_id}"
        kept = rows.observe(seen, *counters).drop(*held.values())
        kept.write.mode("overwrite").partitionBy(_FATE).parquet(folder)
        found = seen.get
        n = found["rows"]
        counts = [
            (name, n, found[f"passed{i}"], found[f"failed{i}"], n - found[f"passed{i}"] - found[f"failed{i}"])
            for i, name in enumerate(held)
        ]
        told = spark.createDataFrame(counts, _COUNTS).coalesce(1)
        told.write.mode("overwrite").parquet(f"{self.root}/rules/{BATCH}={batch_id}")
        stored = spark.read.schema(kept.schema).parquet(folder)
        self.history.apply(stored.filter(F.col(_FATE) == _ON).drop(_FATE, REASONS), batch_id)

    # --- reading -----------------------------------------------------------

    def silver_schema(self, spark: SparkSession, columns: T.StructType) -> T.StructType:
        """Columns of the cleansed rows of change rows with a schema."""
        rows, held = self.judged(spark.createDataFrame([], columns))
        return rows.drop(*held.values(), _FATE, REASONS).schema

    def read(self, spark: SparkSession, columns: T.StructType) -> DataFrame:
        """The history; ``columns`` is the schema of the stream's change rows."""
        return self.history.read(spark, self.silver_schema(spark, columns))

    def quarantined(self, spark: SparkSession, columns: T.StructType) -> DataFrame:
        """Rows kept out of the history, cleansed, with the reasons and their batch."""
        schema = T.StructType(
            [*self.silver_schema(spark, columns).fields, T.StructField(REASONS, T.StringType())]
        ).add(BATCH, T.LongType()).add(_FATE, T.IntegerType())
        rows = spark.read.schema(schema).parquet(f"{self.root}/judged")
        upto = self.history.committed_batch(spark)
        return rows.filter((F.col(_FATE) == _OUT) & (F.col(BATCH) <= upto)).drop(_FATE)

    def rule_counts(self, spark: SparkSession) -> DataFrame:
        """Counters of every rule and batch."""
        rows = spark.read.schema(f"{_COUNTS}, {BATCH} long").parquet(f"{self.root}/rules")
        return rows.filter(F.col(BATCH) <= self.history.committed_batch(spark))
