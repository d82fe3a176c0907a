"""SCD Type 2 history kept up to date by a stream of changes.

Plain parquet has no upsert, so every micro-batch writes folders of its own and
never touches older ones::

    changes/batch_id=N/kb=B      the batch's change rows, by key bucket
    changes/batch_id=N/kb=-1     its rows without key or sequence
    versions/batch_id=N/slot=B   the latest row of every key of bucket B
    versions/batch_id=N/slot=-1  the versions the batch closed
    versions/batch_id=N/slot=-2  the keys whose earlier versions it replaced
    versions/batch_id=N/slot=-3  the state of those keys just before its late rows
    commits/batch_id=N           per bucket, the batch that last wrote it

**Rows in order.** The latest row of a key (its *tail*) is all that is needed to
go on: newer changes resume from it. A batch costs its own rows plus the tails of
the buckets it touches, however long the history is.

**Late rows.** A key that receives a row not newer than its tail is repaired: it
resumes from a state stored before that row and replays the changes since. Such
states are its tail of ``lookback`` batches ago, still on disk, and the marks that
repairs in between left just before their own late rows; so a key that is a
little late in every batch replays a little in every batch. Only a row older than
all of them has its key rebuilt from all its changes. A repair voids the key's
closed versions that ended after the point of resumption and were written by
earlier batches.

**Failures.** Batch N reads only what batches before N committed and overwrites
its own folders, so a replay, after whatever failure, ends in the same state. The
commit is the last step; readers use the newest one and see one consistent
snapshot. A root belongs to one stream checkpoint, whose batch ids it uses.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lustra.operators.history import (
    CLOSED,
    DELETED,
    END,
    LAST,
    MARK,
    SEED,
    START,
    WATCH,
    HistorySpec,
    SkewPolicy,
    identified,
    mark_deletes,
    walk_changes,
)
from lustra.sources.workspace import ensure_checkpoints

BUCKET, BATCH, SLOT = "kb", "batch_id", "slot"
_REJECTED = -1
_CLOSED, _VOIDS, _MARKS = -1, -2, -3
_BROADCAST_ROWS = 100_000
_COMMIT_SCHEMA = f"buckets array<struct<{BUCKET}: int, generation: bigint>>, repaired boolean"


@dataclass
class _Commit:
    """A batch's end state: the batch that last wrote each bucket, and whether any key was ever repaired."""

    batch_id: int = -1
    generations: dict[int, int] = field(default_factory=dict)
    repaired: bool = False


@dataclass(frozen=True)
class StreamedHistory:
    """History of one table under one folder on shared storage.

    ``buckets`` bounds how many tails a small batch has to rewrite; a few
    thousand suit billions of keys. ``lookback`` is how many batches late a row
    may be before its key is rebuilt from all its changes.
    """

    root: str
    spec: HistorySpec
    buckets: int = 64
    lookback: int = 8
    skew: SkewPolicy | None = SkewPolicy()

    def start(self, changes: DataFrame, checkpoint: str, once: bool = True) -> StreamingQuery:
        """Feed a stream of change rows into the history."""
        writer = changes.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        if once:
            writer = writer.trigger(availableNow=True)
        return writer.start()

    # --- one micro-batch ---------------------------------------------------

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Bring the history up to one batch; one that is committed already stays as it is."""
        spark, columns = batch.sparkSession, batch.schema
        ensure_checkpoints(spark)
        commit = self._committed(spark, batch_id)
        if commit.batch_id == batch_id:
            return
        held = self._log_batch(batch, batch_id)
        touched = [row[0] for row in held.select(BUCKET).distinct().collect()]
        if touched:
            tails = self._tails(spark, columns, commit, touched)
            commit.repaired |= self._advance(held, tails, columns, batch_id)
            commit.generations.update(dict.fromkeys(touched, batch_id))
        row = (sorted(commit.generations.items()), commit.repaired)
        one_file = spark.createDataFrame([row], _COMMIT_SCHEMA).coalesce(1)
        one_file.write.mode("overwrite").parquet(f"{self.root}/commits/{BATCH}={batch_id}")

    def _log_batch(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Store the batch and return what can be placed, so that its source is read once."""
        placed = F.when(identified(self.spec), self._bucket()).otherwise(F.lit(_REJECTED))
        folder = f"{self.root}/changes/{BATCH}={batch_id}"
        logged = batch.withColumn(BUCKET, placed).hint("rebalance", BUCKET)
        logged.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        stored = batch.sparkSession.read.schema(_with(batch.schema, f"{BUCKET} int")).parquet(folder)
        return stored.filter(F.col(BUCKET) != _REJECTED)

    def _advance(self, held: DataFrame, tails: DataFrame, columns: T.StructType, batch_id: int) -> bool:
        """Write what the batch changes; says whether keys had to be repaired."""
        spec, keys, seq = self.spec, list(self.spec.keys), self.spec.sequence_by
        arrived = held.groupBy(*keys).agg(F.min(seq).alias("first"), F.count(F.lit(1)).alias("n"))
        arrived = arrived.withColumn(BUCKET, self._bucket())
        known = _shuffled(tails.select(*keys, F.col(seq).alias("newest")))
        is_late = F.coalesce(F.col("first") <= F.col("newest"), F.lit(False))
        plan = arrived.join(known, keys, "left").withColumn("late", is_late).drop("newest").checkpoint()
        late_per_bucket = dict(plan.filter("late").groupBy(BUCKET).count().collect())

        nothing = F.lit(None).cast(columns[seq].dataType)
        changes, voids = held.drop(BUCKET), None
        seeds = tails.join(_shuffled(plan.filter(~F.col("late")).select(*keys)), keys, "left_semi")
        counts = plan.filter(~F.col("late")).select(*keys, "n")
        if late_per_bucket:
            late, n_late = plan.filter("late"), sum(late_per_bucket.values())
            changes = changes.join(_broadcast_if_few(late.select(*keys), n_late), keys, "left_anti")
            changes = changes.withColumn(WATCH, nothing)
            replayed, resumed, voids = self._repair(late, columns, batch_id, late_per_bucket)
            changes = changes.unionByName(replayed)
            seeds = seeds.withColumn(WATCH, nothing).unionByName(resumed)
            counts = counts.unionByName(replayed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))

        rows = mark_deletes(changes, spec).withColumn(SEED, nothing)
        rows = rows.unionByName(seeds.withColumn(SEED, F.col(START)).select(*rows.columns))
        walked = walk_changes(rows, spec, self.skew, counts)
        slots = F.array(
            F.when(F.col(LAST), self._bucket()),
            F.when(F.col(CLOSED), F.lit(_CLOSED)),
            F.when(F.col(MARK), F.lit(_MARKS)),
        )
        stored = [*columns.names, START, END, DELETED, SLOT]
        out = walked.withColumn(SLOT, F.explode(F.array_compact(slots))).select(*stored)
        untouched = tails.join(_shuffled(plan.select(*keys)), keys, "left_anti").withColumn(SLOT, self._bucket())
        out = out.unionByName(untouched.select(*stored))
        if voids is not None:
            out = out.unionByName(voids.withColumn(SLOT, F.lit(_VOIDS)), allowMissingColumns=True)
        folder = f"{self.root}/versions/{BATCH}={batch_id}"
        out.hint("rebalance", SLOT).write.mode("overwrite").partitionBy(SLOT).parquet(folder)
        return voids is not None

    def _repair(
        self, late: DataFrame, columns: T.StructType, batch_id: int, late_per_bucket: dict[int, int]
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """For keys with late rows: changes to replay, states to resume from, and what becomes void.

        A void row holds the point of resumption as sequence (NULL for the
        beginning) and the earliest late row as start.
        """
        spark, keys, seq = late.sparkSession, list(self.spec.keys), self.spec.sequence_by
        buckets, n_late = list(late_per_bucket), sum(late_per_bucket.values())
        floor = self._committed(spark, batch_id - self.lookback)
        old_tails = self._tails(spark, columns, floor, buckets)
        written = self._versions(spark, columns).filter((F.col(BATCH) > floor.batch_id) & (F.col(BATCH) < batch_id))
        marks = written.filter(F.col(SLOT) == _MARKS).drop(SLOT)
        disturbed = written.filter(F.col(SLOT) == _VOIDS).select(
            *keys, F.col(START).alias("late_row"), F.col(BATCH).alias("in_batch")
        )

        # A state holds as long as no later batch brought a row that precedes it.
        states = old_tails.withColumn(BATCH, F.lit(floor.batch_id)).unionByName(marks)
        states = states.join(_broadcast_if_few(late.select(*keys, "first"), n_late), keys).filter(F.col(seq) < F.col("first")).drop("first")
        same_key = [states[key] == disturbed[key] for key in keys]
        precedes = (disturbed["in_batch"] > states[BATCH]) & (disturbed["late_row"] <= states[seq])
        holding = states.join(_shuffled(disturbed), [*same_key, precedes], "left_anti").drop(BATCH)
        whole_row = F.struct(*(c for c in holding.columns if c not in keys))
        newest = holding.groupBy(*keys).agg(F.max_by(whole_row, seq).alias("state"))

        # The batches since the floor have all changes newer than the tail of
        # then, and all changes of keys not known then.
        known = old_tails.select(*keys, F.col(seq).alias("floor_seq"))
        after, floor_seq = F.col(f"state.{seq}"), F.col("floor_seq")
        deep = floor_seq.isNotNull() & (after.isNull() | (after < floor_seq))
        found = late.join(_shuffled(known), keys, "left").join(_shuffled(newest), keys, "left")
        repairs = found.select(
            *keys, BUCKET, "first", deep.alias("deep"), F.when(~deep, F.col("state")).alias("state")
        ).checkpoint()
        deep_buckets = [row[0] for row in repairs.filter("deep").select(BUCKET).distinct().collect()]

        watch = F.col("first").alias(WATCH)
        shallow = repairs.filter(~F.col("deep")).select(*keys, after.alias("after"), watch)
        recent = self._log(spark, columns, floor.batch_id, batch_id, buckets)
        recent = recent.join(_broadcast_if_few(shallow, n_late), keys)
        replayed = recent.filter(F.col("after").isNull() | (F.col(seq) > F.col("after"))).drop("after")
        if deep_buckets:
            rebuilt = _broadcast_if_few(repairs.filter("deep").select(*keys, watch), n_late)
            whole = self._log(spark, columns, -1, batch_id, deep_buckets)
            replayed = replayed.unionByName(whole.join(rebuilt, keys))
        resumed = repairs.filter(F.col("state").isNotNull()).select(*keys, "state.*", watch)
        voids = repairs.select(*keys, after.alias(seq), F.col("first").alias(START))
        return replayed, resumed, voids

    # --- stored state ------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.spec.keys), F.lit(self.buckets)).cast("int")

    def _row_schema(self, columns: T.StructType) -> T.StructType:
        at = columns[self.spec.sequence_by].dataType
        return T.StructType(list(columns.fields)).add(START, at).add(END, at).add(DELETED, "boolean")

    def _versions(self, spark: SparkSession, columns: T.StructType) -> DataFrame:
        schema = _with(self._row_schema(columns), f"{BATCH} long, {SLOT} int")
        return spark.read.schema(schema).parquet(f"{self.root}/versions")

    def _tails(self, spark: SparkSession, columns: T.StructType, commit: _Commit, buckets: list[int]) -> DataFrame:
        """The latest row, as of a commit, of every key in some buckets."""
        schema = self._row_schema(columns)
        written = [(b, commit.generations[b]) for b in sorted(buckets) if b in commit.generations]
        if not written:
            return spark.createDataFrame([], schema)
        folders = [f"{self.root}/versions/{BATCH}={batch}/{SLOT}={bucket}" for bucket, batch in written]
        return spark.read.schema(schema).parquet(*folders)

    def _log(self, spark: SparkSession, columns: T.StructType, after: int, upto: int, buckets: list[int]) -> DataFrame:
        """The change rows some batches brought for some buckets."""
        log = spark.read.schema(_with(columns, f"{BUCKET} int, {BATCH} long")).parquet(f"{self.root}/changes")
        wanted = F.col(BUCKET).isin(sorted(buckets)) & (F.col(BATCH) > after) & (F.col(BATCH) <= upto)
        return log.filter(wanted).drop(BUCKET, BATCH)

    def _committed(self, spark: SparkSession, upto: int | None = None) -> _Commit:
        """The newest commit, or the newest up to a batch."""
        try:
            commits = spark.read.schema(f"{_COMMIT_SCHEMA}, {BATCH} long").parquet(f"{self.root}/commits")
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return _Commit()
            raise
        if upto is not None:
            commits = commits.filter(F.col(BATCH) <= upto)
        newest = commits.agg(F.max_by(F.struct(BATCH, "buckets", "repaired"), BATCH).alias("c")).first()["c"]
        if newest is None:
            return _Commit()
        return _Commit(newest[BATCH], {b[BUCKET]: b["generation"] for b in newest["buckets"]}, newest["repaired"])

    # --- reading -----------------------------------------------------------

    def committed_batch(self, spark: SparkSession) -> int:
        """The newest batch that readers see; -1 before the first."""
        return self._committed(spark).batch_id

    def read(self, spark: SparkSession, columns: T.StructType) -> DataFrame:
        """The history as of the newest commit; ``columns`` is the change rows' schema."""
        commit = self._committed(spark)
        keys, seq = list(self.spec.keys), self.spec.sequence_by
        shown = [*keys, *self.spec.stored(columns.names), START, END]
        tails = self._tails(spark, columns, commit, list(commit.generations))
        still_open = tails.filter(~F.col(DELETED)).select(*shown)
        if not commit.generations:
            return still_open
        written = self._versions(spark, columns).filter(F.col(BATCH) <= commit.batch_id)
        closed = written.filter(F.col(SLOT) == _CLOSED)
        if commit.repaired:
            voids = written.filter(F.col(SLOT) == _VOIDS).select(
                *keys, F.col(seq).alias("void_after"), F.col(BATCH).alias("voided_by")
            )
            replaced = (closed[BATCH] < F.col("voided_by")) & (
                F.col("void_after").isNull() | (closed[END] > F.col("void_after"))
            )
            same_key = [closed[key] == voids[key] for key in keys]
            closed = closed.join(_shuffled(voids), [*same_key, replaced], "left_anti")
        return closed.select(*shown).unionByName(still_open)

    def rejects(self, spark: SparkSession, columns: T.StructType) -> DataFrame:
        """Change rows that could not be placed, with the batch they came in."""
        log = spark.read.schema(_with(columns, f"{BUCKET} int, {BATCH} long")).parquet(f"{self.root}/changes")
        upto = self._committed(spark).batch_id
        return log.filter((F.col(BUCKET) == _REJECTED) & (F.col(BATCH) <= upto)).drop(BUCKET)


def _broadcast_if_few(keyed: DataFrame, rows: int) -> DataFrame:
    """Broadcast a frame of known and small size, so that a hot key on the other side stays spread."""
    return F.broadcast(keyed) if rows <= _BROADCAST_ROWS else _shuffled(keyed)


def _shuffled(keyed: DataFrame) -> DataFrame:
    """Join a frame of unknown size by shuffle: compressed files that look small unfold on the driver."""
    return keyed.hint("merge")


def _with(columns: T.StructType, more: str) -> T.StructType:
    return T.StructType([*columns.fields, *T.StructType.fromDDL(more).fields])
