"""CSV ingest by header: every file's values land under the names its own header gives them.

Exporters write the same table with columns in another order, with some missing or with
some more. A CSV reader with one schema places values by position, so here files are
read as lines, and the header is data: the first line of each file becomes a row of a
small table (file, position of every wanted column), which is joined to the file's
lines. Lines are split by CSV rules into one array, wide enough for the widest header
of the batch, and each column takes its element. A file may be cut into blocks and read
by many tasks; only its first block holds the header, the join hands it to the others.

A batch takes a bounded number of files, so the table of headers is small and goes by
broadcast: lines are never shuffled. Finding headers is a pass of its own over the batch that
keeps one line a file and task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lustra.operators.columns import clean_name

_BATCH = "batch_id"
_END = "\x01"
_LINEAGE = {"ingested_file": T.StringType(), "ingestion_ts": T.TimestampType()}


@dataclass(frozen=True)
class NamedCsv:
    """A stored table fed by CSV files of any column order.

    ``schema`` names the wanted columns and their types; names are cleaned
    (:func:`clean_name`), those of the files too. ``misfits`` holds the text of lines that don't
    fit: more or fewer values than the file's header has names, a value of another
    type, or a name that the header has twice. What fits is kept beside it. ``rescued`` is a
    JSON text of values whose names the schema doesn't have, NULL if there are none.

    A wanted column that a file lacks is NULL there. Blank lines and lines that repeat the
    file's header are no rows. Files without a header line have no rows at all. Values
    don't span lines. A quote inside a quoted value is doubled, or stands behind ``escape``.
    """

    root: str
    schema: T.StructType
    sep: str = ","
    escape: str = '"'
    misfits: str = "misfit_line"
    rescued: str = "rescued_values"
    files_per_batch: int = 1000

    def __post_init__(self) -> None:
        names = [clean_name(f.name) for f in self.schema]
        taken = [*names, self.misfits, self.rescued, *_LINEAGE, _BATCH]
        if len(set(taken)) < len(taken):
            raise ValueError(f"columns share a clean name or take a reserved one: {', '.join(taken)}")

    @property
    def names(self) -> list[str]:
        return [clean_name(f.name) for f in self.schema]

    def stored_schema(self) -> T.StructType:
        fields = [T.StructField(name, f.dataType) for name, f in zip(self.names, self.schema)]
        text = [T.StructField(name, T.StringType()) for name in (self.misfits, self.rescued)]
        lineage = [T.StructField(name, kind) for name, kind in _LINEAGE.items()]
        return T.StructType([*fields, *text, *lineage])

    def start(self, spark: SparkSession, folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
        """Ingest a folder, each file once, in batches of at most ``files_per_batch`` files."""
        lines = spark.readStream.option("maxFilesPerTrigger", self.files_per_batch).text(folder)
        lines = lines.select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        writer = lines.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of all batches so far."""
        schema = T.StructType([*self.stored_schema().fields, T.StructField(_BATCH, T.LongType())])
        try:
            return spark.read.schema(schema).parquet(self.root).drop(_BATCH)
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return spark.createDataFrame([], self.stored_schema())
            raise

    # --- one micro-batch ---------------------------------------------------

    def apply(self, lines: DataFrame, batch_id: int) -> None:
        """Write a batch's rows to its own folder; a replay overwrites them with the same."""
        first = lines.filter(F.col("block") == 0).withColumn("at", F.monotonically_increasing_id())
        headers = first.groupBy("file").agg(F.min_by("value", "at").alias("header"))
        # One small row a file; held, so that the width and the join see the same.
        headers = lines.sparkSession.createDataFrame(headers.toArrow(), "file string, header string")
        width = headers.agg(F.max(F.length("header") - F.length(F.replace("header", F.lit(self.sep))))).first()[0]
        rows = self.placed(lines, headers, (width or 0) + 1)
        rows.write.mode("overwrite").parquet(f"{self.root}/{_BATCH}={batch_id}")

    def placed(self, lines: DataFrame, headers: DataFrame, width: int) -> DataFrame:
        """Lines as rows, by the headers of their files (``file``, ``header``), none wider than ``width``."""
        known = F.array(*(F.lit(name) for name in self.names))
        found = F.transform(self._values(F.regexp_replace("header", "^﻿", ""), width), _clean)
        told = headers.select("file", "header", found.alias("names"))
        told = told.select(
            "file",
            "header",
            "names",
            F.transform(known, lambda n: F.nullif(F.array_position("names", n), F.lit(0))).alias("at"),
            (F.size(F.array_distinct("names")) < F.size("names")).alias("unclear"),
            F.size(F.filter("names", lambda n: ~F.array_contains(known, n))).alias("n_more"),
        )
        rows = lines.filter(F.trim("value") != "").join(F.broadcast(told), "file")
        rows = rows.filter(F.col("value") != F.col("header")).withColumn("values", self._values(F.col("value"), width))
        texts = rows.select(
            "file",
            "value",
            "unclear",
            (F.coalesce(F.size("values"), F.lit(-1)) == F.size("names")).alias("whole"),
            *(self._value_of(i).alias(f"t{i}") for i in range(len(self.names))),
            F.when(F.col("n_more") > 0, self._more()).alias(self.rescued),
        )
        return self._typed(texts)

    def _values(self, line: Column, width: int) -> Column:
        """The values of a line in order, NULL for empty ones; NULL if they are more than the widest header or torn.

        A mark behind the last value tells how many there are.
        """
        ddl = ", ".join(f"c{i} string" for i in range(width + 2))
        parsed = F.from_csv(F.concat(line, F.lit(self.sep + _END)), ddl, {"sep": self.sep, "escape": self.escape})
        values = F.array(*(parsed[f"c{i}"] for i in range(width + 2)))
        end = F.array_position(values, F.lit(_END))
        return F.when(end > 0, F.slice(values, F.lit(1), (end - 1).cast("int")))

    def _value_of(self, i: int) -> Column:
        return F.get("values", F.get("at", F.lit(i)).cast("int") - 1)

    def _more(self) -> Column:
        """Values under names that the schema doesn't have; a repeated name gives its first value."""
        known = F.array(*(F.lit(name) for name in self.names))
        pairs = F.arrays_zip(F.col("names").alias("n"), F.col("values").alias("v"))
        more = F.filter(pairs, lambda p: ~F.array_contains(known, p["n"]) & p["v"].isNotNull())
        once = F.filter(more, lambda p, i: F.array_position(F.transform(more, lambda q: q["n"]), p["n"]) == i + 1)
        return F.when(F.size(once) > 0, F.to_json(F.map_from_entries(once)))

    def _typed(self, texts: DataFrame) -> DataFrame:
        """Texts to the schema's types by the CSV reader's own conversion, all in one go."""
        kinds = {i: f.dataType for i, f in enumerate(self.schema) if f.dataType != T.StringType()}
        bad = ~F.col("whole") | F.col("unclear")
        if kinds:
            schema = ", ".join(f"t{i} {kind.simpleString()}" for i, kind in kinds.items())
            joined = F.concat_ws(_END, *(F.coalesce(F.col(f"t{i}"), F.lit("")) for i in kinds))
            # Without quotes and escapes: these have been undone.
            options = {"sep": _END, "quote": "", "columnNameOfCorruptRecord": "bad"}
            texts = texts.withColumn("typed", F.from_csv(joined, f"{schema}, bad string", options))
            bad = bad | F.col("typed.bad").isNotNull()
        columns = [F.col(f"typed.t{i}" if i in kinds else f"t{i}").alias(name) for i, name in enumerate(self.names)]
        return texts.select(
            *columns,
            F.when(bad, F.col("value")).alias(self.misfits),
            self.rescued,
            F.col("file").alias("ingested_file"),
            F.current_timestamp().alias("ingestion_ts"),
        )


def _clean(name: Column) -> Column:
    """:func:`clean_name` of the names in a header."""
    bare = F.regexp_replace(F.coalesce(name, F.lit("")), r"^\s+|\s+$", "")
    return F.regexp_replace(F.lower(bare), "[ _]+", "_")
