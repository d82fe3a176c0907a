"""Keys that outweigh a shuffle partition, found by a sketch and counted exactly.

A frequent-items sketch of the keys' hashes is built per task and merged in two steps,
so the cluster shuffles a bounded sketch a task instead of a row for each key. Every
key that may be hot is among the sketch's candidates; only their rows are then counted.
Without candidates there is no second pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lustra.sources.workspace import ensure_checkpoints

#: Fixed values of Spark's sketch: most items it tracks, and its error as a share of all rows times the items tracked.
_MOST_TRACKED = 1_000_000
_ERROR = 3.5
_MERGES = 64


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot and how finely it is cut.

    A key is hot if it has at least ``hot_rows`` rows and outweighs an average
    shuffle partition, so there are never more hot keys than partitions.
    """

    hot_rows: int = 2_000_000
    range_rows: int = 1_000_000


def _partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _limit(skew: SkewPolicy, total: int, partitions: int) -> int:
    # The last term lets the sketch tell hot keys apart with more partitions than it can track.
    return max(skew.hot_rows, total // partitions, int(4 * _ERROR * total / _MOST_TRACKED))


def candidates(rows: DataFrame, keys: Sequence[str], skew: SkewPolicy) -> tuple[list[int], int]:
    """Hashes among which are those of all hot keys, and the number of rows.

    A sketch that tracks sixteen items a partition errs by less than a quarter of a hot
    key's rows, so each such key stands out from the error; no more hashes than the
    items tracked come to the driver.
    """
    partitions = _partitions(rows)
    tracked = min(_MOST_TRACKED, max(1024, 16 * partitions))
    hashed = rows.select(F.xxhash64(*keys).alias("h"), F.pmod(F.spark_partition_id(), F.lit(_MERGES)).alias("part"))
    parts = hashed.groupBy("part").agg(
        F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("s"), F.count(F.lit(1)).alias("n")
    )
    # Grouped, as the sketch can't be merged from no rows at all.
    merged = parts.groupBy(F.lit("all").alias("all")).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"), F.sum("n").alias("n"))
    top = merged.select("n", F.expr(f"approx_top_k_estimate(s, {tracked})").alias("top")).first()
    if top is None:
        return [], 0
    total = top["n"]
    # Estimates never fall below a key's true count.
    limit = _limit(skew, total, partitions)
    return [item["item"] for item in top["top"] if item["count"] >= limit], total


def hot_keys(
    rows: DataFrame, keys: Sequence[str], skew: SkewPolicy, counts: DataFrame | None = None
) -> tuple[DataFrame | None, int]:
    """Keys too big for one task, and at least how many rows they have together; (None, 0) if there are none.

    The rows must have no NULL in the keys. Rows per key, if the caller has them (``n``), are used
    instead of a sketch.
    """
    keys, spark = list(keys), rows.sparkSession
    if counts is None:
        hashes, total = candidates(rows, keys, skew)
        if not hashes:
            return None, 0
        few = F.broadcast(spark.createDataFrame([(h,) for h in hashes], "__h long"))
        counted = rows.select(*keys).join(few, F.xxhash64(*keys) == F.col("__h"), "left_semi")
        counts = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    else:
        total, most = counts.agg(F.sum("n"), F.max("n")).first()
        # Mostly no key is hot, and one pass over the counts says so.
        if most is None or most < _limit(skew, total, _partitions(rows)):
            return None, 0
    ensure_checkpoints(spark)
    limit = _limit(skew, total, _partitions(rows))
    found = counts.filter(F.col("n") >= limit).select(*keys, "n").checkpoint()
    hot_rows = found.agg(F.sum("n")).first()[0]
    return (found.drop("n"), hot_rows) if hot_rows else (None, 0)
