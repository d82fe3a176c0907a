"""Drawing documents by importance: the more a text is like a target collection, the likelier.

Runs of words fall into hash buckets. An array over the buckets holds how much commoner
each is in the target than in all documents (its gain); a document's weight is the sum
of the gains of its runs, taken from the array. Gumbel noise turns "the highest weights"
into a draw without replacement whose chances follow the weights.

The highest scores are found by selection, not by sorting all of them. Blocks of
candidates report their medians; the median of these, weighted by how many candidates
each block has left, is the next pivot. At least a quarter of what is left lies on
either side of it and one side goes, until the pivot is the exact cutoff key or so few
keys are left that they are sorted at once. Only the winners are sorted as a whole, by
ranges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lustra.llm.stored import stored

#: Letters become small, what is neither digit, letter nor beyond ASCII becomes a space.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_PIECE = 1 << 20
_LAST = 2**63 - 1


@dataclass(frozen=True)
class Draw:
    """How to draw.

    ``longest``: runs of 1 to so many words count. ``buckets`` bounds what is held per
    task and on the driver. Of the documents with ``least_words`` or more,
    floor(``percent`` * N / 100) are drawn. ``seed`` settles the noise of each doc_id.
    """

    longest: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: str = "2024"


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """A text's words, a megabyte of text at a time."""
    text = text.translate(_WORD_BYTES)
    start = 0
    while start < len(text):
        end = text.find(b" ", start + _PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def run_buckets(text: bytes, draw: Draw) -> Iterator[tuple[int, np.ndarray]]:
    """Piece by piece: new words, and the buckets of the runs that end in them."""
    tail: list[bytes] = []
    for words in word_pieces(text):
        runs = words
        if draw.longest > 1:
            both, known = tail + words, len(tail)
            runs = [
                b" ".join(both[end - n : end])
                for end in range(known + 1, len(both) + 1)
                for n in range(1, min(draw.longest, end) + 1)
            ]
            tail = both[max(0, len(both) - draw.longest + 1) :]
        yield len(words), np.fromiter(map(crc32, runs), np.int64, len(runs)) % draw.buckets


def _text_bytes(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column("text"):
        yield text.as_buffer().to_pybytes() if text.is_valid else b""


def bucket_counts(texts: DataFrame, draw: Draw) -> np.ndarray:
    """How many runs of all texts fall into each bucket; a task sends one row a bucket it has met."""

    def counted(batches):
        counts = np.zeros(draw.buckets, np.int64)
        for batch in batches:
            for text in _text_bytes(batch):
                for _, found in run_buckets(text, draw):
                    counts += np.bincount(found, minlength=draw.buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(draw.buckets, np.int64)
    for bucket, n in rows.collect():
        counts[bucket] = n
    return counts


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much commoner each bucket is in the target; one is added to every count."""
    size = len(documents)
    all_documents, all_target = float(documents.sum() + size), float(target.sum() + size)
    ratios = ((t + 1.0) * all_documents / ((s + 1.0) * all_target) for s, t in zip(documents.tolist(), target.tolist()))
    return np.fromiter((math.floor(1000 * math.log(r)) for r in ratios), np.int64, size)


def weighted(documents: DataFrame, gains: np.ndarray, draw: Draw) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""

    def of(batches):
        for batch in batches:
            rows = []
            for text in _text_bytes(batch):
                n_words = n_features = weight = 0
                for words, found in run_buckets(text, draw):
                    n_words += words
                    n_features += len(found)
                    weight += int(gains[found].sum())
                rows.append((n_words, n_features, weight))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ((), (), ()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", "n_words", "n_features", "weight"]
            )

    doc = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "n_words", "n_features", "weight")])
    return doc.mapInArrow(of, schema)


def noise(doc_id: Column, seed: str) -> Column:
    """Gumbel noise in thousandths, settled by seed and doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


# --- selection ---------------------------------------------------------------

_SIDES = "n_better long, n_worse long, better array<long>, worse array<long>, at array<long>"
#: Candidates of one block: what a task holds at a time.
_BLOCK = 1 << 20
#: So few keys are sorted at once.
_FEW = 4096

Key = tuple[int, int, int]


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """One key a row, the best smallest: score downwards, doc_id, then the row's own number."""
    score, doc, rid = (batch.column(c).to_numpy() for c in ("score", "doc", "rid"))
    return np.rec.fromarrays([-score, doc, rid], names="score,doc,rid")


def _compare(keys: np.ndarray, pivot: Key) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are better than the pivot, and which are it."""
    a, b, c = pivot
    same = keys["score"] == a
    better = (keys["score"] < a) | same & ((keys["doc"] < b) | (keys["doc"] == b) & (keys["rid"] < c))
    return better, same & (keys["doc"] == b) & (keys["rid"] == c)


def _median(keys: np.ndarray) -> list[int] | None:
    if not len(keys):
        return None
    order = np.lexsort((keys["rid"], keys["doc"], keys["score"]))
    return [int(v) for v in keys[order[(len(keys) - 1) // 2]]]


def _split(between: tuple[Key | None, Key | None], pivot: Key | None):
    """A block's candidates on either side of the pivot: how many and their medians."""

    def told(blocks: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.concatenate(blocks)
        if pivot is None:
            better, at = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        else:
            better, at = _compare(keys, pivot)
        worse = ~better & ~at
        hit = [int(v) for v in keys[at][0]] if at.any() else None
        values = [
            [int(better.sum())],
            [int(worse.sum())],
            [_median(keys[better])],
            [_median(keys[worse])],
            [hit],
        ]
        types = (pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3)
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(values, types)], names=["n_better", "n_worse", "better", "worse", "at"]
        )

    def of(batches):
        held, size = [], 0
        for batch in batches:
            keys = _keys(batch)
            low, high = between
            if low is not None:
                better, at = _compare(keys, low)
                keys = keys[~better & ~at]
            if high is not None:
                keys = keys[_compare(keys, high)[0]]
            held.append(keys)
            size += len(keys)
            if size >= _BLOCK:
                yield told(held)
                held, size = [], 0
        if size:
            yield told(held)

    return of


def _weighted_median(medians: list[tuple[Key, int]]) -> Key:
    medians = sorted(medians)
    half, so_far = sum(n for _, n in medians) / 2, 0
    for key, n in medians:
        so_far += n
        if so_far >= half:
            return key
    raise ValueError("no candidates")


def cutoff_key(candidates: DataFrame, place: int) -> Key:
    """The key at a place (1: best) of all candidates, which have score, doc and rid.

    A round is one pass over the keys still between the bounds. The driver gets one row
    for each block of a million candidates.
    """
    between: tuple[Key | None, Key | None] = (None, None)
    pivot: Key | None = None
    while True:
        rows = candidates
        low, high = between
        if low is not None:
            rows = rows.filter(F.col("score") <= -low[0])
        if high is not None:
            rows = rows.filter(F.col("score") >= -high[0])
        told = rows.mapInArrow(_split(between, pivot), _SIDES).collect()
        better, worse = sum(r.n_better for r in told), sum(r.n_worse for r in told)
        if pivot is None:
            left, side, n = worse, "worse", "n_worse"
        elif place == better + 1:
            return pivot
        elif place <= better:
            between, left, side, n = (low, pivot), better, "better", "n_better"
        else:
            place -= better + 1
            between, left, side, n = (pivot, high), worse, "worse", "n_worse"
        if not 1 <= place <= left:
            raise ValueError("there are fewer candidates than places")
        if left <= _FEW:
            return _sorted_few(candidates, between, place)
        pivot = _weighted_median([(tuple(r[side]), r[n]) for r in told if r[n]])


def _sorted_few(candidates: DataFrame, between: tuple[Key | None, Key | None], place: int) -> Key:
    low, high = (None if b is None else F.struct(*(F.lit(v).cast("long") for v in b)) for b in between)
    key = F.struct(-F.col("score"), F.col("doc"), F.col("rid"))
    if low is not None:
        candidates = candidates.filter(key > low)
    if high is not None:
        candidates = candidates.filter(key < high)
    kept = sorted((-r.score, r.doc, r.rid) for r in candidates.select("score", "doc", "rid").collect())
    return kept[place - 1]


def ranked(winners: DataFrame) -> DataFrame:
    """``rank`` from 1 on, by ranges of the order: no task sorts more than its range."""
    by = [F.desc("score"), F.asc("doc"), F.asc("rid")]
    placed = winners.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id()), "winners")
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"range": F.shiftright("place", 33), "place": inside})
    before, offsets = 0, []
    for at, n in sorted(placed.groupBy("range").count().collect()):
        offsets.append((at, before))
        before += n
    if not offsets:
        return placed.withColumn("rank", F.lit(None).cast("long")).drop("place", "range")
    ahead = winners.sparkSession.createDataFrame(offsets, "range long, ahead long")
    placed = placed.join(F.broadcast(ahead), "range")
    return placed.withColumn("rank", F.col("ahead") + F.col("place") + 1).drop("place", "range", "ahead")


def draw_like(documents: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score, and its rank if it is drawn.

    Needs ``doc_id`` and ``text`` of the documents and ``text`` of the target; further
    columns are ignored. A NULL or empty text has no words, weight 0, and is never
    drawn with ``least_words`` above 0, but has a score. A NULL doc_id counts as an
    empty one for the noise and comes last among equal scores. Rows that repeat are drawn one
    by one; between rows equal in score and doc_id their place in the table decides. Very
    long texts are read a megabyte at a time. Without documents the result is empty; without
    a target all gains compare with evenly filled buckets.

    Two passes over the texts; the first leaves one count a bucket, the second five
    numbers a document. These are stored once, and each round of the selection reads them.
    """
    gains = bucket_gains(bucket_counts(documents, draw), bucket_counts(target, draw))
    rows = weighted(documents, gains, draw)
    rows = rows.withColumns(
        {
            "score": F.col("weight") + noise(F.col("doc_id"), draw.seed),
            "doc": F.coalesce("doc_id", F.lit(_LAST)),
            "rid": F.monotonically_increasing_id(),
        }
    )
    rows = stored(rows, "weights")
    eligible = F.col("n_words") >= draw.least_words
    candidates = rows.filter(eligible)
    wanted = draw.percent * candidates.count() // 100
    if wanted < 1:
        won = F.lit(False)
    else:
        score, doc, rid = cutoff_key(candidates.select("score", "doc", "rid"), wanted)
        cut = F.struct(*(F.lit(v).cast("long") for v in (score, doc, rid)))
        won = eligible & (F.struct(-F.col("score"), F.col("doc"), F.col("rid")) <= cut)
    drawn = ranked(rows.filter(won))
    left = rows.filter(~won).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return drawn.select(*columns).unionByName(left.select(*columns))


#: CRC-32 of a word in SQL, by the polynomial of the standard; ``w`` names a table of distinct words.
CRC_SQL = """
crc_steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
 lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps),
crc_bytes AS (SELECT word, list_transform(range(length(h) // 2), lambda i:
  16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1) AS b
 FROM (SELECT word, hex(encode(word)) AS h FROM w)),
crcs AS (SELECT word, xor(list_reduce(list_prepend(4294967295, b),
  lambda c, x: xor(c // 256, steps[(xor(c, x) & 255) + 1])), 4294967295) AS crc FROM crc_bytes, crc_steps)"""

_WORDS_SQL = r"""regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def oracle_sql() -> str:
    """The default draw of ``documents`` towards ``benchmark``."""
    return f"""
WITH dw AS (SELECT r, unnest({_WORDS_SQL.format('text')}) AS word
 FROM (SELECT row_number() OVER () AS r, text FROM documents)),
d AS (SELECT r, word, count(*) AS n FROM dw GROUP BY ALL),
tw AS (SELECT unnest({_WORDS_SQL.format('text')}) AS word FROM benchmark),
w AS (SELECT word FROM d UNION SELECT word FROM tw),{CRC_SQL},
s AS (SELECT crc % 10000 AS bucket, sum(n) AS s FROM d JOIN crcs USING (word) GROUP BY ALL),
t AS (SELECT crc % 10000 AS bucket, count(*) AS t FROM tw JOIN crcs USING (word) GROUP BY ALL),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + 10000)
  / ((s::DOUBLE + 1) * ((SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
 FROM d JOIN crcs USING (word) JOIN gains ON bucket = crc % 10000 GROUP BY r),
scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
   / 4294967296::DOUBLE)))::BIGINT AS score
 FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) LEFT JOIN weights USING (r)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_words, n_features, weight, score,
 CASE WHEN n_words >= 20 AND place <= 10 * (SELECT count(*) FROM scored WHERE n_words >= 20) // 100 THEN place END AS rank
FROM placed"""
