"""Which stretches of a text stand, as windows of a fixed length, in an earlier text too.

Shared by the substring operators: they differ in their symbols (bytes or words) and
in how they find what may repeat. Consecutive windows with the same anchor (the least
gram in them) form a stretch. Equal windows have equal anchors, so

* a stretch that an earlier text has as a whole is repeated as a whole;
* only where an anchor has several different stretches need single windows be compared;
* everything else is unique.

Each chunk of texts settles what it can by itself: of equal stretches or windows it
sends on one, and of an anchor with many stretches only a mark. So a group that is
compared after the shuffle has at most a few rows per chunk, however many texts share it.
Symbols and their sums, eight bytes each, are held for a part of a chunk at a time.

Identities are pairs of 64-bit hashes. A text is known by its doc_id and a hash of
doc_id and text, so rows that repeat a doc_id don't mix. NULL ids come last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lustra.llm.memory import returning
from lustra.llm.sketch import Seen, seen_twice, sketch_width
from lustra.llm.stored import stored
from lustra.llm.symbols import BYTE_VALUES, Chunk, Runs, chunks, mixed, run_starts

U64 = np.uint64
LAST = 2**63 - 1
_REMOVE, _ASK, _MARK, _WINDOW = 0, 1, 2, 3
_FOUND = "k long, s long, doc long, rid long, lo int, n int, kind byte"
_NAMES = [part.split()[0] for part in _FOUND.split(", ")]
#: Different stretches of one anchor that a chunk may send on as they are.
_FEW = 8
#: So many stretches to compare, or as many as there are texts, are few: a list of them names few of the texts.
_FEW_ASKED = 1 << 16


@dataclass(frozen=True)
class Texts:
    """Symbols of a chunk: a value for each, and the text (row of the chunk) each belongs to.

    What repeats is settled within chunks, symbols are read in parts of them; a part has whole texts.
    """

    symbols: Callable[[Chunk], tuple[np.ndarray, np.ndarray]]
    window: int = 50
    gram: int = 25
    chunk_bytes: int = 1 << 20
    part_bytes: int = 1 << 17


def byte_symbols(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUES[0][chunk.data], chunk.doc_of_bytes()


def word_symbols(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, doc = chunk.words()
    return chunk.word_values(starts, ends), doc


def keyed(documents: DataFrame, rest: bool = False) -> DataFrame:
    """``doc`` (NULL as the largest number), ``rid`` and ``text``.

    ``rid`` tells rows of one doc_id apart. It is 0 throughout if no doc_id repeats.
    Other columns are left behind, or with ``rest`` packed into the struct ``row``.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    others = [F.struct(*(c for c in documents.columns if c != "text")).alias("row")] if rest else []
    texts = documents.select(doc.alias("doc"), "text", *others)
    rid = F.xxhash64("doc", "text") if repeats_ids(documents) else F.lit(0).cast("long")
    return texts.select("doc", rid.alias("rid"), "text", *(["row"] if rest else []))


def repeats_ids(documents: DataFrame) -> bool:
    """Whether several rows have the same doc_id, NULL included."""
    return not documents.groupBy("doc_id").count().filter("count > 1").isEmpty()


def stretches(kind: Texts, symbols: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each stretch."""
    n = len(symbols) - kind.window + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
    least = Runs(symbols, 1).every(kind.gram)
    left, span = kind.window - kind.gram + 1, 1
    while 2 * span <= left:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < left:
        least = np.minimum(least[: -(left - span)], least[left - span :])
    within = doc[:n] == doc[kind.window - 1 :]
    opens = within.copy()
    opens[1:] &= ~within[:-1] | (least[1:] != least[:-1])
    lo = np.flatnonzero(opens)
    closes = within.copy()
    closes[:-1] &= ~within[1:] | (least[1:] != least[:-1])
    return least[lo], lo, np.flatnonzero(closes) - lo + 1


def anchors(kind: Texts, column: str = "text") -> Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]:
    """The anchors of every stretch, for a sketch."""

    def anchored(batches):
        for batch in batches:
            for part in chunks(batch.column(column), kind.part_bytes):
                yield stretches(kind, *kind.symbols(part))[0]

    return anchored


def _joined(row: np.ndarray, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching ranges of a text as one."""
    order = np.lexsort((lo, row))
    row, lo, end = row[order], lo[order], (lo + size)[order]
    if not len(row):
        return row, lo, end
    # positions of later texts lie beyond all of earlier ones, so one running maximum serves
    far = int(end.max()) + 2
    reach = np.maximum.accumulate(end + row.astype(np.int64) * far)
    start = lo + row.astype(np.int64) * far
    first = np.ones(len(row), bool)
    first[1:] = start[1:] > reach[:-1]
    at = np.flatnonzero(first)
    last = np.r_[at[1:], len(row)] - 1
    return row[at], lo[at], reach[last] - row[at].astype(np.int64) * far - lo[at]


class _Rows:
    """Rows to send on, gathered for a chunk; positions count from the start of the text."""

    def __init__(self, chunk_doc: np.ndarray, chunk_rid: np.ndarray):
        self._doc, self._rid, self._parts, self._gone = chunk_doc, chunk_rid, [], []

    def gone(self, row: np.ndarray, lo: np.ndarray, size: np.ndarray) -> None:
        self._gone.append((row, lo, size))

    def add(self, kind: int, k: np.ndarray, s: np.ndarray, row: np.ndarray, lo: np.ndarray, n: np.ndarray) -> None:
        order = np.lexsort((lo, row))  # rows of a text stay together and so compress
        k, s, row, lo, n = k[order], s[order], row[order], lo[order], n[order]
        self._parts.append((k, s, self._doc[row], self._rid[row], lo, n, np.full(len(k), kind, np.int8)))

    def batch(self) -> pa.RecordBatch:
        if self._gone:
            row, lo, size = _joined(*(np.concatenate(x) for x in zip(*self._gone)))
            anywhere = mixed(self._doc[row].astype(U64) ^ mixed(lo.astype(U64)))
            self.add(_REMOVE, anywhere, np.zeros(len(row), U64), row, lo, size)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int8())
        columns = [np.concatenate(x) for x in zip(*self._parts)] if self._parts else [np.empty(0, np.int64)] * 7
        arrays = [
            pa.array(c.view(np.int64) if c.dtype == U64 else c.astype(t.to_pandas_dtype()), t)
            for c, t in zip(columns, types)
        ]
        return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


#: Stretches by part of a chunk: the part's first text, its symbols, where each text begins, and of each stretch the
#: text in the part, the first window's place in the symbols and the number of windows.
Parts = Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _each(lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every window of some stretches: which stretch it is of, and its place."""
    each = np.repeat(np.arange(len(lo)), n)
    return each, lo[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)


def _given(kind: Texts, chunk: Chunk, row: np.ndarray, lo: np.ndarray, n: np.ndarray) -> Parts:
    """Stretches known by text and place in it, of the parts that have some."""
    for part in chunk.parts(kind.part_bytes):
        own = (row >= part.first) & (row < part.first + len(part))
        if own.any():
            symbols, doc = kind.symbols(part)
            begin, at = _begins(doc, len(part)), row[own] - part.first
            yield part.first, symbols, begin, at, lo[own] + begin[at], n[own]


def _windows(kind: Texts, parts: Parts, doc_id: np.ndarray, out: _Rows, seen: Seen | None = None) -> None:
    """Single windows of some stretches: of equal ones the least text's goes on, the others are repeats."""
    found = []
    for first, symbols, begin, row, lo, n in parts:
        each, at = _each(lo, n)
        k = Runs(symbols, 0).of(at, kind.window)
        if seen is not None:
            may = seen.twice(k)
            k, each, at = k[may], each[may], at[may]
        row = row[each]
        found.append((k, Runs(symbols, 1).of(at, kind.window), row + first, at - begin[row]))
    if not found:
        return
    k, s, row, lo = (np.concatenate(x) for x in zip(*found))
    found.clear()
    order = np.lexsort((doc_id[row], s, k))
    k, s, row, lo = k[order], s[order], row[order], lo[order]
    starts = run_starts(k, s)
    later = doc_id[row] > doc_id[row][starts][np.cumsum(starts) - 1]
    out.gone(row[later], lo[later], np.full(int(later.sum()), kind.window))
    keep = ~later
    out.add(_WINDOW, k[keep], s[keep], row[keep], lo[keep], np.ones(int(keep.sum()), np.int64))


def _begins(doc: np.ndarray, texts: int) -> np.ndarray:
    return np.searchsorted(doc, np.arange(texts), "left")


def _ids(batch: pa.RecordBatch, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    part = slice(chunk.first, chunk.first + len(chunk))
    return (batch.column(c).to_numpy(zero_copy_only=False)[part] for c in ("doc", "rid"))


def _seen_stretches(kind: Texts, chunk: Chunk, seen: Seen) -> tuple[np.ndarray, ...]:
    """The chunk's stretches whose anchors were seen twice: anchor, identity, text, place in it and number of windows."""
    found = []
    for part in chunk.parts(kind.part_bytes):
        symbols, doc = kind.symbols(part)
        k, lo, n = stretches(kind, symbols, doc)
        may = seen.twice(k)
        k, lo, n = k[may], lo[may], n[may]
        row = doc[lo]
        s = Runs(symbols, 0).of(lo, n + kind.window - 1)
        found.append((k, s, row.astype(np.int64) + part.first, lo - _begins(doc, len(part))[row], n))
    return tuple(np.concatenate(x) for x in zip(*found))


def _candidates(kind: Texts, seen: Seen):
    """First pass over the texts after the sketch: what may repeat, settled within chunks as far as possible."""

    def candidates(batches):
        for batch in batches:
            for chunk in chunks(batch.column("text"), kind.chunk_bytes):
                doc_id, rid = _ids(batch, chunk)
                out = _Rows(doc_id, rid)
                k, s, row, lo, n = _seen_stretches(kind, chunk, seen)
                if not len(k):
                    continue
                order = np.lexsort((doc_id[row], s, k))
                k, s, row, lo, n = k[order], s[order], row[order], lo[order], n[order]
                same = run_starts(k, s)
                least = doc_id[row][same][np.cumsum(same) - 1]
                later = doc_id[row] > least
                out.gone(row[later], lo[later], n[later] + kind.window - 1)
                several = np.bincount(np.cumsum(run_starts(k)) - 1, weights=same) > _FEW
                several = several[np.cumsum(run_starts(k)) - 1]
                alone = ~later & ~several
                out.add(_ASK, k[alone], s[alone], row[alone], lo[alone], n[alone])
                marks = np.flatnonzero(several & run_starts(k))
                none = np.zeros(len(marks), np.int64)
                out.add(_MARK, k[marks], none.astype(U64), row[marks], none, none)
                part = ~later & several
                _windows(kind, _given(kind, chunk, row[part], lo[part], n[part]), doc_id, out)
                yield out.batch()

    return returning(candidates)


def _asked(kind: Texts, batch: pa.RecordBatch):
    """Of each chunk: the stretches whose windows are to be compared singly."""
    asked = batch.column("asked")
    for chunk in chunks(batch.column("text"), kind.chunk_bytes):
        lists = asked.slice(chunk.first, len(chunk))
        row = np.repeat(np.arange(len(chunk)), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        lo, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        yield chunk, _given(kind, chunk, row, lo, n)


def _places(doc_id: np.ndarray, rid: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """What stands for a stretch by its text and start."""
    return mixed(mixed(doc_id.astype(U64)) ^ mixed(rid.astype(U64) + U64(1)) ^ mixed(lo.astype(U64) + U64(2)) * U64(3))


def _asked_places(batches):
    """The places of stretches, each twice, so that a sketch shows it as seen twice."""
    for batch in batches:
        at = _places(*(batch.column(c).to_numpy() for c in ("doc", "rid", "lo")))
        yield np.concatenate([at, at])


#: Of each chunk of a batch: the chunk and the stretches to be compared.
Asked = Callable[[Texts, pa.RecordBatch], Iterator[tuple[Chunk, Parts]]]


def _marked(seen: Seen, marks: Seen) -> Asked:
    """As ``_asked``, of whole texts: the stretches whose places ``marks`` has."""

    def parts(kind, chunk, doc_id, rid):
        for part in chunk.parts(kind.part_bytes):
            symbols, doc = kind.symbols(part)
            begin = _begins(doc, len(part))
            k, lo, n = stretches(kind, symbols, doc)
            may = seen.twice(k)
            lo, n = lo[may], n[may]
            row = doc[lo]
            at = row + part.first
            asked = marks.twice(_places(doc_id[at], rid[at], lo - begin[row]))
            yield part.first, symbols, begin, row[asked], lo[asked], n[asked]

    def of(kind, batch):
        for chunk in chunks(batch.column("text"), kind.chunk_bytes):
            yield chunk, parts(kind, chunk, *_ids(batch, chunk))

    return of


def _asked_windows(kind: Texts, asked: Asked = _asked):
    """Identities of the windows that are to be compared, for a sketch."""

    def asked_windows(batches):
        for batch in batches:
            for _, parts in asked(kind, batch):
                for _, symbols, _, _, lo, n in parts:
                    yield Runs(symbols, 0).of(_each(lo, n)[1], kind.window)

    return asked_windows


def _sent_windows(batches):
    """Identities of windows that were sent on before."""
    for batch in batches:
        yield batch.column("k").to_numpy().view(U64)


def _expanded(kind: Texts, seen: Seen, asked: Asked = _asked):
    """Windows of the stretches that need single comparison, where the sketch shows them twice."""

    def expanded(batches):
        for batch in batches:
            for chunk, parts in asked(kind, batch):
                doc_id, rid = _ids(batch, chunk)
                out = _Rows(doc_id, rid)
                _windows(kind, parts, doc_id, out, seen)
                yield out.batch()

    return returning(expanded)


def _spans(batches):
    """Ranges of each text without overlaps."""
    for batch in batches:
        lists = batch.column("ranges")
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        lo, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        row, lo, n = _joined(row, lo, n)
        bounds = pa.array(np.searchsorted(row, np.arange(len(lists) + 1)), pa.int32())
        pairs = pa.StructArray.from_arrays([pa.array(lo, pa.int32()), pa.array(n, pa.int32())], names=["lo", "n"])
        spans = pa.ListArray.from_arrays(bounds, pairs)
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("rid"), spans], names=["doc", "rid", "ranges"])


def if_small(table: DataFrame, pairs: str, bytes_at_most: int) -> DataFrame:
    """A stored table marked for broadcast if its rows, with the pairs in a list column, are within the bound."""
    size = table.select(F.sum(F.size(pairs) * 8 + 64)).first()[0] or 0
    return F.broadcast(table) if size <= bytes_at_most else table


def repeated_ranges(
    texts: DataFrame, kind: Texts, seen: Seen, broadcast_bytes: int = 16 << 20, most_marks: int = 1 << 24
) -> DataFrame:
    """``doc``, ``rid`` and ``ranges`` (start and length in symbols, apart) of texts with repeats.

    A stretch or window is repeated if a text with a smaller doc has it. ``seen`` must
    be true for every anchor that occurs twice.

    Texts are told which of their stretches to compare by a broadcast list if these are few; up to
    ``most_marks`` stretches by a broadcast bit map of their places (it lets a few more through, which are
    compared too and change nothing); beyond that texts and lists are shuffled.
    """
    stretch, anchor = W.partitionBy("k", "s"), W.partitionBy("k")
    is_ask = F.col("kind") == _ASK
    shared = F.max(F.col("kind") == _MARK).over(anchor) | (
        F.min(F.when(is_ask, F.col("s"))).over(anchor) != F.max(F.when(is_ask, F.col("s"))).over(anchor)
    )
    later = F.col("doc") > F.min("doc").over(stretch)
    judged = (
        texts.mapInArrow(_candidates(kind, seen), _FOUND)
        .repartition("k")  # serves both windows
        .withColumn("later", later)
        .withColumn("shared", F.coalesce(shared, F.lit(False)))
        .filter(F.col("kind").isin(_REMOVE, _WINDOW) | (is_ask & (F.col("later") | F.col("shared"))))
        .withColumn("repeat", is_ask & F.col("later"))
    )
    of_window = F.col("kind") == _WINDOW
    judged = judged.select(
        *(F.when(of_window, F.col(c)).alias(c) for c in ("k", "s")), *_NAMES[2:], "repeat"
    )
    judged = stored(judged, "stretches")

    gone = judged.filter((F.col("kind") == _REMOVE) | F.col("repeat")).select(
        "doc", "rid", "lo", F.when(F.col("repeat"), F.col("n") + (kind.window - 1)).otherwise(F.col("n")).alias("n")
    )
    asks = judged.filter((F.col("kind") == _ASK) & ~F.col("repeat")).select("doc", "rid", "lo", "n")
    n_asks = asks.count()
    many = broadcast_bytes < 8 * n_asks or (n_asks > _FEW_ASKED and n_asks > texts.count())
    if many and n_asks <= most_marks:
        marks = seen_twice([(asks, _asked_places)], sketch_width(n_asks, load=1 / 32))
        source, asked_of = texts, _marked(seen, marks)
    else:
        asked = asks.groupBy("doc", "rid").agg(F.collect_list(F.struct("lo", "n")).alias("asked"))
        # read twice, by the sketch and by the comparison: stored, so that the texts are shuffled once
        joined = texts.join(if_small(stored(asked, "asked"), "asked", broadcast_bytes), ["doc", "rid"])
        source, asked_of = stored(joined, "asked-texts"), _asked
    sent = judged.filter(of_window).select(*_NAMES)
    twice = seen_twice([(source, _asked_windows(kind, asked_of)), (sent.select("k"), _sent_windows)], seen.width)
    single = source.mapInArrow(_expanded(kind, twice, asked_of), _FOUND).unionByName(sent)
    single = single.withColumn("least", F.min("doc").over(stretch))
    more = single.filter((F.col("kind") == _REMOVE) | (F.col("doc") > F.col("least"))).select(
        "doc", "rid", "lo", F.when(F.col("kind") == _REMOVE, F.col("n")).otherwise(F.lit(kind.window)).alias("n")
    )
    ranges = gone.unionByName(more).groupBy("doc", "rid").agg(F.collect_list(F.struct("lo", "n")).alias("ranges"))
    spans = ranges.mapInArrow(_spans, "doc long, rid long, ranges array<struct<lo int, n int>>")
    return if_small(stored(spans, "spans"), "ranges", broadcast_bytes)


def covered(ranges: pa.Array | None, size: int) -> np.ndarray:
    """Symbols of one text in any of its ranges."""
    steps = np.zeros(size + 1, np.int32)
    if ranges is not None and len(ranges):
        lo, n = (ranges.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        np.add.at(steps, lo, 1)
        np.add.at(steps, lo + n, -1)
    return np.cumsum(steps[:-1]) > 0


def id_of(column: Column) -> Column:
    return F.when(column != LAST, column)
