"""Benchmark passages in texts, with some edits: q-gram lemma filter, then banded alignment.

A passage of m bytes and a stretch of text within e edits of it share at least
m + 1 - q (e + 1) q-grams of the passage, and the diagonals (text place minus passage place) of these span
at most e. So hits are counted in bands of 2 (e + 1) diagonals, each overlapping half of
the next: every such stretch lies whole in one band. Bands that reach the bound are aligned;
no other stretch can be within the budget, so the filter loses nothing.

The passages are the query set. They are taken in blocks of bounded size, so what is
handed to every executor is bounded however large the benchmark is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lustra.llm.memory import returning
from lustra.llm.symbols import BYTE_VALUES, Chunk, Runs, chunks, run_starts

U64 = np.uint64
_FOUND = "doc_id {}, item_id {}, distance int, begin int, end int, passage string"
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Budget:
    """Edits allowed per byte of a passage, and the length of the q-grams."""

    rate: float = 0.08
    q: int = 10

    def edits(self, size: int) -> int:
        """At most ``rate * size``, and no more than leaves a bound of one shared q-gram."""
        q = min(self.q, size)
        return max(0, min(int(self.rate * size), (size - q) // q))

    def shared(self, size: int) -> int:
        q = min(self.q, size)
        return size + 1 - q * (self.edits(size) + 1)


def plain(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case (ASCII and Latin-1 letters), white space as one space, and where each byte was."""
    space = _SPACES[data]
    again = np.zeros(len(data), bool)
    again[1:] = space[1:] & space[:-1]
    out = np.where(space, np.uint8(0x20), _LOWER[data])
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out = np.where(latin, out + np.uint8(0x20), out)
    at = np.flatnonzero(~again)
    return out[at], at


class _Index:
    """A block of passages: their q-grams with passage and place, by gram length."""

    def __init__(self, items: list[tuple[object, str]], budget: Budget):
        self.ids, self.passages = [], []
        for item, text in items:
            data, _ = plain(np.frombuffer((text or "").encode(), np.uint8))
            passage = data.tobytes().strip()
            if passage:
                self.ids.append(item)
                self.passages.append(passage)
        sizes = np.array([len(p) for p in self.passages], np.int64)
        self.edits = np.array([budget.edits(n) for n in sizes.tolist()], np.int64)
        self.shared = np.array([budget.shared(n) for n in sizes.tolist()], np.int64)
        self.grams = {}
        for q in np.unique(np.minimum(sizes, budget.q)).tolist():
            own = np.flatnonzero(np.minimum(sizes, budget.q) == q)
            keys, item, place = [], [], []
            for i in own.tolist():
                values = Runs(BYTE_VALUES[0][np.frombuffer(self.passages[i], np.uint8)]).every(q)
                keys.append(values)
                item.append(np.full(len(values), i))
                place.append(np.arange(len(values)))
            keys, item, place = (np.concatenate(x) for x in (keys, item, place))
            order = np.argsort(keys, kind="stable")
            distinct, first = np.unique(keys[order], return_index=True)
            table = np.zeros(1 << 20, bool)
            table[(distinct >> U64(44)).astype(np.int64)] = True
            self.grams[q] = (table, distinct, np.r_[first, len(keys)], item[order], place[order])

    def bands(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passage and first diagonal of every band with enough shared q-grams."""
        found = []
        symbols = BYTE_VALUES[0][data]
        for q, (table, distinct, bounds, item, place) in self.grams.items():
            values = Runs(symbols).every(q)
            at = np.flatnonzero(table[(values >> U64(44)).astype(np.int64)])
            where = np.minimum(np.searchsorted(distinct, values[at]), len(distinct) - 1)
            hit = distinct[where] == values[at]
            at, where = at[hit], where[hit]
            count = bounds[where + 1] - bounds[where]
            entry = np.repeat(bounds[where] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            own, diagonal = item[entry], np.repeat(at, count) - place[entry]
            half = self.edits[own] + 1
            band = diagonal // half
            # each hit counts in the band that begins at its half and in the one before
            key = np.r_[(own << 40) + band + (1 << 39), (own << 40) + band - 1 + (1 << 39)]
            # a gram of the passage counts once in a band, however often the text repeats it
            gram = np.r_[place[entry], place[entry]]
            order = np.lexsort((gram, key))
            key = key[order][run_starts(key[order], gram[order])]
            key, number = np.unique(key, return_counts=True)
            i, band = key >> 40, (key & ((1 << 40) - 1)) - (1 << 39)
            enough = number >= self.shared[i]
            found.append((i[enough], band[enough] * (self.edits[i[enough]] + 1)))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int))


def _forward(passage: np.ndarray, text: np.ndarray, low: int, width: int, anywhere: bool) -> np.ndarray:
    """Edit distances of the whole passage to stretches of text that end at ``low + len(passage) + d``.

    Only cells on the diagonals ``low`` to ``low + width - 1`` are filled. Stretches begin
    anywhere in the band, or else at place 0.
    """
    far, d = 1 << 20, np.arange(width)
    place = low + d
    row = np.where((place >= 0) & (place <= len(text)), 0 if anywhere else np.abs(place), far)
    if not anywhere:
        row = np.where(place >= 0, row, far)
    for i in range(1, len(passage) + 1):
        end = i + place  # text places before which a cell ends
        inside = (end >= 1) & (end <= len(text))
        letter = text[np.clip(end - 1, 0, max(len(text) - 1, 0))] if len(text) else np.zeros(width, np.uint8)
        step = np.where(inside, row + (letter != passage[i - 1]), far)
        drop = np.r_[row[1:], far] + 1
        row = np.minimum(step, np.where((end >= 0) & (end <= len(text)), drop, far))
        row = np.minimum.accumulate(row - d) + d  # letters of the text left out
        row = np.where((end >= 0) & (end <= len(text)), row, far)
    return row


def align(passage: bytes, text: bytes, low: int, width: int, most: int) -> tuple[int, int, int] | None:
    """Least distance of the passage to a stretch in a band of diagonals, and the stretch; None if over ``most``.

    The band is widened by ``most`` on both sides. All stretches in it overlap, so the
    passage itself, if it is there, is the one to report.
    """
    low, width = low - most, width + 2 * most
    exact = text.find(passage, max(low, 0), max(low + width, 0) + len(passage))
    if exact >= 0:
        return 0, exact, exact + len(passage)
    p, t = (np.frombuffer(x, np.uint8) for x in (passage, text))
    ends = _forward(p, t, low, width, True)
    best = int(ends.argmin())
    if ends[best] > most:
        return None
    end = low + best + len(p)
    back = _forward(p[::-1], t[:end][::-1], -most, 2 * most + 1, False)
    return int(ends[best]), end - (len(p) - most + int(back.argmin())), end


def _regions(index):
    def of(batches):
        own: _Index = index.value
        for batch in batches:
            rows = []
            for chunk in chunks(batch.column("text"), 1 << 20):
                rows += _chunk_regions(chunk, own)
            columns = list(zip(*rows)) if rows else [[]] * 6
            docs = batch.column("doc_id").take(pa.array(list(columns[0]), pa.int64()))
            names = [own.ids[i] for i in columns[1]]
            yield pa.RecordBatch.from_arrays(
                [docs, pa.array(names, item_type(own)), *(pa.array(c, pa.int32()) for c in columns[2:5]), pa.array(columns[5], pa.string())],
                names=["doc_id", "item_id", "distance", "begin", "end", "passage"],
            )

    def item_type(own):
        return pa.int64() if all(isinstance(i, int) or i is None for i in own.ids) else pa.string()

    return of


def _chunk_regions(chunk: Chunk, index: _Index) -> list[tuple]:
    """Rows (text, passage, distance, begin, end, stretch) of a chunk; overlapping finds of a passage are one."""
    data, at = plain(chunk.data)
    bounds = np.searchsorted(at, chunk.bounds)
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for i, low in sorted(zip(*(x.tolist() for x in index.bands(data)))):
        passage, most = index.passages[i], int(index.edits[i])
        reach = low + 2 * (most + 1)
        first = int(np.searchsorted(bounds, low - most, "right")) - 1
        last = int(np.searchsorted(bounds, reach + len(passage) + most, "left"))
        for doc in range(max(first, 0), min(last, len(chunk))):
            a, b = int(bounds[doc]), int(bounds[doc + 1])
            left, right = max(a, low - 2 * most), min(b, reach + len(passage) + 2 * most)
            if right - left < len(passage) - most:
                continue
            hit = align(passage, data[left:right].tobytes(), low - left, 2 * (most + 1), most)
            if hit:
                found.setdefault((doc, i), []).append((hit[0], left + hit[1], left + hit[2]))
    rows = []
    for (doc, i), hits in sorted(found.items()):
        kept: list[tuple[int, int, int]] = []
        for hit in sorted(hits):
            if all(hit[2] <= k[1] or hit[1] >= k[2] for k in kept):
                kept.append(hit)
        for distance, begin, end in sorted(kept, key=lambda k: k[1]):
            a, b = int(at[begin]), int(at[end - 1]) + 1
            rows.append(
                (chunk.first + doc, i, distance, a - int(chunk.bounds[doc]), b - int(chunk.bounds[doc]),
                 chunk.data[a:b].tobytes().decode(errors="replace"))
            )
    return rows


def _clean(index):
    def of(batches):
        for batch in batches:
            bad = np.zeros(batch.num_rows, bool)
            for chunk in chunks(batch.column("text"), 1 << 20):
                bad[[row[0] for row in _chunk_regions(chunk, index.value)]] = True
            yield batch.filter(pa.array(~bad))

    return of


def _blocks(benchmark: DataFrame, budget: Budget, block_bytes: int) -> Iterator[Broadcast]:
    """The passages' indexes, each of about ``block_bytes`` of passages."""
    items = benchmark.select("item_id", "text").filter(F.length("text") > 0)
    size = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for block in range(blocks):
        rows = sorted(((r.item_id, r.text) for r in items.filter(number == block).collect()), key=repr)
        yield benchmark.sparkSession.sparkContext.broadcast(_Index(rows, budget))


def contaminated(
    documents: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), block_bytes: int = 4 << 20
) -> DataFrame:
    """One row for each stretch of a text that is a benchmark passage within the edit budget.

    Needs ``doc_id`` and ``text`` of documents, ``item_id`` and ``text`` of the benchmark;
    further columns are ignored. Both sides are compared in lower case (ASCII and Latin-1
    letters) with white space as single spaces. Returns doc_id, item_id, distance (edits in bytes),
    begin and end (bytes of the text) and passage (the stretch). Finds of one passage that
    overlap give the closest one, the first of equals.

    A passage may differ by ``rate`` of its bytes, or less if it is so short that no
    q-gram need be shared; under q bytes it must occur as it is. NULL and empty texts and
    passages match nothing. Repeated rows match each for themselves. Empty tables give an
    empty result.
    """
    kinds = (t.schema[c].dataType.simpleString() for t, c in ((documents, "doc_id"), (benchmark, "item_id")))
    schema, texts = _FOUND.format(*kinds), documents.select("doc_id", "text")
    found = [texts.mapInArrow(returning(_regions(index)), schema) for index in _blocks(benchmark, budget, block_bytes)]
    return reduce(DataFrame.unionByName, found) if found else documents.sparkSession.createDataFrame([], schema)


def clean_texts(
    documents: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), block_bytes: int = 4 << 20
) -> DataFrame:
    """The rows, with all their columns, in which ``contaminated`` finds nothing."""
    for index in _blocks(benchmark, budget, block_bytes):
        documents = documents.mapInArrow(returning(_clean(index)), documents.schema)
    return documents
