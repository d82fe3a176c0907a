"""Count-min sketches built in partitions, merged by Spark, read back as "seen twice" bits.

A sketch has ``depth`` rows of ``width`` cells. A value falls into one cell of each
row; its estimate is the least of its cells' counts and never below its true count.
Only "once" and "more" matter here, so counts stop at two and the merged sketch is one
bit a cell. The width follows the number of values up to a fixed bound, so what is
broadcast is bounded; past the bound the sketch lets more through but loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce, wraps

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lustra.llm.memory import returning, settle
from lustra.llm.stored import stored

U64 = np.uint64
_BLOCK = 1 << 16
_FLUSH = 1 << 20
_ROWS = "block long, cells binary, twice binary"
_GROUP = 32
#: Blocks of a merged sketch that go to the driver at once: 5 MB with levels, 4 without.
_AT_ONCE = 1 << 9


def sketch_width(values: int, load: float = 0.5, largest: int = 1 << 28) -> int:
    """Cells of a row for so many values: a power of two, at most ``largest``."""
    wanted = max(_BLOCK, int(values / load))
    return min(largest, 1 << (wanted - 1).bit_length())


def cells(values: np.ndarray, width: int, row: int) -> np.ndarray:
    """A value's cell in a row. Rows take different products of the value."""
    factor = U64((0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[row])
    where = values * factor
    where >>= U64(64 - width.bit_length() + 1)
    return where.view(np.int64)


def _packed(values: np.ndarray, width: int, depth: int) -> pa.RecordBatch:
    """A partition's cells by block: those hit once and those hit more often."""
    where = np.empty(depth * len(values), np.int64)
    for r in range(depth):
        np.add(cells(values, width, r), r * width, out=where[r * len(values) : (r + 1) * len(values)])
    where.sort()
    first = np.ones(len(where), bool)
    first[1:] = where[1:] != where[:-1]
    more = np.zeros(len(where), bool)
    more[:-1] = ~first[1:]
    where, more = where[first], more[first]
    blocks, low = where >> 16, (where & 0xFFFF).astype(np.uint16)
    starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(where) else np.empty(0, int)
    ends = np.r_[starts[1:], len(where)].astype(int)
    hit, often = [], []
    for a, b in zip(starts.tolist(), ends.tolist()):
        part, twice = low[a:b], more[a:b]
        hit.append(part.tobytes())
        often.append(part[twice].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks[starts], pa.int64()), pa.array(hit, pa.binary()), pa.array(often, pa.binary())],
        names=["block", "cells", "twice"],
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block; one dense block is held at a time."""
    now, counts = None, None

    def done():
        bits = np.packbits(counts > 1, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int64()), pa.array([bits], pa.binary())], names=["block", "bits"]
        )

    for batch in batches:
        for block, hit, often in zip(*(column.to_pylist() for column in batch.columns)):
            if block != now:
                if now is not None:
                    yield done()
                now, counts = block, np.zeros(_BLOCK, np.uint8)
            part = np.frombuffer(hit, np.uint16)
            counts[part] = np.minimum(counts[part] + 1, 2)
            counts[np.frombuffer(often, np.uint16)] = 2
    if now is not None:
        yield done()


def _levelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_merged``, and the logarithm of the largest count of each ``_GROUP`` cells."""
    now, counts = None, None

    def done():
        bits = np.packbits(counts > 1, bitorder="little").tobytes()
        most = counts.reshape(-1, _GROUP).max(axis=1)
        levels = np.log2(np.maximum(most, 1)).astype(np.uint8).tobytes()
        columns = [pa.array([now], pa.int64()), pa.array([bits], pa.binary()), pa.array([levels], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["block", "bits", "levels"])

    for batch in batches:
        for block, hit, often in zip(*(column.to_pylist() for column in batch.columns)):
            if block != now:
                if now is not None:
                    yield done()
                now, counts = block, np.zeros(_BLOCK, np.uint32)
            counts[np.frombuffer(hit, np.uint16)] += 1
            counts[np.frombuffer(often, np.uint16)] += 1
    if now is not None:
        yield done()


class Seen:
    """The merged sketch. ``twice`` is true for every value counted twice or more, and for few others.

    ``level`` grows with the logarithm of a value's estimated count, if the sketch was made with levels.
    """

    def __init__(self, bits: Broadcast, width: int, depth: int, levels: Broadcast | None = None):
        self._bits, self.width, self._depth, self._levels = bits, width, depth, levels

    def level(self, values: np.ndarray) -> np.ndarray:
        return self._levels.value[cells(values, self.width, 0) // _GROUP]

    def release(self) -> None:
        """Drop what was broadcast; only once nothing that reads the sketch will be computed again."""
        for held in (self._bits, self._levels):
            if held is not None:
                held.destroy()

    def twice(self, values: np.ndarray) -> np.ndarray:
        table = self._bits.value
        found = np.ones(len(values), bool)
        for row in range(self._depth):
            where = cells(values, self.width, row) + row * self.width
            found &= (table[where >> 3] >> (where & 7).astype(np.uint8)) & 1 == 1
        return found


Values = Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]


def seen_twice(sources: list[tuple[DataFrame, Values]], width: int, depth: int = 1, levels: bool = False) -> Seen:
    """Sketch the values drawn from each partition of the sources and merge the partitions' sketches.

    Sketches travel sparse (two bytes a cell), by block, and one task merges a
    block at a time. The driver holds one bit a cell: 32 MB for the widest row. With ``levels``
    (one row of cells only) it also holds a byte for ``_GROUP`` cells. It reads a sketch of many
    blocks from the shared folder in portions, as it would else hold it in Spark's results,
    their buffers and Arrow at once besides.
    """

    def sketched(values_of: Values):
        @wraps(values_of)
        def of(batches):
            held, size = [], 0
            for values in values_of(batches):
                held.append(values)
                size += len(values)
                if size >= _FLUSH:
                    whole, held, size = np.concatenate(held), [], 0
                    yield _packed(whole, width, depth)
            if size:
                yield _packed(np.concatenate(held), width, depth)

        return returning(of)

    rows = [source.mapInArrow(sketched(values_of), _ROWS) for source, values_of in sources]
    merged = (
        reduce(DataFrame.unionByName, rows)
        .repartition(F.col("block"))
        .sortWithinPartitions("block")
    )
    if levels:
        merged = merged.mapInArrow(_levelled, "block long, bits binary, levels binary")
    else:
        merged = merged.mapInArrow(_merged, "block long, bits binary")
    table = np.zeros(width * depth // 8, np.uint8)
    ranks = np.zeros(width // _GROUP if levels else 0, np.uint8)
    last = width * depth // _BLOCK
    portions = [merged]
    if last > _AT_ONCE:
        merged = stored(merged, "sketch")
        portions = [merged.filter(F.col("block").between(a, a + _AT_ONCE - 1)) for a in range(0, last, _AT_ONCE)]
    for batch in (batch for portion in portions for batch in portion.toArrow().to_batches()):
        blocks = batch.column("block").to_numpy()
        bits = np.frombuffer(batch.column("bits").buffers()[2], np.uint8)[: len(blocks) * _BLOCK // 8]
        table.reshape(-1, _BLOCK // 8)[blocks] = bits.reshape(-1, _BLOCK // 8)
        if levels:
            own = np.frombuffer(b"".join(batch.column("levels").to_pylist()), np.uint8)
            ranks.reshape(-1, _BLOCK // _GROUP)[blocks] = own.reshape(-1, _BLOCK // _GROUP)
    session = sources[0][0].sparkSession
    bits, ranks = (session.sparkContext.broadcast(x) if len(x) else None for x in (table, ranks))
    if last > _AT_ONCE:
        del table
        settle(session)
    return Seen(bits, width, depth, ranks)
