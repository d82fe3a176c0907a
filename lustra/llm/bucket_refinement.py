"""Removal of byte strings that an earlier text holds, by anchors and hashes of windows.

Windows of ``window`` bytes are compared in two fixed levels, by ``repeats.repeated_ranges``:

1. Of the q-grams of a window the least is its anchor; consecutive windows with one anchor
   are one stretch. Anchors are counted in every partition and merged; those met once are final.
2. Stretches of an anchor are grouped by the hash of their whole bytes.
3. Where an anchor still has different stretches, their windows are hashed and grouped singly.

The hashes come from prefix sums of the bytes. Nothing is refined in rounds by the bucket
identifiers at later offsets: equal hashes of whole windows give the same removals in one step.

Identifiers are hash pairs, not ranks: equal strings must meet, their order is of no use.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lustra.llm.memory import portions, returning
from lustra.llm.repeats import Texts, anchors, byte_symbols, covered, id_of, keyed, repeated_ranges
from lustra.llm.sketch import seen_twice, sketch_width

_DIGEST = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _kept(text: pa.Scalar, ranges: pa.Scalar) -> tuple[memoryview | bytes, int, int]:
    """What is left of a text, and the bytes and runs removed."""
    data = memoryview(text.as_buffer()) if text.is_valid and len(text.as_buffer()) else b""
    if not ranges.is_valid:
        return data, 0, 0
    bad = covered(ranges.values, len(data))
    runs = int(bad[0]) + int((bad[1:] & ~bad[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~bad].tobytes(), int(bad.sum()), runs


def _digests(batches):
    for batch in batches:
        rows = []
        for text, ranges in zip(batch.column("text"), batch.column("ranges")):
            kept, removed, runs = _kept(text, ranges)
            rows.append((len(kept) + removed, removed, runs, hashlib.sha256(kept).hexdigest()))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), *columns], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )


def _cut(batches):
    for batch in (part for whole in batches for part in portions(whole)):
        pairs = zip(batch.column("text"), batch.column("ranges"))
        texts = [bytes(_kept(*pair)[0]).decode(errors="ignore") for pair in pairs]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])


def _with_ranges(documents: DataFrame, window: int, q: int, largest_width: int, rest: bool) -> DataFrame:
    """The texts with their repeated ranges (NULL if none), by the three steps above."""
    kind = Texts(byte_symbols, window, q)
    texts = keyed(documents, rest)
    size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    width = sketch_width(2 * size // (window - q + 2), load=0.25, largest=largest_width)
    plain = texts.select("doc", "rid", "text")
    seen = seen_twice([(plain, anchors(kind))], width)
    return texts.join(repeated_ranges(plain, kind, seen), ["doc", "rid"], "left")


def repeat_digests(documents: DataFrame, window: int = 50, q: int = 25, largest_width: int = 1 << 28) -> DataFrame:
    """What is left of each text without ``window``-byte strings that start in a text with a smaller doc_id.

    Needs ``doc_id`` and ``text``; further columns are ignored. Returns one row for each
    input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of
    the remaining bytes).

    NULL text is empty. A NULL doc_id counts as larger than all others. Rows with the
    same doc_id are never earlier than each other, so copies under one id stay. Texts
    under ``window`` bytes stay whole. An empty table gives an empty result.
    """
    cut = _with_ranges(documents, window, q, largest_width, False).mapInArrow(returning(_digests), _DIGEST)
    return cut.select(id_of(F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(documents: DataFrame, window: int = 50, q: int = 25, largest_width: int = 1 << 28) -> DataFrame:
    """The rows with all their columns and the text that is left; rules as for ``repeat_digests``.

    Characters that a cut splits are dropped whole. NULL text becomes empty. Other columns
    may have any names and stay as they are.
    """
    rows = _with_ranges(documents, window, q, largest_width, True).select("row", "text", "ranges")
    cut = rows.mapInArrow(returning(_cut), f"row {rows.schema['row'].dataType.simpleString()}, text string")
    return cut.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in documents.columns))
