"""Removal of word windows that an earlier text holds, found through a count-min sketch.

First pass: each partition counts its windows in a sketch, and Spark merges the
partitions' sketches. A window counts under its anchor, the least of its grams, so one
count serves a stretch of windows; the sketch never shows less than a window's own
count. Second pass: only stretches that the sketch shows as repeated are grouped, by
their exact words' identities. Whatever repeats is among them, so none is lost.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lustra.llm.repeats import Texts, anchors, covered, id_of, keyed, repeated_ranges, word_symbols
from lustra.llm.sketch import seen_twice, sketch_width

_CUT = "doc long, rid long, kept string, n_words long, n_removed long, kept_sha256 string"


def _cut(with_kept: bool):
    def of(batches):
        for batch in batches:
            rows = {name: [] for name in ("kept", "n_words", "n_removed", "kept_sha256")}
            ranges = batch.column("ranges")
            for i, text in enumerate(batch.column("text")):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                found, removed = ranges[i], 0
                n = len(words)
                if found.is_valid:
                    bad = covered(found.values, n)
                    removed = int(bad.sum())
                    words = [words[j] for j in np.flatnonzero(~bad)]
                kept = b" ".join(words)
                rows["kept"].append(kept.decode() if with_kept else None)
                rows["n_words"].append(n)
                rows["n_removed"].append(removed)
                rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(v, t) for v, t in zip(rows.values(), types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("rid"), *arrays], names=["doc", "rid", *rows]
            )

    return of


def remove_repeated_windows(
    documents: DataFrame, window: int = 50, gram: int = 25, largest_width: int = 1 << 27, keep_text: bool = True
) -> DataFrame:
    """Each text's words without those of ``window``-word sequences that start in a text with a smaller doc_id.

    Needs ``doc_id`` and ``text``; further columns are ignored. Words are runs of
    anything but space and the controls from tab to carriage return. Returns one row for
    each input row: doc_id, kept (kept words joined by a space, NULL without
    ``keep_text``), n_words, n_removed, kept_sha256.

    NULL text has no words. A NULL doc_id counts as larger than all others. Rows with the
    same doc_id are never earlier than each other. Texts under ``window`` words stay
    whole. An empty table gives an empty result.
    """
    kind = Texts(word_symbols, window, gram)
    texts = keyed(documents)
    size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    width = sketch_width(2 * (size // 5) // (window - gram + 2), load=0.25, largest=largest_width)
    seen = seen_twice([(texts, anchors(kind))], width, depth=2)
    ranges = repeated_ranges(texts, kind, seen)
    cut = texts.join(ranges, ["doc", "rid"], "left").mapInArrow(_cut(keep_text), _CUT)
    return cut.select(id_of(F.col("doc")).alias("doc_id"), "kept", "n_words", "n_removed", "kept_sha256")
