"""Small tables for the tests, with the rows that tend to break things."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Columns that operators might use as names of their own.
CLASHING = ("doc", "rid", "row", "ranges", "language", "kept", "n", "toks", "region", "component", "label", "node")


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = True) -> DataFrame:
    """doc_id, text, lang and columns with names that clash."""
    extra = ", ".join(f"`{c}` string" for c in CLASHING) if clashing else "n_chars long"
    filler = ("x",) * len(CLASHING) if clashing else (0,)
    data = [(*r, "en", *filler) for r in rows]
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, {extra}")


#: NULLs, empty and blank texts, repeated rows, a shared id, very long texts, ties.
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "aaaa" * 40),
    (6, "aaaa" * 40),
    (7, LONG),
    (8, LONG),
    (8, LONG),
    (9, "same id, one text"),
    (9, "same id, another text"),
    (None, "no id at all, but quite a few words are in it"),
    (None, "no id at all, but quite a few words are in it"),
    (10, "snow ☃ and clef 𝄞, é and É\r\nlast"),
]
