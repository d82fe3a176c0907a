"""Column naming. Each operator renames everything in one projection."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_name(raw: str) -> str:
    """Trim, lower-case, and turn each run of spaces or underscores into one underscore."""
    return re.sub(r"[ _]+", "_", raw.strip().lower())


def normalize_columns(df: DataFrame, on_collision: str = "raise") -> DataFrame:
    """Clean all column names.

    Two raw names with the same clean name raise, or with
    ``on_collision="suffix"`` the later ones get ``_2``, ``_3`` and so on.
    """
    if on_collision not in ("raise", "suffix"):
        raise ValueError(f"on_collision must be 'raise' or 'suffix', not {on_collision!r}")
    names = [clean_name(raw) for raw in df.columns]
    repeated = sorted(name for name, n in Counter(names).items() if n > 1)
    if repeated and on_collision == "raise":
        raise ValueError(f"columns share a clean name: {', '.join(repeated)}")
    return df.toDF(*(_numbered(names) if repeated else names))


def _numbered(names: list[str]) -> list[str]:
    taken: set[str] = set(names)
    seen: Counter[str] = Counter()
    out = []
    for name in names:
        seen[name] += 1
        unique = name
        if seen[name] > 1:
            n = seen[name]
            while f"{name}_{n}" in taken:
                n += 1
            unique = f"{name}_{n}"
            taken.add(unique)
        out.append(unique)
    return out


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Put a source prefix before every name that does not carry it yet."""
    return df.toDF(*(name if name.startswith(prefix) else prefix + name for name in df.columns))


def stamp(df: DataFrame, **values: Column | None) -> DataFrame:
    """Add bookkeeping columns; a value of None stands for the current time."""
    return df.withColumns({name: F.current_timestamp() if v is None else v for name, v in values.items()})
