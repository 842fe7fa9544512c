"""P-1: header normaliser. Column names are metadata, so this runs on the driver over names only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Fixed values (must equal the reference's): each whitespace character, '-', '.', '(', ')' and the
# two-character text '|/' become '_'; then one left-to-right pass of '__' -> '_'; trailing '_' removed.
_SEPARATORS = re.compile(r"\s|-|\|/|\.|\(|\)")


def clean_name(name: str) -> str:
    n = _SEPARATORS.sub("_", name.strip().lower())
    return n.replace("__", "_").rstrip("_")


class HeaderCollision(ValueError):
    pass


def clean_names(names: list[str]) -> list[str]:
    """Clean a header list; two source headers cleaning to one name is an error (Q14)."""
    out = [clean_name(n) for n in names]
    seen: dict[str, str] = {}
    for src, dst in zip(names, out):
        if dst in seen:
            raise HeaderCollision(f"headers {seen[dst]!r} and {src!r} both clean to {dst!r}")
        seen[dst] = src
    return out


def clean_headers(df: DataFrame) -> DataFrame:
    """Rename every column of ``df`` to its cleaned name (positional ``toDF``, no data touched)."""
    return df.toDF(*clean_names(df.columns))
