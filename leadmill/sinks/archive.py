"""K-6: processed files move to the folder ``Processed`` beside them, moved by tasks, one file a call.

A move can be repeated after any failure: a file that is no longer at its source but at its target has been moved. In
stores that copy and delete, a move that was cut leaves both; if their contents are equal the source goes. If the target holds
another file of that name, the source stays where it is and the outcome says so: nothing is ever overwritten.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import filesystem_of, spread

PROCESSED = "Processed"
MOVED, MOVED_BEFORE, ABSENT, NAME_TAKEN = "moved", "moved before", "absent", "name taken"
CHUNK = 1 << 20


def processed_path(path: Column) -> Column:
    """``<folder>/Processed/<name>`` of a file's path."""
    return F.regexp_replace(path, r"/([^/]+)$", f"/{PROCESSED}/$1")


def not_processed(path: Column) -> Column:
    """Whether a path lies outside all ``Processed`` folders (listings never enter them, S-2)."""
    return ~F.contains(path, F.lit(f"/{PROCESSED}/"))


def _same_content(fs, a: str, b: str) -> bool:
    with fs.open_input_stream(a) as x, fs.open_input_stream(b) as y:
        while True:
            p, q = x.read(CHUNK), y.read(CHUNK)
            if p != q:
                return False
            if not p:
                return True


def move_file(source: str, target: str) -> str:
    """Move one file within its store; the outcome as text."""
    fs, a = filesystem_of(source)
    _, b = filesystem_of(target)
    at_source, at_target = (i.is_file for i in fs.get_file_info([a, b]))
    if not at_source:
        return MOVED_BEFORE if at_target else ABSENT
    if at_target:
        if not _same_content(fs, a, b):
            return NAME_TAKEN
        fs.delete_file(a)
        return MOVED
    fs.create_dir(b.rsplit("/", 1)[0], recursive=True)
    try:
        fs.move(a, b)
    except FileNotFoundError:           # another attempt of this task was faster
        return MOVED_BEFORE
    return MOVED


def _move(batches):
    for pdf in batches:
        yield pd.DataFrame({"source": pdf["source"], "target": pdf["target"],
                            "outcome": [move_file(s, t) for s, t in zip(pdf["source"], pdf["target"])]})


def move_processed(files: DataFrame) -> DataFrame:
    """(source, target, outcome) of the move of each file of ``files`` (column ``path``). The files move when an action
    runs, so write the result once; a null path has no row."""
    paths = spread(files.where(F.col("path").isNotNull() & not_processed(F.col("path"))).select("path"), "path").distinct()
    pairs = paths.select(F.col("path").alias("source"), processed_path(F.col("path")).alias("target"))
    return pairs.mapInPandas(_move, "source string, target string, outcome string")
