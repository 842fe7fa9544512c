"""Sharding (operator 10): minimax contiguous partition of atomic groups of equal texts.

Groups are ordered by the SHA-256 of their text, a total order that spreads evenly, so any prefix of the
digest is a range of the order. The smallest feasible capacity is found by binary search; a candidate
is checked greedily (each shard takes groups until the next one would not fit). Groups stay on the
cluster: the search sees digest ranges with their sums, and asks for a finer split only of those
ranges in which a cut can still fall. What reaches the driver is bounded by the parameters below.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import settle

FIRST_DIGITS = 3        # the first split: 16**3 ranges of the digest
MORE_DIGITS = 2         # each finer split: 16**2 parts of an open range
OPEN_AT_ONCE = 1_000    # ranges split in one round; the others wait for the next round
WHOLE_BELOW = 50_000    # open ranges with fewer groups in total are listed group by group
NULL_KEY = "-"          # the group of null texts; sorts before every digest


@dataclass(frozen=True)
class Unit:
    """A digest range: its prefix, total size, number of groups and largest group."""
    prefix: str
    size: int
    groups: int
    largest: int


def group_key(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(NULL_KEY)).otherwise(F.sha2(text, 256))


def _units(groups: DataFrame, prefix: Column) -> list[Unit]:
    rows = groups.groupBy(prefix.alias("p")).agg(
        F.sum("g_size").alias("s"), F.count(F.lit(1)).alias("n"), F.max("g_size").alias("m")).collect()
    return [Unit(r["p"], int(r["s"]), int(r["n"]), int(r["m"])) for r in rows]


def greedy_ends(ends: list[int], capacity: int, n_shards: int) -> list[int] | None:
    """Positions (counts of units) after which shards end, or None if n_shards do not suffice."""
    cuts, pos, filled = [], 0, 0
    for _ in range(n_shards):
        nxt = bisect.bisect_right(ends, filled + capacity)
        if nxt == pos and pos < len(ends):
            return None
        pos = nxt
        filled = ends[pos - 1] if pos else 0
        cuts.append(pos)
    return cuts if pos == len(ends) else None


def smallest_capacity(sizes: list[int], n_shards: int) -> int:
    """Binary search for the least capacity with which n_shards contiguous shards hold all sizes."""
    ends, total = [], 0
    for s in sizes:
        total += s
        ends.append(total)
    lo, hi = max([math.ceil(total / n_shards), *sizes], default=0), total
    while lo < hi:
        mid = (lo + hi) // 2
        if greedy_ends(ends, mid, n_shards) is None:
            lo = mid + 1
        else:
            hi = mid
    return lo


def _open_units(units: list[Unit], n_shards: int) -> tuple[int, list[Unit]]:
    """The least capacity over whole units, and the units in which an exact cut could still fall.

    The exact capacity lies between ``least`` and that capacity. For every capacity between them, the
    j-th greedy cut lies between ``low`` and ``high``, both taken at unit borders.
    """
    sizes = [u.size for u in units]
    cap = smallest_capacity(sizes, n_shards)
    ends = []
    total = 0
    for s in sizes:
        total += s
        ends.append(total)
    least = max([math.ceil(total / n_shards), *(u.largest for u in units)], default=0)
    found: set[int] = set()
    low = high = 0
    for _ in range(n_shards - 1):
        k = bisect.bisect_right(ends, low + least)
        low = ends[k - 1] if k else 0
        k = bisect.bisect_left(ends, high + cap)
        high = ends[min(k, len(ends) - 1)] if ends else 0
        first, last = bisect.bisect_right(ends, low), bisect.bisect_left(ends, high)
        found.update(range(first, min(last, len(units) - 1) + 1))
    return cap, [units[i] for i in sorted(found) if units[i].groups > 1]


def find_cuts(groups: DataFrame, n_shards: int) -> list[str]:
    """First keys (or digest prefixes) of shards 1 … n-1, for groups(gkey, g_size)."""
    key = F.col("gkey")
    units = sorted(_units(groups, F.substring(key, 1, FIRST_DIGITS)), key=lambda u: u.prefix)
    while True:
        cap, todo = _open_units(units, n_shards)
        if not todo:
            break
        if sum(u.groups for u in todo) > WHOLE_BELOW:
            todo = sorted(todo, key=lambda u: -u.size)[:OPEN_AT_ONCE]
            finer = {u.prefix: len(u.prefix) + MORE_DIGITS for u in todo}
        else:
            finer = {u.prefix: 64 for u in todo}
        by_len: dict[int, list[str]] = {}
        for u in todo:
            by_len.setdefault(len(u.prefix), []).append(u.prefix)
        inside, prefix = F.lit(False), key
        for n, ps in by_len.items():
            hit = F.substring(key, 1, n).isin(ps)
            inside = inside | hit
            prefix = F.when(hit, F.substring(key, 1, finer[ps[0]])).otherwise(prefix)
        gone = set(finer)
        units = sorted([u for u in units if u.prefix not in gone] + _units(groups.where(inside), prefix),
                       key=lambda u: u.prefix)
    ends, total = [], 0
    for u in units:
        total += u.size
        ends.append(total)
    cuts = greedy_ends(ends, cap, n_shards) or []
    return [units[c].prefix for c in cuts[:-1] if c < len(units)]


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every row; equal texts share a shard; the largest shard is as small as can be.

    Law: ``bytes``. Size of a row: UTF-8 bytes of its text plus 1. Null texts form one group (size 1 a
    row, CRC of the empty string); empty texts form another. Rows with equal ids and texts each get a
    slot of their own; null ids are ordinary values. An empty table gives an empty result. Columns other
    than the id and the text are not read. If one group is larger than a fair share, the capacity is
    that group's size. Shards past the last group stay empty.

    Slots number the rows of a shard from 0 without gaps: rows are spread over hash parts, numbered
    inside each part, and moved by the rows of the parts before it; so no task takes a whole shard.
    """
    text = F.col(text_col)
    rows = settle(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        group_key(text).alias("gkey")))
    groups = settle(rows.groupBy("gkey").agg(F.sum("size").alias("g_size"), F.count(F.lit(1)).alias("g_rows")))
    n_rows = groups.agg(F.sum("g_rows")).first()[0] or 0
    cuts = find_cuts(groups, n_shards)
    shard = F.lit(0)
    for c in cuts:
        shard = shard + F.when(F.col("gkey") >= c, 1).otherwise(0)
    parts = max(1, math.isqrt(n_rows))
    placed = rows.withColumn("shard", shard.cast("int")).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "gkey"), F.lit(parts)).cast("int"))
    before = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = before.withColumn("first_slot", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "gkey")
    return (placed.withColumn("at", F.row_number().over(inside) - 1)
            .join(before, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first_slot") + F.col("at")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
