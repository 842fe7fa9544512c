"""Conversation structure repair (operator 13): cheapest edits by Hirschberg's divide and conquer.

A conversation is right if the initials of its roles give ``(s?(ua)+)?``. The automaton has four states: START,
SYSTEM (after s), USER (after u) and DONE (after a); START and DONE accept. Each row is kept (K, 0), given
another role (R, 2) or deleted (D, 3), and user or assistant turns with an empty text are inserted (I, 2). A cut
row that stays costs 1 more; blank and duplicate rows must go. Of equally cheap edits those whose letters are
least in ASCII count. A letter leaves only one state to go to, so the letters name the repaired conversation.

1. Rows are reduced to narrow records (role, digest of the text, faults), and equal ones to one with a count.
2. Records are ordered by a range partitioning over (conversation, turn, role, digest): a long conversation is
   spread over tasks. Each task packs runs of at most ``BLOCK`` records of a conversation into a block, with
   the block's 4 x 4 matrix of least costs (a state before to a state after), and the order of their letters.
3. One task gets the matrices of all blocks of a conversation (some 100 bytes per BLOCK rows, no texts)
   and finds the states between blocks; most conversations are one block.
4. Each block then finds its own edits, again with the states at both ends fixed.

Steps 3 and 4 are the same search (``crossings``): a forward cost vector over the four states from the left
and a backward one from the right meet in the middle; of the states that give the least sum the one whose
letters from the left are least is chosen; both halves are then solved alone. Forward vectors carry the
order of the four letter sequences beside the costs, so no sequence is stored: memory is linear. Sequences
are compared where a row has just been used up, so none is the beginning of another.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import settle

START, SYSTEM, USER, DONE = range(4)
FAR = 1 << 60
BLOCK = 4096
INITIALS = "sua"                 # code 0, 1, 2; any other initial is 3
ROLES = {"u": "user", "a": "assistant"}
NEXT_ROLE = {START: "u", SYSTEM: "u", DONE: "u", USER: "a"}
AFTER = {"s": SYSTEM, "u": USER, "a": DONE}
LEGAL = {"su", "ua", "au"}
TO_END = (0, 4, 2, 0)            # inserts that close a conversation after its last row
NO_BLANK = r"[^\x20\x09-\x0D]"
CUT_END = r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"


@functools.cache
def row_steps(initial: int, must_go: bool, cut: bool) -> tuple:
    """For each state before the row: {state after: (cost, letters)}, inserts before the row included."""
    steps = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}
        at, cost, letters = state, 0, ""
        for _ in range(3):
            options = [(at, 3, "D")]
            if not must_go:
                role = INITIALS[initial] if initial < 3 else ""
                if role == NEXT_ROLE[at] or (role == "s" and at == START):
                    options.append((AFTER[role], int(cut), "K"))
                options.append((AFTER[NEXT_ROLE[at]], 2 + int(cut), "R"))
            for to, more, letter in options:
                found = (cost + more, letters + letter)
                best[to] = min(best.get(to, found), found)
            at, cost, letters = AFTER[NEXT_ROLE[at]], cost + 2, letters + "I"
        steps.append(best)
    return tuple(steps)


def _forward(steps, lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Least costs from ``start`` before step lo to each state after step hi - 1, and the order of their letters."""
    cost, rank = [FAR] * 4, [0] * 4
    cost[start] = 0
    for i in range(lo, hi):
        best: list = [None] * 4
        for state in range(4):
            if cost[state] < FAR:
                for to, (more, letters) in steps[i][state].items():
                    found = (cost[state] + more, rank[state], letters)
                    if best[to] is None or found < best[to]:
                        best[to] = found
        order = sorted({b[1:] for b in best if b is not None})
        cost = [FAR if b is None else b[0] for b in best]
        rank = [0 if b is None else order.index(b[1:]) for b in best]
    return cost, rank


def _backward(steps, lo: int, hi: int, end) -> list[int]:
    """Least costs from each state before step lo to the end costs after step hi - 1."""
    cost = list(end)
    for i in range(hi - 1, lo - 1, -1):
        cost = [min((more + cost[to] for to, (more, _) in steps[i][state].items()), default=FAR) for state in range(4)]
    return cost


def crossings(steps, start: int, end) -> list[int]:
    """The states after each step on the cheapest way from ``start`` to the end costs, of equal ones the one
    with the least letters. Divide and conquer, without recursion into Python's stack limit."""
    states = [0] * len(steps)
    open_parts = [(0, len(steps), start, tuple(end))] if steps else []
    while open_parts:
        lo, hi, first, last = open_parts.pop()
        mid = (lo + hi + 1) // 2
        cost, rank = _forward(steps, lo, mid, first)
        back = _backward(steps, mid, hi, last)
        least = min(a + b for a, b in zip(cost, back))
        state = min((rank[s], s) for s in range(4) if cost[s] < FAR and cost[s] + back[s] == least)[1]
        states[mid - 1] = state
        only = tuple(0 if s == state else FAR for s in range(4))
        if mid - lo > 1:
            open_parts.append((lo, mid, first, only))
        if hi - mid > 0:
            open_parts.append((mid, hi, state, last))
    return states


def block_matrix(steps) -> tuple[list[int], list[int]]:
    """Costs and letter order from each of the four states to each, row by row."""
    out = [_forward(steps, 0, len(steps), s) for s in range(4)]
    return [c for cost, _ in out for c in cost], [r for _, rank in out for r in rank]


def letters_of(steps, start: int, end) -> tuple[list[str], int]:
    """Letters of each step (inserts before a row are its first letters), and the state after the last."""
    out, state = [], start
    for step, to in zip(steps, crossings(steps, start, end)):
        out.append(step[state][to][1])
        state = to
    return out, state


def _steps(codes: np.ndarray) -> list:
    """One step for each row: code = initial + 4 * must go + 8 * cut."""
    return [row_steps(int(c) & 3, bool(c & 4), bool(c & 8)) for c in codes]


_BLOCKS = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("blk", pa.int64()), ("codes", pa.binary()),
                     ("copies", pa.list_(pa.int64())), ("turn", pa.list_(pa.int64())), ("role", pa.list_(pa.string())),
                     ("fp", pa.list_(pa.binary())), ("cost", pa.list_(pa.int64())), ("rank", pa.list_(pa.int32())),
                     ("first_role", pa.string()), ("last_role", pa.string()), ("illegal", pa.int64()),
                     ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
                     ("n_blank", pa.int64()), ("n_duplicate", pa.int64()), ("n_cut", pa.int64())])
_BLOCKS_SQL = ("conv string, part int, blk long, codes binary, copies array<long>, turn array<long>, role array<string>, "
               "fp array<binary>, cost array<long>, rank array<int>, first_role string, last_role string, illegal long, "
               "first_turn long, last_turn long, turns long, n_blank long, n_duplicate long, n_cut long")
_RECORD = ["turn", "role", "fp", "n", "blank", "cut", "again"]


def _block(conv, part: int, blk: int, rows: list) -> dict:
    """A block of ordered records (turn, role, fp, n, blank, cut, again)."""
    codes, illegal, turns, n_blank, n_dup, n_cut = bytearray(), 0, 0, 0, 0, 0
    copies, before, turn_before = [], None, None
    for turn, role, _, n, blank, cut, again in rows:
        initial = role[:1]
        illegal += (before is not None and before + initial not in LEGAL) + n - 1      # a copy follows its like
        before = initial
        turns += turn is not None and turn != turn_before
        turn_before = turn
        code = INITIALS.find(initial) if initial else -1
        codes.append((3 if code < 0 else code) + 4 * (blank or again) + 8 * cut)
        n_blank += n if blank else 0
        n_dup += 0 if blank else n if again else n - 1
        n_cut += cut and not blank and not again
        copies.append(n)
    # a first row that stays and its copies, which must go, are two steps
    cost, rank = block_matrix(_with_copies(codes, copies)[0])
    numbers = [r[0] for r in rows if r[0] is not None]
    return {"conv": conv, "part": part, "blk": blk, "codes": bytes(codes), "copies": copies, "turn": [r[0] for r in rows],
            "role": [r[1] for r in rows], "fp": [r[2] for r in rows], "cost": cost, "rank": rank,
            "first_role": rows[0][1][:1], "last_role": before, "illegal": illegal,
            "first_turn": numbers[0] if numbers else None, "last_turn": numbers[-1] if numbers else None, "turns": turns,
            "n_blank": n_blank, "n_duplicate": n_dup, "n_cut": n_cut}


def _with_copies(codes, copies) -> tuple[list, list[int]]:
    """Steps of the records, a record's further copies as one step that deletes them all; and each step's record."""
    steps, of = [], []
    for i, (code, n) in enumerate(zip(codes, copies)):
        steps.append(row_steps(code & 3, bool(code & 4), bool(code & 8)))
        of.append(i)
        if n > 1:
            steps.append(tuple({s: (3 * (n - 1), "D")} for s in range(4)))
            of.append(i)
    return steps, of


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blk, conv, held, out = TaskContext.get().partitionId(), 0, None, [], []
        for batch in batches:
            convs = batch.column("conv").to_pylist()
            for key, *row in zip(convs, *(batch.column(c).to_pylist() for c in _RECORD)):
                if held and (key != conv or len(held) >= size):
                    out.append(_block(conv, part, blk, held))
                    blk, held = blk + 1, []
                conv = key
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, _BLOCKS)
                out = []
        if held:
            yield pa.RecordBatch.from_pylist([_block(conv, part, blk, held)], _BLOCKS)
    return run


_CROSSED = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("blk", pa.int64()), ("entry", pa.int32()),
                      ("exit", pa.int32()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                      ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64())])
_CROSSED_SQL = ("conv string, part int, blk long, entry int, exit int, gaps long, blank long, duplicate long, "
                "truncated long, illegal long, cost long")


def _cross(conv, blocks: list[dict]) -> list[dict]:
    """Entry and exit state of each block of one conversation (exit -1: the conversation ends); the conversation's
    counts stand in its first block's row."""
    steps = [tuple({t: (b["cost"][4 * s + t], f"{b['rank'][4 * s + t]}") for t in range(4) if b["cost"][4 * s + t] < FAR}
                   for s in range(4)) for b in blocks]
    states = crossings(steps, START, TO_END)
    rows, at, cost = [], START, 0
    for step, b, to in zip(steps, blocks, states):
        rows.append({"conv": conv, "part": b["part"], "blk": b["blk"], "entry": at, "exit": to,
                     "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0})
        cost += step[at][to][0]
        at = to
    rows[-1]["exit"] = -1
    turns, last, illegal = 0, None, 0
    for i, b in enumerate(blocks):
        turns += b["turns"] - (last is not None and b["first_turn"] == last)
        last = last if b["last_turn"] is None else b["last_turn"]
        illegal += b["illegal"] + (i > 0 and blocks[i - 1]["last_role"] + b["first_role"] not in LEGAL)
    low = next((b["first_turn"] for b in blocks if b["first_turn"] is not None), None)
    rows[0] |= {"gaps": 0 if low is None else last - low + 1 - turns, "illegal": illegal, "cost": cost + TO_END[at],
                "blank": sum(b["n_blank"] for b in blocks), "duplicate": sum(b["n_duplicate"] for b in blocks),
                "truncated": sum(b["n_cut"] for b in blocks)}
    return rows


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, held, out = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv"] != conv:
                out += _cross(conv, held)
                held = []
            conv = row["conv"]
            held.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, _CROSSED)
            out = []
    if held:
        yield pa.RecordBatch.from_pylist(_cross(conv, held), _CROSSED)


_EDITS = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("blk", pa.int64()), ("audit", pa.string()),
                    ("edits", pa.list_(pa.struct([("at", pa.int32()), ("role", pa.string()), ("turn", pa.int64()),
                                                  ("old_role", pa.string()), ("fp", pa.binary())])))])
_EDITS_SQL = ("conv string, part int, blk long, audit string, "
              "edits array<struct<at:int,role:string,turn:long,old_role:string,fp:binary>>")


def _edit(row: dict) -> dict:
    """Letters of a block and the turns that stay: ``fp`` is null for inserted ones."""
    steps, of = _with_copies(row["codes"], row["copies"])
    final = TO_END if row["exit"] < 0 else tuple(0 if s == row["exit"] else FAR for s in range(4))
    letters, state = letters_of(steps, row["entry"], final)
    audit, edits, at, first = [], [], row["entry"], True
    for i, (found, record) in enumerate(zip(letters, of)):
        copy = i > 0 and of[i - 1] == record
        audit.append("D" * (row["copies"][record] - 1) if copy else found)
        for letter in "" if copy else found:
            role = row["role"][record]
            if letter == "D":
                continue
            if letter == "K":
                at = AFTER[role[:1]]
            else:
                initial = NEXT_ROLE[at]
                at, role = AFTER[initial], ROLES[initial]
            old = letter != "I"
            edits.append({"at": len(edits), "role": role, "turn": row["turn"][record] if old else None,
                          "old_role": row["role"][record] if old else None, "fp": row["fp"][record] if old else None})
    if row["exit"] < 0:
        for _ in range(TO_END[state] // 2):
            initial = NEXT_ROLE[at]
            at = AFTER[initial]
            audit.append("I")
            edits.append({"at": len(edits), "role": ROLES[initial], "turn": None, "old_role": None, "fp": None})
    return {"conv": row["conv"], "part": row["part"], "blk": row["blk"], "audit": "".join(audit), "edits": edits}


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            yield pa.RecordBatch.from_pylist([_edit(r) for r in batch.slice(at, 64).to_pylist()], _EDITS)


def conv_key(conv_id: Column) -> Column:
    """A key that is never null: null ids form one conversation."""
    return F.when(conv_id.isNull(), "").otherwise(F.concat(F.lit("c"), conv_id.cast("string")))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def repair_conversations(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From rows (conv_id, turn, role, text): ``audits``, ``reports`` and ``repaired``.

    ``audits``: conv, part, blk, audit: the edit letters of a block; a conversation's letters are those of its blocks
    by (part, blk). ``reports``: one row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost.
    ``repaired``: conv, part, blk, at, role, text: the turns of the repaired conversation by (part, blk, at).
    ``conv`` is "" for a null conv_id, else "c" and the id; null ids form one conversation.

    Rows are taken by turn (nulls first), ties by role and by the text's SHA-256. Null roles and texts count as one
    space. Repeated rows are duplicates of the first. Empty texts are blank; very long texts are used whole, only
    their digests are sorted. An empty table gives empty results. Other columns are not read. A conversation
    of n rows may be as long as the table: its rows are spread over tasks; one task sees some n / ``block`` matrices.
    """
    said = rows.select(conv_key(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    said = said.withColumn("fp", _digest(F.col("text")))
    key = ["conv", "role", "fp"]
    one = said.select("conv", "turn", "role", "fp", (~F.col("text").rlike(NO_BLANK)).alias("blank"),
                      F.col("text").rlike(CUT_END).alias("cut")) \
        .groupBy("conv", "turn", "role", "fp").agg(F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    when = F.struct(F.col("turn").isNotNull().alias("there"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = one.groupBy(*key).agg(F.min(when).alias("first"))
    marked = one.join(first, key).select("conv", *_RECORD[:-1], (when != F.col("first")).alias("again"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "fp"]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = settle(dealt.mapInArrow(_blocks(block), _BLOCKS_SQL))
    narrow = [c for c in blocks.columns if c not in ("codes", "copies", "turn", "role", "fp")]
    crossed = settle(blocks.select(*narrow).repartition("conv").sortWithinPartitions("conv", "part", "blk").mapInArrow(_crossed, _CROSSED_SQL))
    edits = settle(blocks.select("conv", "part", "blk", "codes", "copies", "turn", "role", "fp")
                   .join(crossed.select("conv", "part", "blk", "entry", "exit"), ["conv", "part", "blk"]).mapInArrow(_edited, _EDITS_SQL))
    reports = crossed.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])
    turns = edits.select("conv", "part", "blk", F.explode("edits").alias("e")).select(
        "conv", "part", "blk", "e.at", F.col("e.role").alias("new_role"), "e.turn", F.col("e.old_role").alias("role"), "e.fp")
    texts = said.groupBy("conv", "turn", "role", "fp").agg(F.first("text").alias("text")).withColumn("none", F.col("turn").isNull()) \
        .withColumn("turn", F.coalesce("turn", F.lit(0)))
    stay = turns.where("fp is not null").withColumn("none", F.col("turn").isNull()).withColumn("turn", F.coalesce("turn", F.lit(0)))
    kept = stay.join(texts, ["conv", "none", "turn", "role", "fp"]).select("conv", "part", "blk", "at", F.col("new_role").alias("role"), "text")
    made = turns.where("fp is null").select("conv", "part", "blk", "at", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return edits.select("conv", "part", "blk", "audit"), reports, kept.union(made)


_DIGESTS = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation of ordered rows, one row at a time."""
    import hashlib
    conv, sha, out = None, None, []
    for batch in batches:
        for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
            line = f"{role}:{text}".encode()
            if sha is not None and key == conv:
                sha.update(b"\n" + line)
                continue
            if sha is not None:
                out.append({"conv": conv, "repaired_sha256": sha.hexdigest()})
            conv, sha = key, hashlib.sha256(line)
        yield pa.RecordBatch.from_pylist(out, _DIGESTS)
        out = []
    if sha is not None:
        yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": sha.hexdigest()}], _DIGESTS)


def damage(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults by crc32("conv_id:turn") % 20: 0 drops the row, 1 empties its text, 2 takes its
    ``[.!?]`` out, 3 repeats it, 4 makes its role user. Null ids, turns, roles and texts read as one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    df = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return df.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                     F.explode(F.expr("if(fault = 3, array(1, 2), array(1))")).alias("copy")).drop("copy")


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per original conv_id: the counts, the audit and the digest of the conversation as repaired after ``damage``."""
    audits, reports, repaired = repair_conversations(damage(rows))
    whole = audits.groupBy("conv").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "blk", "audit"))),
                                                                lambda x: x["audit"]), "").alias("audit"))
    digests = repaired.repartition("conv").sortWithinPartitions("conv", "part", "blk", "at").select(
        "conv", "role", "text").mapInArrow(_digests, "conv string, repaired_sha256 string")
    ids = rows.select("conv_id", conv_key(F.col("conv_id")).alias("conv")).distinct()
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(reports, "conv", "left").join(whole, "conv", "left").join(digests, "conv", "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
