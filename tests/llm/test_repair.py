"""Conversation repair against brute force over all edit sequences."""

import hashlib
import itertools
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from leadmill.llm.repair import START, TO_END, _steps, crossings, letters_of, repair_conversations, repair_report

RIGHT = re.compile(r"(s?(ua)+)?$")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute(rows):
    """(cost, letters, repaired) of rows (initial, must go, cut): every choice of edits with up to two inserts in each gap."""
    best = None
    inserts = ["", "u", "a", "ua", "au"]
    choices = [[("D", "", 3)] if must else [("D", "", 3), ("K", i, int(cut)), ("R", "u", 2 + cut), ("R", "a", 2 + cut)]
               for i, must, cut in rows]
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for picked in itertools.product(*choices):
            out, letters, cost = gaps[0], "I" * len(gaps[0]), 2 * len(gaps[0])
            for (letter, role, more), gap in zip(picked, gaps[1:]):
                out, letters, cost = out + role + gap, letters + letter + "I" * len(gap), cost + more + 2 * len(gap)
            if RIGHT.match(out) and (best is None or (cost, letters) < best[:2]):
                best = cost, letters, out
    return best


@pytest.mark.parametrize("seed", range(12))
def test_cheapest_edits_with_least_letters(seed):
    rng = random.Random(seed)
    rows = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(1, 4))]
    codes = [("sua".find(i) if i in "sua" else 3) + 4 * must + 8 * cut for i, must, cut in rows]
    steps = _steps(codes)
    letters, state = letters_of(steps, START, TO_END)
    cost = sum(steps[i][s][t][0] for i, (s, t) in enumerate(itertools.pairwise([START, *crossings(steps, START, TO_END)])))
    want = brute(rows)
    assert (cost + TO_END[state], "".join(letters) + "I" * (TO_END[state] // 2)) == want[:2]


def whole_table(codes):
    """Least (cost, letters) by a forward table that keeps every sequence."""
    best = {START: (0, "")}
    for step in _steps(codes):
        new = {}
        for s, (c, a) in best.items():
            for t, (more, letters) in step[s].items():
                new[t] = min(new.get(t, (1 << 60, "")), (c + more, a + letters))
        best = new
    return min((c + TO_END[s], a + "I" * (TO_END[s] // 2)) for s, (c, a) in best.items())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 15), max_size=60))
def test_divided_search_equals_the_whole_table(codes):
    steps = _steps(codes)
    letters, state = letters_of(steps, START, TO_END)
    assert "".join(letters) + "I" * (TO_END[state] // 2) == whole_table(codes)[1]


def fold(rows):
    """Straight reading of the definition for one conversation's ordered rows (turn, role, text)."""
    faults, seen = [], set()
    for _, role, text in rows:
        stripped = WORD.findall(text)
        faults.append("blank" if not stripped else "duplicate" if (role, text) in seen
                      else "truncated" if stripped[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


@pytest.mark.parametrize("block", [3, 4096])
def test_long_and_odd_conversations(spark, block):
    """Blocks and partitions that cut conversations do not change a result."""
    rng = random.Random(5)
    rows = [(c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", "system", "tool", "", None]),
             rng.choice(["Yes.", "no", "", " \n", None, "a. b", f"text {rng.randint(0, 9)}!"]))
            for c in (1, 2, None) for t in range(70 if c else 9)] + [(7, 1, "user", "x " * 50000 + "."), (7, 1, "user", "x " * 50000 + ".")]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, fp int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    audits, reports, repaired = repair_conversations(df, block)
    got = {}
    for r in sorted(audits.collect(), key=lambda r: (r.part, r.blk)):
        got[r.conv] = got.get(r.conv, "") + r.audit
    texts = {}
    for r in sorted(repaired.collect(), key=lambda r: (r.part, r.blk, r["at"])):
        texts.setdefault(r.conv, []).append((r.role, r.text))
    report = {r.conv: r for r in reports.collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for conv in {r[0] for r in rows}:
        key = "" if conv is None else f"c{conv}"
        mine = sorted([(t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv],
                      key=lambda r: (r[0], r[1], r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        faults = fold([(t, r, x) for _, t, r, x in mine])
        codes = [("sua".find(r[:1]) if r[:1] and r[:1] in "sua" else 3) + 4 * (f in ("blank", "duplicate")) + 8 * (f == "truncated")
                 for (_, _, r, _), f in zip(mine, faults)]
        cost, audit = whole_table(codes)
        assert got[key] == audit
        have = report[key]
        assert (have.cost, have.blank, have.duplicate, have.truncated) == (cost, *(faults.count(f) for f in ("blank", "duplicate", "truncated")))
        turns = [t for there, t, _, _ in mine if there]
        assert have.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert have.illegal == sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        out, left = [], list(mine)
        for letter in audit:
            row = None if letter == "I" else left.pop(0)
            if letter == "D":
                continue
            want = "assistant" if out and out[-1][0][0] == "u" else "user"
            out.append((row[2] if letter == "K" else want, "" if row is None else row[3]))
        assert texts.get(key, []) == out and RIGHT.match("".join(r[0] for r, _ in out))


def test_report_of_empty_and_vanished_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair_report(spark.createDataFrame([], schema)).count() == 0
    import zlib
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = repair_report(spark.createDataFrame([(conv, 0, "user", "a.")], schema)).collect()[0]
    assert (row.conv_id, row.cost, row.audit) == (conv, 0, "") and row.repaired_sha256 == hashlib.sha256(b"").hexdigest()
