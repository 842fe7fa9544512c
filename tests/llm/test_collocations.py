"""Collocations against a plain count of every phrase."""

import random
import re
from collections import Counter

import pytest

from leadmill.llm.collocations import collocations, frequent_phrases


def plain(rows, least, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang or "und"] += len(ws)
            f.update((lang or "und", tuple(ws[i:i + m])) for m in range(1, 5) for i in range(len(ws) - m + 1))
    out = []
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    for (lang, p), a in cand.items():
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        if not any(lg == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for (lg, q), b in cand.items()):
            out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    got = []
    for lang in {r[0] for r in out}:
        for rank, r in enumerate(sorted(x for x in out if x[0] == lang)[:top], 1):
            got.append((lang, rank, r[3].decode(), -r[2], r[4], r[5], r[6], -r[1]))
    return sorted(got)


def rows_of(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "B", "the", "über", "Ünder", "x-1", "of", "<s>", "10", "c"]
    return [(i if i % 7 else None, rng.choice([None, "", "x " * 3000, *([None] * 0)]) if i % 29 == 0 else
             "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ","]) for _ in range(40)),
             rng.choice(["en", "de", None, "und"])) for i in range(n)]


@pytest.mark.parametrize("bits", [64, 9])
def test_equals_a_plain_count(spark, bits):
    """Nine bits make unlike phrases share fingerprints, so that they are told apart by their texts."""
    rows = rows_of(1)
    rows += rows[:20]
    df = spark.createDataFrame([(i, t, g, "x", 2) for i, t, g in rows], "doc_id long, text string, lang string, fp string, n int").repartition(5)
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations(df, 5, 2000, bits).collect())
    assert got == plain(rows, 5) and got


def test_top_and_no_candidates(spark):
    rows = rows_of(2)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations(df, 5, 3).collect())
    assert got == plain(rows, 5, 3)
    assert collocations(df.where("false")).count() == 0
    assert collocations(df.limit(3)).count() == 0


def test_frequent_phrases_are_whole(spark):
    rows = [(i, "alpha beta gamma delta epsilon", "en") for i in range(40)]
    phrases, totals = frequent_phrases(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {(r.phrase, r.f) for r in phrases.collect()} == {
        (" ".join("alpha beta gamma delta epsilon".split()[i:i + m]), 40) for m in range(1, 5) for i in range(6 - m)}
    assert [tuple(r) for r in totals.collect()] == [("en", 200)]
