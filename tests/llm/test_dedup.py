"""Near-dedup, substring dedup and decontamination: brute force and edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from leadmill.llm.components import components
from leadmill.llm.decontaminate import drop_leaks, find_leaks, window_keys
from leadmill.llm.near_dups import STEP, Sampler, _likely_pairs, duplicate_classes, keep_one_of_each, weighted_jaccard
from leadmill.llm.substrings import greedy_factors, remove_repeats
from leadmill.llm.tokens import Words

R = random.Random(5)
WORD = [f"w{i}" for i in range(4000)]


def prose(n):
    return " ".join(R.choice(WORD) for _ in range(n))


def edited(t, k):
    ws = t.split()
    for i in R.sample(range(len(ws)), k):
        ws[i] = "edit" + str(R.random())
    return " ".join(ws)


def shingle_set(t):
    ws = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())


def test_word_hashes_follow_words():
    texts = ["a b\tc", None, "", "  x y ", "b a", "long" * 300_000 + " tail", "\x1c a"]
    w = Words(pa.array(texts, pa.string()))
    h = w.hashes()
    words = [x for t in texts for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert len(h) == len(words) and np.diff(w.first).tolist() == [3, 0, 0, 1, 2, 2, 2]
    known = {}
    for x, v in zip(words, h.tolist()):
        assert known.setdefault(x, v) == v
    assert len(set(known.values())) == len(known)
    sliced = pa.array(texts, pa.string()).slice(3, 2)
    assert Words(sliced).hashes().tolist() == h[3:6].tolist()


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(40):
        x = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        lv = rng.integers(0, 20, 300).astype(np.uint8)
        y, ly = x[60:].copy(), lv[60:].copy()
        ly[:50] += 4
        s = Sampler().sample(np.concatenate([x, y]), np.concatenate([lv, ly]), np.array([0, 300]))
        order, o2 = np.argsort(x), np.argsort(y)
        agree.append((s[:, 0] == s[:, 1]).mean() - weighted_jaccard(x[order], lv[order], y[o2], ly[o2]))
    assert abs(np.mean(agree)) < 0.02
    assert abs(weighted_jaccard(x, lv, x, lv) - 1) < 1e-9 and STEP > 0


def test_classes_match_brute_force(spark, docs):
    base = [prose(R.randint(30, 200)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, edited(t, max(1, len(t.split()) // 80))) for i, t in enumerate(base[:15])]
    rows += [(200 + i, t) for i, t in enumerate(base[:5])] + [(300 + i, edited(base[20], 1)) for i in range(30)]
    rows += [(400, None), (401, None), (402, ""), (403, ""), (404, "one two"), (405, "one two"), (406, "two one"), (407, " "), (7, base[7]), (None, base[3])]
    got = {}
    for r in duplicate_classes(docs(rows)).collect():
        got.setdefault(r["doc_id"], set()).add(r["class_id"])
    sets = [(i, shingle_set(t), t) for i, t in rows if t is not None and i is not None]
    root = {i: i for i, _, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    unsure = set()
    for a, (i, s, t) in enumerate(sets):
        for j, u, v in sets[:a]:
            sim = len(s & u) / len(s | u) if s | u else float(t == v)
            if t == v or sim >= 0.84:
                x, y = sorted((find(i), find(j)))
                root[y] = x
            elif sim > 0.74:
                unsure |= {i, j}
    unsure = {find(i) for i in unsure}
    for i, _, _ in sets:
        if find(i) not in unsure:
            assert got[i] == {find(i)}, i
    assert got[400] == {400} and got[401] == {401} and got[None] == {3}


def test_families_without_a_common_original_are_one_class(docs):
    """Versions that drift: next ones share 0.9 or 0.8 of their shingles, further ones less. And two groups of copies
    whose originals share 0.73; only one text of either, linked to its original besides, reaches 0.82."""
    families = []
    for n in [2000, 20, 20]:
        ws = prose(200 + 10 * n).split()
        families.append([" ".join(ws[10 * i:10 * i + 200]) for i in range(n)])
    for _ in range(12):
        common, family = prose(170), []
        for _ in range(2):
            bridge = common + " " + prose(17)
            original = bridge + " " + prose(14)
            family += [bridge, original] + [edited(original, 1) for _ in range(30)]
        families.append(family)
    rows = [(10_000 * k + i, t) for k, family in enumerate(families) for i, t in enumerate(family)]
    classes = {}
    for r in duplicate_classes(docs(rows)).collect():
        classes.setdefault(r["doc_id"] // 10_000, set()).add(r["class_id"])
    assert len(classes) == len(families) and all(len(c) == 1 for c in classes.values()), {k: len(c) for k, c in classes.items()}


def test_pairs_in_crowded_buckets_are_found(docs):
    """A page template of 0.7 to each other with few true pairs at 0.83."""
    common = prose(180)
    rows = [(i, common + " " + prose(20)) for i in range(400)]
    rows += [(1000 + i, edited(rows[i][1][:len(common)], 3) + rows[i][1][len(common):]) for i in range(100)]
    got = {r["doc_id"]: r["class_id"] for r in duplicate_classes(docs(rows)).collect()}
    assert got == {i: i % 1000 for i, _ in rows}


def test_block_bound_misses_no_pair():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 1 << 32, 300, dtype=np.uint32))
    ids, lvs = [], []
    for _ in range(60):
        x = np.unique(np.concatenate([rng.choice(base, 290, replace=False), rng.integers(0, 1 << 32, rng.integers(1, 40), dtype=np.uint32)]))
        ids.append(x)
        lvs.append(np.where(rng.random(len(x)) < 0.02, 20, 5).astype(np.uint8))
    a, b = np.arange(30), np.arange(30, 60)
    likely = {tuple(x) for x in _likely_pairs(ids, [np.exp(v * STEP) for v in lvs], a, b).tolist()}
    real = {(i, j) for i in range(30) for j in range(30) if weighted_jaccard(ids[i], lvs[i], ids[30 + j], lvs[30 + j]) >= 0.8}
    assert real and real <= likely and len(likely) < 900


def test_one_of_each_class_stays(docs):
    t = prose(80)
    rows = [(5, t), (3, t), (3, t), (9, edited(t, 1)), (1, prose(60)), (2, None), (2, None), (None, t), (6, "")]
    df = docs(rows)
    out = keep_one_of_each(df)
    assert out.columns == df.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({3: 1, 1: 1, 2: 2, None: 1, 6: 1})
    assert keep_one_of_each(docs([])).count() == 0 and duplicate_classes(docs([])).count() == 0


def test_unlike_texts_of_one_id_are_judged_each(docs):
    t, u = prose(80), prose(80)
    rows = [(7, edited(t, 1)), (7, u), (1, t), (8, prose(60)), (8, prose(60)), (9, u)]
    got = Counter((r["doc_id"], r["text"]) for r in keep_one_of_each(docs(rows)).collect())
    assert got == Counter(rows[i] for i in (1, 2, 3, 4))


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 50), (70, 71), (71, 72), (90, 72)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and got[60] == 50 and got[90] == 70


def repeats_by_hand(rows):
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, ws in split:
        if i is not None:
            for k in range(len(ws) - 12):
                w = tuple(ws[k:k + 13])
                first[w] = min(first.get(w, i), i)
    out = []
    for i, ws in split:
        keep = [True] * len(ws)
        for k in range(len(ws) - 12):
            if i is not None and first[tuple(ws[k:k + 13])] < i:
                keep[k:k + 13] = [False] * 13
        out.append((i, len(ws), keep.count(False), " ".join(w for w, k in zip(ws, keep) if k)))
    return Counter(out)


def test_repeats_match_brute_force(docs):
    passage, lines = prose(60), [prose(13) for _ in range(4)]
    rows = [(i, prose(R.randint(0, 60)) + "\n" + passage + " " + prose(R.randint(0, 60))) for i in range(8)]
    rows += [(20 + i, prose(20) + " " + lines[i % 4] + "\t" + lines[(i + 1) % 4] + " " + prose(5)) for i in range(12)]
    rows += [(40 + i, edited(rows[2][1], 2)) for i in range(6)] + [(50, rows[3][1]), (51, rows[3][1]), (51, rows[3][1]), (2, lines[0] + " " + passage)]
    rows += [(60, None), (61, ""), (62, passage + " " + passage), (None, passage), (63, " ".join(passage.split()[:12])), (-5, lines[2]), (64, "z " * 40), (65, "z " * 14)]
    R.shuffle(rows)
    got = remove_repeats(docs(rows)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == repeats_by_hand(rows)
    for r in got:
        covered = {p for f in r["factors"] for p in range(f["start"], f["end"])}
        assert len(covered) == r["n_removed"] and all(f["ref"] < r["doc_id"] for f in r["factors"])
    assert remove_repeats(docs([])).count() == 0


def test_factors_end_where_the_reference_changes():
    assert greedy_factors(np.array([3, 4, 5, 9]), np.array([1, 1, 2, 2])) == [(3, 17, 1), (5, 18, 2), (9, 22, 2)]


def test_leaks_match_brute_force(spark, docs):
    items = [(i, prose(n)) for i, n in enumerate([6, 9, 17, 30, 64, 300, 5, 3, 40])] + [(9, None), (10, ""), (2, None)]
    rows = [(i, prose(R.randint(0, 500)) + " " + t + " " + prose(R.randint(0, 700))) for i, t in items if t]
    rows += [(50, prose(200) + " " + edited(items[5][1], 3) + " " + prose(90)), (51, " ".join(items[4][1].split()[:40])),
             (52, edited(items[8][1], 1)), (53, None), (54, ""), (55, prose(3000) + " " + items[3][1]), (55, prose(10) + " " + items[2][1]), (None, items[4][1])]
    rows += [(100 + i, prose(150)) for i in range(20)]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, fp string")
    got = Counter((r["doc_id"], r["item_id"], r["n_shared"]) for r in find_leaks(docs(rows), bench).collect())
    want = Counter()
    five = lambda t: {s for s in shingle_set(t) if len(s) == 5}
    for i, t in rows:
        for j, u in items:
            a, b = five(t), five(u)
            if b and len(a & b) / len(b) >= 0.8:
                want[i, j, len(a & b)] += 1
    assert got == want
    clean = drop_leaks(docs(rows), bench)
    bad = {(i, t) for i, t in rows if any(five(u) and len(five(t) & five(u)) / len(five(u)) >= 0.8 for _, u in items)}
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(i for i, t in rows if (i, t) not in bad)
    assert clean.columns == docs(rows).columns
    assert find_leaks(docs([]), bench).count() == 0 and find_leaks(docs(rows), bench.where("false")).count() == 0


def test_windows_cover_every_place():
    x = np.arange(1, 60_000, dtype=np.uint64)
    hit = np.zeros(len(x), bool)
    hit[20_000:20_020] = True
    near = window_keys(x, hit, 4)
    alone = window_keys(x[19_900:20_100], hit[19_900:20_100], 4)
    assert len(near) and len(np.intersect1d(near, alone)) > 0
