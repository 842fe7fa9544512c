"""The Pitman-Yor model against enumeration, a customer-by-customer Gibbs sampler and plain counts."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from leadmill.llm.pitman_yor import END, STRENGTH, Seats, fit, score_documents
from leadmill.llm.tokens import Words


def partitions(n):
    """Sizes of the blocks of every partition of n customers."""
    def go(i, sizes):
        if i == n:
            yield tuple(sizes)
            return
        for j in range(len(sizes)):
            sizes[j] += 1
            yield from go(i + 1, sizes)
            sizes[j] -= 1
        yield from go(i + 1, [*sizes, 1])
    yield from go(0, [])


@pytest.mark.parametrize("c,d,a", [(2, 0.5, 0.3), (5, 0.8, 1.7), (6, 0.2, 0.05)])
def test_tables_follow_the_exact_distribution(c, d, a):
    weight = Counter()
    for sizes in partitions(c):
        weight[len(sizes)] += a ** len(sizes) * math.prod(math.prod(k - d for k in range(1, n)) for n in sizes)
    n = 100_000
    t = Seats(d).draw(np.full(n, c), np.full(n, a), np.random.Generator(np.random.PCG64(1)))
    for k in range(1, c + 1):
        p = weight[k] / sum(weight.values())
        assert abs((t == k).mean() - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_many_customers_sit_like_one_after_another():
    d, a, c, rng = 0.6, 40.0, 3000, random.Random(2)
    plain = []
    for _ in range(60):
        t = 1
        for i in range(1, c):
            t += rng.random() < a / (a + i - d * t)
        plain.append(t)
    t = Seats(d).draw(np.full(400, c), np.full(400, a), np.random.Generator(np.random.PCG64(1)))
    assert abs(t.mean() - np.mean(plain)) < 0.03 * np.mean(plain)


def tokens_of(text):
    low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\0end"]


def hash_of(token):
    import pyarrow as pa
    return END if token == "\0end" else Words(pa.array([token], pa.string())).hashes()[0]


class Textbook:
    """Chinese-restaurant seating, one customer at a time."""

    def __init__(self, model, seed):
        self.m, self.rng = model, random.Random(seed)
        self.seats = defaultdict(lambda: defaultdict(list))          # context -> word -> table sizes
        self.t, self.c = Counter(), Counter()

    def p(self, u, w):
        above = self.m.base if u == 0 else self.p(self.m.parent[u], w)
        d, tables = self.m.discount[self.m.level[u]], self.seats[u].get(w, [])
        return (sum(tables) - d * len(tables) + (STRENGTH + d * self.t[u]) * above) / (STRENGTH + self.c[u])

    def add(self, u, w):
        d, tables = self.m.discount[self.m.level[u]], self.seats[u][w]
        above = self.m.base if u == 0 else self.p(self.m.parent[u], w)
        k = self.rng.choices(range(len(tables) + 1), [n - d for n in tables] + [(STRENGTH + d * self.t[u]) * above])[0]
        self.c[u] += 1
        if k < len(tables):
            tables[k] += 1
            return
        tables.append(1)
        self.t[u] += 1
        if u:
            self.add(self.m.parent[u], w)

    def remove(self, u, w):
        tables = self.seats[u][w]
        k = self.rng.choices(range(len(tables)), tables)[0]
        tables[k] -= 1
        self.c[u] -= 1
        if not tables[k]:
            del tables[k]
            self.t[u] -= 1
            if u:
                self.remove(self.m.parent[u], w)


def corpus(n, seed):
    rng = random.Random(seed)
    follow = {a: [rng.choice("abcdefghijklmnop") for _ in range(4)] for a in "abcdefghijklmnop"}
    rows = []
    for i in range(n):
        words, w = [], "a"
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(follow[w]) if rng.random() < 0.7 else rng.choice("abcdefghijklmnop")
            words.append(w if rng.random() > 0.1 else f"Rare{rng.randint(0, 300)}")
        rows.append((i, " ".join(words)))
    return rows


def test_scores_equal_a_textbook_sampler(spark, docs):
    rows = corpus(120, 4)
    df = docs(rows)
    model = fit(df).model
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    book, customers, texts = Textbook(model, 1), [], {}
    for i, text in rows:
        h = np.array([hash_of(t) for t in tokens_of(text)], np.uint64)
        _, context = model.contexts(h, np.array([0]))
        texts[i] = list(zip(context.tolist(), h.tolist()))
        if i not in held:
            customers += texts[i]
    for u, w in customers:
        book.add(u, w)
    want, sweeps = defaultdict(lambda: np.zeros(0)), 0
    for sweep in range(30):
        for u, w in customers:
            book.remove(u, w)
            book.add(u, w)
        if sweep >= 10:
            sweeps += 1
            for i, pairs in texts.items():
                now = np.array([book.p(u, w) for u, w in pairs])
                want[i] = now if len(want[i]) == 0 else want[i] + now
    got = {r.doc_id: r for r in score_documents(df).collect()}
    for part in (held, {i for i, _ in rows} - held):
        a = sum(got[i].score for i in part)
        b = sum(np.log10(want[i] / sweeps).sum() for i in part)
        assert abs(a - b) < 0.01 * abs(b)
        assert a > sum(got[i].base_score for i in part)
    # the probabilities of all words and of the unknown one add up to one in a restaurant
    assert len(model.parent) > 10 and model.level.max() == 2


def test_base_scores_and_edge_cases(spark, docs):
    rows = [(i, t) for i, t in corpus(40, 6)] + [(1000, None), (1001, ""), (None, "a b"), (None, None), (1002, "long " * 60000), (1002, "long " * 60000)]
    c = Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(tokens_of(t))
    n, v = sum(c.values()), len(c)
    got = score_documents(docs(rows).repartition(3)).collect()
    assert len(got) == len(rows)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(tokens_of(t))
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        fits = [w for w in texts[r.doc_id] if len(w) == r.n_tokens and sum(c[x] > 0 for x in w) == r.n_known]
        assert any(abs(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) - r.base_score) < 1e-6 * abs(r.base_score) for w in fits)
        assert r.train_tokens == n and r.score < 0 and r.perplexity > 0
    empty = [r for r in range(3000) if zlib.crc32(str(r).encode()) % 7 == 2][:3]
    lone = score_documents(docs([(i, "a b") for i in empty])).collect()         # nothing to learn from
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in lone] == [(0, 0, 0.0, 0.0)] * 3
    assert score_documents(docs([])).count() == 0
