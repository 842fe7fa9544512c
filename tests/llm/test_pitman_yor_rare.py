"""Contexts of few tokens have restaurants too: the same model, however many of them count as common."""

import random
import zlib

import pytest

from leadmill.llm import pitman_yor as py


def _held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def _corpus(n, seed):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(60)]
    follow = {(a, b): rng.choices(names, k=3) for a in names for b in names}
    rows = []
    for i in range(n):
        words = rng.choices(names, k=2)
        for _ in range(rng.randint(0, 60)):
            words.append(rng.choice(follow[words[-2], words[-1]]) if rng.random() < 0.8 else rng.choice(names))
        rows.append((i, " ".join(words)))
    return rows


def _sums(rows):
    return [sum(r.score for r in rows if r.held_out == held) for held in (False, True)]


@pytest.mark.parametrize("share", [1, 8, 40])
def test_rare_contexts_score_as_if_they_were_common(spark, docs, monkeypatch, share):
    rows = docs(_corpus(250, 3))
    monkeypatch.setattr(py, "SHARE", 60_000)            # every context is common: the sampler that a textbook one confirms
    want = py.score_documents(rows).collect()
    monkeypatch.setattr(py, "SHARE", share)
    monkeypatch.setattr(py, "KNOWN", 10)                # others go by their hashes
    got = py.score_documents(rows).collect()
    key = lambda r: r.doc_id
    exact = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    assert [tuple(r[c] for c in exact) for r in sorted(got, key=key)] == [tuple(r[c] for c in exact) for r in sorted(want, key=key)]
    assert all(abs(a.base_score - b.base_score) < 1e-6 for a, b in zip(sorted(got, key=key), sorted(want, key=key)))
    for a, b in zip(_sums(got), _sums(want)):
        assert abs(a - b) < 0.02 * abs(b)


def test_a_text_that_occurs_twice_is_expected(spark, docs, monkeypatch):
    monkeypatch.setattr(py, "SHARE", 8)
    rng = random.Random(5)
    texts = [" ".join(rng.choices([f"v{k}" for k in range(400)], k=80)) for _ in range(60)]
    learned = [i for i in range(200) if not _held(i)]
    rows = list(zip(learned, texts + texts[:20]))
    got = {r.doc_id: r.perplexity for r in py.score_documents(docs(rows)).collect()}
    twice = [got[i] for i in learned[:20] + learned[60:80]]
    once = [got[i] for i in learned[20:60]]
    assert max(twice) < 0.8 * min(once)
