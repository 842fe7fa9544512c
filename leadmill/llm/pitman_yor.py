"""Language-model scores (operator 11): a hierarchical Pitman-Yor model, seated by Gibbs sampling.

Restaurants are contexts: every word, and every two words, that stand before a training token. Each token is a customer of the two
words before it. The parent of a two-word context is its later word, that of a word is the root, that of the root
the uniform distribution over all training words and one unknown word. Every table of a restaurant is a
customer of its parent. A predictive probability is

    P_u(w) = (c - d t + (s + d T) P_parent(w)) / (s + C)

with c customers at t tables for w, and C customers at T tables in the whole restaurant u. Discounts d, one per
level, come from the counts of counts (n1 / (n1 + 2 n2)); strengths s are fixed. A context that no training token follows is empty
and gives what its parent gives.

A Gibbs step takes all customers of one dish (context, word) from their tables
and seats them anew, given the tables elsewhere: the number of tables is drawn from its exact distribution,
proportional to S_d(c, t) * ((s + d T) P_parent(w))**t with generalised Stirling numbers S_d, for up to
``EXACT`` customers; for more, the first ``EXACT`` are drawn so and the rest is seated one after another, in runs of at most
1/16 of those seated, each run's new tables being one binomial draw. Children go before parents, whose
customers are their tables. Predictive probabilities are averaged over the last sweeps.

Restaurants are dealt in two ways, for no task can hold all.

* Common ones: the root, the ``SHARE`` most frequent words ("hot") and the ``SHARE`` most frequent pairs of them. Their dishes are dealt by
  word, with all common restaurants of a word in one place. Seats of different words meet only in the totals T of at most
  2 * ``SHARE`` + 1 restaurants, which are exchanged: each round samples all seats with the totals of the round before (``ROUNDS`` jobs).
* All others hold less than 1 / ``SHARE`` of the tokens each and are dealt whole (``Rare``): those that end in a hot word by both their
  words, the rest by their later word, with that word's own restaurant. So their totals are at hand, and of the parent they need
  P_parent(w) only. They send up their tables first (drawn with the share of a hot word among all tokens, or one unknown word's, for
  P_parent), the common ones are seated, and then they are seated anew with the probabilities that come back.

Scale: tokens in common pairs that are hot words themselves are counted before any shuffle and scored in place from a table of at
most 4,097 x 2,048 probabilities. All other tokens move to their bucket as codes into the words of their block, once to be counted and
once to be scored (texts are read and packed anew, so that the blocks are never kept twice); sums by document go back. A bucket holds its tokens in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import settle
from .tokens import Words, mix

SHARE = 2048
EXACT = 64
ROUNDS = 3
BURN_IN, SAMPLES = 4, 6
EARLY = 2, 2                # the same for the rounds that only give totals
RARE = 2, 4                 # the same for restaurants that are dealt whole, and for the tables they first send up
LIFT = 1, 1
STRENGTH = 1.0
PART_DOCS, PART_BYTES = 8192, 12 << 20
KNOWN = 30_000              # words beyond the hot ones that blocks name by number, not by hash
BUCKETS_PER_PARTITION = 4
BASE_UNIT, SCORE_UNIT = 2.0 ** -32, 2.0 ** -18     # of the sums that buckets send back
END = np.uint64(0x51ED270B9F4A7C15)          # the end token, and what stands before a text's first word


# ---- seats ------------------------------------------------------------------------------------------

class Seats:
    """Draws numbers of tables for given numbers of customers, for one discount."""

    def __init__(self, discount: float):
        self.d = discount
        s = np.zeros((EXACT + 1, EXACT + 1))
        s[1, 1] = 1
        t = np.arange(EXACT + 1)
        for c in range(1, EXACT):
            s[c + 1, 1:] = s[c, :-1] + (c - discount * t[1:]).clip(0) * s[c, 1:]
        with np.errstate(divide="ignore"):
            self.log_s = np.log(s)

    def draw(self, c: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Tables of dishes with ``c`` customers; ``weight`` is (s + d T) * P_parent(w)."""
        out = np.minimum(c, 1)
        small = np.minimum(c, EXACT).astype(np.uint8)
        order = np.argsort(small, kind="stable")
        sizes, at = np.unique(small[order], return_index=True)
        log_a = np.log(weight)
        for n, rows in zip(sizes.tolist(), np.split(order, at[1:])):
            for some in (rows[i:i + 65536] for i in range(0, len(rows) if n > 1 else 0, 65536)):
                w = self.log_s[n, 1:n + 1][None, :] + log_a[some][:, None] * np.arange(1, n + 1)
                w = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
                out[some] = 1 + (w < (rng.random(len(some)) * w[:, -1])[:, None]).sum(axis=1)
        big = np.flatnonzero(c > EXACT)
        seated = np.full(len(big), EXACT)
        while len(big):
            run = np.minimum(np.maximum(1, seated // 16), c[big] - seated)
            a = weight[big]
            out[big] += rng.binomial(run, a / (a + seated - self.d * out[big]))
            seated = seated + run
            more = seated < c[big]
            big, seated = big[more], seated[more]
        return out


def shifted(x: np.ndarray, first: np.ndarray, start) -> np.ndarray:
    """What stands before each token; ``start`` before the first one of a text."""
    out = np.concatenate([x[:1], x[:-1]])
    out[first] = start
    return out


class Model:
    """What all tasks know: contexts, totals and discounts. Small: at most 2 * SHARE + 1 contexts."""

    def __init__(self, hot: np.ndarray, pairs: np.ndarray, tokens: int, words: int, hot_counts: np.ndarray | None = None,
                 known: np.ndarray = np.zeros(0, np.uint64)):
        self.hot = hot                                   # sorted hashes of the hot words
        self.known = known                               # and of the most frequent others
        self.hot_counts = hot_counts                     # their training tokens
        self.pairs = pairs                               # sorted numbers later word * len(hot) + earlier word
        self.tokens, self.base = tokens, 1.0 / (words + 1)
        self.words = words
        n = 1 + len(hot) + len(pairs)
        self.parent = np.zeros(n, np.int64)
        self.parent[1 + len(hot):] = 1 + pairs // max(1, len(hot))
        self.level = np.zeros(n, np.int64)
        self.level[1:] = 1
        self.level[1 + len(hot):] = 2
        self.direct = np.zeros(n, np.int64)              # customers that are tokens
        self.tables = np.zeros(n)
        self.discount = np.full(3, 0.5)

    def before(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For a run of tokens (texts begin at ``first``): hot word or -1 of each, of the one before, and of the one before that."""
        hot = self.find(self.hot, tokens)
        end = self.find(self.hot, np.array([END], np.uint64))[0]
        return hot, shifted(hot, first, end), shifted(shifted(hot, first, end), first, end)

    def common(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The longest common context, given the hot words before."""
        context = one + 1
        if len(self.pairs):
            both = np.flatnonzero((one >= 0) & (two >= 0))
            found = self.find(self.pairs, one[both].astype(np.int64) * len(self.hot) + two[both])
            context[both[found >= 0]] = 1 + len(self.hot) + found[found >= 0]
        return context

    def contexts(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For a run of tokens (texts begin at ``first``): hot word or -1, and common context, of each."""
        hot, one, two = self.before(tokens, first)
        return hot, self.common(one, two)

    @staticmethod
    def find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not len(sorted_keys):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        return np.where(sorted_keys[at] == keys, at, -1).astype(np.int32)

    def customers(self) -> np.ndarray:
        """All customers of each restaurant."""
        out = self.direct.astype(float)
        np.add.at(out, self.parent[1:], self.tables[1:])
        return out


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


class Dishes:
    """All dishes of some words: (word, context) with direct customers, and those of the contexts above.

    Dishes that can never have two customers have one table or none; only the others (``many``) are drawn."""

    def __init__(self, model: Model, word: np.ndarray, context: np.ndarray, count: np.ndarray):
        m, self.model = len(model.parent), model
        own, two = word * m + context, model.level[context] == 2
        self.keys = distinct(np.concatenate([own, word[two] * m + model.parent[context[two]], distinct(word) * m]))
        n = len(self.keys)
        self.direct = np.bincount(np.searchsorted(self.keys, own), count, n).astype(np.int64)
        self.context = self.keys % m
        self.up = np.searchsorted(self.keys, self.keys - self.context + model.parent[self.context])
        level = model.level[self.context]
        self.rows = [np.flatnonzero(level == k) for k in range(3)]
        most = self.direct.copy()
        for k in (2, 1):
            most += np.bincount(self.up[self.rows[k]], most[self.rows[k]], n).astype(np.int64)
        self.many = [rows[most[rows] > 1] for rows in self.rows]
        self.tables = np.minimum(most, 1)                # at first one table for each dish
        single = np.flatnonzero((most <= 1) & (level > 0))
        self.fixed = self.direct + np.bincount(self.up[single], self.tables[single], n).astype(np.int64)

    def find(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, word * len(self.model.parent) + context)

    def _customers(self, k: int) -> np.ndarray:
        """Customers of all dishes of level k (those of other levels have no meaning)."""
        if k == 2:
            return self.direct
        child = self.many[k + 1]
        return self.fixed + np.bincount(self.up[child], self.tables[child], len(self.keys)).astype(np.int64)

    def _share(self, k: int, c: np.ndarray, t: np.ndarray, rows: np.ndarray, above: np.ndarray, all_c: np.ndarray) -> np.ndarray:
        m, u = self.model, self.context[rows]
        return (c - m.discount[k] * t + (STRENGTH + m.discount[k] * m.tables[u]) * above) / (STRENGTH + all_c[u])

    def probabilities(self, all_c: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Predictive probability of each dish in its restaurant. Linear in the tables, as the restaurants' totals are those of the
        round: of averaged tables it gives the averaged probabilities."""
        p = np.empty(len(self.keys))
        for k in range(3):
            rows = self.rows[k]
            c = self.direct[rows]
            if k < 2:
                child = self.rows[k + 1]
                c = c + np.bincount(self.up[child], tables[child], len(self.keys))[rows]
            above = np.full(len(rows), self.model.base) if k == 0 else p[self.up[rows]]
            p[rows] = self._share(k, c, tables[rows], rows, above, all_c)
        return p

    def sweep(self, seats: list[Seats], all_c: np.ndarray, rng: np.random.Generator) -> None:
        """A Gibbs step for every dish, children first. What a dish's own tables add to its parent is left out of the parent's
        probability."""
        m = self.model
        for k in (2, 1, 0):
            rows = self.many[k]
            if not len(rows):
                continue
            c, above = self._customers(k)[rows], np.full(len(rows), m.base)
            if k:
                up = self.up[rows]
                if k == 2:
                    root = self.up[up]
                    above = self._share(0, self._customers(0)[root], self.tables[root], root, above, all_c)
                rest = self._customers(k - 1)[up] - self.tables[rows]
                above = self._share(k - 1, rest, np.minimum(self.tables[up], rest), up, above, all_c)
            weight = (STRENGTH + m.discount[k] * m.tables[self.context[rows]]) * above
            self.tables[rows] = seats[k].draw(c, weight, rng)

    def counts_of_counts(self) -> np.ndarray:
        """Dishes with one and with two customers, by level."""
        return np.array([[(c == n).sum() for n in (1, 2)] for c in (self._customers(k)[self.rows[k]] for k in range(3))])

    def averaged(self, seed: int, burn_in: int = BURN_IN, samples: int = SAMPLES) -> np.ndarray:
        """Tables, averaged over the sweeps after the burn-in."""
        rng = np.random.Generator(np.random.PCG64(seed))
        seats, all_c = [Seats(d) for d in self.model.discount], self.model.customers()
        many = np.concatenate(self.many)
        total = np.zeros(len(many))
        for i in range(burn_in + samples):
            self.sweep(seats, all_c, rng)
            if i >= burn_in:
                total += self.tables[many]
        mean = self.tables.astype(float)
        mean[many] = total / samples
        return mean

    def predicted(self, seed: int) -> np.ndarray:
        """Predictive probabilities, averaged over the sweeps after the burn-in."""
        return self.probabilities(self.model.customers(), self.averaged(seed))


# ---- reading texts ----------------------------------------------------------------------------------

def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of at most PART_DOCS texts and about PART_BYTES; a longer text is a slice of its own."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PART_BYTES, "right"))
            to = min(max(at + 1, to), at + PART_DOCS)
            yield batch.slice(at, to - at)
            at = to


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end included; the first token of each text; and each token's text."""
    w = Words(column, lower=True)
    n = np.diff(w.first) + 1
    first = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    tokens = np.full(int(first[-1]), END, np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[first[1:] - 1] = False
    tokens[inner] = w.hashes()
    return tokens, first[:-1], np.repeat(np.arange(len(n)), n)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        keys, counts = np.unique(_tokens(batch.column("text"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["w", "n"])


def _count_pairs(hot):
    """Customers of each pair of hot words: later * number of hot words + earlier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(hot.value, np.zeros(0, np.int64), 0, 0)
        for batch in _parts(batches):
            tokens, first, _ = _tokens(batch.column("text"))
            _, one, two = model.before(tokens, first)
            both = (one >= 0) & (two >= 0)
            keys, counts = np.unique(one[both].astype(np.int64) * len(hot.value) + two[both], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["w", "n"])
    return run


def _squeezed(x: np.ndarray) -> bytes:
    return x.nbytes.to_bytes(8, "little") + pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def _loosened(x: bytes) -> bytes:
    return pa.decompress(x[8:], int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True)


def _squeezed_hashes(x: np.ndarray) -> bytes:
    """Sorted hashes, or other numbers whose first bytes repeat, byte by byte."""
    return _squeezed(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T))


def _hashes(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_loosened(x), np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1)


def _squeezed_sums(x: np.ndarray, unit: float) -> bytes:
    """Logarithms, not above 0, in whole units."""
    return _squeezed_hashes(np.rint(-x / unit).astype(np.int64))


def _sums_in(x: bytes, unit: float) -> np.ndarray:
    return -unit * _hashes(x).astype(np.int64)


def _small_codes(x: np.ndarray, n: int) -> bytes:
    return _squeezed(x.astype(np.uint16 if n <= 1 << 16 else np.uint32))


def _codes(x: bytes, n: int) -> np.ndarray:
    return np.frombuffer(_loosened(x), np.uint16 if n <= 1 << 16 else np.uint32).astype(np.int64)


_PACKED = [("place", "int"), ("part", "long"), ("hashes", "binary"), ("w", "binary"), ("a", "binary"), ("b", "binary"), ("doc", "binary"),
           ("train", "binary"), ("n_tokens", "array<long>")]


def _rows(rows: list[dict], columns: list[tuple[str, str]]) -> list[pa.Array]:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return [pa.array([r.get(c) for r in rows], types[t]) for c, t in columns]


def _pack(model, buckets: int, id_type, counting: bool):
    """Two kinds of rows. A block (place >= 0): tokens of one part for one bucket, in the order of the texts, as codes of the word and of
    the two before it (hot words, known words, then ``hashes``), with their document in the part. Of a part (place < 0): if ``counting``, how
    often its hot training tokens in common pairs occur (``w``: context * hot words + word, ``a``: how often); else its documents with these tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        h = len(m.hot)
        named = h + len(m.known)
        part = TaskContext.get().partitionId() << 32
        for batch in _parts(batches):
            tokens, first, doc = _tokens(batch.column("text"))
            hot, one, two = m.before(tokens, first)
            context = m.common(one, two)
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(np.uint8)
            direct, after_hot = context > h, one >= 0
            still = direct & (hot >= 0)
            at = np.flatnonzero(still)
            pairs, pair_doc = context[at].astype(np.int64) * h + hot[at], doc[at]
            del one, two, context
            if counting:
                keys, counts = np.unique(pairs[train[pair_doc] > 0], return_counts=True)
                rows, ids = [{"place": -1 - part % buckets, "part": part, "w": _squeezed(keys), "a": _squeezed(counts)}], [None]
            else:
                n_hot = np.bincount(pair_doc, minlength=len(train)).astype(np.uint32)
                rows = [{"place": -1 - part % buckets, "part": part, "w": pairs.astype(np.uint32).tobytes(), "a": n_hot.tobytes(),
                         "train": train.tobytes(), "n_tokens": np.bincount(doc, minlength=len(train)).tolist()}]
                ids = [batch.column("doc_id").to_pylist()]
            word = hot
            is_cold = np.flatnonzero(hot < 0)
            cold, rank = np.unique(tokens[is_cold], return_inverse=True)
            code = m.find(m.known, cold)
            other = code < 0
            code[other] = len(m.known) + np.arange(other.sum())
            word[is_cold] = (h + code)[rank]
            del is_cold, rank
            b = shifted(word, first, word[-1])                    # each text ends with the end token
            a = shifted(b, first, word[-1])
            hashes = np.concatenate([m.hot, m.known, cold[other]])
            move = np.flatnonzero(~still)
            place, own = hashes[b[move]], direct[move]
            both = np.flatnonzero(after_hot[move] & ~own)         # contexts that end in a hot word go by both words
            place[both] = mix(place[both] * np.uint64(0x9E3779B97F4A7C15) + hashes[a[move[both]]])
            place[own] = tokens[move[own]]
            place = (place % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
            del tokens, both, own, direct, after_hot, still
            order = np.argsort(place, kind="stable")
            move, place = move[order], place[order]
            edges = np.append(np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64), len(place))
            code, used = np.arange(len(hashes), dtype=np.int32), np.zeros(len(hashes), bool)
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                mine = move[lo:hi]
                used[:] = False
                for x in (word, a, b):
                    used[x[mine]] = True
                mine_only = named + np.flatnonzero(used[named:])
                code[mine_only] = named + np.arange(len(mine_only))
                n = named + len(mine_only)
                rows.append({"place": int(place[lo]), "part": part, "hashes": _squeezed_hashes(hashes[mine_only]), "w": _small_codes(code[word[mine]], n),
                             "a": _small_codes(code[a[mine]], n), "b": _small_codes(code[b[mine]], n),
                             "doc": _squeezed(doc[mine].astype(np.uint16)), "train": _squeezed(np.packbits(train[doc[mine]]))})
                ids.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(id_type)), *_rows(rows, _PACKED)], ["ids", *[c for c, _ in _PACKED]])
            part += 1
    return run


# ---- counting, seating, scoring ---------------------------------------------------------------------

class Rare:
    """The tokens of one bucket: customers of restaurants that are dealt whole, and cold words in common pairs.

    ``asked`` are the dishes (common context, word) whose probability it needs: of tokens in common pairs their own, of the
    two-word contexts of a hot word those of that word, of the other one-word contexts those of the root."""

    def __init__(self, model: Model, blocks: list[dict]):
        h = len(model.hot)
        self.model, hashes = model, [_hashes(r["hashes"]) for r in blocks]
        others, named = distinct(np.concatenate(hashes)), h + len(model.known)
        self.hashes = np.concatenate([model.known, others])              # of the cold words
        m = self.m = h + len(self.hashes)
        columns = {}
        for c in "wab":
            columns[c] = np.concatenate([np.concatenate([np.arange(named), named + np.searchsorted(others, x)])[_codes(r[c], named + len(x))]
                                         for r, x in zip(blocks, hashes)])
        w, a, b = columns.values()
        self.doc = [np.frombuffer(_loosened(r["doc"]), np.uint16) for r in blocks]
        self.parts = [(r["part"], len(d)) for r, d in zip(blocks, self.doc)]
        self.train = np.concatenate([np.unpackbits(np.frombuffer(_loosened(r["train"]), np.uint8), count=n) for r, (_, n) in zip(blocks, self.parts)])
        hot = (b < h) & (a < h)
        context = model.common(np.where(hot, b, -1).astype(np.int32), np.where(hot, a, -1).astype(np.int32))
        self.direct, self.rare = np.flatnonzero(context > h), np.flatnonzero(context <= h)
        # dishes of two-word contexts
        train, b2, a2, w2 = self.train[self.rare], b[self.rare], a[self.rare], w[self.rare]
        if m < 1 << 21:
            keys, self.dish = np.unique((b2 * m + a2) * m + w2, return_inverse=True)
            contexts, word2 = keys // m, keys % m
        else:                                            # three codes do not fit into 63 bits
            contexts, of = np.unique(b2 * m + a2, return_inverse=True)
            keys, self.dish = np.unique(of * m + w2, return_inverse=True)
            contexts, word2 = contexts[keys // m], keys % m
        self.r2 = np.cumsum(np.append(True, contexts[1:] != contexts[:-1])[:len(contexts)]) - 1
        self.c2 = np.bincount(self.dish, train, len(keys)).astype(np.int64)
        self.all2 = np.bincount(self.r2, self.c2)
        later = contexts // m
        # dishes of one-word contexts: hot ones are asked for, the others sit here and ask for the root's
        keys1, at = np.unique(later * m + word2, return_inverse=True)
        high1 = int(np.searchsorted(keys1, h * m))
        self.low, self.high = np.flatnonzero(later >= h), np.flatnonzero(later < h)
        self.up, words1 = at[self.low] - high1, keys1[high1:] // m
        self.r1 = np.cumsum(np.append(True, words1[1:] != words1[:-1])[:len(words1)]) - 1
        self.n1, self.restaurants1 = len(words1), int(self.r1[-1]) + 1 if len(words1) else 0
        self.above1 = at - high1
        root = np.zeros(m, bool)
        root[keys1[high1:] % m] = True
        root_words = np.flatnonzero(root)
        direct, self.asks_direct = np.unique(context[self.direct].astype(np.int64) * m + w[self.direct], return_inverse=True)
        self.asked = np.concatenate([keys1[:high1] + m, root_words, direct])
        self.asks1 = high1 + (np.cumsum(root) - 1)[keys1[high1:] % m]
        self.asks_direct = self.asks_direct + high1 + len(root_words)
        self.asks2 = np.where(later < h, at, 0)                          # of the common parent; without meaning where the parent sits here
        asks_dish = self.asks2.copy()
        asks_dish[self.low] = self.asks1[self.up]
        self.asks = np.empty(len(w), np.int64)                           # of each token
        self.asks[self.direct], self.asks[self.rare] = self.asks_direct, asks_dish[self.dish]
        self.context, self.word = self.asked // m, self.asked % m

    def cold(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The dishes asked for that have cold words, by the bucket of the word, word and context; the words' hashes and buckets."""
        h = len(self.model.hot)
        at = np.flatnonzero(self.word >= h)
        word = self.hashes[self.word[at] - h]
        place = (word % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((self.context[at], word, place))
        return at[order], word[order], place[order]

    def seat(self, p: np.ndarray, seed: int, burn_in: int, samples: int) -> np.ndarray:
        """Seats everybody, with the probabilities ``p`` of the dishes asked for; averaged predictive probabilities of the dishes of
        two-word contexts."""
        rng = np.random.Generator(np.random.PCG64(seed))
        d1, d2 = self.model.discount[1:].tolist()
        seats1, seats2 = Seats(d1), Seats(d2)
        given, root = p[self.asks2], p[self.asks1]
        many2 = np.flatnonzero(self.c2 > 1)
        inner = self.above1[many2] >= 0
        low2, over = many2[inner], self.above1[many2[inner]]
        t2 = np.minimum(self.c2, 1)
        c1 = np.bincount(self.up, t2[self.low], self.n1).astype(np.int64)
        t1, total = np.minimum(c1, 1), np.zeros(len(self.c2))

        def sums():
            return (np.bincount(self.r1, c1, self.restaurants1)[self.r1], np.bincount(self.r1, t1, self.restaurants1)[self.r1],
                    np.bincount(self.r2, t2, len(self.all2)))
        all1, tables1, tables2 = sums()
        for i in range(burn_in + samples):
            above = given[many2]                         # what a dish's own tables add to its parent is left out
            rest = c1[over] - t2[low2]
            above[inner] = (rest - d1 * np.minimum(t1[over], rest) + (STRENGTH + d1 * tables1[over]) * root[over]) / (STRENGTH + all1[over])
            t2[many2] = seats2.draw(self.c2[many2], (STRENGTH + d2 * tables2[self.r2[many2]]) * above, rng)
            c1 = np.bincount(self.up, t2[self.low], self.n1).astype(np.int64)
            t1 = np.minimum(c1, 1)
            many1 = np.flatnonzero(c1 > 1)
            t1[many1] = seats1.draw(c1[many1], ((STRENGTH + d1 * tables1) * root)[many1], rng)
            all1, tables1, tables2 = sums()
            if i >= burn_in:
                parent = given.copy()
                parent[self.low] = ((c1 - d1 * t1 + (STRENGTH + d1 * tables1) * root) / (STRENGTH + all1))[self.up]
                total += (self.c2 - d2 * t2 + (STRENGTH + d2 * tables2[self.r2]) * parent) / (STRENGTH + self.all2[self.r2])
        self.c1, self.t1, self.t2 = c1, t1, t2
        return total / samples

    def sent_up(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each dish asked for: the customers that the common restaurant gets from here, and the training tokens behind them."""
        n = len(self.asked)
        customers = np.bincount(self.asks_direct, self.train[self.direct], n) + np.bincount(self.asks2[self.high], self.t2[self.high], n) \
            + np.bincount(self.asks1, self.t1, n)
        return customers.astype(np.int64), np.bincount(self.asks, self.train, n).astype(np.int64)

    def counts_of_counts(self) -> np.ndarray:
        return np.array([(c == n).sum() for c in (np.zeros(0), self.c1, self.c2) for n in (1, 2)])


_UPPER = [("place", "int"), ("part", "long"), ("w", "binary"), ("n", "binary"), ("context", "binary"), ("customers", "binary"), ("tokens", "binary"),
          ("n_tokens", "array<long>")]


def _lift(model, buckets: int):
    """What the common restaurants get. Of a bucket and a bucket of words (place >= 0): its cold words, contexts of each, and for each
    of these the customers and the training tokens. Others (place < 0): customers of hot dishes (``w``: context * hot words + word), and
    counts of counts (``n_tokens``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        h, few = len(m.hot), np.zeros(6)
        for place, blocks in _grouped(batches, "place"):
            if place < 0:
                out = [{"place": place, "part": r["part"], "w": r["w"], "customers": r["a"]} for r in blocks]
            else:
                b = Rare(m, blocks)
                share = np.append((m.hot_counts + 1) / (m.tokens + m.words + 1), m.base)
                b.seat(share[np.minimum(b.word, h)], place, *LIFT)
                few += b.counts_of_counts()
                customers, tokens = b.sent_up()
                hot = np.flatnonzero((b.word < h) & (customers > 0))
                out = [{"place": -1 - place, "part": -1, "w": _squeezed(b.context[hot] * h + b.word[hot]), "customers": _squeezed(customers[hot])}]
                at, word, to = b.cold(buckets)
                for k in np.unique(to).tolist():
                    lo, hi = np.searchsorted(to, [k, k + 1])
                    words, n = np.unique(word[lo:hi], return_counts=True)
                    mine = at[lo:hi]
                    out.append({"place": k, "part": place, "w": _squeezed_hashes(words), "n": _squeezed(n.astype(np.uint32)),
                                "context": _squeezed(b.context[mine].astype(np.uint16)), "customers": _squeezed(customers[mine].astype(np.uint32)),
                                "tokens": _squeezed(tokens[mine].astype(np.uint32))})
            yield pa.RecordBatch.from_arrays(_rows(out, _UPPER), [c for c, _ in _UPPER])
        last = [{"place": -1, "part": -1, "n_tokens": few.astype(np.int64).tolist()}]
        yield pa.RecordBatch.from_arrays(_rows(last, _UPPER), [c for c, _ in _UPPER])
    return run


class Bucket:
    """The common dishes of the cold words of one bucket."""

    def __init__(self, model: Model, rows: list[dict]):
        read = lambda c, t: np.concatenate([np.frombuffer(_loosened(r[c]), t) for r in rows]).astype(np.int64)
        self.words = np.concatenate([_hashes(r["w"]) for r in rows])
        self.hashes = distinct(self.words)
        word = np.repeat(np.searchsorted(self.hashes, self.words), read("n", np.uint32))
        context = read("context", np.uint16)
        self.sizes = [(r["part"], int.from_bytes(r["context"][:8], "little") // 2) for r in rows]
        m = len(model.parent)
        keys, self.row = np.unique(word * m + context, return_inverse=True)
        self.pair_word, self.pair_context = keys // m, keys % m
        self.pair_count = np.bincount(self.row, read("customers", np.uint32), len(keys)).astype(np.int64)
        self.count = np.bincount(word, read("tokens", np.uint32), len(self.hashes)).astype(np.uint32)


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Runs of rows with one key, from rows that are sorted by it."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != at:
                yield at, held
                held = []
            at = row[key]
            held.append(row)
    if held:
        yield at, held


_TOTALS = "kind int, k int, x double"


def _totals(model: Model, dishes: Dishes, sampled: bool, seed: int, sums: dict) -> None:
    """Adds up what the next round needs of the words here: tables by context, counts of counts and direct customers."""
    n = len(model.parent)
    found = dishes.averaged(seed, *EARLY) if sampled else dishes.tables
    sums["tables"] += np.bincount(dishes.context, found, n)
    sums["direct"] += np.bincount(dishes.context, dishes.direct, n)
    sums["few"] += dishes.counts_of_counts().reshape(-1)


def _sums_of(model: Model) -> dict:
    n = len(model.parent)
    return {"tables": np.zeros(n), "direct": np.zeros(n), "few": np.zeros(6)}


def _sum_rows(sums: dict) -> pa.RecordBatch:
    kinds = [np.full(len(v), i) for i, v in enumerate(sums.values())]
    values = np.concatenate(list(sums.values()))
    keys = np.concatenate([np.arange(len(v)) for v in sums.values()])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(kinds).astype(np.int32)), pa.array(keys.astype(np.int32)), pa.array(values)],
                                      ["kind", "k", "x"])


def _cold_round(model, sampled: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, sums = model.value, _sums_of(model.value)
        for place, rows in _grouped(batches, "place"):
            b = Bucket(m, rows)
            some = np.flatnonzero(b.pair_count)          # dishes without customers have no tables
            _totals(m, Dishes(m, b.pair_word[some], b.pair_context[some], b.pair_count[some]), sampled, place, sums)
        yield _sum_rows(sums)
    return run


WORDS_AT_ONCE = 64


def _hot_dishes(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Dishes]]:
    """Dishes of some hot words at a time, and the first of these words; ``keys // number of contexts`` are the words."""
    for batch in batches:
        for at in range(0, batch.num_rows, WORDS_AT_ONCE):
            rows = batch.slice(at, WORDS_AT_ONCE)
            contexts, counts = rows.column("contexts"), rows.column("counts")
            word = np.repeat(rows.column("word").to_numpy().astype(np.int64), pc.list_value_length(contexts).to_numpy())
            yield int(word[0]), Dishes(model, word, contexts.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy())


def _hot_round(model, sampled: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, sums = model.value, _sums_of(model.value)
        for seed, dishes in _hot_dishes(m, batches):
            _totals(m, dishes, sampled, seed, sums)
        yield _sum_rows(sums)
    return run


def _hot_scores(model):
    """(context, word, probability) of the hot words: in each context of theirs, and in all contexts above."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for seed, dishes in _hot_dishes(m, batches):
            p = dishes.predicted(seed)
            yield pa.RecordBatch.from_arrays([pa.array(dishes.context), pa.array(dishes.keys // len(m.parent)), pa.array(p)],
                                             ["context", "word", "p"])
    return run


_REPLY = "place int, part long, p binary, count binary"


def _cold_scores(model):
    """To each bucket that asked for cold words (place; the words' bucket in ``part``): their probabilities in the contexts asked for, and
    their training tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for place, rows in _grouped(batches, "place"):
            b = Bucket(m, rows)
            dishes = Dishes(m, b.pair_word, b.pair_context, b.pair_count)
            p = dishes.predicted(place)[dishes.find(b.pair_word, b.pair_context)].astype(np.float32)
            out, lo = [], 0
            for part, n in b.sizes:
                pair = b.row[lo:lo + n]
                out.append((part, -1 - place, _squeezed(p[pair]), _squeezed(b.count[b.pair_word[pair]])))
                lo += n
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["place", "part", "p", "count"])
    return run


_SUMS = [("part", "long"), ("doc", "binary"), ("train", "binary"), ("n_tokens", "array<long>"), ("known", "binary"), ("base", "binary"),
         ("score", "binary")]


def _sums(model, table, buckets: int, id_type):
    """Of each part: its documents with the sums of their tokens that did not move; and those of the tokens in each bucket, by document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, (counts, scores) = model.value, table.value
        h = max(1, len(m.hot))
        for place, rows in _grouped(batches, "place"):
            out = []
            if place < 0:
                for row in rows:
                    pairs, n_hot = np.frombuffer(row["w"], np.uint32), np.frombuffer(row["a"], np.uint32)
                    doc, n, c = np.repeat(np.arange(len(n_hot)), n_hot), len(n_hot), counts[pairs % h] if len(pairs) else np.zeros(0)
                    known, base, score = (np.bincount(doc, x, n) for x in (c > 0, np.log10((c + 1) / (m.tokens + m.words + 1)), scores[pairs]))
                    out.append({"ids": row["ids"], "part": row["part"], "train": row["train"], "n_tokens": row["n_tokens"],
                                "known": known.tobytes(), "base": base.tobytes(), "score": score.tobytes()})
            else:
                out = _bucket_sums(m, counts, scores, place, rows, buckets)
            yield pa.RecordBatch.from_arrays([pa.array([r.get("ids") for r in out], pa.list_(id_type)), *_rows(out, _SUMS)],
                                             ["ids", *[c for c, _ in _SUMS]])
    return run


def _bucket_sums(m: Model, counts: np.ndarray, scores: np.ndarray, place: int, rows: list[dict], buckets: int) -> list[dict]:
    h = len(m.hot)
    b = Rare(m, [r for r in rows if r["part"] >= 0])
    replies = sorted((r for r in rows if r["part"] < 0), key=lambda r: -r["part"])
    p, count = np.empty(len(b.asked)), np.empty(len(b.asked), np.int64)
    hot = np.flatnonzero(b.word < h)
    p[hot], count[hot] = 10.0 ** scores[b.context[hot] * h + b.word[hot]].astype(float), counts[b.word[hot]]
    at = b.cold(buckets)[0]
    if len(at):
        p[at] = np.concatenate([np.frombuffer(_loosened(r["p"]), np.float32) for r in replies])
        count[at] = np.concatenate([np.frombuffer(_loosened(r["count"]), np.uint32) for r in replies])
    score = np.empty(len(b.asks))
    score[b.direct] = p[b.asks_direct]
    score[b.rare] = b.seat(p, place, *RARE)[b.dish]
    score, known = np.log10(score), (count > 0)[b.asks]
    base = np.log10((count + 1.0) / (m.tokens + m.words + 1))[b.asks]
    out, lo = [], 0
    for (part, n), doc in zip(b.parts, b.doc):
        docs, first = np.unique(doc, return_index=True)               # a block's tokens are in the order of its texts
        known_n, base_n, score_n = (np.add.reduceat(x[lo:lo + n], first) for x in (known.astype(np.uint32), base, score))
        out.append({"part": part, "doc": _squeezed(docs), "known": _squeezed(known_n.astype(np.uint32)), "base": _squeezed_sums(base_n, BASE_UNIT),
                    "score": _squeezed_sums(score_n, SCORE_UNIT)})
        lo += n
    return out


def _documents(model, id_type):
    """A part's documents: the sums of the tokens that did not move and those of the buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for _, rows in _grouped(batches, "part"):
            head = next(r for r in rows if r["ids"] is not None)
            n = len(head["ids"])
            known, base, score = (np.frombuffer(head[c]).copy() for c in ("known", "base", "score"))
            for r in rows:
                if r["doc"] is not None:
                    doc = np.frombuffer(_loosened(r["doc"]), np.uint16)
                    known[doc] += np.frombuffer(_loosened(r["known"]), np.uint32)
                    base[doc] += _sums_in(r["base"], BASE_UNIT)
                    score[doc] += _sums_in(r["score"], SCORE_UNIT)
            yield pa.RecordBatch.from_arrays(
                [pa.array(head["ids"], id_type), pa.array(np.frombuffer(head["train"], np.uint8) == 0), pa.array(head["n_tokens"], pa.int64()),
                 pa.array(known.astype(np.int64)), pa.array(np.full(n, m.tokens)), pa.array(base), pa.array(score)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


@dataclass
class Fitted:
    """A model, and the tables of dishes that it was fitted to."""
    model: Model
    rows: DataFrame
    cold: DataFrame
    hot_table: DataFrame
    buckets: int
    word_buckets: int


def _most(counted: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` most frequent of (w, n), with their counts."""
    most = counted.orderBy(F.desc("n"), "w").limit(n).toArrow()
    return most.column("w").to_numpy(), most.column("n").to_numpy()


def _packed_rows(rows: DataFrame, model, buckets: int, counting: bool) -> DataFrame:
    id_field = rows.schema["doc_id"].dataType
    return rows.mapInArrow(_pack(model, buckets, to_arrow_type(id_field), counting),
                           f"ids array<{id_field.simpleString()}>, " + ", ".join(f"{c} {t}" for c, t in _PACKED))


def _dealt(df: DataFrame) -> DataFrame:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, "place").sortWithinPartitions("place", "part")


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries made and run in here are removed when the query ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fit(docs: DataFrame) -> Fitted:
    """See ``_fit``; shuffle files go as soon as they are read."""
    with _cleaned(docs.sparkSession):
        return _fit(docs)


def _fit(docs: DataFrame) -> Fitted:
    """Counts the training rows of ``docs``, sends up the tables of the restaurants that are dealt whole, and runs the rounds of seating
    of the common ones."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    rows = docs.select("doc_id", (~held).alias("train"), F.coalesce("text", F.lit("")).alias("text"))
    train = rows.where("train").select("text")
    words = train.mapInArrow(_count_words, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).persist(StorageLevel.DISK_ONLY)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    found, counts = _most(words, SHARE + KNOWN)
    words.unpersist()
    hashes, counts, known = found[:SHARE].view(np.uint64), counts[:SHARE], found[SHARE:].view(np.uint64)
    hot, hot_counts = np.sort(hashes), counts[np.argsort(hashes)]
    pairs, _ = _most(train.mapInArrow(_count_pairs(send(hot)), "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), SHARE)
    model = Model(hot, np.sort(pairs), total.tokens, total.words, hot_counts, np.sort(known))

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # no more than the tokens fill: each bucket writes to each bucket of words
    buckets = min(partitions * BUCKETS_PER_PARTITION, 1 + (total.tokens >> 17))
    word_buckets = min(partitions, 1 + (total.tokens >> 19))
    now = send(model)
    lifted = _dealt(_packed_rows(rows, now, buckets, True).drop("ids")).mapInArrow(_lift(now, word_buckets), ", ".join(f"{c} {t}" for c, t in _UPPER))
    upper = settle(_dealt(lifted))
    cold = upper.where("place >= 0")

    n_hot = max(1, len(hot))
    hot_pairs = upper.where("place < 0 and w is not null").select("w", "customers").mapInArrow(_count_hot, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    hot_table = settle(hot_pairs.select(F.expr(f"cast(pair % {n_hot} as int)").alias("word"), F.expr(f"cast(pair div {n_hot} as int)").alias("u"), "n")
                       .repartition(partitions, "word").groupBy("word").agg(F.collect_list("u").alias("contexts"), F.collect_list("n").alias("counts")))
    rare_few = np.zeros(6)
    for r in upper.where("n_tokens is not null").select(F.posexplode("n_tokens").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect():
        rare_few[r.k] = r.n

    for k in range(ROUNDS):
        now = send(model)
        sums = cold.mapInArrow(_cold_round(now, k > 0), _TOTALS).union(hot_table.mapInArrow(_hot_round(now, k > 0), _TOTALS)) \
            .groupBy("kind", "k").agg(F.sum("x").alias("x")).collect()          # at most 4 * SHARE + 8 rows
        table = [np.zeros(len(model.parent)), np.zeros(len(model.parent)), np.zeros(6)]
        for r in sums:
            table[r.kind][r.k] = r.x
        model.tables, model.direct = table[0], table[1].astype(np.int64)
        if k <= 1:
            few = (table[2] + rare_few).reshape(3, 2)
            model.discount = np.clip(few[:, 0] / np.maximum(1, few[:, 0] + 2 * few[:, 1]), 0.05, 0.95)
    return Fitted(model, rows, cold, hot_table, buckets, word_buckets)


def score_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the
    whole text) and perplexity (10 ** (-score / n_tokens)).

    Rows whose crc32(doc_id as text) mod 7 is 2 are held out: nothing is learned from them. Tokens are words
    in lower case (A-Z) and one end per text. Null and empty texts are an end alone. Null ids have no remainder and are
    learned from; repeated rows count and return each. Very long texts are used whole. Without training rows every
    token is unknown. An empty table gives an empty result. Other columns are not read.
    """
    fitted = fit(docs)
    model, send = fitted.model, docs.sparkSession.sparkContext.broadcast
    now, id_field = send(model), docs.schema["doc_id"].dataType
    found = fitted.hot_table.mapInArrow(_hot_scores(now), "context long, word long, p double").toArrow()   # at most 4097 x 2048 rows
    table = send((model.hot_counts, _filled(model, found)))
    blocks = _packed_rows(fitted.rows, now, fitted.buckets, False)
    both = blocks.unionByName(fitted.cold.mapInArrow(_cold_scores(now), _REPLY), allowMissingColumns=True)
    sums = _dealt(both).mapInArrow(_sums(now, table, fitted.word_buckets, to_arrow_type(id_field)),
                                   f"ids array<{id_field.simpleString()}>, " + ", ".join(f"{c} {t}" for c, t in _SUMS))
    out = sums.repartition("part").sortWithinPartitions("part").mapInArrow(
        _documents(now, to_arrow_type(id_field)), f"doc_id {id_field.simpleString()}, held_out boolean, n_tokens long, n_known long, "
                                                  "train_tokens long, base_score double, score double")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def _count_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Customers of hot dishes by (context, word)."""
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(_loosened(row[c]), np.int64)) for c in ("w", "customers")], ["pair", "n"])


def _filled(model: Model, found: pa.Table) -> np.ndarray:
    """log10 probability of each hot word in each context; where a word was never seen in a context, its share of
    the context above."""
    n, h = len(model.parent), max(1, len(model.hot))
    p = np.full((n, h), np.nan)
    p[found.column("context").to_numpy(), found.column("word").to_numpy()] = found.column("p").to_numpy()
    all_c = model.customers()
    for u in range(n):                      # parents come before their children
        above = model.base if u == 0 else p[model.parent[u]]
        d = model.discount[model.level[u]]
        p[u] = np.where(np.isnan(p[u]), (STRENGTH + d * model.tables[u]) * above / (STRENGTH + all_c[u]), p[u])
    return np.log10(p).astype(np.float32).reshape(-1)
