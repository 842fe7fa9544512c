"""Phrase collocation mining (operator 12): Rabin-Karp fingerprints of all phrases, frequent ones only as text.

1. A phrase of n words is hashed by prefix polynomials: a word is a polynomial over its bytes, a phrase one over its
   words' hashes, both taken from running sums in numpy; language and n are mixed in.
2. Words are counted by fingerprint (partial sums before the shuffle). A phrase can only be frequent if all
   its words are, and a longer one only if the phrases in it are: so phrases of 2 words are counted where
   both words may be frequent, those of 3 and 4 words where all phrases of 2 words in them may be. "May be" is a filter
   of fixed size (``bits``) that never misses a key; what it lets through too much costs work, not results.
   These shuffles carry a fingerprint and a count only.
3. For frequent fingerprints a further shuffle sums the occurrences by size, and keeps an occurrence pointer (the least hash of
   document and word position) and the least and greatest of a second, independent fingerprint.
4. Each frequent phrase is read back from the text: the occurrence that its pointer names. Where the second
   fingerprints differ, unlike phrases share a fingerprint; then all its occurrences are read from the text and
   counted by text.
5. Scores come from joins of the frequent phrases with each other; every part of a frequent phrase is one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .bits import build_filter, may_hold
from .common import settle
from .tokens import Words, mix

LEAST = 30                  # occurrences from which a phrase counts
LONGEST = 4
COVERED = 80                # per cent of a phrase's occurrences in one longer candidate from which it goes
SCALE = 2_000_000
TOP = 2000
TEXT_BYTES = 2 << 20        # texts worked on at once; a longer text is worked on alone
WORD_BASE, CHECK_BASE = 0x9E3779B97F4A7C55, 0xD6E8FEB86659FD93
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of about ``TEXT_BYTES``."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + TEXT_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to


class Phrases:
    """The phrases of a batch (key: hash of the document, lang, text) by their first word."""

    def __init__(self, batch: pa.RecordBatch, bits: int):
        self.words = w = Words(batch.column("text"), _GAP, lower=True)
        self.bits = bits
        self.keys = batch.column("key").to_numpy().view(np.uint64)
        langs = batch.column("lang").dictionary_encode()
        self.lang_names = langs.dictionary.to_pylist()
        self.lang_of = langs.indices.to_numpy()
        names = Words(pa.array([f"x{n.encode().hex()}" for n in self.lang_names], pa.string()))
        self.lang_hash = names.hashes()[self.lang_of][w.text_of] if len(w.text_of) else np.zeros(0, np.uint64)
        breaks = np.cumsum(_BREAK[w.data])
        self.piece = breaks[w.starts] if len(w.starts) else np.zeros(0, np.int64)
        self._sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sums(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix polynomials of the words' hashes (sums of hash * base**i), and base**-i."""
        if which not in self._sums:
            hashes, base = self.words.hashes(which), (WORD_BASE, CHECK_BASE)[which]
            power, back = (np.full(len(hashes) + 1, x, np.uint64) for x in (base, pow(base, -1, 1 << 64)))
            power[0] = back[0] = 1
            sums = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(hashes * np.cumprod(power)[:-1], out=sums[1:])
            self._sums[which] = sums, np.cumprod(back)
        return self._sums[which]

    def whole(self, n: int) -> np.ndarray:
        """Words at which n words of one piece begin."""
        m = max(0, len(self.piece) - n + 1)
        t, p = self.words.text_of, self.piece
        return np.flatnonzero((t[:m] == t[n - 1:n - 1 + m]) & (p[:m] == p[n - 1:n - 1 + m]))

    def hashes(self, at: np.ndarray, n: int, which: int = 0) -> np.ndarray:
        """Fingerprints of the n words from each place (language and n mixed in)."""
        sums, back = self.sums(which)
        own = (sums[at + n] - sums[at]) * back[at]
        out = mix(mix(own + np.uint64(n)) + self.lang_hash[at])     # well mixed, as the filters ask
        return out & np.uint64((1 << self.bits) - 1) if which == 0 and self.bits < 64 else out

    def pointers(self, at: np.ndarray) -> np.ndarray:
        """A number for each occurrence: 31 bits of a hash of its document and its word's place there. Occurrences of one phrase may
        share a number; then each of them gives the same text."""
        text = self.words.text_of[at]
        return (mix(self.keys[text] + mix((at - self.words.first[text]).astype(np.uint64))) >> np.uint64(33)).astype(np.int32)

    def texts(self, at: np.ndarray, n: int) -> list[str]:
        data, starts, ends = self.words.data, self.words.starts, self.words.ends
        return [" ".join(data[starts[i + j]:ends[i + j]].tobytes().decode() for j in range(n)) for i in at.tolist()]

    def places(self, n: int, words: np.ndarray | None, pairs: np.ndarray | None) -> np.ndarray:
        """Places of phrases of n words that may be frequent, given the filters of frequent words and of pairs."""
        at = self.whole(n)
        if words is not None and n <= 2:
            good = self._ok("_word_ok", 1, words)
            for j in range(n):
                at = at[good[at + j]]
        if pairs is not None and n >= 3:
            good = self._ok("_pair_ok", 2, pairs)
            for j in range(n - 1):
                at = at[good[at + j]]
        return at

    def _ok(self, name: str, n: int, table: np.ndarray) -> np.ndarray:
        """For each word, whether the n words from it may be a frequent phrase."""
        if not hasattr(self, name):
            good = np.zeros(len(self.piece), bool)
            at = self.whole(n) if n == 1 else self.places(n, None, None)
            good[at] = may_hold(table, self.hashes(at, n))
            setattr(self, name, good)
        return getattr(self, name)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _count_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            p = Phrases(batch, bits)
            keys, counts = np.unique(p.hashes(p.whole(1), 1), return_counts=True)
            langs = np.bincount(p.lang_of[p.words.text_of], minlength=len(p.lang_names))
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([_long(keys), pa.nulls(len(langs), pa.int64())]), pa.array(np.concatenate([counts, langs])),
                pa.concat_arrays([pa.nulls(len(keys), pa.string()), pa.array(p.lang_names, pa.string())])], ["fp", "n", "lang"])
    return run


def _count_phrases(bits: int, sizes, words, pairs):
    """Occurrences of the phrases of the given sizes by fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            p = Phrases(batch, bits)
            keys = [p.hashes(p.places(n, words.value if words else None, pairs.value if pairs else None), n) for n in sizes]
            keys, counts = np.unique(np.concatenate(keys), return_counts=True)
            yield pa.RecordBatch.from_arrays([_long(keys), pa.array(counts)], ["fp", "n"])
    return run


def _point(bits: int, words, pairs, frequent):
    """Of phrases that may be frequent: fp, size, occurrences, least pointer, least and greatest second fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            p = Phrases(batch, bits)
            for size in range(1, LONGEST + 1):
                at = p.places(size, words.value, pairs.value)
                keys = p.hashes(at, size)
                hit = may_hold(frequent.value, keys)
                if not hit.any():
                    continue
                at, keys = at[hit], keys[hit]
                order = np.argsort(keys)
                at, keys = at[order], keys[order]
                check, pointer = (p.hashes(at, size, 1) >> np.uint64(33)).astype(np.int32), p.pointers(at)
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                yield pa.RecordBatch.from_arrays([
                    _long(keys[first]), pa.array(np.full(len(first), size, np.int32)), pa.array(np.diff(np.append(first, len(keys)))),
                    pa.array(np.minimum.reduceat(pointer, first)), pa.array(np.minimum.reduceat(check, first)),
                    pa.array(np.maximum.reduceat(check, first))], ["fp", "size", "n", "pointer", "low", "high"])
    return run


_FOUND = "fp long, size int, n long, pointer int, low int, high int"


def _read_back(bits: int, words, pairs, named, unclear):
    """Text of the occurrences that a pointer may name, and of all occurrences of fingerprints that may be unclear."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            p = Phrases(batch, bits)
            for size in range(1, LONGEST + 1):
                at = p.places(size, words.value, pairs.value)
                keys, pointer = p.hashes(at, size), p.pointers(at)
                hit = may_hold(named.value, keys ^ (pointer.astype(np.uint64) * np.uint64((1 << 32) + 1)))
                if unclear is not None:
                    hit |= may_hold(unclear.value, keys)
                at, keys, pointer = at[hit], keys[hit], pointer[hit]
                langs = pa.array([p.lang_names[i] for i in p.lang_of[p.words.text_of[at]]], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [_long(keys), pa.array(np.full(len(at), size, np.int32)), pa.array(pointer), langs, pa.array(p.texts(at, size), pa.string())],
                    ["fp", "size", "pointer", "lang", "phrase"])
    return run


def _filter(df: DataFrame, key: Column):
    return build_filter(df.select(key.alias("k")), "k")


def frequent_phrases(docs: DataFrame, least: int = LEAST, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): (lang, phrase, size, f) of all phrases of 1 to 4 words with f >= ``least`` occurrences in their
    language, and (lang, n): all word occurrences of each language. ``bits`` is the fingerprints' length (tests)."""
    rows = docs.select(F.xxhash64("doc_id").alias("key"), F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))
    counted = settle(rows.mapInArrow(_count_words(bits), "fp long, n long, lang string")
                     .groupBy("fp", "lang").agg(F.sum("n").alias("n")).where(f"lang is not null or n >= {least}"))
    totals = counted.where("lang is not null").select("lang", "n")
    words = _filter(counted.where("lang is null"), F.col("fp"))

    def count(sizes, some, pairs):
        counts = rows.mapInArrow(_count_phrases(bits, sizes, some, pairs), "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n"))
        return settle(counts.where(F.col("n") >= least).select("fp"))

    two = count((2,), words, None)
    pairs = _filter(two, F.col("fp"))
    frequent = _filter(counted.where("lang is null").select("fp").union(two).union(count((3, 4), None, pairs)), F.col("fp"))
    found = settle(rows.mapInArrow(_point(bits, words, pairs, frequent), _FOUND).groupBy("fp", "size").agg(
        F.sum("n").alias("n"), F.min("pointer").alias("pointer"), F.min("low").alias("low"), F.max("high").alias("high"))
        .where(F.col("n") >= least))
    clear = found.where("low = high")
    mixed_up = found.where("low <> high").select("fp", "size")
    named = _filter(clear, F.expr("fp ^ (shiftleft(cast(pointer as bigint), 32) | pointer)"))
    unclear = None if mixed_up.isEmpty() else _filter(mixed_up, F.col("fp"))
    texts = settle(rows.mapInArrow(_read_back(bits, words, pairs, named, unclear), "fp long, size int, pointer int, lang string, phrase string"))
    one = clear.join(texts, ["fp", "size", "pointer"]).groupBy("fp", "size").agg(
        F.first("lang").alias("lang"), F.first("phrase").alias("phrase"), F.first("n").alias("f")).drop("fp", "size")
    if unclear is not None:
        one = one.union(texts.join(mixed_up, ["fp", "size"]).groupBy("lang", "phrase").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= least))
    return settle(one.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("size"), "f")), totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, bits: int = 64) -> DataFrame:
    """Per language the ``top`` best phrases of 2 to 4 words: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and at spaces and tabs into words; phrases
    lie within pieces. a, l, r: occurrences of the phrase and of the two parts of its weakest cut; n: the language's words;
    score = floor(2000000 a / (l + r)), exact by decimals. Phrases that lie in a longer candidate with at least 80 % of
    their occurrences go. Ties: a, then the phrase by its UTF-8 bytes.

    Null languages are ``und``; null and empty texts have no words; null ids are ids of their own; repeated rows
    count each. Very long texts are used whole. An empty table, and languages without candidates, give no rows.
    Other columns are not read.
    """
    phrases, totals = frequent_phrases(docs, least, bits)
    parts = phrases.select("lang", F.col("phrase").alias("part"), "f")
    longer = phrases.where("size > 1").withColumn("w", F.split("phrase", " "))
    cut = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = longer.select("lang", "phrase", F.col("f").alias("a"), "w", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")) \
        .select("lang", "phrase", "a", "k", cut(F.lit(1), F.col("k")).alias("left"), cut(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    both = cuts.join(parts.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"]) \
        .join(parts.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    big = lambda c: F.col(c).cast("decimal(25,0)")
    score = F.expr(f"cast((cast(a as decimal(25,0)) * {SCALE}) div (cast(l as decimal(25,0)) + cast(r as decimal(25,0))) as long)")
    scored = both.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("c"))
    inner = longer.where("size > 2").select("lang", "f", "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m")) \
        .select("lang", "f", "w", "size", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("i")) \
        .select("lang", cut(F.col("i"), F.col("m")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    stay = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (big("cover") * 100 < big("a") * COVERED))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = stay.select("lang", "phrase", "a", "c.l", "c.r", "c.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
