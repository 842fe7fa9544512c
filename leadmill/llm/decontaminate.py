"""Benchmark decontamination (operator 9): size-partitioned MinHash containment search.

Short test items are searched inside long documents. MinHash estimates Jaccard similarity, which says little
about containment when the sizes differ, so sizes are made alike:

1. Items are partitioned by size: class c has 2**c to 2**(c+1) - 1 distinct shingles (five words).
2. For each class, a document is read through overlapping windows of 1.25 * 2**(c+1) shingles, a quarter of
   2**(c+1) apart, so that a passage of the class's size lies whole in some window. An item of the class
   with containment 0.8 has a Jaccard similarity of 0.29 or more with that window.
3. Items and windows have ``HASHES`` min-hashes; a candidate agrees in one of them (bands of one row), which
   a similarity of 0.29 misses with a probability of 0.71**64, about 3e-10.
4. Candidates are verified by exact shingle containment in the whole document.

A filter of fixed size over the items' shingles and min-hashes is sent to the tasks. A window that holds no
shingle of any item cannot agree with one, so only windows with a possible hit are hashed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bits import build_filter, may_hold
from .common import broadcast_checked, settle
from .tokens import Words, mix, odd

SHINGLE = 5
CONTAINED = 0.8
HASHES = 64
PIECE = 1 << 14         # shingles of a long document that are hashed at once
TEXTS_AT_ONCE = 512
_MULTIPLIERS = odd(HASHES, 5)


def _spread(x: np.ndarray) -> np.ndarray:
    """(HASHES, n) hash values of n shingles."""
    z = x[None, :] * _MULTIPLIERS[:, None]
    return z ^ (z >> np.uint64(31))


def _keys(minima: np.ndarray, size_class: int) -> np.ndarray:
    """Join keys of min-hashes: they tell class and hash number apart."""
    k = np.arange(HASHES, dtype=np.uint64).reshape(-1, *[1] * (minima.ndim - 1))
    return mix(minima + mix(k + np.uint64(size_class * HASHES + 1)))


def size_class(n: int) -> int:
    return int(n).bit_length() - 1


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        w = Words(batch.column("text"))
        g = w.grams(w.hashes(), SHINGLE)
        found, keys, classes = [], [], []
        for i in range(batch.num_rows):
            s = np.unique(g[w.first[i]:max(w.first[i], w.first[i + 1] - SHINGLE + 1)])
            c = size_class(len(s)) if len(s) else -1
            found.append(s.view(np.int64))
            classes.append(c)
            keys.append(_keys(_spread(s).min(axis=1), c).view(np.int64) if len(s) else s.view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(classes, pa.int32()), pa.array(found, pa.list_(pa.int64())),
                                          pa.array(keys, pa.list_(pa.int64()))], ["item_id", "size_class", "shingles", "keys"])


def window_keys(x: np.ndarray, hit: np.ndarray, c: int) -> np.ndarray:
    """Distinct keys of the windows of class c that hold a hit; x: shingles in order, hit: flags."""
    top = 1 << (c + 1)
    step = max(1, top // 4)
    blocks = -(-top // step) + 1                       # a window is this many blocks of ``step`` shingles
    out = []
    for at in range(0, len(x), PIECE):                 # the next pieces' windows overlap this one's end
        part, flags = x[at:at + PIECE + blocks * step], hit[at:at + PIECE + blocks * step]
        if not flags.any():
            continue
        first = np.arange(0, len(part), step)
        has = np.logical_or.reduceat(flags, first)
        near = has.copy()                              # blocks of windows with a hit
        for d in range(1, blocks):
            near[d:] |= has[:-d]
            near[:-d] |= has[d:]
        low = np.full((HASHES, len(first)), np.iinfo(np.uint64).max, np.uint64)
        chosen = np.flatnonzero(near)
        cells = (chosen[:, None] * step + np.arange(step)[None, :]).ravel()
        cells = np.minimum(cells, len(part) - 1)
        low[:, chosen] = _spread(part[cells]).reshape(HASHES, len(chosen), step).min(axis=2)
        n = max(1, len(first) - blocks + 1)
        wide, some = low[:, :n].copy(), has[:n].copy()
        for d in range(1, min(blocks, len(first))):
            np.minimum(wide, low[:, d:d + n], out=wide)
            some |= has[d:d + n]
        out.append(np.unique(_keys(wide[:, some], c)))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def _document_batches(wanted, classes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                w = Words(batch.column("text"))
                g = w.grams(w.hashes(), SHINGLE)
                hit = np.zeros(len(g), bool)
                places = w.whole(SHINGLE)
                hit[places] = may_hold(wanted.value, g[places])
                rows, hits, keys = [], [], []
                for i in np.unique(w.text_of[np.flatnonzero(hit)]):
                    a, b = w.first[i], max(w.first[i], w.first[i + 1] - SHINGLE + 1)
                    found = np.concatenate([window_keys(g[a:b], hit[a:b], c) for c in classes])
                    found = found[may_hold(wanted.value, found)]
                    if len(found):
                        rows.append(i)
                        hits.append(np.unique(g[a:b][hit[a:b]]).view(np.int64))
                        keys.append(found.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())), batch.column("fp").take(pa.array(rows, pa.int64())),
                     pa.array(hits, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "fp", "hits", "keys"])
    return run


def _with_fingerprint(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("fp"))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, fp, item_id, n_shingles, n_shared, containment) for each item with containment >= 0.8 in a document.

    ``fp`` is the text's fingerprint (16 bytes). Null and empty texts, and items of fewer than five words, have no
    shingles and no matches. Rows with a null id are searched like others. Repeated documents or items
    appear once each. Very long documents are searched whole, piece by piece. Empty tables give an empty
    result. Other columns are not read.
    """
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    items = settle(benchmark.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(
        _item_batches, f"item_id {item_type}, size_class int, shingles array<long>, keys array<long>")
        .where("size_class >= 0").select("*", F.xxhash64("item_id", "shingles").alias("item")))
    classes = sorted(r[0] for r in items.select("size_class").distinct().collect())        # at most 63
    wanted = build_filter(items.select(F.explode(F.concat("shingles", "keys")).alias("k")).distinct(), "k")
    seen = settle(_with_fingerprint(docs).mapInArrow(_document_batches(wanted, classes),
                                                     f"doc_id {doc_type}, fp binary, hits array<long>, keys array<long>"))
    texts = seen.groupBy("fp").agg(F.max("hits").alias("hits"), F.max("keys").alias("keys"))   # equal texts once
    pairs = texts.select("fp", F.explode("keys").alias("key")).join(
        items.select("item", F.explode("keys").alias("key")), "key").select("fp", "item").distinct()
    checked = pairs.join(texts.select("fp", "hits"), "fp").join(items.select("item", "item_id", "shingles"), "item").select(
        "fp", "item_id", F.size("shingles").alias("n_shingles"), F.size(F.array_intersect("shingles", "hits")).alias("n_shared"))
    checked = checked.withColumn("containment", F.col("n_shared") / F.col("n_shingles")).where(F.col("containment") >= CONTAINED)
    return seen.select("doc_id", "fp").distinct().join(checked, "fp").distinct()


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item, with all their columns. Others all stay."""
    bad = settle(find_leaks(docs.select("doc_id", "text"), benchmark).select("fp").distinct())
    fp = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), fp.alias("fp"))
    return packed.join(broadcast_checked(bad), "fp", "left_anti").select("row.*")
