"""Substring dedup (operator 3): relative Lempel-Ziv parsing of each document against all earlier documents.

The reference of a document is every document with a smaller id. Its index is a hash table of all seeds
(sequences of ``SEED`` = 13 words) of all documents, dealt over the cluster by seed; each of its
partitions is one indexed block, and every seed of a document is looked up in the block that would hold
it. A document is then parsed greedily: a factor starts at the first word where a seed is found and
grows while the next seed is found in the same reference; where a factor ends, the seeds that reach
over its border have been looked up too, and open the next factor. Each factor is a duplicate span;
words outside all factors are kept.

To index all seeds of a large corpus would move more bytes than the corpus has. So:

* Each seed has an anchor: the least hash of the eight 6-word sequences in it. Equal seeds have equal
  anchors, and neighbouring seeds mostly share theirs. A first exchange of (anchor, document), about one
  for five words, finds anchors that occur in two documents or more; only seeds with such an anchor enter
  the index. Nothing is lost: a seed of two documents has its anchor in both.
* Both exchanges are reduced in each task first: of an anchor or seed that a batch has several times, one
  row goes to the index, and the others are decided on the spot (a smaller id is in the same batch). So
  a passage in a third of all documents reaches its index partition once per batch.
* Of equal texts, only the one with the smallest id enters the index; the others are wholly in it.

Seeds are compared by two independent 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .common import settle
from .near_dups import fingerprint
from .tokens import Words, mix, odd

SEED = 13
GRAM = 6
TEXTS_AT_ONCE = 2_048


def anchors(w: Words, h: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The anchor of the seed at each place."""
    g = w.grams(h, GRAM)
    span = SEED - GRAM + 1                              # 8 sequences: minima over 1, 2, 4, 8
    d = 1
    while d < span:
        g = np.minimum(g[:-d], g[d:]) if len(g) > d else g[:0]
        d *= 2
    return g[places]


def _distinct_pairs(keys: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((texts, keys))
    keys, texts = keys[order], texts[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])
    return keys[new], texts[new]


def _slices(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
            yield whole.slice(at, TEXTS_AT_ONCE)


def _per_text(values: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts that occur, list offsets, values in their order)."""
    order = np.argsort(texts, kind="stable")
    used, sizes = np.unique(texts, return_counts=True)
    return used, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), values[order]


def _lists(offsets: np.ndarray, values: np.ndarray, before: int) -> pa.Array:
    """``before`` nulls, then a list for each range of the offsets."""
    starts = np.concatenate([np.zeros(before, np.int32), offsets])
    missing = np.arange(len(starts)) < before
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32(), mask=missing if before else None), pa.array(values, pa.int64()))


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, doc_id, decided). An anchor that one text of the batch has gives (anchor, doc, null); one that
    several have gives (anchor, null, null) once, and each of these texts a row (spread, doc, its such anchors)."""
    for batch in _slices(batches):
        w = Words(batch.column("text"))
        places = w.whole(SEED)
        keys, texts = _distinct_pairs(anchors(w, w.hashes(), places), w.text_of[places])
        docs = batch.column("doc_id").to_numpy()
        same = np.zeros(len(keys), bool)
        same[1:] = keys[1:] == keys[:-1]
        several = same.copy()
        several[:-1] |= same[1:]
        token = several & ~same                        # the first of several
        used, offsets, values = _per_text(keys[several].view(np.int64), texts[several])
        spread = mix(docs[used].astype(np.uint64) * odd(1, 11)[0])
        n_alone, n_token = int((~several).sum()), int(token.sum())
        key = np.concatenate([keys[~several], keys[token], spread]).view(np.int64)
        ids = pa.concat_arrays([pa.array(docs[texts[~several]], pa.int64()), pa.nulls(n_token, pa.int64()), pa.array(docs[used], pa.int64())])
        yield pa.RecordBatch.from_arrays([pa.array(key), ids, _lists(offsets, values, n_alone + n_token)], ["anchor", "doc_id", "decided"])


def _in_lists(values: np.ndarray, text_of: np.ndarray, column: pa.Array, n: int) -> np.ndarray:
    """For each value, its position in its text's list (flattened), or -1."""
    lists = column.to_pylist() if not pa.types.is_list(column.type) else None
    offsets = column.offsets.to_numpy() if lists is None else None
    flat = column.values.to_numpy(zero_copy_only=False).view(np.uint64) if lists is None else None
    found = np.full(len(values), -1, np.int64)
    first = np.searchsorted(text_of, np.arange(n + 1))
    for i in range(n):
        a, b = first[i], first[i + 1]
        lo, hi = offsets[i], offsets[i + 1]
        if a < b and lo < hi:
            order = np.argsort(flat[lo:hi])
            sorted_ = flat[lo:hi][order]
            at = np.minimum(np.searchsorted(sorted_, values[a:b]), hi - lo - 1)
            ok = sorted_[at] == values[a:b]
            found[a:b] = np.where(ok, lo + order[at], -1)
    return found


def _seed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h1, h2, doc_id, hits, refs) of the seeds whose anchor is shared. The batch's smallest document with a seed
    gives (h1, h2, doc, null, null) for the index. Each document whose seeds are in a smaller document of the
    batch has a row with lists of these seeds and documents."""
    for batch in _slices(batches):
        w = Words(batch.column("text"))
        h, h2 = w.hashes(), w.hashes(1)
        places = w.whole(SEED)
        hit = _in_lists(anchors(w, h, places), w.text_of[places], batch.column("shared"), batch.num_rows) >= 0
        places = places[hit]
        s1, s2, texts = w.grams(h, SEED, 7)[places], w.grams(h2, SEED, 9)[places], w.text_of[places]
        ids = batch.column("doc_id").to_numpy()
        docs = ids[texts]
        order = np.lexsort((texts, docs, s2, s1))
        s1, s2, docs, texts = s1[order], s2[order], docs[order], texts[order]
        new_seed = np.ones(len(s1), bool)
        new_seed[1:] = (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
        new_pair = new_seed.copy()
        new_pair[1:] |= texts[1:] != texts[:-1]
        least = docs[np.flatnonzero(new_seed)][np.cumsum(new_seed) - 1] if len(docs) else docs
        late = new_pair & (docs != least)
        used, offsets, hits = _per_text(s1[late].view(np.int64), texts[late])
        _, _, refs = _per_text(least[late], texts[late])
        spread = mix(ids[used].astype(np.uint64) * odd(1, 13)[0])
        n = int(new_seed.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([s1[new_seed], spread]).view(np.int64)), pa.array(np.concatenate([s2[new_seed], spread]).view(np.int64)),
             pa.array(np.concatenate([docs[new_seed], ids[used]]), pa.int64()), _lists(offsets, hits, n), _lists(offsets, refs, n)],
            ["h1", "h2", "doc_id", "hits", "refs"])


def greedy_factors(found: np.ndarray, ref: np.ndarray) -> list[tuple[int, int, int]]:
    """Factors (start, end, ref) in words; found: places of seeds with a reference, ascending; ref: the reference of each."""
    if not len(found):
        return []
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1] + 1) | (ref[1:] != ref[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(found)) - 1
    return list(zip(found[first].tolist(), (found[last] + SEED).tolist(), ref[first].tolist()))


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        n = batch.num_rows
        w = Words(batch.column("text"))
        spans: list[list] = [[] for _ in range(n)]
        flags = batch.column("hits")
        sizes = np.diff(flags.offsets.to_numpy()) if n else np.zeros(0, int)
        if sizes.any():
            places = w.whole(SEED)
            text_of = w.text_of[places]
            at = _in_lists(w.grams(w.hashes(), SEED, 7)[places], text_of, flags, n)
            refs = batch.column("refs").values.to_numpy(zero_copy_only=False)
            ok = at >= 0
            places, text_of, at = places[ok], text_of[ok], at[ok]
            first = np.searchsorted(text_of, np.arange(n + 1))
            for i in np.flatnonzero(np.diff(first)):
                a, b = first[i], first[i + 1]
                spans[i] = greedy_factors(places[a:b] - w.first[i], refs[at[a:b]])
        copies = batch.column("copy_of").to_pylist()
        kept, removed, n_words = [], [], np.diff(w.first)
        for i, text in enumerate(batch.column("text").to_pylist()):
            words = text.encode().split()              # bytes split at the six blanks only
            if copies[i] is not None and len(words) >= SEED:
                spans[i] = [(0, len(words), copies[i])]
            if spans[i]:
                keep = np.ones(len(words), bool)
                for a, b, _ in spans[i]:
                    keep[a:b] = False
                removed.append(int(len(words) - keep.sum()))
                words = [words[k] for k in np.flatnonzero(keep)]
            else:
                removed.append(0)
            kept.append(b" ".join(words).decode())
        factor = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("ref", pa.int64())]))
        spans = [[{"start": a, "end": b, "ref": r} for a, b, r in s] for s in spans]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(kept, pa.string()), pa.array(spans, factor)],
                                         ["doc_id", "n_words", "n_removed", "kept", "factors"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, ``kept`` (the words outside all factors, joined by one space) and
    ``factors`` (start, end, ref): word positions and an earlier document with this passage.

    A word goes if a window of 13 words over it also begins in a document with a smaller doc_id; repeats
    inside one document stay. doc_id must be a whole number. Rows with a null id neither lose words nor make
    others lose them. Rows with equal ids are compared with smaller ids only. Null and empty texts have
    no words and are kept as the empty string. Texts under 13 words lose nothing. Very long texts are
    parsed whole. An empty table gives an empty result. Other columns are not read.
    """
    # without a needless alias, under which Spark would not see that both joins can read one exchange of the texts
    ident = F.col("doc_id") if docs.schema["doc_id"].dataType.typeName() == "long" else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(ident, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    known = rows.where("doc_id is not null")
    # equal texts: all but the smallest id are copies
    ids = settle(known.where("text <> ''").select("doc_id", fingerprint(F.col("text")).alias("fp")))
    several = ids.groupBy("fp").agg(F.min("doc_id").alias("copy_of"), F.max("doc_id").alias("last")).where("copy_of < last")
    copies = ids.join(several.select("fp", "copy_of"), "fp").where("doc_id > copy_of").select("doc_id", "copy_of")

    found = known.mapInArrow(_anchor_batches, "anchor long, doc_id long, decided array<long>")
    found = found.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("anchor")))
    shared = found.where("doc_id is not null and (decided is not null or n > 1)").groupBy("doc_id").agg(
        F.flatten(F.collect_list(F.coalesce("decided", F.array("anchor")))).alias("shared"))
    # a repeated id with two texts: copies are settled by id and text, so only ids with one text count as copies
    one_text = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("doc_id")
    copies = settle(copies.join(one_text, "doc_id"))
    shared = shared.join(copies, "doc_id", "left_anti")
    seeds = known.join(shared, "doc_id").select("doc_id", "text", "shared").mapInArrow(
        _seed_batches, "h1 long, h2 long, doc_id long, hits array<long>, refs array<long>")
    seeds = seeds.withColumn("least", F.min("doc_id").over(Window.partitionBy("h1", "h2"))).where("hits is not null or least < doc_id")
    hits = seeds.groupBy("doc_id").agg(
        F.flatten(F.collect_list(F.coalesce("hits", F.array("h1")))).alias("hits"),
        F.flatten(F.collect_list(F.coalesce("refs", F.array("least")))).alias("refs"))
    decided = hits.join(copies, "doc_id", "full")
    empty = F.expr("cast(array() as array<bigint>)")
    # the join reads the same exchange of texts as the one for the seeds
    parsed = known.join(decided, "doc_id", "left").unionByName(rows.where("doc_id is null"), allowMissingColumns=True)
    return parsed.select(
        "doc_id", "text", F.coalesce("hits", empty).alias("hits"), F.coalesce("refs", empty).alias("refs"), "copy_of").mapInArrow(
        _parse_batches, "doc_id long, n_words long, n_removed long, kept string, factors array<struct<start:int,end:int,ref:long>>")
