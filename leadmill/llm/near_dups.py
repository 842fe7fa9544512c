"""MinHash near-dedup (operator 2): improved consistent weighted sampling over TF-IDF shingles.

1. Document frequencies of all shingles (five words) of all documents are counted into ``CELLS`` hashed
   cells, summed map-side. A cell's count errs by a fixed share of the documents, whatever their number.
2. Weight of a shingle: (1 + ln tf) * idf, idf = 1 + IDF_GAIN * ln(N / (df + N / CELLS * 600)), rounded to
   powers of exp(STEP). The gain keeps the weighted similarity near the plain one even where a large
   group of copies makes its own shingles frequent.
3. Consistent weighted sampling (Ioffe 2010): for sample k, a shingle draws r, c ~ Gamma(2, 1) and
   b ~ U(0, 1); t = floor(ln w / r + b); a = ln c - r (t - b + 1); the least a wins. Two documents draw the
   same (shingle, t) with a probability equal to their weighted Jaccard similarity. The draws come from
   one fixed table of triples, at the place a hash of (shingle, k) says.
4. Bands of ``ROWS`` samples are hashed; documents with an equal band form a bucket. A bucket elects
   the member that shares most buckets as its centre (the original of a group of copies shares more than
   a copy does), and every member is paired with it: as many pairs as members, never all pairs. After
   each round the classes of the links so far are computed, and buckets whose members are all in one class
   are done. What is still open after ``CENTRES`` rounds is compared in pairs of blocks, all pairs of unlike classes.
   Open buckets of one family hold much the same texts in many bands; those with one most shared member
   are joined to a crowd, so that a pair meets once. A class that fills blocks has them for itself, and they do not
   meet each other. So every pair with an equal band is either compared or in one class.
5. Pairs are verified by exact weighted Jaccard similarity >= ``SIMILAR``; links form classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bits import build_filter, may_hold
from .common import settle
from .components import components
from .tokens import Words, mix, odd

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 18, 4
CELLS = 1 << 18
IDF_GAIN = 0.1
STEP = 0.05
TRIPLES = 1 << 16
TEXTS_AT_ONCE = 256
CENTRES = 1             # rounds with one centre per bucket before the blocks
BLOCK = 512             # units in a block
UNIT = 1024             # shingles of a text that count as a unit
COLUMNS = 8192          # shingles of a block's table at once


def shingles(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes of each text with their counts. A text of 1 to 4 words has one shingle, all of
    its words; a text without words has none."""
    w = Words(column)
    h = w.hashes()
    g = w.grams(h, SHINGLE)
    for i in range(len(column)):
        a, b = w.first[i], w.first[i + 1]
        if b - a >= SHINGLE:
            yield np.unique(g[a:b - SHINGLE + 1], return_counts=True)
        elif b > a:
            yield mix(np.array([(h[a:b] * odd(b - a, 1)).sum()], np.uint64)), np.ones(1, np.int64)
        else:
            yield np.zeros(0, np.uint64), np.zeros(0, np.int64)


def _batches(batches, n=TEXTS_AT_ONCE):
    for batch in batches:
        for at in range(0, batch.num_rows, n):
            yield batch.slice(at, n)


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: document counts by cell, and the number of documents as cell -1."""
    counts, n = np.zeros(CELLS, np.int64), 0
    for batch in _batches(batches):
        n += batch.num_rows
        found = [s for s, _ in shingles(batch.column("text"))]
        if found:
            counts += np.bincount((np.concatenate(found) & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(counts[used], n))], ["cell", "n"])


def idf_table(docs: DataFrame):
    """Broadcast variable: idf by cell (1 MB)."""
    cells = docs.select("text").mapInArrow(_count_cells, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = cells.column("cell").to_numpy(), cells.column("n").to_numpy()
    total = max(1, int(n[cell < 0].sum()))
    df = np.zeros(CELLS)
    df[cell[cell >= 0]] = n[cell >= 0]
    idf = 1 + IDF_GAIN * np.log(np.maximum(1, total / (df + total * (600 / CELLS))))
    return docs.sparkSession.sparkContext.broadcast(idf.astype(np.float32))


def levels(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights as whole powers of exp(STEP)."""
    w = (1 + np.log(counts)) * idf[(found & np.uint64(CELLS - 1)).astype(np.int64)]
    return np.minimum(255, np.rint(np.log(w) / STEP)).astype(np.uint8)


class Sampler:
    """Consistent weighted samples of a weighted set, as 64-bit numbers that are equal where (shingle, t) are."""

    def __init__(self):
        rng = np.random.Generator(np.random.PCG64(7))
        self.r, self.c = rng.gamma(2, 1, TRIPLES), rng.gamma(2, 1, TRIPLES)
        self.b = rng.random(TRIPLES)
        self.tables: dict[int, np.ndarray] = {}
        self.multipliers = odd(BANDS * ROWS, 2)

    def table(self, level: int) -> np.ndarray:
        """For each triple: a as a sortable 32-bit number above, t below, given the weight's level."""
        if level not in self.tables:
            t = np.floor(level * STEP / self.r + self.b)
            a = (np.log(self.c) - self.r * (t - self.b + 1)).astype(np.float32).view(np.uint32)
            a = np.where(a >> 31, ~a, a | np.uint32(1 << 31))
            self.tables[level] = (a.astype(np.uint64) << np.uint64(32)) | (t.astype(np.int64).astype(np.uint64) & np.uint64(255))
        return self.tables[level]

    def sample(self, found: np.ndarray, level: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Samples (k, set) of the non-empty sets found[first[i]:first[i + 1]]."""
        used, inverse = np.unique(level, return_inverse=True)
        table = np.concatenate([self.table(int(v)) for v in used])
        base = inverse.astype(np.uint64) * np.uint64(TRIPLES)
        out = np.empty((len(self.multipliers), len(first)), np.uint64)
        for k, m in enumerate(self.multipliers):
            z = found * m
            z ^= z >> np.uint64(29)
            z *= np.uint64(0xBF58476D1CE4E5B9)
            drawn = table[(z >> np.uint64(48)) + base]
            drawn |= (z >> np.uint64(8)) & np.uint64(0xFFFFFF00)
            out[k] = np.minimum.reduceat(drawn, first)
        return out


_SAMPLER: list[Sampler] = []


def _band_batches(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _SAMPLER:
            _SAMPLER.append(Sampler())
        mixers = odd(ROWS, 3)
        for batch in _batches(batches):
            sets = list(shingles(batch.column("text")))
            sizes = np.array([len(s) for s, _ in sets])
            full = np.flatnonzero(sizes)
            bands = np.zeros((0, BANDS), np.uint64)
            if len(full):
                found = np.concatenate([s for s, _ in sets])
                level = levels(found, np.concatenate([c for _, c in sets]), idf.value)
                first = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                s = _SAMPLER[0].sample(found, level, first).reshape(BANDS, ROWS, len(full))
                bands = mix((mix(s) * mixers[None, :, None]).sum(axis=1)).T
            offsets = np.concatenate([[0], np.cumsum((sizes > 0) * BANDS)]).astype(np.int32)
            values = pa.array(np.ascontiguousarray(bands).reshape(-1).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("fp"), batch.column("doc_id"),
                                              pa.ListArray.from_arrays(pa.array(offsets), values)], ["fp", "doc_id", "bands"])
    return run


def _vector_batches(idf, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            keys = batch.column("key").to_numpy().view(np.uint64)
            batch = batch.take(pa.array(np.flatnonzero(may_hold(wanted.value, keys))))
            ids, lvs = [], []
            for found, counts in shingles(batch.column("text")):
                short = (found >> np.uint64(32)).astype(np.uint32)      # in the order of the hashes, so sorted
                ids.append(short.tobytes())
                lvs.append(levels(found, counts, idf.value).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(ids, pa.binary()), pa.array(lvs, pa.binary())], ["fp", "ids", "lvs"])
    return run


def weighted_jaccard(a_ids: np.ndarray, a_lvs: np.ndarray, b_ids: np.ndarray, b_lvs: np.ndarray) -> float:
    """Sum of the lesser weights over the sum of the greater ones; weights are given as levels."""
    a, b = np.exp(a_lvs.astype(np.float64) * STEP), np.exp(b_lvs.astype(np.float64) * STEP)
    _, i, j = np.intersect1d(a_ids, b_ids, assume_unique=False, return_indices=True)
    low = np.minimum(a[i], b[j]).sum()
    high = a.sum() + b.sum() - low
    return float(low / high) if high else 0.0


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sims = []
        cols = [batch.column(c).to_pylist() for c in ("a_ids", "a_lvs", "b_ids", "b_lvs")]
        for ai, al, bi, bl in zip(*cols):
            sims.append(weighted_jaccard(np.frombuffer(ai, np.uint32), np.frombuffer(al, np.uint8),
                                         np.frombuffer(bi, np.uint32), np.frombuffer(bl, np.uint8)))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sims, pa.float64())], ["a", "b", "sim"])


def _likely_pairs(ids: list[np.ndarray], weights: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(i, j) for all pairs of ``left`` x ``right`` that may reach ``SIMILAR``: sqrt(x * y) >= min(x, y) bounds what they share."""
    shared = np.zeros((len(left), len(right)))
    total = np.array([w.sum() for w in weights])
    sides = []
    for members in (left, right):
        at = np.concatenate([ids[m] for m in members])
        order = np.argsort(at, kind="stable")
        sides.append((at[order], np.repeat(np.arange(len(members)), [len(ids[m]) for m in members])[order],
                      np.sqrt(np.concatenate([weights[m] for m in members]))[order]))
    common = np.intersect1d(sides[0][0], sides[1][0])
    for k in range(0, len(common), COLUMNS):
        some, tables = common[k:k + COLUMNS], []
        for (at, row, root_w), members in zip(sides, (left, right)):
            a, b = np.searchsorted(at, some[0]), np.searchsorted(at, some[-1], "right")
            column = np.searchsorted(some, at[a:b])
            hit = some[column] == at[a:b]
            table = np.zeros((len(members), len(some)), np.float32)
            np.add.at(table, (row[a:b][hit], column[hit]), root_w[a:b][hit])
            tables.append(table)
        shared += tables[0] @ tables[1].T
    return np.argwhere(shared * (1 + SIMILAR) >= SIMILAR * (total[left][:, None] + total[right][None, :]) * 0.999)


def _verify_blocks(block: pa.Table) -> pa.Table:
    """Links that join all classes of two blocks (or one) of a bucket: each pair of texts of unlike classes is compared,
    but for those that links found before have joined."""
    key = block.column("i")[0].as_py(), block.column("j")[0].as_py()
    fps, p = block.column("fp").to_pylist(), block.column("block").to_numpy()
    _, part = np.unique(np.array([r.hex() for r in block.column("root").to_pylist()]), return_inverse=True)
    ids = [np.frombuffer(x, np.uint32) for x in block.column("ids").to_pylist()]
    lvs = [np.frombuffer(x, np.uint8) for x in block.column("lvs").to_pylist()]
    left, right = np.flatnonzero(p == key[0]), np.flatnonzero(p == key[1])
    out = []
    if len(left) and len(right):
        for i, j in _likely_pairs(ids, [np.exp(x * STEP) for x in lvs], left, right):
            a, b = int(left[i]), int(right[j])
            if part[a] == part[b]:
                continue
            sim = weighted_jaccard(ids[a], lvs[a], ids[b], lvs[b])
            if sim >= SIMILAR:
                part[part == part[b]] = part[a]
                out.append((fps[a], fps[b], sim))
    return pa.table([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.float64()))], ["a", "b", "sim"])


def fingerprint(text: Column) -> Column:
    """128 bits that stand for a text; null for a null text."""
    return F.unhex(F.md5(text.cast("binary")))


def _open_buckets(left: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of buckets whose members are not yet all in one class, each with the root of its class."""
    known = left.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    still = known.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    return settle(known.join(still, "key"))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after further links (a, b)."""
    return settle(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links.select("a", "b"))))


def _crowds(left: DataFrame) -> DataFrame:
    """(crowd, fp, root): open buckets with one most shared member are one crowd, in which two texts meet once and not once
    per band, if the crowd has no more pairs than its buckets together. Other buckets are crowds of their own."""
    heads = left.groupBy("key").agg(F.min(F.struct("rank", "fp")).alias("h"), F.count(F.lit(1)).cast("double").alias("n"))
    placed = settle(left.join(heads.select("key", F.col("h.fp").alias("head"), "n"), "key").select("key", "head", "n", "fp", "root"))
    texts = placed.groupBy("head", "fp").agg(F.sum("n").alias("n"))         # summed over texts: the squares of the buckets
    merge = texts.groupBy("head").agg((F.pow(F.count(F.lit(1)), F.lit(2.0)) <= F.sum("n")).alias("merge"))
    crowd = F.when(F.col("merge"), F.xxhash64(F.lit("crowd"), "head")).otherwise(F.col("key"))
    return placed.join(merge, "head").select(crowd.alias("crowd"), "fp", "root").distinct()


def _in_blocks(crowds: DataFrame, vectors: DataFrame) -> DataFrame:
    """(crowd, block, fp, root): the members of a crowd dealt to blocks of about ``BLOCK`` units, of ``UNIT`` shingles
    each. A class that fills a block has blocks of its own, since its members need not meet; the other classes
    share blocks, each whole in one."""
    units = vectors.select("fp", F.expr(f"ceil(octet_length(ids) / {4 * UNIT})").alias("units"))
    members = settle(crowds.join(units, "fp"))
    classes = members.groupBy("crowd", "root").agg(F.sum("units").alias("units"))
    large = classes.where(F.col("units") >= BLOCK).select("crowd", "root", F.ceil(F.col("units") / BLOCK).alias("parts"))
    small = classes.where(F.col("units") < BLOCK).groupBy("crowd").agg(F.ceil(F.sum("units") / BLOCK).alias("shared"))
    dealt = members.join(large, ["crowd", "root"], "left").join(small, "crowd", "left")
    block = F.when(F.col("parts").isNull(), F.xxhash64(F.lit("shared"), F.expr("pmod(xxhash64(root, crowd), shared)"))).otherwise(
        F.xxhash64("root", F.expr("pmod(xxhash64(fp, crowd), parts)")))
    return settle(dealt.select("crowd", block.alias("block"), "fp", "root"))


def _block_pairs(members: DataFrame) -> DataFrame:
    """(crowd, i, j, block, fp, root): the members of all pairs of blocks of a crowd that hold unlike classes."""
    blocks = members.groupBy("crowd", "block").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    a = blocks.select("crowd", F.col("block").alias("i"), F.col("x").alias("i_x"), F.col("y").alias("i_y"))
    b = blocks.select("crowd", F.col("block").alias("j"), F.col("x").alias("j_x"), F.col("y").alias("j_y"))
    unlike = F.least("i_x", "j_x") < F.greatest("i_y", "j_y")
    pairs = a.join(b, "crowd").where((F.col("i") <= F.col("j")) & unlike).select("crowd", "i", "j")
    sides = pairs.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    return sides.join(members, ["crowd", "block"])


def near_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, roots): the distinct texts as (fp, rep: smallest doc_id), and (node, root) for each text that is linked
    to another, by verified links; root is one text of its class."""
    rows = docs.select("doc_id", "text", fingerprint(F.col("text")).alias("fp")).where("text is not null")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    idf = idf_table(rows)
    signed = rows.select("fp", "doc_id", "text").mapInArrow(_band_batches(idf), f"fp binary, doc_id {id_type}, bands array<long>")
    texts = settle(signed.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.max("bands").alias("bands")))
    key = F.xxhash64(F.lit("band"), "pos", F.expr("get(bands, pos)"))
    places = texts.select("fp", "bands", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("pos")).where(F.size("bands") > 0)
    # only members of buckets with two or more are kept, without the long rows
    left = places.select("fp", key.alias("key"))
    shared = left.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    left = settle(left.join(shared, "key").select("fp", "key", "n"))
    degree = left.groupBy("fp").agg((-F.sum("n")).alias("rank"))        # the most shared come first
    left = settle(left.join(degree, "fp").select("fp", "key", "rank"))
    wanted = build_filter(left.select(F.xxhash64("fp").alias("k")).distinct(), "k")
    vectors = rows.select("fp", "text", F.xxhash64("fp").alias("key")).mapInArrow(
        _vector_batches(idf, wanted), "fp binary, ids binary, lvs binary").groupBy("fp").agg(
        F.max("ids").alias("ids"), F.max("lvs").alias("lvs"))
    vectors = settle(vectors)
    a_side = vectors.select(F.col("fp").alias("a"), F.col("ids").alias("a_ids"), F.col("lvs").alias("a_lvs"))
    b_side = vectors.select(F.col("fp").alias("b"), F.col("ids").alias("b_ids"), F.col("lvs").alias("b_lvs"))
    roots = texts.select(F.col("fp").alias("node"), F.col("fp").alias("root")).where("false")
    left = _open_buckets(left, roots)
    for _ in range(CENTRES):
        if left.isEmpty():
            break
        order = F.struct(F.col("rank"), F.xxhash64("key", "fp"), F.col("fp"), F.col("root"))
        centres = left.groupBy("key").agg(F.min(order).alias("c")).select("key", F.col("c.fp").alias("c"), F.col("c.root").alias("c_root"))
        met = left.join(centres, "key").where("fp <> c")
        pairs = met.where("root <> c_root").select(F.greatest("fp", "c").alias("a"), F.least("fp", "c").alias("b")).distinct()
        sims = pairs.join(a_side, "a").join(b_side, "b").mapInArrow(
            _verify, "a binary, b binary, sim double").where(F.col("sim") >= SIMILAR)
        roots = _joined(roots, sims)
        left = _open_buckets(met.select("fp", "key", "rank"), roots)      # a centre has met all others of its bucket
    if not left.isEmpty():
        places = _block_pairs(_in_blocks(_crowds(left), vectors))
        found = places.join(vectors, "fp").groupBy("crowd", "i", "j").applyInArrow(_verify_blocks, "a binary, b binary, sim double")
        roots = _joined(roots, found)
    return texts.select("fp", "rep"), roots


def _rooted(texts: DataFrame, roots: DataFrame) -> DataFrame:
    return texts.join(roots, texts.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))


def duplicate_classes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id and class_id, the smallest doc_id of its class.

    Equal texts share a class; texts linked by a weighted Jaccard similarity of 0.8 or more, directly or
    through others, do too. Texts without words are equal only to the same text. A null text is a
    class of its own, named by its doc_id. Null ids are kept; a class with null ids only has a null class_id.
    Repeated rows get a row each. Very long texts are used whole. An empty table gives an empty result.
    Other columns are not read. Vectors hold 32-bit shingle ids, so a similarity may err by about
    n / 2**32 for n shingles.
    """
    of_text = _rooted(*near_classes(docs))
    names = of_text.groupBy("root").agg(F.min("rep").alias("class_id"))
    classes = settle(of_text.join(names, "root").select("fp", "class_id"))
    ids = docs.select("doc_id", fingerprint(F.col("text")).alias("fp"))
    return ids.join(classes, "fp", "left").select(
        "doc_id", F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class stays, the one with the smallest doc_id, with all columns of ``docs``.

    Rows with a null text or a null doc_id are no part of a class and stay. A document is a pair of doc_id and
    text: unlike texts under one doc_id are judged each. Of texts of one class under its smallest doc_id
    the one with the least fingerprint stays; of repeated rows the one whose JSON has the least MD5.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    of_text = _rooted(*near_classes(docs.where("doc_id is not null").select("doc_id", "text")))
    stay = of_text.groupBy("root").agg(F.min(F.struct("rep", "fp")).alias("k")).select(F.col("k.rep").alias("doc_id"), "k.fp")
    packed = docs.select(row.alias("row"), "doc_id", fingerprint(F.col("text")).alias("fp"))
    whole = packed.where("doc_id is null or fp is null").select("row")
    once = packed.join(stay, ["doc_id", "fp"], "left_semi").groupBy("doc_id", "fp").agg(
        F.min_by("row", F.md5(F.to_json("row"))).alias("row")).select("row")
    return whole.union(once).select("row.*")
