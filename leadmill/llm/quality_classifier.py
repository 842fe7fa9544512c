"""Quality classifier (operator 1): positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are labelled rows of label 1; rows of label 0 are never used. Unlabelled text is any text of
the learning fold. With class prior p, loss l and model g, the risk (Kiryo et al. 2017) is

    p * E_pos[l(g)] + max(0, E_unl[l(-g)] - p * E_pos[l(-g)])

and while the second term is negative, a step lowers its size instead. The prior is estimated: a
first classifier tells positives from unlabelled text; over regions of high scores, where
few other texts lie, the ratio of the unlabelled share to the positive share is about the prior, and the
median of the ratios estimates it (their least value would be drawn down by chance in small samples).

The features are shares and lengths of a text (no vocabulary): they are computed in one pass over whole
texts. Their means and spreads are taken over all documents; the fit uses bounded samples of
``SAMPLE`` rows each, chosen by a hash of the id, and a few numpy steps on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import settle
from .tokens import Words

SAMPLE = 20_000         # positives, and unlabelled rows, of the fit
KEEP_AT = 0.7
STEPS, RATE, L2 = 600, 0.5, 1e-4
FEATURES = ["log_words", "word_len", "symbols", "pipes", "bangs", "capitals", "digits", "high_bytes", "stops", "commas",
            "lines", "distinct_words", "repeated_triples", "same_neighbours"]
TEXTS_AT_ONCE = 512
_BYTES = {"symbols": b"#*$%&<>", "pipes": b"|", "bangs": b"!?", "capitals": bytes(range(65, 91)), "digits": b"0123456789",
          "high_bytes": bytes(range(128, 256)), "stops": b".", "commas": b",;:", "lines": b"\n"}


def text_features(column: pa.Array) -> np.ndarray:
    """(texts, features) of whole texts; texts without words have zeros."""
    w = Words(column)
    n_texts = len(column)
    n = np.diff(w.first)
    ok = np.maximum(n, 1)
    chars = np.bincount(w.text_of, weights=w.ends - w.starts, minlength=n_texts)
    out = {"log_words": np.log1p(n), "word_len": chars / ok}
    # bytes by text: sums between the texts' first bytes
    lengths = np.array([len(t) for t in column.cast(pa.binary()).to_pylist()] if n_texts else [], np.int64)
    edges = np.concatenate([[0], np.cumsum(lengths)])
    for name, values in _BYTES.items():
        table = np.zeros(256, bool)
        table[list(values)] = True
        sums = np.concatenate([[0], np.cumsum(table[w.data], dtype=np.int64)])
        out[name] = (sums[edges[1:]] - sums[edges[:-1]]) / ok
    h = w.hashes()

    def distinct(values, texts):
        order = np.lexsort((values, texts))
        v, t = values[order], texts[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (t[1:] != t[:-1])
        return np.bincount(t[new], minlength=n_texts)

    out["distinct_words"] = distinct(h, w.text_of) / ok
    places = w.whole(3)
    triples = np.bincount(w.text_of[places], minlength=n_texts)
    out["repeated_triples"] = (triples - distinct(w.grams(h, 3)[places], w.text_of[places])) / np.maximum(triples, 1)
    pairs = w.whole(2)
    same = pairs[h[pairs] == h[pairs + 1]]
    out["same_neighbours"] = np.bincount(w.text_of[same], minlength=n_texts) / ok
    # shares are squeezed so that a few extreme texts do not set the scale
    x = np.stack([np.sqrt(out[f]) if f not in ("log_words", "word_len") else out[f] for f in FEATURES], axis=1)
    return x * (n > 0)[:, None]


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
            batch = whole.slice(at, TEXTS_AT_ONCE)
            x = text_features(pa.array(batch.column("text").to_pylist(), pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(x[:, j]) for j in range(x.shape[1])], ["doc_id", *FEATURES])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Class prior of the unlabelled rows: the median ratio of shares over regions of high scores."""
    w = np.zeros(pos.shape[1])
    for _ in range(STEPS):      # a classifier of positive against unlabelled rows, equally weighted
        grad = (-(_sigmoid(-pos @ w))[:, None] * pos).mean(0) + (_sigmoid(unl @ w)[:, None] * unl).mean(0) + L2 * w
        w -= RATE * grad
    p, u = np.sort(pos @ w), np.sort(unl @ w)
    cuts = p[(len(p) * np.arange(0, 51) // 100)]                     # regions with half of the positives or more
    share_p = 1 - np.searchsorted(p, cuts, "left") / len(p)
    share_u = 1 - np.searchsorted(u, cuts, "left") / len(u)
    return float(np.clip(np.median(share_u / share_p), 0.05, 0.99))


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float) -> np.ndarray:
    """Weights of a linear model by gradient steps on the non-negative risk, averaged over the last half."""
    w, mean = np.zeros(pos.shape[1]), np.zeros(pos.shape[1])
    for step in range(STEPS):
        gp, gu = pos @ w, unl @ w
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        grad_n = (_sigmoid(gu)[:, None] * unl).mean(0) - prior * (_sigmoid(gp)[:, None] * pos).mean(0)
        if negative >= 0:
            grad = prior * (-(_sigmoid(-gp))[:, None] * pos).mean(0) + grad_n
        else:
            grad = -grad_n
        w = w - RATE * (grad + L2 * w)
        if step >= STEPS // 2:
            mean += w
    return mean / (STEPS - STEPS // 2)


def fold(doc_id: Column) -> Column:
    """True for the rows held out: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.7).

    ``labels``: (doc_id, quality); a document is a trusted positive if all its labels are 1. Labels of held-out rows
    are not read. Null and empty texts are scored as texts without words. Null ids are not held out and
    have no labels. Repeated rows are scored each. Without any positive or unlabelled row every score is
    0.5. Very long texts are used whole. An empty table gives an empty result. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    x = settle(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(
        _feature_batches, f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES)))
    scale = x.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"m_{f}") for f in FEATURES],
                  *[F.stddev_pop(f).alias(f"s_{f}") for f in FEATURES]).first()
    good = labels.where(F.col("doc_id").isNotNull() & ~fold(F.col("doc_id"))).groupBy("doc_id").agg(
        F.min("quality").alias("q")).where("q = 1").select("doc_id")
    learn = x.where(~fold(F.col("doc_id")))

    def sample(df: DataFrame) -> np.ndarray:
        n = df.count()
        if n > SAMPLE:
            df = df.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * SAMPLE / n))
        got = df.select(*FEATURES).toArrow()
        raw = np.stack([got.column(f).to_numpy() for f in FEATURES], axis=1).reshape(-1, len(FEATURES))
        centred = (raw - [scale[f"m_{f}"] or 0 for f in FEATURES]) / [scale[f"s_{f}"] or 1 for f in FEATURES]
        return np.concatenate([centred, np.ones((len(raw), 1))], axis=1)

    weights = np.zeros(len(FEATURES) + 1)
    if scale["n"]:
        pos, unl = sample(learn.join(good, "doc_id", "left_semi")), sample(learn)
        if len(pos) and len(unl):
            weights = fit_nnpu(pos, unl, fit_prior(pos, unl))
    z = F.lit(float(weights[-1]))
    for f, w in zip(FEATURES, weights):
        z = z + (F.col(f) - float(scale[f"m_{f}"] or 0)) / float(scale[f"s_{f}"] or 1) * float(w)
    score = 1 / (1 + F.exp(-z))
    return x.select("doc_id", fold(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= KEEP_AT, 1).otherwise(0))
