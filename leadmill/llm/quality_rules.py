"""Quality rules (operator 4): adaptive thresholds from mergeable quantile sketches per language and source.

The sketch is a histogram with log-linear bins: a value keeps its leading ``SKETCH_BITS`` binary digits, so a
bin is at most 1/64 of its value wide. Two sketches merge by adding counts; the result does not
depend on the order of the rows, on partitions or on retries. Spark builds it as an ordinary
aggregation by (language, source, metric, bin) with partial sums before the shuffle, so a source with
a third of all rows sends a few hundred rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .common import broadcast_checked, settle, words

SKETCH_BITS = 7
FENCE = 3               # fences lie this many spreads beyond the quartiles
SHRINK = 200            # a group's fence counts by its rows, its language's by this many rows
MIN_WORDS = 50
# metric: smallest spread, and whether low values fail too. All are whole numbers:
# symbols and repeated words per 10,000 words, repeated lines per 10,000 lines, characters per 100 words.
METRICS = {
    "symbols": (500, False),
    "word_len": (50, True),
    "dup_lines": (1_500, False),
    "repeats": (1_200, False),
}


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words to whole texts.

    Null texts count as empty. Everything stays inside the row: no shuffle.
    """
    t = "coalesce(text, '')"
    df = docs.withColumn("_w", words(F.col("text")))
    df = df.withColumn("n_words", F.size("_w").cast("long"))
    df = df.withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
    df = df.withColumn("n_symbols", F.expr(f"cast(length(regexp_replace({t}, '[^#*$%&|<>]+', '')) as bigint)"))
    df = df.withColumn("_l", F.expr(rf"filter(split({t}, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    df = df.withColumn("n_lines", F.size("_l").cast("long"))
    df = df.withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
    df = df.withColumn("_g", F.expr(
        "if(n_words < 3, array(), transform(sequence(0, cast(n_words as int) - 3),"
        " i -> concat_ws(' ', get(_w, i), get(_w, i + 1), get(_w, i + 2))))"))
    # windows that occur again: sort (window, position) and compare neighbours; skipped if all differ
    df = df.withColumn("_s", F.expr(
        "if(size(array_distinct(_g)) = size(_g), array(), sort_array(transform(_g, (g, i) -> struct(g, i as p))))"))
    df = df.withColumn("_p", F.expr(
        "sort_array(filter(transform(_s, (x, i) ->"
        " if(x.g = get(_s, i - 1).g or x.g = get(_s, i + 1).g, x.p, -1)), p -> p >= 0))"))
    # each such window covers 3 words, less what the window before it has covered
    df = df.withColumn("n_repeat_words", F.expr(
        "cast(aggregate(transform(_p, (p, i) -> if(i = 0, 3, least(3, p - get(_p, i - 1)))), 0L, (a, x) -> a + x) as bigint)"))
    return df.drop("_w", "_l", "_g", "_s", "_p")


def _binned(v: str) -> str:
    shift = f"greatest(0, length(bin({v})) - {SKETCH_BITS})"
    return f"shiftleft(shiftright({v}, {shift}), {shift})"


def _metrics(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "*",
        "if(n_words = 0, 0, n_symbols * 10000 div n_words) as symbols",
        "if(n_words = 0, 0, word_chars * 100 div n_words) as word_len",
        "if(n_lines = 0, 0, n_dup_lines * 10000 div n_lines) as dup_lines",
        "if(n_words = 0, 0, n_repeat_words * 10000 div n_words) as repeats")


def sketch(df: DataFrame) -> DataFrame:
    """The sketches: rows (lang_key, source_key, metric, bin, n) over rows that pass the base rules."""
    pairs = ", ".join(f"'{m}', {m}" for m in METRICS)
    long = df.where("not base_failed").selectExpr(
        "lang_key", "source_key", f"stack({len(METRICS)}, {pairs}) as (metric, v)")
    return long.groupBy("lang_key", "source_key", "metric", F.expr(_binned("v")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))


def _fences(bins: DataFrame, keys: list[str]) -> DataFrame:
    """Lower and upper fence of each sketch: quartiles widened by FENCE spreads."""
    w = Window.partitionBy(*keys, "metric")
    cum = bins.withColumn("cum", F.sum("n").over(w.orderBy("bin"))).withColumn("total", F.sum("n").over(w))
    q = cum.groupBy(*keys, "metric").agg(
        F.max("total").alias("total"),
        F.min(F.expr("if(cum * 4 >= total, bin, null)")).alias("q1"),
        F.min(F.expr("if(cum * 4 >= total * 3, bin, null)")).alias("q3"))
    floor = "case metric " + " ".join(f"when '{m}' then {f}" for m, (f, _) in METRICS.items()) + " end"
    return q.selectExpr(
        *keys, "metric", "total",
        f"q1 - {FENCE} * greatest(q3 - q1, {floor}) as lower",
        f"q3 + {FENCE} * greatest(q3 - q1, {floor}) as upper")


def thresholds(bins: DataFrame) -> DataFrame:
    """Per language and source: the group's own fences, drawn towards its language's in small groups."""
    own = _fences(bins, ["lang_key", "source_key"])
    merged = bins.groupBy("lang_key", "metric", "bin").agg(F.sum("n").alias("n"))   # merging is adding
    lang = _fences(merged, ["lang_key"]).selectExpr("lang_key", "metric", "lower as l_lower", "upper as l_upper")
    both = own.join(lang, ["lang_key", "metric"]).selectExpr(
        "lang_key", "source_key", "metric",
        f"(total * lower + {SHRINK} * l_lower) div (total + {SHRINK}) as lower",
        f"(total * upper + {SHRINK} * l_upper) div (total + {SHRINK}) as upper")
    aggs = []
    for m in METRICS:
        aggs += [F.max(F.expr(f"if(metric = '{m}', lower, null)")).alias(f"{m}_lower"),
                 F.max(F.expr(f"if(metric = '{m}', upper, null)")).alias(f"{m}_upper")]
    return both.groupBy("lang_key", "source_key").agg(*aggs)


MADE = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed"]


def counted(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Rows (row, lang_key, source_key, counts, metrics): ``row`` holds the ``carry`` columns as a struct,
    so that no column of the input can clash with a name used here."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), "text",
                     F.coalesce(F.col("lang"), F.lit("")).alias("lang_key"),
                     F.coalesce(F.col("source"), F.lit("")).alias("source_key"))
    df = base_counts(df).withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words"))
    # unpacked from a struct, so that a later filter on the counts is not rewritten into a second computation of them
    return _metrics(df.select("row", "lang_key", "source_key", F.inline(F.array(F.struct(*MADE)))))


def verdicts(df: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``kept``: not failed by the base rules, and every metric within its group's fences."""
    tests = [f"{m} <= {m}_upper" + (f" and {m} >= {m}_lower" if two_sided else "") for m, (_, two_sided) in METRICS.items()]
    out = df.join(broadcast_checked(limits), ["lang_key", "source_key"], "left")
    return out.withColumn("kept", F.expr(f"not base_failed and coalesce({' and '.join(tests)}, true)"))


def judge_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the base counts, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated 3-word windows. Other
    rows are kept if every metric lies within the fences of their language and source. Null texts are
    empty and fail the base rule; null languages and sources form a group with the empty string. Null
    ids are returned as they are. Repeated rows count each and share a verdict. An empty table gives an
    empty result. Other columns are not read. The texts are scanned once; the small counts are
    checkpointed and serve both the sketches and the verdicts.
    """
    df = settle(counted(docs, ["doc_id"]))
    out = verdicts(df, settle(thresholds(sketch(df))))
    return out.select("row.doc_id", *MADE, "kept")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all columns of ``docs``, whatever their names.

    The texts are read twice, once for the sketches and once for the verdicts, rather than moved.
    """
    limits = settle(thresholds(sketch(counted(docs, []).drop("row"))))
    return verdicts(counted(docs, docs.columns), limits).where("kept").select("row.*")
