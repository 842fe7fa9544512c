"""Secret scans (operator 8): patterns, plus sliding-window Shannon entropy per character class.

All steps are column expressions inside the row: no shuffle, no Python. Positions come from splitting a
text by the pattern that also extracts the matches: pieces and matches alternate, so sums of their
lengths give the offsets (in code points).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# The base patterns. Runs that are too short are dropped (``MIN_*``).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
MIN_VALUE = 8
KINDS = ["assign", "access", "hex", "entropy"]       # the order of kinds at one start

# The entropy scan.
WINDOW = 24
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# character class: (pattern of a candidate of this class, entropy in bits per character from which a window counts)
CLASSES = [("^[0-9a-fA-F]+$", 3.0), ("^[A-Za-z0-9]+$", 3.6), ("^.+$", 3.8)]
# candidates that are suppressed: no digit or no letter (words, numbers), words joined by marks, UUIDs, placeholders
ALLOWED = [
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"^([A-Za-z]+|[0-9]+)([-_/=+]+([A-Za-z]+|[0-9]+))*[-_/=+]*$",
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|changeme|xxxxxx|123456789",
]


def _sql(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"



def _spans(m: str, pattern: str, kind: str, keep: str) -> str:
    """SQL for array<struct<s, k, e, kind>> of the matches ``m`` that satisfy ``keep`` (over x, the match)."""
    # running offset: lengths of the pieces before, and of the matches before
    return (
        f"if(size({m}) = 0, cast(array() as array<struct<s:int,k:int,e:int>>), filter("
        f"aggregate(zip_with(slice(split(t, {_sql(pattern)}, -1), 1, size({m})), {m},"
        f" (g, x) -> named_struct('g', g, 'x', x)),"
        f" struct(0 as at, cast(array() as array<struct<s:int,k:int,e:int>>) as out),"
        f" (a, z) -> struct(a.at + length(z.g) + length(z.x) as at, concat(a.out, array(struct("
        f"   cast(a.at + length(z.g) as int) as s, if({keep}, {KINDS.index(kind)}, -1) as k,"
        f"   cast(a.at + length(z.g) + length(z.x) as int) as e))) as out),"
        f" a -> a.out), y -> y.k >= 0))")


def _entropy_matches() -> str:
    """SQL: of the candidates ``c`` (structs s, e) with their strings, the part from the first to the last window
    whose entropy reaches its class's bound.

    A window's entropy is log2(W) - S / W with S the sum of n*log2(n) over its character counts. A step
    adds one character and drops one: two counts change, and S by two table differences. S is kept in
    millionths as a whole number, so that it does not drift.
    """
    f = [0] + [round(1e6 * n * math.log2(n)) for n in range(1, WINDOW + 1)]
    table = "array(" + ",".join(f"{b - a}L" for a, b in zip(f, f[1:])) + ")"      # rise from n to n + 1
    most = [math.floor(1e6 * WINDOW * (math.log2(WINDOW) - bits)) for _, bits in CLASSES]
    bound = "case " + " ".join(f"when x rlike {_sql(p)} then {m}L" for (p, _), m in zip(CLASSES, most)) + " end"
    ok = " and ".join(f"not x rlike {_sql(p)}" for p in ALLOWED)
    char = f"instr({_sql(ALPHABET)}, substr(x, %s, 1)) - 1"
    start = f"struct(array_repeat(0, {len(ALPHABET)}) as n, 0L as s, -1 as first, -1 as last)"
    c_in, c_out = char % "i", f"if(i > {WINDOW}, {char % f'i - {WINDOW}'}, -1)"
    rise, fall = f"get({table}, get(a.n, d.p))", f"get({table}, get(a.n, d.q) - 1)"
    s_new = f"(a.s + if(d.p = d.q, 0L, {rise} - if(d.q < 0, 0L, {fall})))"
    n_new = "if(d.p = d.q, a.n, transform(a.n, (v, j) -> v + if(j = d.p, 1, 0) - if(j = d.q, 1, 0)))"
    # a one-element array of struct(p, q) binds both characters once
    step = (
        f"element_at(transform(array(struct({c_in} as p, {c_out} as q)), d -> element_at(transform(array({s_new}), v -> struct("
        f"{n_new} as n, v as s,"
        f" if(a.first < 0 and i >= {WINDOW} and v <= b, i - {WINDOW}, a.first) as first,"
        f" if(i >= {WINDOW} and v <= b, i, a.last) as last)), 1)), 1)")
    scan = f"aggregate(sequence(1, length(x)), {start}, (a, i) -> {step}, a -> struct(a.first as first, a.last as last))"
    with_bound = f"element_at(transform(array({bound}), b -> {scan}), 1)"
    return (
        f"filter(transform(filter(cand, c -> element_at(transform(array(substr(t, c.s + 1, c.e - c.s)), x -> {ok}), 1)),"
        f" c -> element_at(transform(array(element_at(transform(array(substr(t, c.s + 1, c.e - c.s)), x -> {with_bound}), 1)),"
        f"  w -> struct(if(w.first < 0, -1, c.s + w.first) as s, {KINDS.index('entropy')} as k, c.s + w.last as e)), 1)),"
        f" y -> y.s >= 0)")


def with_spans(df: DataFrame) -> DataFrame:
    """From a frame with a text column ``t``: adds ``base`` and ``spans``, sorted arrays of struct(s, k, e): start, kind
    (position in KINDS) and end (exclusive), in code points.

    ``spans`` holds the base spans and the parts of entropy spans outside of them.
    """
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("cand", CANDIDATE)):
        df = df.withColumn(f"m_{name}", F.regexp_extract_all("t", F.lit(pattern), F.lit(0)))
    keep = f"length(regexp_extract(z.x, {_sql(ASSIGN)}, 1)) >= {MIN_VALUE}"
    df = df.withColumn("base", F.expr(
        "sort_array(concat(" + ", ".join([_spans("m_assign", ASSIGN, "assign", keep),
                                          _spans("m_access", ACCESS, "access", "true"),
                                          _spans("m_hex", HEX, "hex", "true")]) + "))"))
    df = df.withColumn("cand", F.expr(_spans("m_cand", CANDIDATE, "entropy", "true")))
    df = df.withColumn("extra", F.expr(f"if(size(cand) = 0, cand, {_entropy_matches()})"))
    df = df.withColumn("spans", F.expr(
        "sort_array(concat(base, flatten(transform(extra, x -> aggregate(base, array(x), (a, b) -> flatten(transform(a, p ->"
        " filter(array(struct(p.s as s, p.k as k, least(p.e, b.s) as e), struct(greatest(p.s, b.e) as s, p.k as k, p.e as e)),"
        " y -> y.s < y.e))))))))"))
    return df.drop("m_assign", "m_access", "m_hex", "m_cand", "cand", "extra")


def _listed(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat(get({names}, x.k), ':', x.s, ':', x.e)), ',')")


def scan_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256 and spans (kind:start:end, comma-joined).

    Null and empty texts have no spans (the digest is that of the empty string). Very long texts are
    scanned whole. Repeated rows are returned each, null ids as they are; an empty table gives an empty
    result. Other columns are not read.
    """
    df = with_spans(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("t")))
    n = lambda k: F.expr(f"cast(size(filter(base, x -> x.k = {KINDS.index(k)})) as bigint)")
    return df.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
                     F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def redact_documents(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; spans that touch or overlap become one mark.

    All rows and columns stay, whatever their names; texts without a span (also null and empty ones) are
    unchanged. ``n_chars``, where there is such a column and the text changed, is set to the new length.
    """
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                     F.coalesce(F.col("text"), F.lit("")).alias("t"))
    df = with_spans(df)
    clean = F.expr(
        "aggregate(spans, struct(0 as at, '' as out), (a, x) -> struct(greatest(a.at, x.e) as at,"
        f" if(x.s < a.at or (x.s = a.at and a.at > 0), a.out, concat(a.out, substr(t, a.at + 1, x.s - a.at), {_sql(mark)})) as out),"
        " a -> concat(a.out, substr(t, a.at + 1)))")
    df = df.withColumn("clean", F.when(F.size("spans") > 0, clean))
    cols = []
    for c in docs.columns:
        old = F.col(f"row.`{c}`")
        if c == "text":
            cols.append(F.coalesce(F.col("clean"), old).alias(c))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            cols.append(F.when(F.col("clean").isNotNull(), F.length("clean").cast(kind)).otherwise(old).alias(c))
        else:
            cols.append(old.alias(c))
    return df.select(*cols)
