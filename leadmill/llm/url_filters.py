"""URL filters (operator 5): host rules first, then a path-template tree judged by smoothed labelled purity.

The tree is built from the distinct (host, typed path) pairs, counted with partial sums before the
shuffle, so a host with a third of all rows is reduced to its few distinct paths first.

1. Typing: digit runs of a segment become ``<n>``, long hexadecimal segments and UUIDs ``<h>``.
2. Merging: a node is (host, typed prefix, segment). The distribution of a node over (next segment, label)
   is compared with that of all nodes under the same prefix. A node whose total-variation distance is
   at most ``TOLERANCE`` + 1 / sqrt(its rows) is merged: its segment becomes ``*``. Rare variable
   segments cannot be told from their siblings and merge; frequent ones stay when they lead to other
   paths or other labels. Each node is compared with one pooled distribution, never with each sibling.
3. Purity: (blocked + PRIOR_ROWS * PRIOR_BAD) / (labelled + PRIOR_ROWS) of a template; at ``REJECT_AT`` or
   more the template is rejected. A template without labels has PRIOR_BAD and stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values: (host, path, verdict), the base rules.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
TOLERANCE = 0.1
PRIOR_ROWS = 5
PRIOR_BAD = 0.5
REJECT_AT = 0.7
END = "<end>"           # a path's end as the next segment


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to
    ``?``, ``#`` or the end. Null urls and urls without ``://`` give two empty strings."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict), else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):      # the longest is tried first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))).otherwise(out)
    return out


def typed_segments(path: Column) -> Column:
    return F.transform(F.split(path, "/"), lambda s: F.when(
        s.rlike("^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$") | (s.rlike("^[0-9a-f]{12,}$") & s.rlike("[a-f]")), F.lit("<h>"))
        .otherwise(F.regexp_replace(s, "[0-9]+", "<n>")))


def template_tree(paths: DataFrame) -> DataFrame:
    """From distinct (host, segs, bad, good, none) rows: (host, segs, template).

    ``bad``, ``good`` and ``none`` count the rows that are labelled blocked, labelled allowed, and not labelled.
    """
    nodes = paths.select("host", "segs", "bad", "good", "none", F.posexplode("segs").alias("pos", "seg"))
    nodes = nodes.withColumn("prefix", F.array_join(F.expr("slice(segs, 1, pos)"), "/")).withColumn(
        "next", F.coalesce(F.expr("get(segs, pos + 1)"), F.lit(END)))
    at = ["host", "pos", "prefix"]
    kids = nodes.select(*at, "seg", "next", F.expr("stack(3, 'bad', bad, 'good', good, 'none', none) as (label, n)")) \
        .where("n > 0").groupBy(*at, "seg", "next", "label").agg(F.sum("n").alias("n"))
    pooled = kids.groupBy(*at, "next", "label").agg(F.sum("n").alias("p_n"))
    p_total = pooled.groupBy(*at).agg(F.sum("p_n").alias("p_total"))
    b_total = kids.groupBy(*at, "seg").agg(F.sum("n").alias("b_total"))
    # total variation = sum over the node's own outcomes of max(0, its share - the pooled share)
    far = (kids.join(b_total, [*at, "seg"]).join(pooled, [*at, "next", "label"]).join(p_total, at)
           .withColumn("over", F.greatest(F.lit(0), F.col("n") * F.col("p_total") - F.col("p_n") * F.col("b_total")))
           .groupBy(*at, "seg").agg(F.sum("over").alias("over"), F.max("b_total").alias("b_total"),
                                    F.max("p_total").alias("p_total")))
    merged = far.select(*at, "seg", F.expr(
        f"over / b_total / p_total <= {TOLERANCE} + 1 / sqrt(b_total) and b_total < p_total").alias("merge"))
    named = nodes.select("host", "segs", *at[1:], "seg").join(merged, [*at, "seg"])
    return named.groupBy("host", "segs").agg(F.sort_array(F.collect_list(F.struct(
        "pos", F.when(F.col("merge"), F.lit("*")).otherwise(F.col("seg")).alias("name")))).alias("t")) \
        .select("host", "segs", F.array_join(F.col("t.name"), "/").alias("template"))


def judge_urls(pages: DataFrame, labels: DataFrame | None = None, rules=RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, template and purity.

    A page that a rule fits takes the rule's verdict. Others take that of their template: ``block`` if its
    smoothed share of blocked labels is at least ``REJECT_AT``, else ``allow``. ``labels`` (page_id, bad)
    are the labels; without them, the rules' verdicts label the pages they fit.

    Null urls and urls without ``://`` have empty host and path and one shared template. Null ids are kept; of
    several labels of one page the worst counts; repeated rows count each. Very long urls are read whole
    (a path of k segments gives k nodes). An empty table gives an empty result. Other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    df = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    df = df.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).withColumn("segs", typed_segments(F.col("path")))
    if labels is None:
        df = df.withColumn("bad", F.expr("case r.verdict when 'block' then 1 when 'allow' then 0 end"))
    else:
        worst = labels.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
        df = df.join(worst, "page_id", "left")
    count = lambda cond: F.sum(F.expr(f"if({cond}, 1L, 0L)"))
    paths = df.groupBy("host", "segs").agg(count("bad = 1").alias("bad"), count("bad = 0").alias("good"),
                                           count("bad is null").alias("none"))
    tree = template_tree(paths)
    of_path = paths.join(tree, ["host", "segs"])
    templates = of_path.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum(F.col("bad") + F.col("good")).alias("labelled"))
    templates = templates.select("host", "template", F.expr(
        f"(bad + {PRIOR_ROWS} * {PRIOR_BAD}D) / (labelled + {PRIOR_ROWS})").alias("purity"))
    judged = of_path.join(templates, ["host", "template"]).select("host", "segs", "template", "purity")
    return df.join(judged, ["host", "segs"], "left").select(
        "page_id", "host", "path", "r.rule",
        F.coalesce("r.verdict", F.when(F.col("purity") >= REJECT_AT, "block").otherwise("allow")).alias("verdict"),
        "template", "purity")
