"""Chat formatting (operator 7): reply trees to conversations.

A tree is a table of messages with a parent each. Root-to-leaf paths are enumerated by self-joins of
jump pointers: after round k every message points 2**k steps up, with the sum of the scores on the
way. Depth and path score of all messages need log2(depth) joins. The best leaves of each
conversation are chosen; the same pointers then lead each chosen leaf to all messages of its path.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from .common import settle

START, END = "<|im_start|>", "<|im_end|>\n"
# Characters with which a control string can begin, and the escape mark itself (first when escaping, last when
# reading back).
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]
ROLE_ESCAPES = [*ESCAPES, ("\n", "&#10;")]
LEARNED_ROLE = "assistant"


def _escape(s: str, pairs=ESCAPES) -> str:
    for plain, coded in pairs:
        s = s.replace(plain, coded)
    return s


def _unescape(s: str, pairs=ESCAPES) -> str:
    for plain, coded in reversed(pairs):
        s = s.replace(coded, plain)
    return s


def format_path(turns) -> tuple[str, list[tuple[int, int]]]:
    """The text of one conversation, and the spans [start, end) of the texts to learn from, in code points."""
    parts, mask, at = [], [], 0
    for turn in turns:
        role, text = turn["role"] or "", _escape(turn["text"] or "")
        head = START + _escape(role, ROLE_ESCAPES) + "\n"
        if role == LEARNED_ROLE:
            mask.append((at + len(head), at + len(head) + len(text)))
        parts += [head, text, END]
        at += len(head) + len(text) + len(END)
    return "".join(parts), mask


def read_path(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    out = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix(START).partition("\n")
        out.append((_unescape(role, ROLE_ESCAPES), _unescape(text)))
    return out


FORMATTED = T.StructType([
    T.StructField("formatted", T.StringType()),
    T.StructField("mask", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
READ_BACK = T.StructType([
    T.StructField("n_turns", T.LongType()), T.StructField("turns", T.StringType()), T.StructField("loss", T.StringType())])


def _format(turns: pd.Series) -> pd.DataFrame:
    done = [format_path(t) for t in turns]
    return pd.DataFrame({"formatted": [f for f, _ in done],
                         "mask": [[{"start": a, "end": b} for a, b in m] for _, m in done]})


def _read(formatted: pd.Series, mask: pd.Series) -> pd.DataFrame:
    rows = []
    for f, m in zip(formatted, mask):
        turns = read_path(f)
        rows.append((len(turns), "".join(f"{r}\n{t}\n" for r, t in turns),
                     "".join(_unescape(f[x["start"]:x["end"]]) for x in m)))
    return pd.DataFrame(rows, columns=["n_turns", "turns", "loss"])


def read_back(formatted: Column, mask: Column) -> Column:
    """From the output alone: n_turns, all ``turns`` as role and text lines, and all text under the mask (``loss``)."""
    return F.pandas_udf(_read, READ_BACK)(formatted, mask)


def best_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """The messages on the ``top`` best root-to-leaf paths of each conversation.

    ``messages``: (conv, id, parent, role, text, score) with id unique in its conversation and parent null at
    roots. Returns (conv, path, pos, role, text): path from 1 (best), pos from the end (0 is the leaf). A
    path's score is the mean of its messages' scores (null counts 0); ties go to the smaller leaf id.
    Messages whose parent does not exist count as roots. Messages on a cycle have no root and no path.
    """
    key = ["conv", "id"]
    base = settle(messages.select("conv", "id", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")))
    known = base.select("conv", F.col("id").alias("parent"), F.lit(True).alias("there"))
    jump = settle(base.join(known, ["conv", "parent"], "left").select(
        *key, F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(1).alias("steps"), F.col("score").alias("total")))
    n = jump.count()
    levels = []
    while not jump.where("up is not null").isEmpty() and (1 << len(levels)) <= max(1, n):
        going = jump.where("up is not null")           # messages that have reached their root are only carried on
        levels.append(going.select(*key, "up"))
        above = jump.select("conv", F.col("id").alias("up"), F.col("up").alias("up2"),
                            F.col("steps").alias("steps2"), F.col("total").alias("total2"))
        moved = going.join(above, ["conv", "up"]).select(
            *key, F.col("up2").alias("up"), (F.col("steps") + F.col("steps2")).alias("steps"),
            (F.col("total") + F.col("total2")).alias("total"))
        jump = settle(jump.where("up is null").union(moved))
    parents = base.where("parent is not null").select("conv", F.col("parent").alias("id"))
    leaves = jump.where("up is null").join(parents, key, "left_anti")
    rank = Window.partitionBy("conv").orderBy((F.col("total") / F.col("steps")).desc(), "id")
    chosen = leaves.withColumn("path", F.row_number().over(rank)).where(F.col("path") <= top)
    on_path = settle(chosen.select("conv", "path", "id", F.lit(0).alias("pos")))
    for k in reversed(range(len(levels))):
        up = on_path.join(levels[k], key).select("conv", "path", F.col("up").alias("id"), (F.col("pos") + (1 << k)).alias("pos"))
        on_path = settle(on_path.union(up))        # else each step would double the plan
    return on_path.join(messages.select(*key, "role", "text"), key).select("conv", "path", "pos", "role", "text")


def format_conversations(messages: DataFrame, top: int = 1) -> DataFrame:
    """One row per chosen path: conv, path, formatted, mask (spans of the texts to learn from)."""
    turns = best_paths(messages, top).groupBy("conv", "path").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("pos")).alias("at"), "role", "text"))).alias("turns"))
    return turns.select("conv", "path", F.pandas_udf(_format, FORMATTED)("turns").alias("f")).select("conv", "path", "f.formatted", "f.mask")


def reply_chains(rows: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees: each turn replies to the one before it.

    Turns with equal numbers are ordered by role and text; null turn numbers come first; null ids form
    one conversation; null roles and texts count as empty. Repeated rows are turns of their own.
    """
    conv = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    return (rows.select(conv.alias("conv"), "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("id", F.row_number().over(order))
            .withColumn("parent", F.when(F.col("id") > 1, F.col("id") - 1))
            .select("conv", "conv_id", "id", "parent", "role", "text", F.lit(0.0).alias("score")))
