"""Chat formatting from reply trees.

Messages name the message they answer.  Iterative self-joins over ever longer
jumps (1, 2, 4, ... answers up) give each message its root, its depth and the sum
of scores on the way, in as many joins as the depth has binary digits; the same
jumps then enumerate the root-to-leaf paths of the branches that are chosen by
score.  Each path becomes one formatted conversation with the spans that count for
the loss.

A turn is written as ``### role : text </turn>`` and a line feed.  In texts and
roles, backslashes, ``<`` and ``###`` (in roles also ``:``) get a backslash before
them, so neither `` </turn>`` nor `` :`` can occur inside; taking each first
backslash away again gives the text back.  Everything is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import staged

START, MIDDLE, END = "### ", " : ", " </turn>\n"


def _escape(text: Column, more: str = "") -> Column:
    return F.regexp_replace(text, rf"[\\<{more}]|###", r"\\$0")


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turns: Column) -> Column:
    """``turns`` (array of role and text) as one string; nulls count as empty."""
    return F.array_join(F.transform(turns, _turn), "")


def _role(turn: Column) -> Column:
    return _escape(F.coalesce(turn["role"], F.lit("")), ":")


def _text(turn: Column) -> Column:
    return _escape(F.coalesce(turn["text"], F.lit("")))


def _turn(turn: Column) -> Column:
    return F.concat(F.lit(START), _role(turn), F.lit(MIDDLE), _text(turn), F.lit(END))


def loss_spans(turns: Column, role: str = "assistant") -> Column:
    """Where in :func:`formatted` the texts of ``role`` stand: an array of start and
    end, in code points from 0."""
    def go(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_role(turn)) + len(START) + len(MIDDLE)
        end = begin + F.length(_text(turn))
        spans = F.when(turn["role"] == role, F.concat(state["spans"], F.array(F.struct(
            begin.alias("start"), end.alias("end"))))).otherwise(state["spans"])
        return F.struct((end + len(END)).alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(turns, begin, go, lambda state: state["spans"])


def read_turns(text: Column) -> Column:
    """The turns of a formatted string."""
    turns = F.filter(F.split(text, rf"\Q{END}\E"), lambda x: x != "")

    def parts(turn: Column) -> Column:
        middle = F.locate(MIDDLE, turn)
        return F.struct(_unescape(F.substr(turn, F.lit(len(START) + 1), middle - 1 - len(START))).alias("role"),
                        _unescape(F.substr(turn, middle + len(MIDDLE))).alias("text"))

    return F.transform(turns, parts)


def read_loss(text: Column, spans: Column) -> Column:
    """The texts under ``spans``, in order, nothing between them."""
    return F.array_join(F.transform(spans, lambda s: _unescape(F.substr(text, s["start"] + 1, s["end"] - s["start"]))), "")


def _same(message: str) -> Column:
    """The condition that ``message`` of ``tree`` is the message ``n`` of ``t``."""
    return F.col("tree").eqNullSafe(F.col("t")) & (F.col(message) == F.col("n"))


def _jumps(messages: DataFrame, most: int = 40) -> list[DataFrame]:
    """Tables of ``tree, node, up, total, depth``: in the k-th, ``up`` is the message
    2**k answers above (null beyond the root), ``total`` and ``depth`` sum the scores
    and count the messages from ``node`` to below ``up``.  In the last, no ``up`` is left
    but of messages that answer each other in a ring."""
    known = messages.select(F.col("tree").alias("t"), F.col("node").alias("n")).distinct()
    start = messages.join(known, _same("parent"), "left").select(
        "tree", "node", F.col("n").alias("up"), F.coalesce("score", F.lit(0.0)).alias("total"),
        F.lit(1).cast("long").alias("depth"))
    tables = [staged(start, "replies-jump")[0]]
    for _ in range(most):
        now = tables[-1]
        if now.filter("up is not null").isEmpty():
            break
        far = now.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("next"),
                         F.col("total").alias("more"), F.col("depth").alias("deeper"))
        tables.append(staged(now.join(far, _same("up"), "left").select(
            "tree", "node", F.col("next").alias("up"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"),
            (F.col("depth") + F.coalesce("deeper", F.lit(0))).alias("depth")), "replies-jump")[0])
    return tables


def branches(messages: DataFrame, per_tree: int | None = 1) -> DataFrame:
    """``tree, leaf, turns`` for the ``per_tree`` best branches of each tree (None:
    all): ``turns`` are the messages from the root to the leaf, role and text.

    ``messages``: ``tree, node, parent, role, text, score``; (tree, node) is unique.
    A branch's score is the mean over its messages, a missing score counts 0; ties go
    to the smaller leaf.  A message whose parent is null or absent is a root.
    Messages in a ring have no root and are in no branch.
    """
    tables = _jumps(messages)
    inner = messages.select(F.col("tree").alias("t"), F.col("parent").alias("n")).dropna(subset=["n"]).distinct()
    ends = tables[-1].filter("up is null")
    leaves = ends.join(inner, _same("node"), "left_anti")
    if per_tree is not None:
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), "node"))
        leaves = leaves.withColumn("rank", rank).filter(F.col("rank") <= per_tree)
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    for k in range(len(tables) - 1, -1, -1):
        jump = tables[k].filter("up is not null").select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        higher = paths.join(jump, _same("node"))
        paths = paths.unionAll(higher.select("tree", "leaf", F.col("up").alias("node"), F.col("above") + (1 << k)))
        paths = staged(paths, "replies-paths")[0]
    said = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    whole = paths.join(said, _same("node"))
    turn = F.struct((-F.col("above")).alias("order"), "role", "text")
    return whole.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def conversation_messages(rows: DataFrame) -> DataFrame:
    """Rows by turn as reply trees of one branch: each row answers the one before.
    Rows of the same turn follow each other by role and text; null turns come first."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return rows.select(F.col("conv_id").alias("tree"), node.alias("node"),
                       F.when(node > 1, node - 1).alias("parent"), "role", "text",
                       F.lit(None).cast("double").alias("score"))


def format_conversations(rows: DataFrame, role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, spans``: every conversation of ``rows`` (``conv_id, turn,
    role, text``) as one string, and the spans of ``role``'s texts in it.  Null roles and
    texts count as empty; rows without a ``conv_id`` are one conversation of their own."""
    messages, _ = staged(conversation_messages(rows.select("conv_id", "turn", "role", "text")), "replies-messages")
    turns = branches(messages).select(F.col("tree").alias("conv_id"), "turns")
    return turns.select("conv_id", formatted(F.col("turns")).alias("formatted"),
                        loss_spans(F.col("turns"), role).alias("spans"))


def conversation_digest(rows: DataFrame) -> DataFrame:
    """What is read back from each formatted conversation."""
    out = format_conversations(rows).select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                                            read_loss(F.col("formatted"), F.col("spans")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))
