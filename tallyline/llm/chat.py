"""Conversations from reply trees, in DataFrame operations only.

Messages name their parent.  Jump tables (each message with its ancestor 1, 2,
4, ... steps up) come from self-joins that double the step, so a thread of a
thousand turns takes ten of them.  A leaf's path is then put together from the
longest jump down.  Branches are ranked by the mean score of their messages
(ties to the smaller leaf); the best ``branches`` of each tree, or all, are
formatted as one conversation each.

Template: a turn is ``### role: text</turn>`` and a line feed.  Texts and roles
hold neither ``#`` nor ``<`` once escaped (backslash, number sign, less-than
and, in roles, the colon become a backslash and a letter), so no text can fake
a turn, and unescaping gives back the same text.  ``loss_spans`` are the
character ranges of the assistant's texts.

Nulls and edges: null texts and roles are empty; a null tree id is a tree of
its own; a parent that does not exist makes the message a root; messages on a
cycle have no root and are in no path; rows that repeat a message id are
dropped but for one; null scores count as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import Staging

# The marks of the template and the escapes.
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
ASSISTANT = "assistant"


def escape(text: Column, escapes=ESCAPES) -> Column:
    for mark, stands in escapes:
        text = F.replace(text, F.lit(mark), F.lit(stands))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for mark, stands in reversed(escapes):
        text = F.replace(text, F.lit(stands), F.lit(mark))
    return text


def _path_rows(staging: Staging, nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): every message of every root-to-leaf path; ``up`` is its distance to the leaf."""
    up = nodes.where("parent IS NOT NULL").select("tree", F.col("node").alias("low"), F.col("parent").alias("high"))
    jumps = [staging.keep(up, "jump")]
    limit = nodes.count()
    while (1 << len(jumps)) <= limit:
        half = jumps[-1]
        upper = half.select(F.col("tree").alias("_t"), F.col("low").alias("_l"), F.col("high").alias("_h"))
        longer = half.join(upper, half["tree"].eqNullSafe(upper["_t"]) & (half["high"] == upper["_l"]))
        longer = staging.keep(longer.select("tree", "low", F.col("_h").alias("high")), "jump")
        if longer.isEmpty():
            break
        jumps.append(longer)
    parents = up.select(F.col("tree").alias("_t"), F.col("high").alias("_h")).distinct()
    leaves = nodes.join(parents, nodes["tree"].eqNullSafe(parents["_t"]) & (nodes["node"] == parents["_h"]), "left_anti")
    rows = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    for k in reversed(range(len(jumps))):
        jump = jumps[k].select(F.col("tree").alias("_t"), F.col("low").alias("_l"), F.col("high").alias("_h"))
        further = rows.join(jump, rows["tree"].eqNullSafe(jump["_t"]) & (rows["node"] == jump["_l"]))
        further = further.select("tree", "leaf", F.col("_h").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        rows = staging.keep(rows.unionAll(further), "paths")
    return rows


def _best_branches(rows: DataFrame, branches: int) -> DataFrame:
    """(tree, leaf) of each tree's best paths; a large tree is ranked in slices first."""
    scored = rows.groupBy("tree", "leaf").agg(F.avg("score").alias("score"))
    order = [F.col("score").desc(), F.col("leaf")]
    sliced = scored.withColumn("_slice", F.pmod(F.xxhash64("leaf"), F.lit(256)))
    for keys in (["tree", "_slice"], ["tree"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        sliced = sliced.withColumn("_rank", rank).where(F.col("_rank") <= branches)
    return sliced.select("tree", "leaf")


def format_threads(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree, leaf, n_turns, formatted, loss_spans) from messages (tree, node, parent, role, text, score)."""
    staging = Staging(messages.sparkSession, "chat")
    nodes = staging.keep(
        messages.where("node IS NOT NULL").groupBy("tree", "node").agg(
            F.min(F.struct("parent", "role", "text", "score")).alias("m")
        ).select("tree", "node", "m.*"),
        "messages",
    )
    own = nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_p"))
    linked = nodes.join(own, nodes["tree"].eqNullSafe(own["_t"]) & (nodes["parent"] == own["_p"]), "left")
    linked = staging.keep(linked.select("tree", "node", F.col("_p").alias("parent")), "links")
    paths = _path_rows(staging, linked)
    content = nodes.select(
        F.col("tree").alias("_t"), F.col("node").alias("_n"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    turns = paths.join(content, paths["tree"].eqNullSafe(content["_t"]) & (paths["node"] == content["_n"]))
    turns = turns.select("tree", "leaf", "up", "role", "text", "score")
    if branches is not None:
        turns = staging.keep(turns, "turns")
        best = _best_branches(turns, branches).select(F.col("tree").alias("_t"), F.col("leaf").alias("_l"))
        turns = turns.join(best, turns["tree"].eqNullSafe(best["_t"]) & (turns["leaf"] == best["_l"]), "left_semi")
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(BETWEEN))
    body = escape(F.col("text"))
    parts = turns.select(
        "tree", "leaf", F.struct(
            (-F.col("up")).alias("place"), F.concat(head, body, F.lit(CLOSE)).alias("turn"),
            F.length(head).alias("head"), F.length(body).alias("body"), (F.col("role") == ASSISTANT).alias("loss"),
        ).alias("p"),
    )
    whole = parts.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    close = len(CLOSE)
    # end of each turn, as running sums, then the spans of the assistant's texts
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))

    def step(acc, p):
        begin = acc["at"] + p["head"]
        end = begin + p["body"]
        span = F.struct(begin.alias("start"), end.alias("end"))
        spans = F.when(p["loss"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((end + close).alias("at"), spans.alias("spans"))

    return whole.select(
        "tree", "leaf", F.size("ps").cast("long").alias("n_turns"),
        F.array_join(F.transform("ps", lambda p: p["turn"]), "").alias("formatted"),
        F.aggregate("ps", start, step)["spans"].alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) structs of a formatted conversation."""
    turns = F.filter(F.split(formatted, CLOSE.replace("\n", "\\n")), lambda t: t != "")
    start = len(OPEN) + 1

    def parse(t):
        middle = F.instr(t, BETWEEN)
        role = F.substr(t, F.lit(start), middle - start)
        text = F.substr(t, middle + len(BETWEEN))
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, parse)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    pieces = F.transform(
        spans,
        lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")),
    )
    return unescape(F.array_join(pieces, ""))


def threads_of(conversations: DataFrame) -> DataFrame:
    """Messages from rows by turn: each row replies to the row before it in its conversation.

    Rows are in the order of turn (null first), role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return conversations.select(
        F.col("conv_id").cast("long").alias("tree"), node.alias("node"), "role", "text"
    ).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.lit(None).cast("double").alias("score"),
    )
