"""Chat formatting from reply trees.

Messages form trees (each names its parent).  Root-to-leaf paths are enumerated
by iterative self-joins that double their reach: round i joins every message's
ancestor pointer with that ancestor's own pointer, so a pointer then spans 2^i
messages and carries their number and summed score; log2(depth) rounds reach the
roots.  A leaf's pointers give its path's score and root, branches of a root are
ranked by score, and the chosen leaves are unrolled to their messages by walking
the pointer tables back from the widest.  Each chosen path becomes one
conversation.

The template marks a turn as ``### role: text</turn>`` and a line feed.  In texts and roles
``\\``, ``#`` and ``<`` are written as ``\\\\``, ``\\h`` and ``\\l`` (and ``:`` in roles as
``\\c``), so neither marker can occur inside one and reading back is exact.
The loss mask is a list of spans, in code points, over the assistant texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import is_empty, materialized, union

HEAD, SEP, END = "### ", ": ", "</turn>\n"
ASSISTANT = "assistant"


def escape(text: Column, role: bool = False) -> Column:
    for plain, code in (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l"), *([(":", "\\c")] if role else [])):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    """Undo ``escape``: doubled backslashes part the text, all others start a code."""
    def plain(part: Column) -> Column:
        for char, code in (("#", "\\h"), ("<", "\\l"), *([(":", "\\c")] if role else [])):
            part = F.replace(part, F.lit(code), F.lit(char))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def linear_trees(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages ``tree, id, parent, role, text, score`` of conversations without branches.

    Rows follow each other by turn, equal turns by role and text; null roles and
    texts are empty; every row, repeated ones too, is a message of its own."""
    rows = turns.select(F.col(conv_col).alias("tree"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    nth = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text"))
    return (rows.withColumn("id", nth)
            .select("tree", F.col("id").cast("long").alias("id"),
                    F.when(F.col("id") > 1, F.col("id") - 1).cast("long").alias("parent"),
                    "role", "text", F.lit(0.0).alias("score")))


def _same(left: str, right: str, a: str, b: str) -> Column:
    return F.col(f"{left}.tree").eqNullSafe(F.col(f"{right}.tree")) & (F.col(f"{left}.{a}") == F.col(f"{right}.{b}"))


def paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """Messages of the chosen root-to-leaf paths: ``tree, leaf, rank, depth, role, text``.

    A tree's paths are ranked by the sum of their scores (null scores count 0),
    longer paths first among equals, then the smaller leaf id; ``per_tree`` of them are chosen.
    Ids are unique within a tree and not null; a parent that is missing makes its child a
    root; messages on a parent cycle belong to no path and are left out."""
    nodes = materialized(messages.select("tree", "id", "parent", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score")))
    n, p = nodes.alias("n"), nodes.select("tree", "id").alias("p")
    # pointers of reach 1; up is null beyond a root
    step = materialized(n.join(p, _same("n", "p", "parent", "id"), "left")
                        .select("n.tree", "n.id", F.col("p.id").alias("up"), "n.score", F.lit(1).cast("long").alias("size")))
    inner = step.where("up IS NOT NULL").select("tree", F.col("up").alias("id")).distinct()
    s, i = step.alias("s"), inner.alias("i")
    leaves = s.join(i, _same("s", "i", "id", "id"), "left_anti").select("s.tree", "s.id")
    levels, previous, open_rows = [step], step, step.count()
    while not is_empty(previous.where("up IS NOT NULL")):
        # only pointers that have not reached a root are joined further
        a, b = previous.where("up IS NOT NULL").alias("a"), previous.alias("b")
        longer = a.join(b, _same("a", "b", "up", "id")).select(
            "a.tree", "a.id", F.col("b.up").alias("up"), (F.col("a.score") + F.col("b.score")).alias("score"),
            (F.col("a.size") + F.col("b.size")).alias("size"))
        previous = materialized(union(longer, previous.where("up IS NULL")))
        if 2 ** len(levels) > open_rows:    # longer than any path: what is left is a cycle
            break
        levels.append(previous)
    whole, f = previous.where("up IS NULL").alias("w"), leaves.alias("f")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("size"), "id")
    chosen = (whole.join(f, _same("w", "f", "id", "id"), "left_semi")
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_tree)
              .select("tree", F.col("id").alias("leaf"), "rank", "id", F.col("size").alias("depth")))
    # unroll: every message on the path, each found once, from the widest pointers down
    for level in range(len(levels) - 1, -1, -1):
        c, w = chosen.alias("c"), levels[level].where("up IS NOT NULL").alias("l")
        here = F.struct(F.col("c.id").alias("id"), F.col("c.depth").alias("depth"))
        there = F.struct(F.col("l.up").alias("id"), (F.col("c.depth") - F.lit(2 ** level)).alias("depth"))
        chosen = materialized(
            c.join(w, _same("c", "l", "id", "id"), "left")
            .select("c.tree", "c.leaf", "c.rank", F.explode(F.when(F.col("l.up").isNull(), F.array(here))
                                                            .otherwise(F.array(here, there))).alias("at"))
            .select("tree", "leaf", "rank", "at.id", "at.depth"))
    c, n = chosen.alias("c"), nodes.alias("n")
    return (c.join(n, _same("c", "n", "id", "id"))
            .select("c.tree", "c.leaf", "c.rank", "c.depth", "n.role", "n.text"))


def format_paths(chosen: DataFrame) -> DataFrame:
    """One row per path: ``tree, leaf, rank, formatted, loss_spans``.

    ``loss_spans`` are the places of the assistants' texts in ``formatted``, as code
    points from ``start`` to before ``end``."""
    turn = chosen.select(
        "tree", "leaf", "rank", "depth", "role",
        F.concat(F.lit(HEAD), escape(F.col("role"), role=True), F.lit(SEP)).alias("head"),
        escape(F.col("text")).alias("body"))
    line = F.concat("head", "body", F.lit(END))
    upto = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = turn.select(
        "tree", "leaf", "rank", "depth", "role", line.alias("line"),
        (F.coalesce(F.sum(F.length(line)).over(upto), F.lit(0)) + F.length("head")).alias("start"), F.length("body").alias("n"))
    parts = F.array_sort(F.collect_list(F.struct(
        "depth", "line", F.col("start").alias("start"), (F.col("start") + F.col("n")).alias("end"),
        (F.col("role") == ASSISTANT).alias("loss"))))
    return placed.groupBy("tree", "leaf", "rank").agg(parts.alias("parts")).select(
        "tree", "leaf", "rank", F.array_join(F.transform("parts", lambda p: p["line"]), "").alias("formatted"),
        F.transform(F.filter("parts", lambda p: p["loss"]),
                    lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    lines = F.split(formatted, END)     # texts hold no '<'; the last part is empty
    def turn(line: Column) -> Column:
        body = F.substr(line, F.lit(len(HEAD) + 1))
        at = F.instr(body, F.lit(SEP))      # roles hold no ':'
        return F.struct(unescape(F.substr(body, F.lit(1), at - 1), role=True).alias("role"),
                        unescape(F.substr(body, at + len(SEP))).alias("text"))
    return F.transform(F.slice(lines, F.lit(1), F.size(lines) - 1), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask."""
    return F.transform(spans, lambda s: unescape(F.substr(
        formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\h'), '<', '\l') AS body,
         replace(replace(replace(replace(role, '\', '\\'), '#', '\h'), '<', '\l'), ':', '\c') AS head FROM r)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(head) + 2 + length(body) + 8)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
