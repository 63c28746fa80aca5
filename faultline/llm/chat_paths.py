"""Chat formatting of reply trees (operator 2), built-in functions only.

Input is a forest of messages (conv_id, node, parent, role, text, score).
Iterative self-joins double the pointers from node to ancestor, so paths from
root to leaf take as many rounds as the depth has bits.  They give each leaf
its root, length and sum of scores; the best ``branches`` leaves of each tree
are chosen, and the stored jumps are replayed from the chosen leaves to list
the messages of their paths.  Each path becomes one conversation:

    ### <role>: <text> </turn>

per message, with a line feed after each.  Inside texts and roles a backslash,
``#`` and ``<`` (and ``:`` in roles) are written as ``\\e``, ``\\h``, ``\\l`` and
``\\c``, so no text holds a control string and the escape can be undone.  The
loss mask lists the spans of assistant texts in code points.

Defined results: null texts and roles count as empty.  A null conv_id is a
conversation of its own.  A parent that is missing makes its child a root;
messages on or below a cycle have no root and are left out; of rows that
repeat (conv_id, node) the one with the smallest role and text stays.  Branch
ties go to the longer path, then the smaller leaf.  A null score counts as 0.
Other columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm import shared

NULL_ID = -(1 << 63)
HEAD, MIDDLE, END = "### ", ": ", " </turn>\n"
TEXT_CODES = (("\\", "\\e"), ("#", "\\h"), ("<", "\\l"))
ROLE_CODES = (*TEXT_CODES, (":", "\\c"))
ASSISTANT = "assistant"


def escaped(value: Column, codes=TEXT_CODES) -> Column:
    return functools.reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), codes, value)


def unescaped(value: Column, codes=TEXT_CODES) -> Column:
    return functools.reduce(lambda c, x: F.replace(c, F.lit(x[1]), F.lit(x[0])), reversed(codes), value)


def forest(messages: DataFrame) -> DataFrame:
    """(c, node, up, score): the tree edges; ``up`` is null at roots."""
    nodes = messages.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("c"), "node", "parent",
                            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")) \
        .groupBy("c", "node").agg(F.min("parent").alias("parent"), F.max("score").alias("score"))
    known = nodes.select("c", F.col("node").alias("parent"), F.lit(True).alias("known"))
    return (nodes.join(known, ["c", "parent"], "left")
            .select("c", "node", F.when(F.col("known"), F.col("parent")).alias("up"), "score"))


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(c, path, node, place): the messages of the chosen paths; ``path`` is the
    leaf, ``place`` counts from the root."""
    edges = shared.stored(forest(messages), "forest")
    total = edges.count()
    # state: n nodes from node up to, not including, up; sum of their scores
    state = edges.withColumns({"n": F.lit(1).cast("long"), "root": F.when(F.col("up").isNull(), F.col("node"))}) \
        .select("c", "node", "up", "root", "n", F.col("score").alias("sum"))
    jumps = []
    while True:
        jump = shared.stored(state.where("up is not null"), f"jump-{len(jumps)}")
        done = state.where("up is null")
        done = shared.stored(done, f"rooted-{len(jumps)}")
        open_ = jump.count()
        if not open_ or (1 << len(jumps)) > total:  # what is left then hangs on a cycle
            break
        jumps.append(jump)
        above = jump.union(done).select("c", F.col("node").alias("up"), F.col("up").alias("up2"),
                                        F.col("root").alias("root2"), F.col("n").alias("n2"), F.col("sum").alias("sum2"))
        state = (jump.drop("root").join(above, ["c", "up"])
                 .select("c", "node", F.col("up2").alias("up"), F.col("root2").alias("root"),
                         (F.col("n") + F.col("n2")).alias("n"), (F.col("sum") + F.col("sum2")).alias("sum"))
                 .union(done))
    parents = edges.where("up is not null").select("c", F.col("up").alias("node")).distinct()
    leaves = done.join(parents, ["c", "node"], "left_anti")
    best = Window.partitionBy("c", "root").orderBy(F.desc("sum"), F.desc("n"), "node")
    chosen = (leaves.withColumn("r", F.row_number().over(best)).where(F.col("r") <= branches)
              .select("c", F.col("node").alias("path"), "node", (F.col("n") - 1).alias("place")))
    listed = shared.stored(chosen, "path")
    for k in reversed(range(len(jumps))):
        higher = (listed.join(jumps[k].select("c", "node", "up"), ["c", "node"])
                  .select("c", "path", F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place")))
        listed = shared.stored(listed.union(higher), "path")
    return listed


def formatted(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, path, formatted, loss): one conversation per chosen path;
    ``loss`` has the spans (start from 0, length) of its assistant texts."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    body = messages.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("c"), "node",
                           F.struct(plain("role").alias("role"), plain("text").alias("text")).alias("m")) \
        .groupBy("c", "node").agg(F.min("m").alias("m"))
    turn = F.struct("place", (F.col("m.role") == ASSISTANT).alias("loss"),
                    F.concat(F.lit(HEAD), escaped(F.col("m.role"), ROLE_CODES), F.lit(MIDDLE)).alias("head"),
                    escaped(F.col("m.text")).alias("text"))
    turns = (paths(messages, branches).join(body, ["c", "node"]).groupBy("c", "path")
             .agg(F.sort_array(F.collect_list(turn)).alias("turns")))
    walk = F.aggregate(
        "turns", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["head"]) + F.length(t["text"]) + len(END)).cast("long").alias("at"),
            F.when(t["loss"], F.concat(s["spans"], F.array(F.struct(
                (s["at"] + F.length(t["head"])).cast("long").alias("start"), F.length(t["text"]).cast("long").alias("length")))))
            .otherwise(s["spans"]).alias("spans")),
        lambda s: s["spans"])
    return turns.select(F.when(F.col("c") != NULL_ID, F.col("c")).alias("conv_id"), "path",
                        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit(END))), "")
                        .alias("formatted"), walk.alias("loss"))


def turns_of(value: Column) -> Column:
    """The (role, text) of a formatted conversation's turns."""
    parts = F.split(value, END)
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda t: F.struct(
        unescaped(F.substring_index(F.substr(t, F.lit(len(HEAD) + 1)), MIDDLE, 1), ROLE_CODES).alias("role"),
        unescaped(F.substr(t, F.instr(t, MIDDLE) + len(MIDDLE))).alias("text")))


def loss_text(value: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(
        F.substr(value, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def chains(conversations: DataFrame) -> DataFrame:
    """Messages of conversations given by turn: each replies to the one before.
    Null turns come first; equal turns are ordered by role, then by text (null: empty)."""
    order = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    node = F.row_number().over(order).cast("long")
    return (conversations.withColumn("node", node)
            .select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                    F.lit(0.0).alias("score")))


def query(spark, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one full of control strings, read back from the output."""
    table = shared.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, ASSISTANT, probe)],
                                  "conv_id long, turn long, role string, text string")
    out = formatted(chains(table.union(extra)))
    read = out.select("conv_id", "formatted", turns_of(F.col("formatted")).alias("turns"),
                      loss_text(F.col("formatted"), F.col("loss")).alias("lost"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(whole, 256).alias("turns_sha256"), F.length("lost").cast("long").alias("loss_chars"),
                       F.sha2("lost", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + 2 + 9 + length(role) + length(text)
                + (length(role) - length(translate(role, '\#<:', ''))) + (length(text) - length(translate(text, '\#<', ''))))
            AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
