"""Chat formatting: reply trees become conversations, with DataFrame functions only.

A tree's messages are linked by parent ids. Self-joins that double their reach each time find
every message's depth and path score; branches are ranked by score; the chosen leaves' paths are
listed by going back over the stored jumps, and every path is formatted as one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import stored

# The template's control strings.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escaped(text: Column) -> Column:
    """No control string of any usual template (all begin with < or [) survives, and every text can be read back."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("[\\"), F.lit("[")), F.lit("<\\"), F.lit("<")), F.lit("\\\\"), F.lit("\\"))


def chain(conversations: DataFrame) -> DataFrame:
    """Flat conversations (conv_id, turn, role, text) as reply trees: every row answers the one before it.

    Rows go by turn, then role and text; a null turn comes first. Rows without conv_id form one tree.
    """
    by = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return (
        conversations.select(F.col("conv_id").cast("long").alias("tree"), F.col("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
        .withColumn("message", F.row_number().over(by).cast("long"))
        .select("tree", "message", F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
    )


def paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, branch, leaf, depth, message) of the best root-to-leaf paths of each tree.

    messages: tree, message (unique within its tree), parent (null for a root), score. A branch's
    score is the mean score of its messages (null: 0); ties go to the longer path, then to the
    smaller leaf. branches: how many to keep of a tree, all of them if None. A parent that doesn't
    exist makes its child a root. Messages on a cycle are on no path, nor is what hangs below them.
    """
    ids = messages.select("tree", "message", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    there = ids.select("tree", F.col("message").alias("parent"), F.lit(True).alias("found"))
    same = lambda a, b: a["tree"].eqNullSafe(b["tree"])
    a, b = ids.alias("a"), there.alias("b")
    start = a.join(b, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.parent") == F.col("b.parent")), "left").select(
        "a.tree", "a.message", F.when(F.col("b.found"), F.col("a.parent")).alias("up"), F.col("a.score").alias("total"), F.lit(1).cast("long").alias("length")
    )
    start = stored(start, "jumps")
    done, active = start.where("up IS NULL"), start.where("up IS NOT NULL")
    # jumps[k]: of messages with one 2**k above, that one (up); total and length are of the messages passed.
    jumps: list[DataFrame] = []
    whole = start.count()
    while (1 << len(jumps)) < whole and active.limit(1).count():
        jumps.append(active)
        x, y = active.alias("x"), done.unionByName(active).alias("y")
        nxt = x.join(y, F.col("x.tree").eqNullSafe(F.col("y.tree")) & (F.col("x.up") == F.col("y.message"))).select(
            "x.tree", "x.message", "y.up", (F.col("x.total") + F.col("y.total")).alias("total"), (F.col("x.length") + F.col("y.length")).alias("length")
        )
        nxt = stored(nxt, "jumps")
        done, active = done.unionByName(nxt.where("up IS NULL")), nxt.where("up IS NOT NULL")
    # What is still active hangs on a cycle.
    whole, first = done, start
    m, p = whole.alias("m"), first.where("up IS NOT NULL").select(F.col("tree").alias("t"), F.col("up").alias("answered")).distinct().alias("p")
    leaves = m.join(p, F.col("m.tree").eqNullSafe(F.col("p.t")) & (F.col("m.message") == F.col("p.answered")), "left_anti")
    rank = Window.partitionBy("tree").orderBy((F.col("total") / F.col("length")).desc(), F.col("length").desc(), "message")
    chosen = leaves.withColumn("branch", F.row_number().over(rank))
    if branches is not None:
        chosen = chosen.where(F.col("branch") <= branches)
    # Going back: each pass adds to the messages known the ones 2**k above them.
    known = stored(chosen.select("tree", "branch", F.col("message").alias("leaf"), F.col("length").alias("depth"), "message"), "paths")
    for k in reversed(range(len(jumps))):
        j = jumps[k].select(F.col("tree").alias("t"), F.col("message").alias("below"), "up").alias("j")
        more = known.alias("n").join(j, F.col("n.tree").eqNullSafe(F.col("j.t")) & (F.col("n.message") == F.col("j.below"))).select(
            "n.tree", "n.branch", "n.leaf", (F.col("n.depth") - F.lit(1 << k)).alias("depth"), F.col("j.up").alias("message")
        )
        known = stored(known.unionByName(more), "paths")
    return known


def formatted(messages: DataFrame, branches: int | None = 1, learn: str = "assistant") -> DataFrame:
    """(tree, branch, leaf, formatted, loss_spans) of every chosen path, a row for each.

    formatted: ``<|turn|>role<|text|>text<|end|>`` for each message, roles and texts escaped.
    loss_spans: start (from 0) and length in code points of the learnt role's texts in formatted.
    Null roles and texts are empty. See paths() for branches, broken links and ties. An empty
    table gives no rows.
    """
    listed = paths(messages, branches)
    said = messages.select(F.col("tree").alias("t"), F.col("message").alias("m"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = listed.join(said, F.col("tree").eqNullSafe(F.col("t")) & (F.col("message") == F.col("m")))
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    pieces = rows.select("tree", "branch", "leaf", "depth", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    turns = pieces.groupBy("tree", "branch", "leaf").agg(F.array_sort(F.collect_list(F.struct("depth", "head", "body", (F.col("role") == learn).alias("learnt")))).alias("turns"))
    end = F.length(F.lit(END))
    step = lambda acc, t: F.struct(
        (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + end).alias("at"),
        F.when(t["learnt"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length"))))).otherwise(acc["spans"]).alias("spans"),
    )
    zero = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start:int,length:int>>)").alias("spans"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return turns.select("tree", "branch", "leaf", text.alias("formatted"), F.aggregate("turns", zero, step, lambda acc: acc["spans"]).alias("loss_spans"))


def read_back(conversations: DataFrame) -> DataFrame:
    """tree, branch, the turns (role, text) and the learnt text of formatted(), from its output alone."""
    pieces = F.split("formatted", r"<\|turn\|>")
    pieces = F.slice(pieces, F.lit(2), F.size(pieces))
    role = lambda p: unescaped(F.split_part(p, F.lit(TEXT), F.lit(1)))
    text = lambda p: unescaped(F.split_part(F.split_part(p, F.lit(TEXT), F.lit(2)), F.lit(END), F.lit(1)))
    return conversations.select(
        "tree", "branch", "formatted",
        F.transform(pieces, lambda p: F.struct(role(p).alias("role"), text(p).alias("text"))).alias("turns"),
        F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "").alias("loss_text"),
    )
