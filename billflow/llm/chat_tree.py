"""Chat formatting into a prefix tree.

Conversations that begin with the same turns share them: each distinct beginning is one node, formatted and
emitted once. Nodes are laid out depth first, which is the order of the distinct conversations sorted by
their turns: a node stands where its first conversation needs it. A row of the output is a node:

- `at`: place of its first character in the layout, `segment`: its formatted text;
- `position`: position id of its first character in every conversation through it;
- `loss_from`, `loss_to`: characters of the segment under the loss mask (an assistant's text);
- `sees`: intervals [from, to) of the layout that its characters attend to: ancestors and itself (causally),
  neighbours joined.

The template writes user turns as [INST]..[/INST], system turns as <<SYS>>..<</SYS>>, assistant turns as
<s>..</s> and others as [ROLE]role[/ROLE]text[END]. A control string inside a text or role gets a
backslash behind its first bracket (one more if it has some), which reading back takes away.

Null role or text: empty. Null conv_id: left out. Turns are ordered by turn (null first), then role and
text, so rows of the same turn all stay. Empty table: empty results. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from billflow.llm.ranges import running_sum
from billflow.workspace import written

# fixed values: the control strings of the template
OPEN = {"user": "[INST]", "system": "<<SYS>>", "assistant": "<s>"}
CLOSE = {"user": "[/INST]", "system": "<</SYS>>", "assistant": "</s>"}
_TAIL = "(/?INST\\]|</?SYS>>|/?s>|/?ROLE\\]|END\\])"
NODE = ["depth", "one", "two"]


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, "([<\\[])(\\\\*)" + _TAIL, "$1\\\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, "([<\\[])\\\\(\\\\*)" + _TAIL, "$1$2$3")


def formatted(role: Column, text: Column) -> Column:
    out = F.concat(F.lit("[ROLE]"), escaped(role), F.lit("[/ROLE]"), escaped(text), F.lit("[END]"))
    for name in OPEN:
        out = F.when(role == name, F.concat(F.lit(OPEN[name]), escaped(text), F.lit(CLOSE[name]))) \
            .otherwise(out)
    return out


def read_turn(segment: Column) -> tuple[Column, Column]:
    """Role and text of a formatted turn."""
    inner = F.regexp_extract(segment, "(?s)^\\[ROLE\\](.*?)\\[/ROLE\\](.*)\\[END\\]$", 2)
    role = F.regexp_extract(segment, "(?s)^\\[ROLE\\](.*?)\\[/ROLE\\](.*)\\[END\\]$", 1)
    text = inner
    for name in OPEN:
        held = segment.startswith(OPEN[name])
        cut = F.substring(segment, F.lit(len(OPEN[name]) + 1),
                          F.length(segment) - len(OPEN[name]) - len(CLOSE[name]))
        text = F.when(held, cut).otherwise(text)
        role = F.when(held, F.lit(name)).otherwise(role)
    return unescaped(role), unescaped(text)


@dataclass
class ChatTree:
    nodes: DataFrame  # depth, one, two (the node's name), at, segment, position, loss_*, sees
    paths: DataFrame  # conv_id, depth, one, two: the nodes of each conversation


def build(conversations: DataFrame) -> ChatTree:
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = rows.withColumn("depth", F.row_number().over(order).cast("long"))
    so_far = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0)
    # the name of a beginning: its number of turns and two combined hashes of its numbered turns
    turns = turns.withColumn("step", F.xxhash64("depth", "role", "text"))
    turns = turns.withColumn("one", F.bit_xor("step").over(so_far)).withColumn(
        "two", F.bit_xor(F.xxhash64(F.lit(1), "depth", "role", "text")).over(so_far))
    turns = written(turns, "chat-turns")
    # one conversation stands for all with the same turns; the sorted ones give the depth-first order
    ends = turns.groupBy("conv_id").agg(F.max(F.struct(*NODE)).alias("leaf"))
    first = ends.groupBy("leaf").agg(F.min("conv_id").alias("conv_id")).select("conv_id")
    alone = turns.join(first, "conv_id", "left_semi")
    ways = alone.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(
        F.struct("depth", "step"))), lambda x: x["step"]).alias("way"))
    ranked = running_sum(ways, ["way", "conv_id"], F.lit(1).cast("long"), "rank").drop("way")
    nodes = alone.join(ranked, "conv_id").groupBy(*NODE).agg(
        F.min("rank").alias("rank"), F.min(F.struct("role", "text")).alias("turn"))
    segment = formatted(F.col("turn.role"), F.col("turn.text"))
    nodes = nodes.select(*NODE, "rank", segment.alias("segment"),
                         (F.col("turn.role") == "assistant").alias("learned"))
    nodes = written(running_sum(nodes, ["rank", "depth"], F.length("segment").cast("long"), "at"),
                    "chat-nodes")
    # ancestors along the conversation that places the node
    way = Window.partitionBy("conv_id").orderBy("depth")
    before = way.rowsBetween(Window.unboundedPreceding, -1)
    until = way.rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("at") + F.length("segment")
    along = alone.join(ranked.withColumnRenamed("rank", "mine"), "conv_id").select(
        "conv_id", *NODE, "mine").join(nodes, NODE)
    along = along.withColumn("position", F.coalesce(F.sum(F.length("segment")).over(before),
                                                    F.lit(0)).cast("long"))
    along = along.withColumn("_end", F.lag(end).over(way))
    along = along.withColumn("_jump", F.coalesce(F.col("_end") != F.col("at"), F.lit(True)))
    along = along.withColumn("_from", F.last(F.when(F.col("_jump"), F.col("at")), True).over(until))
    along = along.withColumn("_last", F.lag("_from").over(way))
    closed = F.collect_list(F.when(F.col("_jump") & F.col("_end").isNotNull(), F.struct(
        F.col("_last").alias("from"), F.col("_end").alias("to")))).over(until)
    along = along.withColumn("sees", F.concat(closed, F.array(F.struct(
        F.col("_from").alias("from"), end.alias("to"))))).filter(F.col("mine") == F.col("rank"))
    low, high = len(OPEN["assistant"]), len(CLOSE["assistant"])
    out = along.select(*NODE, "at", "segment", "position",
                       F.when(F.col("learned"), F.lit(low)).otherwise(0).alias("loss_from"),
                       F.when(F.col("learned"), F.length("segment") - high).otherwise(0)
                       .alias("loss_to"), "sees")
    return ChatTree(out, turns.select("conv_id", *NODE))


def read_back(tree: ChatTree) -> DataFrame:
    """What each conversation says, from the segments of its path alone."""
    role, text = read_turn(F.col("segment"))
    learned = unescaped(F.substring(F.col("segment"), F.col("loss_from") + 1,
                                    F.col("loss_to") - F.col("loss_from")))
    pieces = tree.paths.join(tree.nodes, NODE).select(
        "conv_id", "depth", F.length("segment").alias("size"),
        F.concat(role, F.lit("\n"), text, F.lit("\n")).alias("said"), learned.alias("learned"))
    whole = pieces.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("depth", "said", "learned"))).alias("turns"),
        F.count("*").alias("n_turns"), F.sum("size").cast("long").alias("formatted_chars"))
    loss = F.array_join(F.transform("turns", lambda x: x["learned"]), "")
    said = F.array_join(F.transform("turns", lambda x: x["said"]), "")
    return whole.select("conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"),
                        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
