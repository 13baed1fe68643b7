"""Message tables: paths through a conversation's tree, indexes, rollups, deltas, context."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.storage import stored


def in_conversation():
    return Window.partitionBy("conversation_id")


def main_path(nodes: DataFrame, heads: DataFrame, rounds: int = 20) -> DataFrame:
    """(conversation_id, node_id, sequence_index, branch) by doubling parent pointers from each node.

    ``nodes``: (conversation_id, node_id, parent); ``heads``: (conversation_id, current_node).
    ``rounds`` doublings reach 2 ** rounds ancestors, so cycles end too. A node is on the
    main path if the head reaches it.
    """
    keys = ["conversation_id", "node_id"]
    hop = nodes.select(*keys, F.col("parent").alias("up"), F.lit(1).alias("d"))
    reached = heads.select("conversation_id", F.col("current_node").alias("node_id"), F.lit(0).alias("steps")).join(nodes.select(*keys), keys)
    while rounds:
        onward = reached.join(hop, keys).select("conversation_id", F.col("up").alias("node_id"), (F.col("steps") + F.col("d")).alias("steps")).join(nodes.select(*keys), keys, "left_semi")
        grown = reached.unionByName(onward).groupBy(*keys).agg(F.min("steps").alias("steps"))
        further = hop.select("conversation_id", F.col("node_id").alias("up"), F.col("up").alias("up2"), F.col("d").alias("d2"))
        hop = hop.join(further, ["conversation_id", "up"]).select(*keys, F.col("up2").alias("up"), (F.col("d") + F.col("d2")).alias("d"))
        grown, hop = stored(grown, "path"), stored(hop, "hops")
        rounds -= 1
        if not hop.where("up IS NOT NULL").limit(1).count() or grown.count() == reached.count():
            reached = grown
            break
        reached = grown
    depth = F.max("steps").over(in_conversation())
    path = reached.select(*keys, (depth - F.col("steps")).alias("sequence_index"))
    return nodes.join(path, keys, "left").select(*keys, "sequence_index", F.when(F.col("sequence_index").isNotNull(), "main").otherwise("alternate").alias("branch"))


def child_lists(nodes: DataFrame) -> DataFrame:
    """Sorted children of each node that has some."""
    return nodes.where("parent IS NOT NULL").groupBy("conversation_id", F.col("parent").alias("node_id")).agg(F.array_sort(F.collect_list("node_id")).alias("children"))


def conversation_index(messages: DataFrame) -> DataFrame:
    return messages.groupBy("source_file", "conversation_id").agg(
        F.count("*").alias("n_messages"), F.count_if(F.col("role") == "user").alias("n_user"), F.count_if(F.col("role") == "assistant").alias("n_assistant"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.sum(F.char_length("text")).alias("n_chars"),
    )


def manifest(messages: DataFrame) -> DataFrame:
    """Counts by file, with a total row whose file is null."""
    return messages.rollup("source_file").agg(F.count_distinct("conversation_id").alias("n_conversations"), F.count("*").alias("n_messages"), F.sum(F.char_length("text")).alias("n_chars"))


def duplicates(rows: DataFrame, key: str, within: str) -> DataFrame:
    """Keys that occur in more than one ``within``, and the first of these."""
    return rows.groupBy(key).agg(F.count_distinct(within).alias("n"), F.min(within).alias("first")).where("n > 1")


def merge_delta(existing: DataFrame, new: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """What is there, and new rows with other keys; columns that one side lacks are null, or with ``strict`` an error."""
    if strict:
        check_columns(new, existing.columns)
    return existing.unionByName(new.join(existing.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def chronology(rows: DataFrame, row_number: str, first_role: str = "user") -> DataFrame:
    """Rows of a flat export in order of time, the person first on ties, and whether a conversation had to be reordered."""
    order = in_conversation().orderBy("ts", F.when(F.col("role") == first_role, 0).otherwise(1), row_number)
    placed = rows.withColumn("sequence_index", F.row_number().over(order) - 1).withColumn("was", F.row_number().over(in_conversation().orderBy(row_number)) - 1)
    return placed.withColumn("reordered", F.max((F.col("was") != F.col("sequence_index")).cast("int")).over(in_conversation())).drop("was")


def neighbours(messages: DataFrame) -> DataFrame:
    """Each message with its neighbours on the main branch: role of the turn just before, id of that just after."""
    order = in_conversation().orderBy("turn")
    adjacent = lambda f, c, d: F.when(f("turn").over(order) == F.col("turn") + d, f(c).over(order))
    return messages.withColumns({"prev_role": adjacent(F.lag, "role", -1), "prev_id": adjacent(F.lag, "canonical_id", -1), "next_id": adjacent(F.lead, "canonical_id", 1)})


def context(messages: DataFrame, targets: DataFrame, radius: int = 8) -> DataFrame:
    """Messages within ``radius`` places of each target (canonical_id) of their conversation."""
    placed = messages.select("canonical_id", "conversation_id", F.row_number().over(in_conversation().orderBy("turn")).alias("place"))
    aim = placed.join(targets.select("canonical_id"), "canonical_id", "left_semi").select("conversation_id", F.col("canonical_id").alias("target_id"), F.col("place").alias("at"))
    return placed.join(aim, "conversation_id").where(F.abs(F.col("place") - F.col("at")) <= radius).select("target_id", "canonical_id", (F.col("place") - F.col("at")).alias("offset"))


def graph_breaks(messages: DataFrame) -> DataFrame:
    """Messages whose parent isn't in their conversation: none in a sound table."""
    ids = messages.select("conversation_id", F.col("message_id").alias("parent_message_id"))
    return messages.where("parent_message_id IS NOT NULL").join(ids, ["conversation_id", "parent_message_id"], "left_anti").select("canonical_id", "conversation_id", "parent_message_id")


def children_context(messages: DataFrame, limit: int = 2, chars: int = 400) -> DataFrame:
    """(canonical_id, nth, child, role, text): each message's first ``limit`` children that say something, by turn, and how they begin."""
    said = messages.where("parent_message_id IS NOT NULL AND text <> ''")
    first = Window.partitionBy("conversation_id", "parent_message_id").orderBy("turn", "message_id")
    kept = said.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= limit)
    below = kept.select("conversation_id", F.col("parent_message_id").alias("message_id"), "nth", F.col("canonical_id").alias("child"), F.coalesce("role", F.lit("unknown")).alias("role"), F.substring("text", 1, chars).alias("text"))
    return messages.select("conversation_id", "message_id", "canonical_id").join(below, ["conversation_id", "message_id"]).select("canonical_id", "nth", "child", "role", "text")


def ancestors(messages: DataFrame, hops: int = 3) -> DataFrame:
    """(canonical_id, hop, ancestor): each message's parents, up to ``hops`` above."""
    up = messages.select("conversation_id", F.col("message_id").alias("at"), "canonical_id", F.col("parent_message_id").alias("next"))
    walk, out = up.select("canonical_id", "conversation_id", "next"), None
    for hop in range(1, hops + 1):
        step = walk.join(up.select("conversation_id", F.col("at").alias("next"), F.col("canonical_id").alias("ancestor"), F.col("next").alias("above")), ["conversation_id", "next"])
        made = step.select("canonical_id", F.lit(hop).alias("hop"), "ancestor")
        out = made if out is None else out.unionByName(made)
        walk = step.select("canonical_id", "conversation_id", F.col("above").alias("next"))
    return out


def compare_exports(old: DataFrame, new: DataFrame) -> DataFrame:
    """(conversation_id, same, changed, extra, missing): messages of two exports by id and text."""
    a = old.select("conversation_id", "message_id", F.md5(F.col("text").cast("binary")).alias("a"))
    b = new.select("conversation_id", "message_id", F.md5(F.col("text").cast("binary")).alias("b"))
    both = a.join(b, ["conversation_id", "message_id"], "full")
    return both.groupBy("conversation_id").agg(F.count_if(F.col("a") == F.col("b")).alias("same"), F.count_if(F.col("a") != F.col("b")).alias("changed"), F.count_if(F.col("a").isNull()).alias("extra"), F.count_if(F.col("b").isNull()).alias("missing"))


def identity_breaks(messages: DataFrame) -> DataFrame:
    """(rule, id): ids that occur twice, and each id that isn't well formed."""
    twice = messages.groupBy("canonical_id").count().where("count > 1").select(F.lit("duplicate_id").alias("rule"), F.col("canonical_id").alias("id"))
    return twice.unionByName(messages.where(~F.col("canonical_id").rlike(r"^srcmsg_[a-f0-9]{32}\z")).select(F.lit("bad_id").alias("rule"), F.col("canonical_id").alias("id")))


def first_child_path(nodes: DataFrame, root: str = "root", rounds: int = 20) -> DataFrame:
    """(conversation_id, node_id, sequence_index) from the node ``root`` along first children.

    ``nodes``: (conversation_id, node_id, children in order). First children are links to
    one node each, so the walk is a path that is reached by doubling them; a conversation
    without the root has none, and a cycle ends where it closes.
    """
    keys = ["conversation_id", "node_id"]
    hop = nodes.select(*keys, F.get("children", F.lit(0)).alias("down"), F.lit(1).alias("d")).where("down IS NOT NULL").join(nodes.select("conversation_id", F.col("node_id").alias("down")), ["conversation_id", "down"], "left_semi").select(*keys, "down", "d")
    reached = nodes.where(F.col("node_id") == root).select(*keys, F.lit(0).alias("sequence_index"))
    for _ in range(rounds):
        onward = reached.join(hop, keys).select("conversation_id", F.col("down").alias("node_id"), (F.col("sequence_index") + F.col("d")).alias("sequence_index"))
        grown = stored(reached.unionByName(onward).groupBy(*keys).agg(F.min("sequence_index").alias("sequence_index")), "path")
        if grown.count() == reached.count():
            break
        further = hop.select("conversation_id", F.col("node_id").alias("down"), F.col("down").alias("down2"), F.col("d").alias("d2"))
        reached, hop = grown, stored(hop.join(further, ["conversation_id", "down"]).select(*keys, F.col("down2").alias("down"), (F.col("d") + F.col("d2")).alias("d")), "hops")
    return reached


def preferred(messages: DataFrame, delta: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """(conversation_id, message_id, columns...) of each wanted key: from ``delta`` by conversation and message where it has both, else from ``messages`` by message alone."""
    own = delta.select("conversation_id", "message_id", *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_own"))
    other = messages.select("message_id", *columns)
    joined = wanted.select("conversation_id", "message_id").join(own, ["conversation_id", "message_id"], "left").join(other, "message_id", "left")
    return joined.select("conversation_id", "message_id", *(F.when(F.col("_own"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in columns))


def check_columns(rows: DataFrame, required: list[str]) -> None:
    """Raises ValueError unless the table has just these columns."""
    missing, extra = sorted({*required} - {*rows.columns}), sorted({*rows.columns} - {*required})
    if missing or extra:
        raise ValueError(f"columns missing: {missing}, not asked for: {extra}")


def by_month(messages: DataFrame) -> DataFrame:
    """(month, conversation_id, source_file, n): the conversations of each month and their messages in it."""
    return messages.where("ts IS NOT NULL").groupBy(F.substring("ts", 1, 7).alias("month"), "conversation_id", "source_file").agg(F.count("*").alias("n"))


def unreachable(nodes: DataFrame) -> DataFrame:
    """(conversation_id, node_id, rule) of nodes (conversation_id, node_id, parent) that no root leads to: below a parent that isn't there, or on or below a cycle.

    Pointers to ancestors are doubled until no more of them pass a root: each round at least
    the nodes of the next depth do, while there are any.
    """
    keys = ["conversation_id", "node_id"]
    up = stored(nodes.select(*keys, F.col("parent").alias("up")), "up")
    left = up.where("up IS NOT NULL").count()
    while left:
        above = up.select("conversation_id", F.col("node_id").alias("up"), F.col("up").alias("further"), F.lit(True).alias("there"))
        moved = up.join(above, ["conversation_id", "up"], "left").select(*keys, F.when(F.col("there"), F.col("further")).otherwise(F.col("up")).alias("up"))
        up, before = stored(moved, "up"), left
        left = up.where("up IS NOT NULL").count()
        if left == before:
            break
    ends = nodes.select("conversation_id", F.col("node_id").alias("up"), F.lit(True).alias("there"))
    lost = up.where("up IS NOT NULL").join(ends, ["conversation_id", "up"], "left")
    return lost.select(*keys, F.when(F.col("there"), "cycle").otherwise("missing_parent").alias("rule"))
