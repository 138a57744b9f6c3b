"""Conversations from reply trees: one per chosen path from a root to a leaf.

Paths are found by self-joins that double the distance: after round k every message knows its
ancestor 2**k replies up, the number of messages and the total score on the way. When all
pointers have passed the roots, each leaf knows its path's length and score, and leaves
are ranked per tree. The messages of the chosen paths come from the same pointers, the
largest jump first, so that a path of n messages takes about log n joins.

A conversation is its turns in the template below. Control strings inside texts and roles
are escaped, so that both can be read back; the loss mask lists where the assistant's texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapharbor.llm.shared import prepare, stored

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape_text(text: Column) -> Column:
    """A bar after each "<|": a control string inside a text is none any more."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape_text(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def escape_role(role: Column) -> Column:
    """As a text, and without line feeds: a role ends at the first one."""
    role = F.replace(escape_text(role), F.lit("%"), F.lit("%25"))
    return F.replace(role, F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    role = F.replace(role, F.lit("%0A"), F.lit("\n"))
    return unescape_text(F.replace(role, F.lit("%25"), F.lit("%")))


def _pointers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(row, up) per power of two: the ancestor that many replies up, where there is one; and
    (row, n, total): messages and total score from the root, for all rows that have a root.

    A row is joined only as long as its pointer has not passed its root, so the joins
    hold a row per message and, beyond that, only what long paths need.
    """
    start = nodes.select("row", "tree", "id", "parent", "score")
    above = nodes.select(F.col("row").alias("up"), F.col("tree").alias("up_tree"), F.col("id").alias("up_id"))
    linked = start.join(
        above,
        F.col("tree").eqNullSafe(F.col("up_tree"))
        & (F.col("parent") == F.col("up_id"))
        & (F.col("parent") != F.col("id")),
        "left",
    )
    state = linked.select("row", "up", F.lit(1).cast("bigint").alias("n"), F.col("score").alias("total"))
    state = stored(state, "pointers")
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    jumps: list[DataFrame] = []
    # Past the largest tree's size only replies in a circle still point somewhere.
    while (1 << len(jumps)) <= 2 * largest and not state.where("up is not null").isEmpty():
        live = state.where("up is not null")
        jumps.append(live.select("row", "up"))
        more = state.select(
            F.col("row").alias("up"), F.col("up").alias("next"), F.col("n").alias("n2"), F.col("total").alias("t2")
        )
        doubled = live.join(more, "up").select(
            "row",
            F.col("next").alias("up"),
            (F.col("n") + F.col("n2")).alias("n"),
            (F.col("total") + F.col("t2")).alias("total"),
        )
        state = stored(state.where("up is null").unionByName(doubled), "pointers")
    return jumps, state.where("up is null").select("row", "n", "total")


def paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """Turns of the chosen paths: (path, tree, rank, path_score, place, role, text).

    ``messages`` has tree, id, parent, role, text and score. A path's score is the mean of its
    messages' scores, null scores counting 0; per tree the ``branches`` best leaves are chosen (None: all),
    ties to the smaller leaf id. A message without a parent in its tree is a root. Rows
    that share tree and id are one message, the smallest by role, text and score. A null tree is
    a tree; messages without an id are trees of their own. Replies in a circle have no root and are
    left out.
    """
    rank = Window.partitionBy("tree", "id").orderBy("role", "text", "score")
    numbered = messages.select(
        "tree", "id", "parent", "role", "text", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")
    )
    one = numbered.withColumn("copy", F.row_number().over(rank)).where("copy = 1 or id is null").drop("copy")
    nodes = stored(one.withColumn("row", F.monotonically_increasing_id()), "messages")
    jumps, rooted = _pointers(nodes)
    leaves = rooted.join(nodes.select("row", "tree", "id"), "row")
    if jumps:
        parents = jumps[0].select(F.col("up").alias("row")).distinct()
        leaves = leaves.join(parents, "row", "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("path_score"), "id", "row")
    ranked = leaves.withColumn("path_score", F.col("total") / F.col("n")).withColumn("rank", F.row_number().over(best))
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)
    chosen = stored(ranked.select(F.col("row").alias("path"), "tree", "rank", "path_score", "n"), "paths")
    on_path = chosen.select("path", F.col("path").alias("row"), F.lit(0).cast("bigint").alias("up_by"))
    for k in reversed(range(len(jumps))):
        far = on_path.join(jumps[k], "row")
        far = far.select("path", F.col("up").alias("row"), (F.col("up_by") + (1 << k)).alias("up_by"))
        on_path = stored(on_path.unionByName(far), "on-path")
    return (
        on_path.join(nodes.select("row", "role", "text"), "row")
        .join(chosen, "path")
        .select("path", "tree", "rank", "path_score", (F.col("n") - 1 - F.col("up_by")).alias("place"), "role", "text")
    )


def formatted(turns: DataFrame) -> DataFrame:
    """(tree, rank, path_score, conversation, loss_mask): one row per path.

    ``conversation`` is the turns in the template, ``loss_mask`` an array of (start, length) in
    code points. Null roles and texts are empty.
    """
    role = F.coalesce("role", F.lit(""))
    body = escape_text(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(OPEN), escape_role(role), F.lit("\n"))
    until = Window.partitionBy("path").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = turns.select(
        "path", "tree", "rank", "path_score", "place",
        (role == LOSS_ROLE).alias("loss"),
        F.char_length(head).cast("bigint").alias("skip"),
        F.char_length(body).cast("bigint").alias("size"),
        F.concat(head, body, F.lit(CLOSE)).alias("piece"),
    )
    pieces = pieces.withColumn("start", F.sum(F.char_length("piece")).over(until) - F.char_length("piece") + F.col("skip"))
    span = F.when(F.col("loss"), F.struct("place", "start", F.col("size").alias("length")))
    rows = pieces.groupBy("path", "tree", "rank", "path_score").agg(
        F.array_sort(F.collect_list(F.struct("place", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(span)).alias("spans"),
    )
    return rows.select(
        "tree", "rank", "path_score",
        F.array_join(F.col("pieces.piece"), "").alias("conversation"),
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss_mask"),
    )


def conversations(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """Reply trees to conversations: see ``paths`` and ``formatted``."""
    prepare(messages.sparkSession)
    return formatted(paths(messages, branches))


def chain(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as reply trees without branches: each turn answers the one
    before it. Equal turn numbers go by role, then text; null turns come first."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.withColumn("id", F.row_number().over(order).cast("bigint"))
    return rows.select(
        F.col("conv_id").alias("tree"),
        "id",
        F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def turns_of(conversation: Column) -> Column:
    """The turns of a conversation, read back as an array of (role, text)."""
    pieces = F.slice(F.split(conversation, r"<\|im_start\|>"), 2, 1 << 30)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        skip = F.char_length(role) + 1
        text = F.substring(piece, skip + 1, F.char_length(piece) - skip - len(CLOSE))
        return F.struct(unescape_role(role).alias("role"), unescape_text(text).alias("text"))

    return F.transform(pieces, turn)


def masked_texts(conversation: Column, loss_mask: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(
        loss_mask,
        lambda s: unescape_text(F.substring(conversation, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
