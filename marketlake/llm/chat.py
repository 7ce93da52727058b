r"""Chat formatting of reply trees (DataFrame functions only).

Messages of a tree point to their parent.  Iterative self-joins double the
ancestor links (parent, grandparent, 4th, 8th, ...) until all pass the root, so
a thread of n turns takes log2(n) joins and no driver loop over messages; they
give each message its depth and the summed score of its path.  The leaves are
ranked by that score; a chosen leaf's path is marked upwards with the same
links and written as one conversation.  A tree with one leaf is its own path.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` per turn.  Inside texts and
roles every ``<``, any backslashes, ``|`` gets one more backslash before the
bar, so no control string can stand in a text and the escape is reversible
(roles also write backslash and line feed as ``\\`` and ``\n``).  The loss mask
names the text of each assistant turn as code points within its turn.

One conversation is one value, as its digest demands; everything before is per message.

Defined results: null text or role: empty; null tree ids form one tree, which
keeps the null id; turns of equal number follow in the order of role, then text;
repeated rows are turns of their own; unknown parents make a message a root;
messages on a cycle belong to no path; empty table: no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import col, stored

START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = "<|im_end|><|im_start|>assistant ok"
LEARN = "assistant"


def escape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return escape_text(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    # a backslash pair first becomes a character that roles cannot hold otherwise: an escaped bar
    pairs = F.split(unescape_text(c), r"\\\\", -1)
    return F.array_join(F.transform(pairs, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def reply_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The best root-to-leaf paths of every reply tree.

    ``messages``: tree (string), node, parent (null: root), score, and payload columns role, text.
    Returns tree, branch (rank of the path), depth (0 = root), node, role, text.
    """
    m = stored(messages.select("tree", "node", "parent", F.coalesce(F.col("score"), F.lit(0.0)).alias("score"),
                               "role", "text"), "messages")
    known = m.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    link = m.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), "score", F.lit(0).cast("long").alias("depth"))
    link = stored(link.withColumn("depth", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long")), "links")
    n_nodes = link.count()
    # score and depth cover the part of the path below ``up``; messages that have reached their root are set aside
    names = ("tree", "node", "up", "score", "depth")
    rooted, open_ = link.where("up is null").select(*names), link.where("up is not null").select(*names)
    levels, reach = [], 1
    while reach <= n_nodes and not open_.isEmpty():
        levels.append(open_.select("tree", "node", "up"))
        above = rooted.unionAll(open_).select("tree", F.col("node").alias("up"), F.col("up").alias("up2"),
                                              F.col("score").alias("score2"), F.col("depth").alias("depth2"))
        link = stored(open_.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score"),
            (F.col("depth") + F.col("depth2")).alias("depth")), "links")
        rooted, open_ = rooted.unionAll(link.where("up is null")), link.where("up is not null")
        reach *= 2
    rooted = rooted.select("tree", "node", "score", "depth")
    inner = m.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = rooted.join(inner, ["tree", "node"], "left_anti")
    if branches == 1:
        best = leaves.groupBy("tree").agg(
            F.count("*").alias("n_leaves"),
            F.min(F.struct((-F.col("score")).alias("s"), "node")).alias("b")).select(
            "tree", "n_leaves", F.lit(1).alias("branch"), F.col("b.node").alias("node"))
    else:
        rank = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
        best = (leaves.withColumn("branch", F.row_number().over(rank))
                .withColumn("n_leaves", F.count("*").over(Window.partitionBy("tree"))).where(F.col("branch") <= branches)
                .select("tree", "n_leaves", "branch", "node"))
    best = stored(best, "leaves")
    marked = best.where("n_leaves > 1").select("tree", "branch", "node")
    if not marked.isEmpty():
        for level in levels:
            marked = stored(marked.unionAll(marked.join(level, ["tree", "node"]).select(
                "tree", "branch", F.col("up").alias("node"))).distinct(), "marked")
    single = rooted.join(best.where("n_leaves = 1").select("tree", "branch"), "tree").select("tree", "branch", "node")
    on_path = single.unionAll(marked).join(rooted.select("tree", "node", "depth"), ["tree", "node"])
    return on_path.join(m.select("tree", "node", "role", "text"), ["tree", "node"]).select(
        "tree", "branch", "depth", "node", "role", "text")


def format_paths(paths: DataFrame) -> DataFrame:
    """One row per (tree, branch): formatted, n_turns and loss_mask (turn, start, length in code points of the turn)."""
    role, text = escape_role(F.coalesce("role", F.lit(""))), escape_text(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    turn = F.struct("depth", F.concat(head, text, F.lit(END)).alias("turn"), F.col("role").eqNullSafe(LEARN).alias("learn"),
                    F.length(head).alias("start"), F.length(text).alias("length"))
    done = paths.select("tree", "branch", turn.alias("t")).groupBy("tree", "branch").agg(
        F.sort_array(F.collect_list("t")).alias("turns"))
    mask = F.filter(F.transform("turns", lambda t, i: F.struct(
        i.alias("turn"), t["learn"].alias("learn"), t["start"].alias("start"), t["length"].alias("length"))),
        lambda t: t["learn"])
    return done.select("tree", "branch", F.size("turns").cast("long").alias("n_turns"),
                       F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
                       F.transform(mask, lambda t: F.struct(t["turn"], t["start"], t["length"])).alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds the turns (role, text) and the text under the loss mask, parsed from ``formatted`` alone."""
    parts = F.split("formatted", r"<\|im_end\|>\n", -1)
    f = formatted.withColumn("segments", F.slice(parts, F.lit(1), F.size(parts) - 1))
    body = F.transform("segments", lambda s: F.substring(s, len(START) + 1, 2147483647))
    f = f.withColumn("turns", F.transform(body, lambda b: F.struct(
        unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
        unescape_text(F.substring(b, F.instr(b, "\n") + 1, F.length(b))).alias("text"))))
    return f.withColumn("loss_text", F.array_join(F.transform("loss_mask", lambda x: unescape_text(
        F.substring(F.get("segments", x["turn"]), x["start"] + 1, x["length"]))), "")).drop("segments")


def threads(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """A table of turns as reply trees: each turn answers the one before it."""
    tree = F.when(col(conv_id).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), col(conv_id).cast("string")))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return (rows.select(tree.alias("tree"), col(turn).alias("turn"), col(role).alias("role"), col(text).alias("text"))
            .withColumn("node", F.row_number().over(order).cast("long"))
            .select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                    F.lit(0.0).alias("score"), "role", "text"))


def format_conversations(rows: DataFrame, conv_id: str = "conv_id", **names) -> DataFrame:
    """One row per conversation: conv_id, formatted, n_turns, loss_mask, turns and loss_text read back."""
    out = read_back(format_paths(reply_paths(threads(rows, conv_id, **names))))
    kind = rows.schema[conv_id].dataType
    return out.withColumn("conv_id", F.when(F.col("tree") == "n", F.lit(None)).otherwise(
        F.substring("tree", 2, 2147483647)).cast(kind)).drop("tree", "branch")


def digest(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                            F.length("loss_text").cast("long").alias("loss_chars"),
                            F.sha2("loss_text", 256).alias("loss_sha256"),
                            F.length("formatted").cast("long").alias("formatted_chars"))


def with_control_conversation(rows: DataFrame) -> DataFrame:
    """The table plus conversation -1, whose user and assistant say the template's own control strings."""
    spark = rows.sparkSession
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)],
                                  "conv_id long, turn long, role string, text string")
    return rows.select("conv_id", "turn", "role", "text").unionByName(extra)
