"""Conversations from reply trees, formatted for training, in DataFrame operations alone.

Replies (tree, node, parent, role, text, score) form trees. :func:`paths` enumerates paths from root to leaf by iterative
self-joins: the join of round k takes every reply from its 2^k-th ancestor to that one's, so a tree of any depth takes
logarithmically many rounds. A branch's score is the sum of its replies' scores; each tree's best branches by it, or all, are
formatted, each as one conversation (:func:`conversations`).

A turn is ``<turn>``, role, ``<text>``, text and ``</turn>``, one below the other. A backslash is put before each backslash and each
such mark within roles and texts, so no mark is found in them and :func:`unescape` gives them back. A conversation is an array of blocks of
at most ``BLOCK`` turns: their text, and the loss mask as places (begin, length) in code points of what assistants say. Together
they are the conversation (:func:`formatted`); turns are put together by block before blocks are by conversation.

Defined results: null roles and texts are empty; null scores count 0; a parent that isn't a reply of the table makes a root; replies
in a cycle raise an error; of branches of equal score the smaller leaf comes first; a node must be one reply (repeated rows of
:func:`turns` get nodes of their own); null trees are one tree; empty tables have no conversations. A conversation is one row, so it must fit in one (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factline.llm.mixing import sums_before
from factline.sources.storage import write_shared

BLOCK = 64
_OPEN, _TEXT, _CLOSE = "<turn>\n", "\n<text>\n", "\n</turn>\n"
_MARKS = "<turn>|<text>|</turn>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\|{_MARKS}", r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\|{_MARKS})", "$1")


def turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Replies of conversations whose turns answer each other in turn (null first; ties by role and the text's digest)."""
    rows = df.select(F.col(id_col).alias("tree"), F.col(turn_col).alias("turn"), *(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))))
    rows = sums_before(rows, [F.col("tree").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.md5("text")], {"node": F.lit(1).cast("long")})
    rows = write_shared(rows.select("tree", "node", "role", "text"), "turns")
    first = rows.groupBy("tree").agg(F.min("node").alias("node")).select("node", F.lit(True).alias("first"))
    parent = F.when(F.col("first").isNull(), F.col("node") - 1).alias("parent")
    return rows.join(first, "node", "left").select("tree", "node", parent, "role", "text", F.lit(0.0).alias("score"))


def _jumps(replies: DataFrame) -> list[DataFrame]:
    """For each k, every reply with its 2^k-th ancestor (``up``, null beyond the root) and the sum of the scores before that one."""
    known = replies.select(F.col("node").alias("above"), F.lit(True).alias("known"))
    own = replies.select("node", "parent", F.coalesce("parent", "node").alias("above"), F.coalesce(F.col("score"), F.lit(0.0)).alias("total"))  # roots look for themselves, so that nulls don't meet
    jumps = [write_shared(own.join(known, "above", "left").select("node", F.when(F.col("known"), F.col("parent")).alias("up"), "total"), "jumps")]
    n = jumps[0].count()
    while jumps[-1].where("up IS NOT NULL").limit(1).count():
        if 1 << (len(jumps) - 1) > n:
            raise ValueError("replies form a cycle")
        low = jumps[-1]
        high = low.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"))
        far = low.where("up IS NOT NULL").join(high, "up").select("node", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"))
        jumps.append(write_shared(far.unionByName(low.where("up IS NULL")), "jumps"))
    return jumps


def paths(replies: DataFrame, best: int | None = None) -> DataFrame:
    """(leaf, rank, score, node, distance) for every reply of each tree's ``best`` branches (null: of all): its distance from the leaf."""
    jumps = _jumps(replies)
    leaves = replies.select("tree", "node").join(replies.select(F.col("parent").alias("node")), "node", "left_anti")
    leaves = leaves.join(jumps[-1].select("node", F.col("total").alias("score")), "node")
    if best is None:  # all ranks, so that a tree with many branches isn't in one task
        placed = write_shared(sums_before(leaves, [F.col("tree").asc_nulls_first(), F.col("score").desc(), F.col("node")], {"at": F.lit(1)}), "leaves")
        first = placed.groupBy(F.col("tree").alias("of")).agg(F.min("at").alias("first"))
        chosen = placed.join(first, F.col("tree").eqNullSafe(F.col("of"))).withColumn("rank", F.col("at") - F.col("first") + 1)
    else:
        chosen = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.col("score").desc(), "node"))).where(F.col("rank") <= best)
    chosen = write_shared(chosen.select(F.col("node").alias("leaf"), F.col("rank").cast("int").alias("rank"), "score"), "branches")
    found = chosen.select("leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("distance"))
    for k, jump in enumerate(jumps[:-1]):
        above = found.join(jump.where("up IS NOT NULL").select("node", "up"), "node")
        found = found.unionByName(write_shared(above.select("leaf", F.col("up").alias("node"), (F.col("distance") + (1 << k)).alias("distance")), "paths"))
    return found.join(chosen, "leaf")


def _begins(sizes: Column) -> Column:
    """1 + the sum of the sizes before each."""
    return F.transform(sizes, lambda _, i: F.aggregate(F.slice(sizes, 1, i), F.lit(1).cast("long"), lambda a, x: a + x))


def conversations(replies: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, rank, score, n_turns, blocks) of each chosen branch; see the module on blocks."""
    spoken = replies.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text"))
    head = F.concat(F.lit(_OPEN), escape(F.col("role")), F.lit(_TEXT))
    turn = F.struct((-F.col("distance")).alias("at"), F.concat(head, "text", F.lit(_CLOSE)).alias("text"), F.length(head).alias("begin"), F.when(F.col("role") == "assistant", F.length("text")).alias("length"))
    rows = paths(replies, best).join(spoken, "node").select("tree", "leaf", "rank", "score", F.floor(F.col("distance") / BLOCK).alias("block"), turn.alias("turn"))
    blocks = rows.groupBy("tree", "leaf", "rank", "score", "block").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    begins = blocks.withColumn("begins", _begins(F.transform("turns", lambda t: F.length(t["text"]).cast("long"))))
    mask = F.zip_with("turns", "begins", lambda t, b: F.struct((t["begin"] + b).cast("int").alias("begin"), t["length"].alias("length")))
    block = F.struct((-F.col("block")).alias("at"), F.array_join("turns.text", "").alias("text"), F.filter(mask, lambda m: m["length"].isNotNull()).alias("loss"), F.size("turns").cast("long").alias("n"))
    whole = begins.select("tree", "leaf", "rank", "score", block.alias("block")).groupBy("tree", "leaf", "rank", "score").agg(F.array_sort(F.collect_list("block")).alias("blocks"))
    n_turns = F.aggregate("blocks", F.lit(0).cast("long"), lambda a, b: a + b["n"])
    return whole.select("tree", "leaf", "rank", "score", n_turns.alias("n_turns"), F.transform("blocks", lambda b: F.struct(b["text"].alias("text"), b["loss"].alias("loss"))).alias("blocks"))


def formatted(blocks: str = "blocks") -> Column:
    """A conversation as one text."""
    return F.array_join(F.col(f"{blocks}.text"), "")


def loss_texts(blocks: str = "blocks") -> Column:
    """What the loss mask covers, unescaped, one after the other."""
    return F.flatten(F.transform(blocks, lambda b: F.transform(b["loss"], lambda m: unescape(F.substring(b["text"], m["begin"], m["length"])))))


def read_turns(blocks: str = "blocks") -> Column:
    """Array of (role, text) that a formatted conversation holds."""
    parts = lambda text: F.split(text, _CLOSE)

    def turn(part: Column) -> Column:
        sides = F.split(part, _TEXT, 2)
        return F.struct(unescape(F.substring(sides[0], len(_OPEN) + 1, F.length(sides[0]))).alias("role"), unescape(sides[1]).alias("text"))

    return F.flatten(F.transform(blocks, lambda b: F.transform(F.slice(parts(b["text"]), 1, F.size(parts(b["text"])) - 1), turn)))


def read_back(df: DataFrame) -> DataFrame:
    """Digests of written conversations, as their texts and masks hold them."""
    said = F.array_join(F.transform(read_turns(), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = df.select("tree", "leaf", F.size(read_turns()).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.array_join(loss_texts(), "").alias("loss"), F.length(formatted()).cast("long").alias("formatted_chars"))
    return read.select("tree", "leaf", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
