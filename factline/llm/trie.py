"""The trie of conversations' prefixes, rolled up by centroid decomposition.

A node is a distinct sequence of first turns (role and text); its members are the conversations that start with it. Nodes are named by
their smallest member and depth: on a conversation's way down, smallest members only grow, so nodes of one smallest member are
a stretch of its own turns (a path), and the place of any conversation at any depth is one row of a table, the
ancestors of every node included.

Roll-up of subtree sums: of every component of the forest of parent edges the centroid is taken out, whose removal leaves components of
at most half the size. What the component holds at and below the centroid is summed and added to the nodes from the centroid up to
the component's top; then the parts are components. A chain of any depth takes logarithmically many rounds so. Components
of over ``LOCAL`` nodes are split by joins; smaller ones go on, many at once, as numpy vectors in a task. Sizes, which
choose centroids, are summed along paths once, by pointers that double, and follow each cut.

Prefixes are told apart by their depth and 144 bits: sums, over the turns so far, of hashes of each turn and its place. Such sums and ranks
are taken over ranges of a distributed sort (:func:`factline.llm.mixing.sums_before`), so no conversation meets in one task.

Defined results: rows without a conversation id belong to none and take no part; null roles and texts are empty; turns are ordered by
``turn`` (null first), ties by role and the text's digest; repeated rows are turns of their own; an empty table has no nodes, not even a root;
other columns aren't read. A node's digest of ends is one hash of an ordered text, which is streamed through one task in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.llm.mixing import sums_before
from factline.sources.storage import write_shared

#: Nodes of a component that a task splits by itself, nodes that it takes at once, and ends in a piece.
LOCAL, NODES, PIECE = 512, 1 << 16, 512
_LANE = 1 << 24
RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def ordered_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, rank, digest, chars) of every turn: its place in its conversation, from 1, a digest of role and text, and the text's code points."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), empty(role_col).alias("role"), F.md5(empty(text_col)).alias("digest"), F.length(empty(text_col)).cast("long").alias("chars"))
    rows = sums_before(rows, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")], {"at": F.lit(1).cast("long")})
    rows = write_shared(rows.select("conv", "at", F.md5(F.concat("digest", "role")).alias("digest"), "chars"), "turns")
    first = rows.groupBy("conv").agg(F.min("at").alias("first"))
    return write_shared(rows.join(first, "conv").select("conv", (F.col("at") - F.col("first") + 1).alias("rank"), "digest", "chars"), "turns")


def with_shared_heads(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations whose first h turns are those of conversation c - c % group, h = crc32(decimal c) % most; all that there are, if fewer.

    Gives the rebuilt turns (as :func:`ordered_turns`) and one row (conv, length) for every conversation, without turns too.
    """
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    heads = sizes.select("conv", "n", (F.crc32(F.col("conv").cast("string")) % most).alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    heads = heads.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("there")), "base", "left")
    heads = write_shared(heads.withColumn("taken", F.least("h", F.coalesce("there", F.lit(0)))), "heads")
    first = turns.where(F.col("rank") < most).withColumnRenamed("conv", "base")
    head = heads.select("conv", "base", "taken").join(first, "base").where("rank <= taken").select("conv", "rank", "digest", "chars")
    own = turns.join(heads.select("conv", "h", "taken"), "conv").where("rank > h").select("conv", (F.col("taken") + F.col("rank") - F.col("h")).alias("rank"), "digest", "chars")
    return head.unionByName(own), heads.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, chars, k0, k1, k2): the prefix that ends with each turn."""
    hashes = [F.xxhash64(F.lit(i), "rank", "digest") for i in range(3)]
    lanes = {f"s{i}": F.shiftrightunsigned(hashes[i // 2], 24 * (i % 2)).bitwiseAND(F.lit(_LANE - 1)) for i in range(6)}
    sums = write_shared(sums_before(turns.withColumns({f"o{k[1]}": c for k, c in lanes.items()}), [F.col("conv"), F.col("rank")], {k: F.col(f"o{k[1]}") for k in lanes}), "sums")
    begin = sums.where("rank = 1").select("conv", *(F.col(k).alias(f"b{k[1]}") for k in lanes))
    key = lambda i: F.pmod(F.col(f"s{i}") + F.col(f"o{i}") - F.col(f"b{i}"), F.lit(_LANE))
    return sums.join(begin, "conv").select("conv", F.col("rank").alias("depth"), "chars", *((key(2 * i) * _LANE + key(2 * i + 1)).alias(f"k{i}") for i in range(3)))


def _places(steps: DataFrame, members: DataFrame, root: int) -> DataFrame:
    """(conv, depth, m, above): the node of each conversation at each depth from 1, and the one above it."""
    at = write_shared(steps.join(members, ["depth", "k0", "k1", "k2"]).select("conv", "depth", "m"), "at")
    above = at.select("conv", (F.col("depth") + 1).alias("depth"), F.col("m").alias("above"))
    return write_shared(at.join(above, ["conv", "depth"], "left").withColumn("above", F.coalesce("above", F.lit(root))), "places")


def _with_sizes(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the number of nodes in each one's subtree: totals of paths by doubling pointers, then sums along each path."""
    tops = nodes.where("depth = lo").select("m", (F.when(F.col("depth") > 0, F.col("parent"))).alias("up"), (F.col("depth") - 1).alias("at"), (F.col("hi") - F.col("lo") + 1).alias("total"))
    tops = write_shared(tops, "paths")
    now = tops.select("m", "up", "total")
    while now.where("up IS NOT NULL").limit(1).count():
        add = now.where("up IS NOT NULL").groupBy(F.col("up").alias("m")).agg(F.sum("total").alias("more"))
        further = now.where("up IS NOT NULL").select("m", "up").join(now.select(F.col("m").alias("up"), F.col("up").alias("next")), "up").select("m", "next")
        now = now.join(add, "m", "left").join(further, "m", "left")
        now = write_shared(now.select("m", F.col("next").alias("up"), (F.col("total") + F.coalesce("more", F.lit(0))).alias("total")), "totals")
    hung = tops.where("up IS NOT NULL").select("m", "up", "at").join(now.select("m", "total"), "m").groupBy(F.col("up").alias("m"), F.col("at").alias("depth")).agg(F.sum("total").alias("hung"))
    rows = nodes.join(hung, ["m", "depth"], "left").withColumn("own", 1 + F.coalesce("hung", F.lit(0))).drop("hung")
    sums = write_shared(sums_before(rows, [F.col("m"), F.col("depth").desc()], {"below": F.col("own")}), "sizes")
    base = sums.where("depth = hi").select("m", F.col("below").alias("base"))
    return sums.join(base, "m").withColumn("size", F.col("below") + F.col("own") - F.col("base")).drop("own", "below", "base")


def _split(state: DataFrame, places: DataFrame, root: int) -> tuple[DataFrame, DataFrame]:
    """One round over large components: what is left of them, and their centroids with whole sums."""
    comp = ["top", "top_depth"]
    cents = state.where(2 * F.col("size") > F.col("n")).groupBy(*comp).agg(F.min(F.struct("size", "depth", "m")).alias("c"))
    cents = write_shared(cents.select(*comp, F.col("c.size").alias("cut"), F.col("c.depth").alias("at"), F.col("c.m").alias("cm")), "centroids")
    rows = state.join(cents, comp)
    child = places.select(F.col("conv").alias("m"), (F.col("depth") - 1).alias("at"), F.col("m").alias("child"), "above")
    low = rows.where("depth > at").join(child, ["m", "at"]).withColumn("child", F.when(F.col("above") == F.col("cm"), F.col("child"))).drop("above")
    rows = write_shared(low.unionByName(rows.where("depth <= at").withColumn("child", F.lit(None).cast("long"))), "split")
    below = rows.where("child IS NOT NULL OR (m = cm AND depth = at)")
    kids = write_shared(below.groupBy(*comp, "child").agg(F.count(F.lit(1)).alias("held"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "parts")
    sums = cents.join(kids.groupBy(*comp).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")), comp)
    up = sums.where("at > 0").select("cm", "more_leaves", "more_saved", F.explode(F.sequence(F.greatest("top_depth", F.lit(1).cast("long")), F.col("at"))).alias("depth"))
    up = up.join(places.select(F.col("conv").alias("cm"), "depth", "m"), ["cm", "depth"]).select("m", "depth", "more_leaves", "more_saved")
    up = up.unionByName(sums.where("top_depth = 0").select(F.lit(root).cast("long").alias("m"), F.lit(0).cast("long").alias("depth"), "more_leaves", "more_saved"))

    kept = rows.where("child IS NULL").join(up, ["m", "depth"], "left")
    kept = kept.withColumns({"n": F.col("n") - F.col("cut"), "size": F.col("size") - F.when(F.col("more_leaves").isNull(), 0).otherwise(F.col("cut"))})
    kept = kept.withColumns({f"sum_{c}": F.col(f"sum_{c}") + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")})
    kept = write_shared(kept.withColumn("done", (F.col("m") == F.col("cm")) & (F.col("depth") == F.col("at"))).select(*state.columns, "done"), "kept")
    fell = rows.where("child IS NOT NULL").drop("n").join(kids.select(*comp, "child", F.col("held").alias("n")), [*comp, "child"])
    fell = fell.withColumns({"top": F.col("child"), "top_depth": F.col("at") + 1}).select(*state.columns)
    return kept.where("NOT done").drop("done").unionByName(fell), kept.where("done").select("m", "depth", "sum_leaves", "sum_saved")


def centroid_sums(parent: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums over each node's subtree, of forests whose parents (-1: none) come before their children, by centroid decomposition."""
    count = len(parent)
    parent, sums = parent.copy(), np.zeros_like(values)
    live, top = np.arange(count), np.arange(count)
    label, depth = np.empty(count, np.int64), np.zeros(count, np.int64)
    first = True
    while len(live):
        # Depth in its component and top of each node, from the top down; only the first time nothing is known of them.
        if first:
            known = np.flatnonzero(parent < 0)
            at = 0
            order = np.argsort(parent, kind="stable")
            begins, ends = np.searchsorted(parent[order], np.arange(count)), np.searchsorted(parent[order], np.arange(count), "right")
            while len(known):
                sizes = ends[known] - begins[known]
                below = order[np.repeat(begins[known] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                at += 1
                depth[below], top[below] = at, np.repeat(top[known], sizes)
                known = below
            first = False
        inner = depth[live] - depth[top[live]]
        by_depth = live[np.argsort(inner, kind="stable")]
        cuts = np.searchsorted(np.sort(inner), np.arange(inner.max() + 2))
        levels = [by_depth[s:e] for s, e in zip(cuts, cuts[1:], strict=False)]
        size = np.ones(count, np.int64)
        for own in reversed(levels[1:]):
            np.add.at(size, parent[own], size[own])
        heavy = live[2 * size[live] > size[top[live]]]
        heavy = heavy[np.lexsort((size[heavy], top[heavy]))]
        cents = heavy[np.flatnonzero(np.diff(top[heavy], prepend=-1))]
        # Each node below a centroid gets the centroid's child that it is under as its new top.
        cut = np.zeros(count, bool)
        cut[cents] = True
        label[live] = -1
        label[cents] = cents
        for own in levels[1:]:
            above = parent[own]
            label[own] = np.where(cut[own], own, np.where(cut[above], own, label[above]))
        below = live[label[live] >= 0]
        belongs = np.empty(count, np.int64)
        belongs[top[cents]] = np.arange(len(cents))
        totals = np.zeros((len(cents), values.shape[1]), values.dtype)
        np.add.at(totals, belongs[top[below]], values[below])
        at = cents
        while len(at):
            sums[at] += totals
            on = parent[at] >= 0
            at, totals = parent[at][on], totals[on]
        top[below] = label[below]
        hung = below[parent[below] >= 0]
        parent[hung[cut[parent[hung]]]] = -1
        live = live[~cut[live]]
    return sums


def _finish(rows: DataFrame) -> DataFrame:
    """Whole sums of nodes in small components, whose rows are together and in order; a task takes about ``NODES`` nodes at once."""
    names = ["m", "depth", "sum_leaves", "sum_saved"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def take(held: list[np.ndarray]) -> pa.RecordBatch:
            top, top_depth, depth, m, parent, leaves, saved, sum_leaves, sum_saved = held
            begins = (np.diff(top, prepend=top[0] - 1) != 0) | (np.diff(top_depth, prepend=0) != 0)
            begins[0] = True
            comp = np.cumsum(begins) - 1
            _, name = np.unique(np.concatenate((m, parent)), return_inverse=True)
            wide = len(m) * 2 + 1
            key = lambda d, x: (comp * (LOCAL + 1) + d) * wide + x
            inner = depth - top_depth
            keys = key(inner, name[: len(m)])
            order = np.argsort(keys, kind="stable")
            wanted = key(inner - 1, name[len(m) :])
            at = order[np.minimum(np.searchsorted(keys[order], wanted), len(m) - 1)]
            sums = centroid_sums(np.where(inner > 0, at, -1), np.stack((leaves, saved), 1))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (m, depth, sums[:, 0] + sum_leaves, sums[:, 1] + sum_saved)], names=names)

        held = None
        for batch in batches:
            own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = own if held is None else [np.concatenate(x) for x in zip(held, own, strict=True)]
            if len(held[0]) >= NODES:
                last = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0))
                if len(last):  # the last component may go on in the next batch
                    cut = last[-1] + 1
                    yield take([x[:cut] for x in held])
                    held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield take(held)

    rows = rows.select("top", "top_depth", "depth", "m", F.coalesce("parent", "m").alias("parent"), "leaves", "saved", "sum_leaves", "sum_saved")
    rows = rows.repartition("top", "top_depth").sortWithinPartitions("top", "top_depth", "depth", "m")
    return rows.mapInArrow(run, "m long, depth long, sum_leaves long, sum_saved long")


def roll_up(nodes: DataFrame, places: DataFrame, root: int) -> DataFrame:
    """(m, depth, sum_leaves, sum_saved): sums over subtrees of ``leaves`` and ``saved``, by centroid decomposition."""
    state = _with_sizes(nodes).select(F.lit(root).cast("long").alias("top"), F.lit(0).cast("long").alias("top_depth"), "m", "depth", "parent", "size", "leaves", "saved", *(F.lit(0).cast("long").alias(c) for c in ("sum_leaves", "sum_saved")))
    state = write_shared(state.withColumn("n", F.lit(nodes.count())), "components")
    small, done = [], []
    while state.where(F.col("n") > LOCAL).limit(1).count():
        small.append(state.where(F.col("n") <= LOCAL))
        left, whole = _split(state.where(F.col("n") > LOCAL), places, root)
        done.append(whole)
        state = write_shared(left, "components")
    small.append(state)
    parts = small[0]
    for part in small[1:]:
        parts = parts.unionByName(part)
    found = _finish(parts)
    for part in done:
        found = found.unionByName(part)
    return found


def _end_digests(ends: DataFrame) -> DataFrame:
    """(m, depth, ends_sha256) of nodes where conversations end: of their ids in decimal, ascending, joined by commas."""
    at = sums_before(ends, [F.col("m"), F.col("depth"), F.col("conv")], {"at": F.lit(1).cast("long")}).withColumn("piece", F.floor(F.col("at") / PIECE))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = at.groupBy("m", "depth", "piece").agg(text.alias("text")).repartition("m", "depth").sortWithinPartitions("m", "depth", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for *own, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != node:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["m", "depth", "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())], names=["m", "depth", "ends_sha256"])

    return pieces.select("m", "depth", "text").mapInArrow(run, "m long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv, rank, digest, chars) and all conversations ``convs`` (conv, length); see ``RESULT``."""
    convs = write_shared(convs, "convs")
    root, total = convs.agg(F.min("conv"), F.count(F.lit(1))).first()
    if not total:
        return turns.sparkSession.createDataFrame([], RESULT)
    steps = write_shared(_prefixes(turns), "steps")
    members = write_shared(steps.groupBy("depth", "k0", "k1", "k2").agg(F.min("conv").alias("m"), F.count(F.lit(1)).alias("n_convs"), F.first("chars").alias("chars")), "members")
    places = _places(steps.drop("chars"), members.drop("n_convs", "chars"), root)
    nodes = members.select("m", "depth", "n_convs", "chars").join(places.select(F.col("conv").alias("m"), "depth", F.col("above").alias("parent")), ["m", "depth"])
    top = convs.limit(1).select(F.lit(root).cast("long").alias("m"), F.lit(0).cast("long").alias("depth"), F.lit(total).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("chars"), F.lit(None).cast("long").alias("parent"))
    nodes = write_shared(nodes.unionByName(top), "nodes")
    stretch = nodes.groupBy("m").agg(F.min("depth").alias("lo"), F.max("depth").alias("hi"))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("m"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(stretch, "m").join(children, ["m", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = write_shared(nodes.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")}), "nodes")

    ends = convs.where("length > 0").withColumnRenamed("length", "depth").join(places, ["conv", "depth"]).select("conv", "m", "depth")
    ends = ends.unionByName(convs.where("length = 0").select("conv", F.lit(root).cast("long").alias("m"), F.lit(0).cast("long").alias("depth")))
    summed = roll_up(nodes.select("m", "depth", "parent", "lo", "hi", "leaves", "saved"), places, root)
    found = nodes.join(summed, ["m", "depth"]).join(_end_digests(ends), ["m", "depth"], "left")
    nothing: Column = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(F.col("m").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("sum_leaves").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
