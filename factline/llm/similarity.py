"""Links of near duplicates that hold by the exact Jaccard index, from candidate links of sketches.

Candidates are edges that connect what sketches within a radius connect; a true link may be missing among them where others
stand for it. So they are checked in two steps, and nothing is decided by an estimate. First the index of every candidate edge is taken, and edges
that hold make components. Then groups of candidates with an edge that doesn't hold are gone through: all their pairs within the radius that
are still in different components are compared, a link that holds joins two. A group's rows are cut into chunks in the order of their
components; two chunks of one and the same component aren't compared, so a large group of copies costs a pass for each chunk of what else
is in it, not for each pair of its own chunks.

A set of shingles is their distinct hashes of 32 bits, so that the index of texts with n shingles is off by about n / 2^33 at most; a
text without words has an empty set, which is like another empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from factline.llm.components import connected_components
from factline.llm.mixing import sums_before
from factline.sources.storage import write_shared

#: The least index of a link, nodes of a chunk, rows of which a task compares pairs at once, and rows that are sent to all tasks at most.
LEAST, CHUNK, ROWS, BROADCAST = 0.8, 2048, 64, 1 << 20


def similar(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    """Whether two sorted sets have a Jaccard index of ``least`` or more."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= least * (len(a) + len(b) - common) - 1e-9


def _held(least: float) -> Callable:
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similar(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), least) for x, y in zip(a, b, strict=True)], dtype=bool)

    return pandas_udf(run, "boolean")


class _Groups:
    """Labels that are joined, within one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> None:
        self.up[x] = y


def _settle(radius: int, least: float, words: int) -> Callable:
    """Edges of links that join components, of rows (i, j, root, side, node, label, set, words of the fingerprint) in the order of the first three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        unit = None

        def pairs() -> pa.RecordBatch:
            side, node, label = (np.array([r[k] for r in held], np.int64) for k in (3, 4, 5))
            sets = [np.frombuffer(r[6], np.uint32) for r in held]
            fps = np.array([r[7:] for r in held], np.int64).view(np.uint64).reshape(len(held), words)
            stored, found, groups = np.flatnonzero(side != 0), [], _Groups()
            asked = np.flatnonzero(side != 1)
            for at in range(0, len(asked), ROWS):
                own = asked[at : at + ROWS]
                apart = np.bitwise_count(fps[own][:, None, :] ^ fps[stored][None, :, :]).sum(axis=2, dtype=np.int64)
                near = (apart <= radius) & (label[own][:, None] != label[stored][None, :])
                for q, s in zip(*np.nonzero(near), strict=True):
                    a, b = own[q], stored[s]
                    x, y = groups.find(int(label[a])), groups.find(int(label[b]))
                    if x != y and similar(sets[a], sets[b], least):
                        groups.join(x, y)
                        found.append((int(node[a]), int(node[b])))
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != unit:
                    if len(held) > 1:
                        yield pairs()
                    held, unit = [], row[:3]
                held.append(row)
        if len(held) > 1:
            yield pairs()

    return run


def shingle_sets(df: DataFrame, key: list[Column], wanted: DataFrame, digest: Callable) -> DataFrame:
    """(node, set) of the rows of ``wanted`` (k1, k2, node), from the texts of ``df``: columns k1, k2 and text in UTF-8 by ``key``."""
    few = wanted.count() <= BROADCAST
    rows = df.select(*key).join(F.broadcast(wanted) if few else wanted, ["k1", "k2"]).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([digest(x.as_py()).tobytes() for x in batch.column(1)], pa.binary())], names=["node", "set"])

    return rows.mapInArrow(run, "node long, set binary").groupBy("node").agg(F.first("set").alias("set"))  # rows may repeat


def verified_components(edges: DataFrame, nodes: DataFrame, sets: Callable[[DataFrame], DataFrame], words: list[str], radius: int, least: float = LEAST, chunk: int = CHUNK) -> DataFrame:
    """(node, root) of the nodes that links of an index of ``least`` or more connect.

    ``edges`` (a, b) are candidates, ``nodes`` has node and the fingerprint's ``words``, and ``sets`` gives (node, set) of the nodes of a table.
    """
    edges = write_shared(edges.select("a", "b").distinct(), "candidates")
    known = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    known = write_shared(sets(known), "shingles")
    side = lambda c: known.select(F.col("node").alias(c), F.col("set").alias(f"{c}_set"))
    judged = edges.join(side("a"), "a").join(side("b"), "b").select("a", "b", _held(least)("a_set", "b_set").alias("holds"))
    judged = write_shared(judged, "judged")
    held = judged.where("holds").select("a", "b")
    if judged.where("NOT holds").limit(1).count() == 0:
        return connected_components(held)
    loose = connected_components(edges)
    labels = connected_components(held).withColumnRenamed("root", "label")
    open_ = loose.join(judged.where("NOT holds").select(F.col("a").alias("node")), "node", "left_semi").select("root").distinct()
    members = loose.join(open_, "root").join(labels, "node", "left").select("root", "node", F.coalesce("label", "node").alias("label"))
    placed = sums_before(members, [F.col("root"), F.col("label"), F.col("node")], {"at": F.lit(1).cast("long")})
    placed = write_shared(placed.select("root", "node", "label", F.floor(F.col("at") / chunk).alias("chunk")), "members")
    chunks = placed.groupBy("root", "chunk").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    one, two = (chunks.select("root", F.col("chunk").alias(c), F.col("lo").alias(f"lo{c}"), F.col("hi").alias(f"hi{c}")) for c in "ij")
    units = one.join(two, "root").where("i <= j AND NOT (loi = hij)").select("root", "i", "j")  # labels ascend with chunks: equal ends are one label
    first = placed.join(units.withColumn("chunk", F.col("i")), ["root", "chunk"]).withColumn("side", F.when(F.col("i") == F.col("j"), 2).otherwise(0))
    second = placed.join(units.where("i < j").withColumn("chunk", F.col("j")), ["root", "chunk"]).withColumn("side", F.lit(1))
    rows = first.unionByName(second).join(known, "node").join(nodes, "node").select("i", "j", "root", "side", "node", "label", "set", *words)
    rows = rows.repartition("i", "j", "root").sortWithinPartitions("i", "j", "root")
    more = write_shared(rows.mapInArrow(_settle(radius, least, len(words)), "a long, b long"), "more-links")
    return connected_components(held.unionByName(more))
