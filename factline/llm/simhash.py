"""Near-duplicate detection with SimHash fingerprints, compared bit-sliced.

Fingerprints that differ in at most ``radius`` of 64 bits link. The bits are cut into ``blocks`` runs; two
linked fingerprints agree in at least ``blocks - radius`` of them, so each choice of that many runs is a key
and a link shows under one key at least: no link is lost. Equal fingerprints are one row from the start.

Under a key, fingerprints are stored as bit planes: word ``w`` of plane ``p`` holds bit ``p`` of 64
fingerprints. One query updates 64 distances at once with carry-save counters (three planes of counts and a
sticky overflow), and a word is abandoned as soon as all its distances exceed the radius. Only a spanning
forest of the links found leaves a task, so a group of copies gives as many edges as members, not pairs.
Keys with over ``chunk`` fingerprints are cut into chunks, and each pair of chunks is a unit of its own.

:func:`drop_near_duplicates` is for a similarity: texts whose sets of five-word shingles have a Jaccard index of 0.8 or
more. Such texts differ in about a seventh of their bits, too many for runs of 64 bits as keys. So fingerprints have
256 bits there, texts are compared if they share one of ``KEYS`` pairs of least shingle hashes (0.998 of texts at 0.8 do),
and those within ``WIDE_RADIUS`` bits are candidates. Comparison is the same, over more planes. The radius is that of an index of about 0.7, four
deviations of the estimate from 0.8; whether a candidate links is decided by the exact index (:mod:`factline.llm.similarity`).

Defined results: null texts are empty; a text without words has fingerprint zero and links like any other;
null ids count as no id for the smallest id of a component; repeated rows give repeated results, and one of them
stays; an empty table gives an empty result; other columns of the input may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType, StructType

from factline.llm.components import connected_components
from factline.llm.similarity import shingle_sets, verified_components
from factline.sources.storage import write_shared

SHINGLE, RADIUS, SEED = 4, 4, 42
#: For a similarity of 0.8: words of a shingle, words of a fingerprint, bits within which texts are candidates, and keys.
WIDE_SHINGLE, WIDE_WORDS, WIDE_RADIUS, KEYS = 5, 4, 58, 6
#: Fingerprints of a unit of comparison, and expected fingerprints of a key beyond which keys get longer.
CHUNK, PER_KEY = 4096, 512
#: Shingles whose bits are counted, words of planes that are compared, and rows that are gathered at once.
_PIECE, _WORDS, _ROWS = 1 << 15, 1 << 16, 1 << 15


def shingle_hashes(data: bytes, shingle: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text in UTF-8, in pieces; of all words if there are fewer, none without words."""
    words = data.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        yield np.array([digest(joined, seed)], np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    for at in range(0, len(starts), _PIECE):
        yield np.array([digest(joined[a:b], seed) for a, b in zip(starts[at : at + _PIECE], ends[at : at + _PIECE], strict=True)], np.uint64)


def _ones(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint_of(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint of a text in UTF-8: a bit is 1 if over half the shingles' XXH64 have it."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(data, shingle, seed):
        ones += _ones(hashes)
        n += len(hashes)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _remixed(hashes: np.ndarray, number: int) -> np.ndarray:
    """Another hash of each."""
    x = hashes + np.uint64((number + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def wide_sketch(data: bytes, shingle: int = WIDE_SHINGLE, words: int = WIDE_WORDS, keys: int = KEYS) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint words of the set of a text's shingles, and its keys: hashes of pairs of least hashes."""
    ones, least, n = np.zeros((words, 64), np.int64), np.full(2 * keys, ~np.uint64(0)), 0
    pieces = [np.unique(h) for h in shingle_hashes(data, shingle)]
    for hashes in pieces if len(pieces) < 2 else [np.unique(np.concatenate(pieces))]:
        n = len(hashes)
        mixed = [_remixed(hashes, i) for i in range(max(words, 2 * keys))]
        for i in range(words):
            for at in range(0, n, _PIECE):
                ones[i] += _ones(mixed[i][at : at + _PIECE])
        least = np.array([mixed[i].min() for i in range(2 * keys)])
    fingerprint = np.packbits(ones * 2 > n, axis=1, bitorder="little").view(np.uint64).ravel()
    return fingerprint, _remixed(least[::2] ^ _remixed(least[1::2], 1), 2)


def shingle_set(data: bytes, shingle: int = WIDE_SHINGLE) -> np.ndarray:
    """Sorted distinct hashes, of 32 bits, of a text's shingles."""
    pieces = [np.unique((h >> np.uint64(32)).astype(np.uint32)) for h in shingle_hashes(data, shingle)]
    return np.unique(np.concatenate(pieces)) if pieces else np.zeros(0, np.uint32)


@pandas_udf(LongType())
def simhash(text: pd.Series) -> pd.Series:
    """Fingerprint, as a signed long, of a binary column of UTF-8 text."""
    return pd.Series(np.fromiter(map(fingerprint_of, text), np.uint64, len(text)).view(np.int64))


def _exceeds(counts: list, over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count, in bit planes and the overflow, is above the radius."""
    above, equal = over.copy(), np.full_like(over, ~np.uint64(0))
    for bit in range(len(counts) - 1, -1, -1):
        if radius >> bit & 1:
            equal &= counts[bit]
        else:
            above |= equal & counts[bit]
            equal &= ~counts[bit]
    return above


def _planes(lanes: np.ndarray) -> np.ndarray:
    """(bits, words) bit planes of fingerprints given as (words, 64, words of a fingerprint)."""
    bits = np.unpackbits(lanes.view(np.uint8).reshape(len(lanes), 64, -1), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64).reshape(bits.shape[2], -1)


def _links(planes, valid, fps, query, word, radius):
    """Positions in ``query`` and lanes (64 * word + bit) of fingerprints within the radius."""
    counts = [np.zeros(len(query), np.uint64) for _ in range(radius.bit_length())]
    over = np.zeros(len(query), np.uint64)
    if not len(query):
        return query, query
    values, alive, at = fps[query], np.arange(len(query)), word
    for plane in range(len(planes)):
        rest = planes[plane][at] ^ (np.uint64(0) - (values[:, plane // 64] >> np.uint64(plane % 64) & np.uint64(1)))
        for count in counts:
            carry = count & rest
            count ^= rest
            rest = carry
        over |= rest
        if plane % 6 == 5 or plane == len(planes) - 1:
            near = ~_exceeds(counts, over, radius) & valid[at]
            keep = np.flatnonzero(near)
            if len(keep) < len(at):
                counts, over = [c[keep] for c in counts], over[keep]
                values, alive, at, near = values[keep], alive[keep], at[keep], near[keep]
            if not len(at):
                return alive, alive
    row, lane = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return query[alive[row]], at[row] * 64 + lane


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels, each a root, after links a-b have been added."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label != (up := label[label])).any():
            label = up


def spanning_edges(group: np.ndarray, fps: np.ndarray, side: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (pairs of rows) of a spanning forest of the links within each group.

    ``group`` is sorted, ``fps`` has a column for each word of a fingerprint. A row of side 0 is compared with rows of side 1 of its group, one of side 2 with all of side 2.
    """
    label = np.arange(len(fps))
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    number = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(fps))))
    stored = np.flatnonzero(side != 0)
    sizes = np.bincount(number[stored], minlength=len(starts))
    words = -(-sizes // 64)
    first = np.cumsum(words) - words
    asked = np.flatnonzero((side != 1) & (words[number] > 0))
    # All rows meet the first word of their group. In what is left, words are filled by component, and a row skips a
    # word that its own component fills: a group of near copies takes one pass, not one for each word. Groups of one
    # word are done after the first pass.
    for rest in (False, True):
        if rest:
            more = words > 1
            stored, asked = stored[more[number[stored]]], asked[more[number[asked]]]
            sizes, words = sizes * more, words * more
            first = np.cumsum(words) - words
        stored = stored[np.lexsort((label[stored], number[stored]))]
        slot = first[number[stored]] * 64 + np.arange(len(stored)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        lanes, owner = np.zeros((words.sum() * 64, fps.shape[1]), np.uint64), np.full(words.sum() * 64, -1)
        lanes[slot], owner[slot] = fps[stored], stored
        blocks = lanes.reshape(-1, 64, fps.shape[1])
        planes = np.concatenate([_planes(blocks[at : at + 4096]) for at in range(0, len(blocks), 4096)] or [np.zeros((64 * fps.shape[1], 0), np.uint64)], axis=1)
        valid = np.packbits((owner >= 0).reshape(-1, 64), axis=1, bitorder="little").view(np.uint64).ravel()
        of = np.where(owner >= 0, label[owner], label[np.maximum(owner.reshape(-1, 64)[:, :1], 0)].repeat(64)).reshape(-1, 64)
        filled = np.where((of == of[:, :1]).all(axis=1), of[:, 0], -1)
        each = words[number[asked]] if rest else np.ones(len(asked), np.int64)
        ends = np.cumsum(each)
        at = 0
        while at < len(asked):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _WORDS, "right")))
            n = each[at:to]
            query = np.repeat(asked[at:to], n)
            word = np.repeat(first[number[asked[at:to]]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            apart = filled[word] != label[query]
            q, lane = _links(planes, valid, fps, query[apart], word[apart], radius)
            label = _unite(label, q, owner[lane])
            at = to
    child = np.flatnonzero(label != np.arange(len(label)))
    return child, label[child]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        rows = 0

        def flush(last: bool):
            nonlocal held, rows
            table = [np.concatenate(x) for x in zip(*held, strict=True)]
            combo, key, i, j, side, node, *fp = table
            change = (combo[1:] != combo[:-1]) | (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            group = np.concatenate(([0], np.cumsum(change)))
            end = len(group) if last else int(np.searchsorted(group, group[-1]))
            held, rows = [[x[end:] for x in table]], len(group) - end
            own = np.flatnonzero(np.bincount(group[:end])[group[:end]] > 1) if end else group[:0]  # a row that is alone under its key takes no lanes
            if len(own):
                node = node[own]
                a, b = spanning_edges(group[own], np.stack([f[own].view(np.uint64) for f in fp], axis=1), side[own], radius)
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

        for batch in batches:
            held.append([np.array(c) for c in batch.columns])
            rows += len(batch)
            if rows >= _ROWS:
                yield from flush(False)
        if rows:
            yield from flush(True)

    return run


def masks(blocks: int, radius: int) -> list[int]:
    """The bits of each key: every choice of ``blocks - radius`` of the runs."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    runs = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(runs, blocks - radius)]


def blocks_for(n: int, radius: int = RADIUS, per_key: int = PER_KEY) -> int:
    """Fewest runs for which ``n`` evenly spread fingerprints put at most ``per_key`` under a key."""
    blocks = radius + 1
    while n > per_key * 2 ** (64 * (blocks - radius) // blocks):
        blocks += 1
    return blocks


def link_fingerprints(fps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) that connect exactly what links within ``radius`` connect. ``fps``: distinct longs ``fp``."""
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(blocks_for(fps.count(), radius), radius)]
    keys = F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in signed))).alias("combo", "key")
    return link_under_keys(fps.select(keys, F.col("fp").alias("node"), "fp"), ["fp"], radius, chunk)


def link_under_keys(keyed: DataFrame, words: list[str], radius: int, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) that connect what links within ``radius`` under a key connect. ``keyed``: combo, key, node, and the columns ``words`` of fingerprints."""
    large = keyed.groupBy("combo", "key").count().where(F.col("count") > chunk)
    large = write_shared(large.select("combo", "key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")), "large-keys")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    other = F.explode(F.expr("sequence(0, coalesce(chunks, 1) - 1)"))
    units = keyed.join(large, ["combo", "key"], "left").withColumn("own", F.coalesce(own, F.lit(0))).withColumn("other", other)
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    unit = ["combo", "key", "i", "j"]
    units = units.select("combo", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "node", *words)
    return units.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(_compare(radius), "a long, b long").distinct()


def component_of_fingerprints(docs: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(fp, root, component_id) from rows (id, fp): the least fingerprint and the smallest id of each one's component."""
    fps = write_shared(docs.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    roots = connected_components(link_fingerprints(fps.select("fp"), radius, chunk))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``df``: ``id_col``, fingerprint (16 hex digits), component_id."""
    docs = write_shared(df.select(F.col(id_col).alias("id"), _of(text_col).alias("fp")), "document-fingerprints")
    found = docs.join(component_of_fingerprints(docs, radius, chunk), "fp")
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _sketches(df: DataFrame, id_col: str, text_col: str, shingle: int, words: int, keys: int) -> DataFrame:
    """(id, k1, k2, keys, f0, f1, ...): hashes of a row's id and text, keys, and words of the fingerprint."""

    rows = df.select(F.col(id_col).alias("id"), *_row_keys(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    names = [*(f"f{i}" for i in range(words)), "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wide_sketch(x.as_py(), shingle, words, keys) for x in batch.column(3)]
            fps = np.array([f for f, _ in found], np.uint64).reshape(len(found), words).view(np.int64)
            held = pa.array(np.array([k for _, k in found], np.uint64).view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * keys), held)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(fps[:, i].copy()) for i in range(words)), lists], names=["id", "k1", "k2", *names])

    schema = StructType(rows.select("id", "k1", "k2").schema.fields)
    for name in names[:-1]:
        schema.add(name, LongType())
    return rows.mapInArrow(run, schema.add("keys", ArrayType(LongType())))


def _row_keys(id_col: str, text_col: str) -> list:
    return [F.xxhash64(F.lit(i), F.col(id_col), F.col(text_col).isNull(), F.col(text_col)).alias(f"k{i}") for i in (1, 2)]


def similar_components(sketches: DataFrame, sets, words: int = WIDE_WORDS, radius: int = WIDE_RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(node, root) of the fingerprints that link with another; ``node`` is a hash of the fingerprint, and ``sets`` gives shingle sets of (k1, k2, node)."""
    columns = [f"f{i}" for i in range(words)]
    # Equal fingerprints have equal nodes; they meet under a key only if they share one, so all keys of one row stand for them.
    nodes = write_shared(sketches.groupBy("node", *columns).agg(F.min_by(F.struct("k1", "k2", "keys"), F.struct("k1", "k2")).alias("r")).select("node", *columns, "r.*"), "nodes")
    keyed = nodes.select("node", *columns, F.posexplode("keys").alias("combo", "key"))
    own = lambda some: sets(nodes.join(some, "node", "left_semi").select("k1", "k2", "node"))
    return verified_components(link_under_keys(keyed, columns, radius, chunk), nodes.select("node", *columns), own, columns, radius, chunk=min(chunk, 2048))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = WIDE_SHINGLE, words: int = WIDE_WORDS, radius: int = WIDE_RADIUS, keys: int = KEYS, chunk: int = CHUNK) -> DataFrame:
    """The row with the smallest id of each group of similar texts, with the columns of ``df``.

    What goes is decided on hashes of rows; texts are read again and meet only the hashes of rows that go.
    """
    node = F.xxhash64(*(f"f{i}" for i in range(words))).alias("node")
    rows = write_shared(_sketches(df, id_col, text_col, shingle, words, keys).select("*", node), "sketches")
    text = [*_row_keys(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")]
    sets = lambda wanted: shingle_sets(df, text, wanted, lambda data: shingle_set(data, shingle))
    roots = write_shared(similar_components(rows, sets, words, radius, chunk), "roots")
    grouped = rows.select("id", "k1", "k2", "node").join(roots, "node", "left").select("id", "k1", "k2", F.coalesce("root", "node").alias("root"))
    best = grouped.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")).alias("best"))
    marked = grouped.join(best, "root").withColumn("stays", (F.col("k1") == F.col("best.k1")) & (F.col("k2") == F.col("best.k2")))
    gone = write_shared(marked.where("NOT stays").select("k1", "k2").distinct(), "gone")
    keyed = df.select(F.struct("*").alias("row"), *_row_keys(id_col, text_col))
    left = keyed.join(gone, ["k1", "k2"], "left_anti")
    if not marked.where("stays").groupBy("k1", "k2").count().where("count > 1").isEmpty():  # rows that repeat id and text
        order = Window.partitionBy("k1", "k2").orderBy("k1")
        left = left.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    return left.select("row.*")


def _of(text_col: str):
    return simhash(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
