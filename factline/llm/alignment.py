"""Aligning the tokens of two tokenizers, and how often ids are linked over a corpus.

Both tokenizers cut the same bytes; where tokens of both end, a group ends. :func:`diagonal_groups` finds groups by
diagonal run skipping: from the current place in both arrays of ends it compares slices at the current index shift, twice
as long each time, and so jumps over a stretch of one-to-one tokens; the irregular group after it is resolved by advancing
the side that is behind, which updates the shift.

Texts fall into units where a space or a line feed follows something visible. No token of either tokenizer goes on
with one there (:class:`Aligner` refuses others), so both end a token there. Units recur; a worker keeps what is known of them in a
cache of bounded size and aligns the distinct new units of a chunk of texts as one stretch of bytes.

Counts of linked ids are exchanged as packed blocks: a task turns a chunk of texts into (pair, text, times) entries, sorted by pair and cut by
buckets of first ids. Blocks are summed by bucket, which gives each pair's number of texts and whether it is the most of its first id; then
every bucket's blocks meet that table in tasks of at most ``SPREAD`` chunks, and sums of texts go back by chunk. A bucket is
a fixed share of the two vocabularies' pairs, so what a task holds has a bound, and frequent pairs don't gather rows: a chunk has one entry of a pair and text.

Defined results: a null or empty text, and one whose tokens' bytes aren't those of a space and the text, has no tokens (a text with
U+2581 is such a one) and counts zero; special tokens' strings are plain text; rows with null or repeated ids are texts of their own; texts of any length
are aligned whole; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from factline.llm.bpe import PATTERN, ByteBpe
from factline.sources.storage import write_shared

#: Units in each half of a worker's cache, characters and most texts of a chunk, buckets of first ids, and chunks whose blocks of a bucket are in one task.
CACHE, CHUNK, TEXTS, BUCKETS, SPREAD = 1 << 17, 1 << 21, 1 << 16, 64, 1024
#: Characters of a unit from which merges go through a heap.
LONG = 256
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_ODD = re.compile(r"[^\S \n]|[ \n][ \n]|\x01|\x85")
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def diagonal_groups(a: list[int], b: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Groups (i, j, m, n) of two ascending lists of ends whose last ones are equal.

    If m equals n, tokens i to i + m of a and j to j + n of b are m groups of one token each. Else they are a single group,
    of -m tokens of a if m is negative (so many as of b), of m if not.
    """
    i = j = 0
    total = len(a)
    while i < total:
        run, step = 0, 1
        while a[i + run : i + run + step] == b[j + run : j + run + step] and i + run < total:
            run += step
            step *= 2
        while step > 1:  # the probe that failed holds the end of the stretch
            step //= 2
            if a[i + run : i + run + step] == b[j + run : j + run + step] and i + run < total:
                run += step
        if run := min(run, total - i):
            yield i, j, run, run
            i += run
            j += run
            if i == total:
                break
        p, q = i, j
        while (x := a[p]) != (y := b[q]):
            if x < y:
                p += 1
            else:
                q += 1
        m, n = p + 1 - i, q + 1 - j
        yield i, j, -m if m == n else m, n
        i, j = p + 1, q + 1


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each stretch."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Aligner:
    """A byte-level BPE tokenizer (a) and a sentencepiece one (b) that puts a space before a text."""

    def __init__(self, a_path: str, b_path: str):
        self.a = ByteBpe(a_path)
        added = set(self.a.added.values())
        made = [new for _, new in self.a.ranks.values()]  # last merges first
        if any(x <= y for x, y in zip(made, made[1:], strict=False)):
            raise ValueError("ids aren't in the order of merges")
        self.merges = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={t: i for i, t in self.a.bytes.items() if i not in added}, special_tokens={})
        self.decimal = [str(i) for i in range(1 << 17)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        if any("\n" in p or re.search(r"[^\s▁]▁", p) for p in pieces):
            raise ValueError("a piece goes on with white space")
        raw = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        self.b_lengths = np.array([len(x) for x in raw], np.int64)
        self.b_starts = np.cumsum(self.b_lengths) - self.b_lengths
        self.b_letters = np.frombuffer(b"".join(raw), np.uint8)
        self.n_a, self.n_b = len(self.a.lengths), size
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def into_units(self, text: str) -> list[str]:
        if not text:
            return []
        text = " " + text
        if _ODD.search(text):
            return _CUT.split(text)
        return text.replace(" ", "\x01 ").replace("\n", "\x01\n").split("\x01")[1:]

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of units by both tokenizers, and how many of each unit."""
        plain = [u for u in units if len(u) < LONG and not u[-1].isspace()]
        a = self.merges.encode_to_numpy("".join(plain), disallowed_special=()).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, plain)), np.int64, len(plain)))
        places = np.searchsorted(np.cumsum(self.a.lengths[a]), ends) + 1 if len(a) else ends
        n_a = np.diff(places, prepend=0)
        if len(plain) < len(units):  # white space at the end would go with what follows, and long units take long
            odd = [u for u in units if len(u) >= LONG or u[-1].isspace()]
            self.a.learn(set(odd))
            found = iter(np.split(a, places[:-1]) if plain else ())
            each = [np.frombuffer(self.a.known[u][0], np.int32) if len(u) >= LONG or u[-1].isspace() else next(found) for u in units]
            a, n_a = np.concatenate(each).astype(np.int64), np.fromiter(map(len, each), np.int64, len(each))
        second = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        for i, u in enumerate(units):
            if u[0] != " ":  # without the space that is put before texts
                if second[i][0] != self.space:
                    raise ValueError("a unit merged with the space before it")
                second[i] = second[i][1:]
            elif len(u) == 1:
                second[i] = [self.space]
        n_b = np.fromiter(map(len, second), np.int64, len(units))
        return a, n_a, np.fromiter(chain.from_iterable(second), np.int64, int(n_b.sum())), n_b

    def learn(self, units: dict[str, int]) -> list[tuple]:
        """What is known of each unit: n_a, n_b, n_groups, n_links, groups as text, and links as packed pairs; n_a is None if the bytes differ."""
        found = list(map(self.known.get, units))
        gaps = [i for i, x in enumerate(found) if x is None]
        if not gaps:
            return found
        names = list(units)
        for i in gaps:
            found[i] = self.older.get(names[i])
        gaps = [i for i in gaps if found[i] is None]
        for at in range(0, len(gaps), CACHE // 2):
            part = gaps[at : at + CACHE // 2]
            for i, x in zip(part, self._align([names[i] for i in part]), strict=True):
                found[i] = x
        if len(self.known) + len(units) > CACHE:
            self.older, self.known = self.known, {}
        self.known.update((names[i], found[i]) for i in range(min(len(names), CACHE)))
        return found

    def _align(self, fresh: list[str]) -> list[tuple]:
        a, n_a, b, n_b = self.encode_units(fresh)
        raw = list(map(str.encode, fresh))
        sizes = self.b_lengths[b]
        letters = self.b_letters[_spread(self.b_starts[b], sizes)]
        if not np.array_equal(letters, np.frombuffer(b"".join(raw), np.uint8)) or not np.array_equal(np.cumsum(sizes)[np.cumsum(n_b) - 1], np.cumsum(list(map(len, raw)))):
            ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(n_b)))].tolist()
            same = [letters[s:e].tobytes() == r for s, e, r in zip(ends, ends[1:], raw, strict=False)]
            good = iter(self._align([u for u, x in zip(fresh, same, strict=True) if x]) if any(same) else ())
            return [next(good) if x else (None, 0, 0, 0, "", b"") for x in same]
        runs = np.array(list(diagonal_groups(np.cumsum(self.a.lengths[a]).tolist(), np.cumsum(sizes).tolist())), np.int64)
        i, j, m, n = runs.T
        even = m == n
        times = np.where(even, m, 1)
        step = _spread(np.zeros_like(times), times)  # the place in a stretch of one-to-one groups
        a_from, b_from = np.repeat(i, times) + step, np.repeat(j, times) + step
        a_size, b_size = np.where(np.repeat(even, times), 1, np.repeat(np.abs(m), times)), np.where(np.repeat(even, times), 1, np.repeat(n, times))
        links = a_size * b_size
        at = _spread(np.zeros_like(links), links)
        wide = np.repeat(b_size, links)
        pairs = (a[np.repeat(a_from, links) + at // wide] * self.n_b + b[np.repeat(b_from, links) + at % wide]).tobytes()
        # Units begin and end with groups.
        g_ends = np.searchsorted(a_from, np.cumsum(n_a))
        l_ends = np.concatenate(([0], np.cumsum(links)))[g_ends]
        names_a, names_b = list(map(self.decimal.__getitem__, a.tolist())), list(map(self.decimal.__getitem__, b.tolist()))
        words = [
            f"{names_a[s]}|{names_b[t]}" if k == 1 == o else f"{','.join(names_a[s : s + k])}|{','.join(names_b[t : t + o])}"
            for s, t, k, o in zip(a_from.tolist(), b_from.tolist(), a_size.tolist(), b_size.tolist(), strict=True)
        ]
        n_g, n_l = np.diff(g_ends, prepend=0), np.diff(l_ends, prepend=0)
        counts = zip(n_a.tolist(), n_b.tolist(), n_g.tolist(), n_l.tolist(), g_ends.tolist(), l_ends.tolist(), strict=True)
        return [(x, y, g, k, ";".join(words[g_end - g : g_end]), pairs[8 * (l_end - k) : 8 * l_end]) for x, y, g, k, g_end, l_end in counts]

    def align(self, texts: list[str]) -> Aligned:
        return Aligned(self, texts)


class Aligned:
    """A chunk of texts: ``counts`` by name, ``ok`` (texts that have tokens), and distinct units with their places."""

    def __init__(self, aligner: Aligner, texts: list[str]):
        split = list(map(aligner.into_units, texts))
        units = dict.fromkeys(chain.from_iterable(split))
        known = aligner.learn(units)
        units = dict(zip(units, range(len(units)), strict=True))
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        self.of = np.repeat(np.arange(len(texts)), sizes)
        self.unit = np.fromiter(map(units.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        bad = np.array([x[0] is None for x in known], bool)
        self.ok = (sizes > 0) & (np.bincount(self.of, bad[self.unit], len(texts)) == 0) if len(known) else sizes > 0
        self.known, self.sizes, self.n = known, sizes, len(texts)
        self.counts = {}
        for place, name in enumerate(_COUNTS):
            each = np.array([x[place] or 0 for x in known], np.float64)
            self.counts[name] = np.where(self.ok, np.bincount(self.of, each[self.unit] if len(known) else None, len(texts)), 0).astype(np.int64)

    def texts(self) -> list[str]:
        """The groups of each text, as ``a1,a2|b1;a3|b2,b3``."""
        words, unit = [x[4] for x in self.known], self.unit.tolist()
        ends = np.cumsum(self.sizes).tolist()
        return [";".join(map(words.__getitem__, unit[e - s : e])) if ok else "" for s, e, ok in zip(self.sizes.tolist(), ends, self.ok.tolist(), strict=True)]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (pair, text) and how many links of it, sorted by both."""
        keep = self.ok[self.of]
        key, times = np.unique(self.of[keep] * max(len(self.known), 1) + self.unit[keep], return_counts=True)
        text, unit = key // max(len(self.known), 1), key % max(len(self.known), 1)
        links = np.array([x[3] for x in self.known], np.int64)
        pairs = np.frombuffer(b"".join([x[5] for x in self.known]), np.int64)
        each = links[unit]
        pair = pairs[_spread((np.cumsum(links) - links)[unit], each)]
        key = pair * TEXTS + np.repeat(text, each)
        order = np.argsort(key)
        key, weight = key[order], np.repeat(times, each)[order]
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        weight = np.add.reduceat(weight, begins) if len(begins) else weight
        return key[begins] // TEXTS, key[begins] % TEXTS, weight


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[str], pa.Array]]:
    """Texts (the second column), with the first one's values, in chunks of about ``CHUNK`` characters."""
    texts, ids, size = [], [], 0
    for batch in batches:
        own = batch.column(1).to_pylist()
        begin = 0
        for at, text in enumerate(own):
            texts.append(text)
            size += len(text)
            if size >= CHUNK or len(texts) == TEXTS:
                yield texts, pa.concat_arrays([*ids, batch.column(0)[begin : at + 1]])
                texts, ids, size, begin = [], [], 0, at + 1
        if begin < len(own):
            ids.append(batch.column(0)[begin:])
    if texts:
        yield texts, pa.concat_arrays(ids)


def align_texts(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's groups: ``id_col`` and ``groups``, an array of (a, b): the ids of both tokenizers in the group."""
    group = StructType().add("a", ArrayType(IntegerType())).add("b", ArrayType(IntegerType()))
    schema = StructType(df.select(id_col).schema.fields).add("groups", ArrayType(group))
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, ids in _chunks(batches):
            groups = [[dict(zip("ab", ([int(i) for i in side.split(",")] for side in g.split("|")), strict=True)) for g in x.split(";") if g] for x in aligner(a_path, b_path).align(texts).texts()]
            yield pa.RecordBatch.from_arrays([ids, pa.array(groups, kind)], names=schema.names)

    return df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text")).mapInArrow(run, schema)


_LONGS = ("chunk", "place", *_COUNTS)
_PACKED = ("pairs", "runs", "texts", "times")


def _blocks(df: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """Rows of texts (bucket -1) with their chunk and place in it, and blocks of (pair, text, times) by chunk and bucket."""
    id_field = df.select(F.col(id_col).alias("id")).schema.fields[0]
    schema = StructType([id_field]).add("bucket", IntegerType())
    for name in _LONGS:
        schema.add(name, LongType())
    schema.add("groups_sha256", StringType())
    for name in _PACKED:
        schema.add(name, BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        chunk = TaskContext.get().partitionId() << 32
        for texts, ids in _chunks(batches):
            found = own.align(texts)
            n = len(texts)
            nothing = pa.nulls(n, pa.binary())
            digests = pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in found.texts()], pa.string())
            longs = [np.full(n, chunk), np.arange(n), *(found.counts[c] for c in _COUNTS)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(n, -1, np.int32)), *map(pa.array, longs), digests, *[nothing] * 4], names=schema.names)
            pair, text, times = found.entries()
            first, second = pair // own.n_b, pair % own.n_b
            bucket, pair = first % BUCKETS, first // BUCKETS * own.n_b + second
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(BUCKETS + 1)).tolist()
            rows = []
            for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if s < e:
                    at = order[s:e]
                    begins = np.flatnonzero(np.diff(pair[at], prepend=-1))
                    runs = np.diff(np.append(begins, e - s))
                    rows.append((k, pair[at][begins].tobytes(), runs.astype(np.int32).tobytes(), text[at].astype(np.uint16).tobytes(), times[at].astype(np.int32).tobytes()))
            if rows:
                k, *packed = zip(*rows, strict=True)
                m = len(rows)
                longs = [np.full(m, chunk), np.full(m, n), *[np.zeros(m, np.int64)] * 4]
                yield pa.RecordBatch.from_arrays([pa.nulls(m, ids.type), pa.array(k, pa.int32()), *map(pa.array, longs), pa.nulls(m, pa.string()), *(pa.array(x, pa.binary()) for x in packed)], names=schema.names)
            chunk += 1

    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, schema)
    return write_shared(rows, "links", "zstd")


def _added(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    pair = np.concatenate(pairs)
    order = np.argsort(pair, kind="stable")
    begins = np.flatnonzero(np.diff(pair[order], prepend=-1))
    return pair[order][begins], np.add.reduceat(np.concatenate(counts)[order], begins)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pairs and counts by bucket of rows (bucket, pairs, counts as int64) in the order of buckets; what is held is added up whenever it has doubled."""
    bucket, held, size, least = None, ([], []), 0, 1 << 20
    for batch in batches:
        for k, pairs, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != bucket:
                if bucket is not None:
                    yield bucket, *_added(*held)
                bucket, held, size, least = k, ([], []), 0, 1 << 20
            held[0].append(np.frombuffer(pairs, np.int64))
            held[1].append(np.frombuffer(counts, np.int64))
            size += len(held[0][-1])
            if size > least:
                pair, count = _added(*held)
                held, size = ([pair], [count]), len(pair)
                least = max(1 << 20, 2 * size)
    if bucket is not None:
        yield bucket, *_added(*held)


def _pair_counts(blocks: DataFrame, n_b: int) -> DataFrame:
    """(bucket, pairs, counts, best): in how many texts each pair of a bucket is linked, and whether that is the most of its first id."""
    schema = "bucket int, pairs binary, counts binary"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def held() -> Iterator[tuple[int, list, list]]:
            kept: dict[int, tuple[list, list]] = {}
            size = 0
            for batch in batches:
                for k, pairs, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    own = kept.setdefault(k, ([], []))
                    own[0].append(np.frombuffer(pairs, np.int64))
                    own[1].append(np.frombuffer(runs, np.int32).astype(np.int64))
                    size += len(own[0][-1])
                    if size > 1 << 22:
                        yield from ((k, *x) for k, x in kept.items())
                        kept, size = {}, 0
            yield from ((k, *x) for k, x in kept.items())

        for k, pairs, counts in held():
            pair, count = _added(pairs, counts)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pair.tobytes()], pa.binary()), pa.array([count.tobytes()], pa.binary())], names=["bucket", "pairs", "counts"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, pair, count in _sums(batches):
            begins = np.flatnonzero(np.diff(pair // n_b, prepend=-1))
            most = np.maximum.reduceat(count, begins)
            best = count == np.repeat(most, np.diff(np.append(begins, len(pair))))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (pair, count, best))], names=["bucket", "pairs", "counts", "best"])

    parts = blocks.select("bucket", "pairs", "runs").mapInArrow(local, schema).repartition("bucket").sortWithinPartitions("bucket")
    return parts.mapInArrow(whole, schema + ", best binary")


def link_votes(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: its id, n_a, n_b, n_groups, n_links, n_best (links whose pair of ids is linked in most texts of all pairs of that
    first id), count_sum (over links: the texts in which their pair is linked), and groups_sha256 (of the groups as text; empty without tokens)."""
    table = _blocks(df, a_path, b_path, id_col, text_col)
    blocks = table.where("bucket >= 0")
    counts = write_shared(_pair_counts(blocks, sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()), "pair_counts")
    chunks = table.agg(F.count_distinct("chunk")).first()[0]
    spread = -(-max(chunks, 1) // SPREAD)
    salt = F.pmod(F.xxhash64("chunk"), F.lit(spread)).cast("int")
    known = counts.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("salt"), F.lit(-1).cast("long").alias("chunk"), F.lit(0).cast("long").alias("place"), "pairs", F.col("counts").alias("runs"), F.col("best").alias("texts"), F.lit(None).cast("binary").alias("times"))
    rows = known.unionByName(blocks.select("bucket", salt.alias("salt"), "chunk", "place", *_PACKED))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = count = best = None
        for batch in batches:
            out = []
            for chunk, n, pairs, runs, texts, times in zip(*(batch.column(c).to_pylist() for c in ("chunk", "place", *_PACKED)), strict=True):
                if chunk < 0:
                    pair, count, best = np.frombuffer(pairs, np.int64), np.frombuffer(runs, np.int64), np.frombuffer(texts, bool)
                    continue
                at = np.repeat(np.searchsorted(pair, np.frombuffer(pairs, np.int64)), np.frombuffer(runs, np.int32))
                text, weight = np.frombuffer(texts, np.uint16), np.frombuffer(times, np.int32)
                sums = [np.bincount(text, weight * x, n).astype(np.int64).tobytes() for x in (best[at], count[at])]
                out.append((chunk, *sums))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "n_best", "count_sum"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["chunk", "place", "n_best", "count_sum"]
        chunk, held = None, None
        emit = lambda: pa.RecordBatch.from_arrays([pa.array(np.full(len(held[0]), chunk)), pa.array(np.arange(len(held[0]))), *map(pa.array, held)], names=names)
        for batch in batches:
            for k, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = [np.frombuffer(x, np.int64) for x in packed]
                if k != chunk:
                    if chunk is not None:
                        yield emit()
                    chunk, held = k, own
                else:
                    held = [x + y for x, y in zip(held, own, strict=True)]
        if chunk is not None:
            yield emit()

    sums = rows.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "chunk").mapInArrow(look_up, "chunk long, n_best binary, count_sum binary")
    sums = sums.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk long, place long, n_best long, count_sum long")
    texts = table.where("bucket < 0").select("id", "chunk", "place", *_COUNTS, "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return texts.join(sums, ["chunk", "place"], "left").select(F.col("id").alias(id_col), *_COUNTS, zero("n_best"), zero("count_sum"), "groups_sha256")
