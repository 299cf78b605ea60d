"""Language-model scores from a probabilistic suffix tree over words.

Tokens are white-space words, ASCII lower-cased, and an end of text. A context of one word is a candidate if it
occurs ``LEAST_CONTEXT`` times, whatever the corpus's size; a longer one if it occurs ``LEAST_LONGER`` times, its suffix
(all but its first word) is in the tree and all but its last word was a candidate. A next symbol counts if it
follows ``LEAST_PAIR`` times, counts after the suffix too, and does so by ``LEAST_SURPRISE`` more or less often than the
suffix makes expected (the deviance of a Poisson count). A
candidate stays if the divergence of its next-symbol distribution from its suffix's, times its count, exceeds a
penalty for its parameters. The tree grows by a word until no candidate of a length stays; no depth is set.
Counts are smoothed by the suffix's distribution, which weighs as much as there are symbols; symbols that don't count
share what is left in the suffix's proportions, down to the unigram with half a count for each word. So probabilities
sum to one, and a context that behaves as its suffix gets the suffix's distribution. A text's state at each place is
its longest suffix in the tree.

The tree is a table in the shared folder, keyed by 64-bit hashes of word sequences, and is never in one place. A
sequence of words has one weight: of its words but the last as a state, of what the last one gains over the next
shorter state, and of itself as a state that its next symbol may not be known in. A text's score is the sum of the
weights of all its sequences, so it is scored by a join.

Texts are tokenised once, to a table of their words' hashes. From contexts of three words on, only the parts of texts
around a candidate are read, as longer sequences that count hold one. What tasks count or look up then goes to buckets by
hash, as one block of packed numbers per task and bucket instead of rows; the number of buckets follows the corpus, so
a bucket fits a worker. Sequences that make up at least ``min_word`` of the tokens, at most 1 / min_word of each
length, are broadcast for scoring, so that no bucket is hot. Bit filters, of a size that follows their keys up to a
bound, keep most sequences that a table lacks out of shuffles. Neither has an effect on results.

Defined results: a null text is empty, with one token, the end; null ids are learned from; without training
texts every token has probability one; repeated rows are scored each; an empty table gives an empty result; ids keep
their type; texts of any length are read in pieces; other columns aren't looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from factline.sources.storage import release_table, write_shared

#: Occurrences from which a context of one word, one of more words, and a next symbol count, whatever the corpus's size.
LEAST_CONTEXT, LEAST_LONGER, LEAST_PAIR = 2, 8, 2
#: Nats by which a next symbol's number differs, at least, from what the suffix makes expected.
LEAST_SURPRISE = 4.0
#: Share of the tokens from which a sequence is broadcast for scoring.
MIN_WORD = 5e-7
#: Least and most bits of a filter, as powers of two.
_BITS = 16, 27
#: Tokens for each bucket, tokens that are read at once, sequences that a task holds, and bytes that are split at once.
_BUCKET, _TOKENS, _HELD, _PIECE = 1 << 20, 1 << 19, 1 << 21, 1 << 22
_GAP = re.compile(rb"[\x20\t-\r]")
#: Bytes from which a word is long, and masks of the first bytes of eight.
_LONG_WORD, _MASKS = 128, np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_BLOCK = "bucket int, kind int, data binary"


def held_out(id_col: str = "doc_id"):
    """Texts that aren't learned from: CRC-32 of the id as text leaves 1 modulo 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _mixed(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    x = before * np.uint64(0x9E3779B97F4A7C15) + words
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ x >> np.uint64(31)


#: The hash of the end of a text, an empty word.
_END = _mixed(np.ones(1, np.uint64), np.zeros(1, np.uint64))[0]


def _hashed(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of the words of each text: of their lengths and their bytes, eight at a time for all words; long words one by one."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words = lists.flatten()
    begins = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
    sizes, begins, end = np.diff(begins), begins[:-1], int(begins[-1])
    data = np.zeros(end + 8, np.uint8)
    if end:
        data[:end] = np.frombuffer(words.buffers()[2], np.uint8, end)
    eights = np.ndarray(end + 1, "<u8", data, strides=(1,))
    hashes = _mixed((sizes + 1).astype(np.uint64), eights[begins] & _MASKS[np.minimum(sizes, 8)])
    at, done = np.flatnonzero((sizes > 8) & (sizes <= _LONG_WORD)), 8
    while len(at):
        hashes[at] = _mixed(hashes[at], eights[begins[at] + done] & _MASKS[np.minimum(sizes[at] - done, 8)])
        done += 8
        at = at[sizes[at] > done]
    for i in np.flatnonzero(sizes > _LONG_WORD).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[begins[i] : begins[i] + sizes[i]])
    own = np.split(hashes, np.cumsum(pc.list_value_length(lists).to_numpy())[:-1])
    return [x[x != _END] for x in own]  # white space at an edge makes an empty word


def token_hashes(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of the words of texts in UTF-8, as binary, and of the end of each."""
    if len(texts) > 1:
        return [np.append(x, _END) for x in _hashed(texts)]
    data, parts, at = texts[0].as_py(), [], 0
    while at < len(data):
        gap = _GAP.search(data, min(at + _PIECE, len(data)))
        to = gap.start() if gap else len(data)
        parts += _hashed(pa.array([data[at:to]], pa.binary()))
        at = to
    return [np.append(np.concatenate(parts) if parts else np.zeros(0, np.uint64), _END)]


def _tokenise(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            ends, at = np.cumsum(pc.binary_length(batch.column(2)).to_numpy().astype(np.int64)), 0
            while at < len(batch):
                begin, at = at, max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PIECE, "right")))
                held = token_hashes(batch.column(2).slice(begin, at - begin))
                own = [batch.column(c).slice(begin, len(held)) for c in (0, 1)]
                sizes, data = pa.array([len(x) for x in held]), pa.array([x.tobytes() for x in held], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + len(held))), *own, sizes, data], names=names)
                uid += len(held)

    return run


def _chunks(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[tuple]:
    """(uids, tokens of each, all words, their places in the texts, how many of them only lead in), some texts at a time.

    A long text comes in parts, each after the ``reach`` words before it.
    """
    for batch in batches:
        uids, data = batch.column(0).to_numpy(), batch.column(1)
        sizes = pc.binary_length(data).to_numpy(zero_copy_only=False).astype(np.int64) // 8
        ends, at = np.cumsum(sizes), 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _TOKENS, "right")))
            words = np.frombuffer(b"".join(data.slice(at, to - at).to_pylist()), np.uint64)
            if to == at + 1:
                for begin in range(0, len(words), _TOKENS):
                    lead = min(begin, reach)
                    part = words[begin - lead : begin + _TOKENS]
                    yield uids[at:to], np.array([len(part)]), part, np.arange(begin - lead, begin - lead + len(part)), lead
            else:
                place = np.arange(len(words)) - np.repeat(ends[at:to] - sizes[at:to] - (ends[at - 1] if at else 0), sizes[at:to])
                yield uids[at:to], sizes[at:to], words, place, 0
            at = to


def _longer(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of the sequences, longer by a word, that end at each place."""
    x = np.zeros_like(words)
    x[1:] = hashes[:-1]
    return _mixed(x, words)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _blocks(bucket: np.ndarray, columns: list[np.ndarray], kind: int, first: np.ndarray | None = None) -> pa.RecordBatch:
    """A row for each run of equal ``bucket`` numbers (they begin at ``first``), with its part of all columns as bytes."""
    first = _runs(bucket) if first is None else first
    ends = np.append(first, len(bucket))[1:]
    data = [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int32)), pa.array(np.full(len(first), kind, np.int32)), pa.array(data, pa.binary())], names=["bucket", "kind", "data"])


def _unpacked(data: bytes, types: tuple[str, ...]) -> list[np.ndarray]:
    kinds = [np.dtype(t) for t in types]
    n = len(data) // sum(t.itemsize for t in kinds)
    at = np.cumsum([0] + [n * t.itemsize for t in kinds]).tolist()
    return [np.frombuffer(data, t, n, a) for t, a in zip(kinds, at, strict=False)]


def _by_bucket(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("bucket").sortWithinPartitions("bucket", "kind")


def _order(keys: np.ndarray) -> np.ndarray:
    """An order of hashes, or of numbers in the highest bits. Numbers with places in their lowest bits sort several times faster than places do."""
    bits = np.uint64(len(keys).bit_length())
    x = keys >> bits << bits | np.arange(len(keys), dtype=np.uint64)
    x.sort()
    order = (x & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    found = keys[order]
    return np.argsort(keys) if (found[1:] < found[:-1]).any() else order


class Places:
    """Where distinct hashes are in ``keys``. Each has a slot in a table; those whose slot another one took have one in the next table."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.tables = keys, []
        rest = np.arange(len(keys), dtype=np.int32)
        while len(rest):
            table = np.full(1 << (2 * len(rest)).bit_length() + len(self.tables), -1, np.int32)
            slot = self._slot(keys[rest], len(self.tables), table)
            table[slot] = rest
            self.tables.append(table)
            rest = rest[table[slot] != rest]

    @staticmethod
    def _slot(hashes: np.ndarray, turn: int, table: np.ndarray) -> np.ndarray:
        return hashes * np.uint64(0x9E3779B97F4A7C15 + 2 * turn * 0x61C8864F) >> np.uint64(65 - len(table).bit_length())

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Places of ``wanted``, or -1."""
        out = np.full(len(wanted), -1)
        rest = slice(None)
        for turn, table in enumerate(self.tables):
            at = table[self._slot(wanted[rest], turn, table)]
            same = self.keys[at] == wanted[rest]
            out[rest] = np.where(same, at, -1)
            rest = np.arange(len(wanted))[rest][~same & (at >= 0)]
        return out


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


def _filter(keys: DataFrame) -> np.ndarray:
    """64-bit words of a filter of the longs ``h``: a key sets the bit that its lowest bits name."""
    bits = min(max((16 * keys.count()).bit_length(), _BITS[0]), _BITS[1])
    part = max(bits - 20, 0)

    def positions(batches):
        for batch in batches:
            at = np.unique(batch.column(0).to_numpy().view(np.uint64) & np.uint64((1 << bits) - 1))
            if len(at):
                yield _blocks((at >> np.uint64(bits - part)).astype(np.int32), [at.astype(np.uint32)], 0)

    def words(batches):
        held: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = held.setdefault(row["bucket"], np.zeros(1 << bits - part - 6, np.uint64))
                at = np.frombuffer(row["data"], np.uint32).astype(np.uint64) & np.uint64((1 << bits - part) - 1)
                np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        yield pa.RecordBatch.from_arrays([pa.array([*held], pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["bucket", "data"])

    found = keys.select("h").mapInArrow(positions, _BLOCK).repartition("bucket").mapInArrow(words, "bucket int, data binary").collect()
    out = np.zeros(1 << bits - 6, np.uint64)
    for r in found:
        size = 1 << bits - part - 6
        out[r.bucket * size : (r.bucket + 1) * size] = np.frombuffer(r.data, np.uint64)
    return out


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 64 - 1)
    return bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) > 0


def _count_words(buckets: int):
    """Blocks (kind 0) of words and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0

        def flush():
            h = np.sort(np.concatenate(held))
            first = _runs(h)
            n, h = np.diff(np.append(first, len(h))).astype(np.uint32), h[first]
            bucket = _bucket(h, buckets)
            order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
            return _blocks(bucket[order], [h[order], n[order]], 0)

        for _, _, words, _, _ in _chunks(batches, 0):
            held.append(words)
            size += len(words)
            if size >= _HELD:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for blocks in _buckets_of(batches):
        h, n = (np.concatenate(x) for x in zip(*(_unpacked(b, ("u8", "u4")) for b in blocks), strict=True))
        order = _order(h)
        first = _runs(h[order])
        yield pa.RecordBatch.from_arrays([pa.array(h[order[first]].view(np.int64)), pa.array(np.add.reduceat(n[order].astype(np.int64), first))], names=["h", "n"])


def _count(length: int, buckets: int, shared):
    """Blocks (kind 0) of how often words follow contexts of ``length`` words: context, suffix, number, and the sequence itself if the first two don't say it.

    ``shared``: filters of the candidates of this length, and of the sequences as long whose suffix the tree may give a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0

        def flush():
            h, ctx, suf = (np.concatenate(x) for x in zip(*held, strict=True))
            order = _order(h)
            first = _runs(h[order])
            n = np.diff(np.append(first, len(h))).astype(np.uint32)
            h, ctx, suf = (x[order[first]] for x in (h, ctx, suf))
            bucket = _bucket(h, buckets)
            width = np.uint64(buckets.bit_length())
            order = _order(bucket.astype(np.uint64) << np.uint64(64) - width | ctx >> width)
            return _blocks(bucket[order], [x[order] for x in (ctx, suf, n, h)[: 4 if length > 1 else 3]], 0)

        contexts, often = shared.value
        for _, _, words, place, lead in _chunks(batches, length):
            before = words
            for _ in range(length - 1):
                before = _longer(before, words)
            at = lead + np.flatnonzero(place[lead:] >= length)
            at = at[_passes(often, before[at])]
            at = at[_passes(contexts, before[at - 1])]
            held.append((_mixed(before[at - 1], words[at]), before[at - 1], before[at]))
            size += len(at)
            if size >= _HELD:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _spans(length: int, shared):
    """Parts of texts around candidates of ``length`` words, each with the word after it: sequences that hold one are nowhere else.

    The parts of some texts come as one, with a word that no text has before each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, _ = shared.value
        for batch in batches:
            cut = pc.greater(pc.binary_length(batch.column(1)), 8 * _TOKENS)  # these come in parts, so they stay whole
            yield batch.filter(cut)
            for uids, _, words, place, _ in _chunks(iter([batch.filter(pc.invert(cut))]), length):
                before = words
                for _ in range(length - 1):
                    before = _longer(before, words)
                at = np.flatnonzero(place >= length)
                at = at[_passes(contexts, before[at - 1])]
                steps = np.zeros(len(words) + 1, np.int64)
                steps[at - length] += 1
                steps[at + 1] -= 1
                inside = np.cumsum(steps[:-1]) > 0
                first = inside & ((place == 0) | ~np.concatenate(([False], inside[:-1])))
                held = np.insert(words[inside], np.flatnonzero(first[inside]), np.uint64(0))
                if len(held):
                    yield pa.RecordBatch.from_arrays([pa.array(uids[:1]), pa.array([held.tobytes()], pa.binary())], names=["uid", "words"])

    return run


def _buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """The blocks of each bucket; rows come in the order of buckets."""
    own, blocks = None, []
    for batch in batches:
        for bucket, data in zip(batch.column(0).to_pylist(), batch.column("data"), strict=True):
            if bucket != own and blocks:
                yield blocks
                blocks = []
            own = bucket
            blocks.append(data.as_py())
    if blocks:
        yield blocks


def _counted(length: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = ("u8", "u8", "u4", "u8")[: 4 if length > 1 else 3]
        for blocks in _buckets_of(batches):
            ctx, suf, n, *h = (np.concatenate(x) for x in zip(*(_unpacked(b, types) for b in blocks), strict=True))
            h = h[0] if h else _mixed(ctx, suf)
            order = _order(h)
            first = _runs(h[order])
            n = np.add.reduceat(n[order].astype(np.int64), first)
            keep = n >= least
            at = order[first[keep]]
            columns = {"ctx": ctx, "suf": suf} | ({"h": h} if length > 1 else {})
            yield pa.RecordBatch.from_arrays([*(pa.array(x[at].view(np.int64)) for x in columns.values()), pa.array(n[keep])], names=[*columns, "n"])

    return run


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ctx, suf, *rest = batch.columns
        h = _mixed(ctx.to_numpy().view(np.uint64), suf.to_numpy().view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h), *rest], names=["h", *batch.schema.names[2:]])


def _keyed(pairs: DataFrame, *columns: str) -> DataFrame:
    """The sequences' hashes, and ``columns``. Two words say the hash, so that their rows are joined without it."""
    if "h" in pairs.columns:
        return pairs.select("h", *columns)
    schema = StructType([StructField("h", LongType()), *pairs.select(*columns).schema])
    return pairs.select("ctx", "suf", *columns).mapInArrow(_named, schema)


@dataclass
class Model:
    weights: DataFrame  # h, n, weight, base: log10 probability of a word, 0 for other sequences; in several rows
    longest: int  # words of the longest sequences with a weight
    total: int
    distinct: int
    buckets: int


def _clean(spark) -> None:
    """Files of shuffles that are over stay on disk until the driver forgets them."""
    spark.sparkContext._jvm.System.gc()


def learn(texts: DataFrame, depth: int | None = None, least_context: int = LEAST_CONTEXT, least_longer: int = LEAST_LONGER, least_pair: int = LEAST_PAIR) -> Model:
    """The tree of ``texts``: uid, n_tokens, and words as a binary column of hashes. ``depth``: most words of a context, if any."""
    spark = texts.sparkSession
    total = texts.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    buckets = max(64, -(-total // _BUCKET))
    texts = texts.select("uid", "words")
    counts = write_shared(_by_bucket(texts.mapInArrow(_count_words(buckets), _BLOCK)).mapInArrow(_counted_words, "h long, n long"), "words")
    distinct = counts.count()
    words = counts.select("h", "n", F.log10((F.col("n") + 0.5) / F.lit(total + 0.5 * (distinct + 1))).alias("s"))
    weights = words.select("h", "n", F.col("s").alias("weight"), F.col("s").alias("base"))
    zero = F.lit(0.0).alias("base")
    contexts, known = counts.where(F.col("n") >= least_context), words.where(F.col("n") >= least_pair)
    length, spans = 0, None
    while depth is None or length < depth:
        bits = _filter(contexts), _filter(known)
        if not bits[0].any():
            break
        shared = spark.sparkContext.broadcast(bits)
        if length == 2:  # few words are near a candidate of three or more, and each length reads the words again
            texts = spans = write_shared(texts.mapInArrow(_spans(length + 1, shared), "uid long, words binary"), "spans", compression="zstd")
        blocks = texts.mapInArrow(_count(length + 1, buckets, shared), _BLOCK)
        counted = _by_bucket(blocks).mapInArrow(_counted(length + 1, least_pair), "ctx long, suf long, h long, n long" if length else "ctx long, suf long, n long")
        pairs = counted.join(known.select(F.col("h").alias("suf"), F.col("s").alias("above")), "suf").join(contexts.select(F.col("h").alias("ctx"), F.col("n").alias("sum")), "ctx")
        expected = F.col("sum") * F.pow(F.lit(10.0), F.col("above"))
        pairs = write_shared(pairs.where(F.col("n") * (F.ln(F.col("n") / expected) - 1) + expected >= LEAST_SURPRISE), "pairs")
        shared.destroy()
        retained = write_shared(_retained(pairs), "contexts")
        if length:
            release_table(contexts)
        _clean(spark)
        length += 1
        value = F.log10((F.col("n") + F.col("types") * F.pow(F.lit(10.0), F.col("above"))) / (F.col("sum") + F.col("types")))
        known = pairs.join(retained.drop("sum"), "ctx").withColumns({"s": value, "gain": value - F.col("above") - F.col("back")})
        known = write_shared(_keyed(known, "n", "s", "gain"), "level")
        longer = pairs.where(F.col("n") >= least_longer).join(retained.select(F.col("ctx").alias("suf")), "suf", "left_semi")
        contexts = write_shared(_keyed(longer, "n"), "candidates")
        release_table(pairs)
        _clean(spark)
        gains = known.select("h", "n", F.col("gain").alias("weight"), zero)
        states = retained.select(F.col("ctx").alias("h"), F.col("sum").alias("n"), F.col("back").alias("weight"), zero)
        weights = weights.unionByName(gains).unionByName(states)
    if spans:
        release_table(spans)
    return Model(weights, length + 1, total, distinct, buckets)


def _retained(pairs: DataFrame) -> DataFrame:
    """(ctx, sum, types, back) of the contexts whose next symbols diverge from those of their suffix."""
    n, above = F.col("n"), F.col("above")
    own = F.sum(n * (F.ln(n / F.col("sum")) - above * F.ln(F.lit(10.0))))
    stats = pairs.groupBy("ctx").agg(F.first("sum").alias("sum"), F.sum("n").alias("kept"), (F.count(F.lit(1)) + 1.0).alias("types"), own.alias("own"), F.sum(F.pow(F.lit(10.0), above)).alias("mass"))
    total, kept, types = F.col("sum"), F.col("kept"), F.col("types")
    rest, free = total - kept, F.greatest(1 - F.col("mass"), F.lit(1e-12))
    others = F.when(rest > 0, rest * F.ln(rest / total / free)).otherwise(0.0)
    stays = F.col("own") + others > types * F.ln(F.greatest(total, F.lit(2)))
    return stats.where(stays).select("ctx", "sum", "types", F.log10((rest / free + types) / (total + types)).alias("back"))


def _pack_weights(buckets: int):
    """Blocks (kind 0) of weights: sequence, weight, base."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, *values = (batch.column(c).to_numpy() for c in range(3))
            bucket = _bucket(h.view(np.uint64), buckets)
            order = np.argsort(bucket, kind="stable")
            yield _blocks(bucket[order], [h[order].view(np.uint64), *(x[order] for x in values)], 0)

    return run


def _asked(longest: int, unseen: float, buckets: int, shared):
    """Blocks of what texts need: words (kind 1) and longer sequences (2) to look up, as steps of uids and hashes, and sums of what the broadcast has (3)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weight, base, bits = shared.value
        places = Places(keys)
        for number, (uids, sizes, words, place, lead) in enumerate(_chunks(batches, longest - 1)):
            sums = np.zeros((3, len(words)))
            text = np.repeat(np.arange(len(sizes)), sizes)
            at, h = np.arange(lead, len(words)), words
            rest: dict = {1: [], 2: []}
            for length in range(1, longest + 1):
                if length > 1:
                    h = _longer(h, words)
                    at = at[place[at] >= length - 1]
                may = _passes(bits, h[at])
                if length == 1:
                    sums[:2, at[~may]] = unseen
                at = at[may]  # a sequence with a weight has a suffix with one
                found = places.find(h[at])
                hit, has = at[found >= 0], found[found >= 0]
                sums[0, hit] += weight[has]
                if length == 1:
                    sums[1, hit], sums[2, hit] = base[has], 1
                rest[min(length, 2)].append((text[at[found < 0]], h[at[found < 0]]))
            for kind, parts in rest.items():
                own, h = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (text[:0], words[:0])
                bucket = _bucket(h, buckets)
                width, wide = np.uint64(buckets.bit_length()), np.uint64(len(sizes).bit_length())
                order = _order((bucket.astype(np.uint64) << wide | own.astype(np.uint64)) << np.uint64(64) - width - wide)
                bucket, own, h = bucket[order], uids[own[order]], h[order]
                # Steps between the uids of a task's rows are small: most have one byte that isn't zero.
                first = _runs(bucket.astype(np.int64) << 24 | own >> 40)
                steps = np.diff(own, prepend=0)
                steps[first] = own[first]
                yield _blocks(bucket, [h, steps.astype(np.uint8), (steps >> 8 & 255).astype(np.uint8), steps >> 16], kind, first)
            direct = np.add.reduceat(sums, np.cumsum(sizes) - sizes, axis=1)
            bucket = np.full(len(uids), (int(uids[0]) + number) % buckets, np.int32)
            yield _blocks(bucket, [uids, *direct], 3)

    return run


def _summed(keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted distinct keys, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    first = _runs(keys[order])
    return keys[order[first]], [np.add.reduceat(v[order], first) if len(first) else v for v in values]


def _answered(unseen: float, buckets: int):
    """Blocks of sums by text: weight, base, known words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        asked: list = []
        size, waiting, own, table, parts = 0, 0, None, None, []

        def flush():
            uid, *values = (np.concatenate(x) for x in zip(*held, strict=True))
            uid, values = _summed(uid, values)
            home = (uid % buckets).astype(np.int32)
            order = np.argsort(home, kind="stable")
            return _blocks(home[order], [x[order] for x in (uid, *values)], 0)

        def look_up():
            """Answers what was asked of the bucket so far."""
            uid, h = (np.concatenate(x) for x in list(zip(*asked, strict=True))[:2])
            places, (weight, base) = table
            at, missed = places.find(h), np.repeat([m for _, _, m in asked], [len(x) for x, _, _ in asked])
            hit = at >= 0
            values = [missed, missed.copy(), np.zeros(len(h))]
            values[0][hit], values[1][hit] = weight[at[hit]], base[at[hit]]
            values[2][hit] = base[at[hit]] < 0
            first = _runs(uid)
            held.append([uid[first], *(np.add.reduceat(v, first) for v in values)])
            return len(first)

        for batch in batches:
            for bucket, kind, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if asked and (bucket != own or waiting >= _TOKENS):
                    size += look_up()
                    asked, waiting = [], 0
                if bucket != own:
                    own, table, parts = bucket, None, []
                data = block.as_py()
                if kind == 0:
                    parts.append(_unpacked(data, ("u8", "f8", "f8")))
                    continue
                if kind == 3:
                    held.append(_unpacked(data, ("i8", "f8", "f8", "f8")))
                    size += len(held[-1][0])
                else:
                    if table is None:
                        keys, *values = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
                        keys, values = _summed(keys, values)
                        table, parts = (Places(keys), values), []
                    h, low, middle, high = _unpacked(data, ("u8", "u1", "u1", "i8"))
                    asked.append((np.cumsum(high << 16 | middle.astype(np.int64) << 8 | low), h, unseen if kind == 1 else 0.0))
                    waiting += len(h)
                if size >= _HELD // 2:
                    yield flush()
                    held, size = [], 0
        if asked:
            size += look_up()
        if size:
            yield flush()

    return run


def _totalled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each text, of all its sums."""
    for blocks in _buckets_of(batches):
        uid, *values = (np.concatenate(x) for x in zip(*(_unpacked(b, ("i8", "f8", "f8", "f8")) for b in blocks), strict=True))
        uid, values = _summed(uid, values)
        yield pa.RecordBatch.from_arrays([pa.array(uid), *map(pa.array, values)], names=["uid", "weight", "base", "known"])


def score(df: DataFrame, train_on, id_col: str = "doc_id", text_col: str = "text", min_word: float = MIN_WORD, **options) -> DataFrame:
    """One row per row of ``df``: ``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``train_on``: a condition; rows for which it holds are learned from.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), (~train_on).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kinds = StructType().add("uid", LongType()).add("id", rows.schema["id"].dataType).add("held_out", BooleanType()).add("n_tokens", LongType()).add("words", BinaryType())
    texts = write_shared(rows.mapInArrow(_tokenise(kinds.names), kinds), "tokens", compression="zstd")
    model = learn(texts.where("NOT held_out"), **options)
    unseen = float(np.log10(0.5 / (model.total + 0.5 * (model.distinct + 1))))
    hot = model.weights.where(F.col("n") >= max(min_word * model.total, 1)).groupBy("h").agg(F.sum("weight").alias("weight"), F.sum("base").alias("base")).toArrow()
    bits = _filter(model.weights)
    shared = spark.sparkContext.broadcast((hot["h"].to_numpy().view(np.uint64), hot["weight"].to_numpy(), hot["base"].to_numpy(), bits))
    _clean(spark)
    asked = texts.select("uid", "words").mapInArrow(_asked(model.longest, unseen, model.buckets, shared), _BLOCK)
    table = model.weights.select("h", "weight", "base").mapInArrow(_pack_weights(model.buckets), _BLOCK)
    answered = _by_bucket(table.unionByName(asked)).mapInArrow(_answered(unseen, model.buckets), _BLOCK)
    sums = _by_bucket(answered).mapInArrow(_totalled, "uid long, weight double, base double, known double")
    whole = texts.select("uid", "id", "held_out", "n_tokens").join(sums, "uid")
    known, trained = F.round("known").cast("long"), F.lit(model.total).cast("long")
    return whole.select(F.col("id").alias(id_col), "held_out", "n_tokens", known.alias("n_known"), trained.alias("train_tokens"), F.col("base").alias("base_score"), F.col("weight").alias("score"))
