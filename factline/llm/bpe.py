"""Byte-level BPE with forced boundaries.

A pair of bytes that occurs inside no vocabulary token can't be inside any token of an encoding, so there is
certainly a cut between the two. Such cuts come in two rounds. No token holds white space after a visible
ASCII byte, and the tokenizer's pattern spans no place where white space follows any visible character, so
texts first fall into units: white space and what follows up to the next. Of each distinct unit, the pattern's words are cut at all other such pairs,
and the fragments are merged each by itself, many at once as numpy vectors. Ids of a text are its units' ids in
turn. Units recur, so a worker keeps their ids in a cache of bounded size.

The tokenizer is a ``tokenizers`` JSON file with a byte-level BPE model: no normalizer, no prefix space, plain
merges. Added tokens that the file marks as special are found in texts first, longest leftmost, as the library
does by default. The file is read by each worker and must be on every machine, as the library it comes with is.

Defined results: a null text is empty and has no ids; decoding bytes that aren't UTF-8 gives replacement
characters, as in the library; texts of any length are encoded whole; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructType

#: The published pattern that cuts texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Units in each half of a worker's cache, characters of texts that are cut at once, and most bytes of a fragment that is merged with others.
CACHE, _PIECE, _LONG = 1 << 17, 1 << 20, 64
#: The same two where ids are kept beside their texts, in workers that have other work before and after.
_SMALL, _CHECKED = 1 << 15, 1 << 18
#: White space other than single spaces and line feeds, or the sign that cuts are marked with.
_ODD = re.compile(r"[^\S \n]|[ \n][ \n]|\x01|\x85")


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in the file: printable bytes for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """``cache`` is the number of units in each half of the cache; without ``names`` no decimal ids are kept."""

    def __init__(self, path: str, cache: int = CACHE, names: bool = True):
        self.cache, self.names = cache, names
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec.get("normalizer") or model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE tokenizer")
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.ids = {raw(t): i for t, i in model["vocab"].items()}
        self.bytes = {i: t for t, i in self.ids.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(self.ids[raw(a)], self.ids[raw(b)]): (rank, self.ids[raw(a) + raw(b)]) for rank, (a, b) in reversed(list(enumerate(merges)))}
        keys = np.array([(a << 20) + b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.pairs, self.pair_rank, self.pair_id = keys[order], *(np.array([v[i] for v in self.ranks.values()], np.int64)[order] for i in (0, 1))
        #: Pairs of bytes that some token holds; between any others a cut is certain.
        self.inner = {t[i : i + 2] for t in self.ids for i in range(len(t) - 1)}
        self.holds = np.zeros(1 << 16, bool)
        self.holds[[p[0] << 8 | p[1] for p in self.inner]] = True
        if any(pair[1] in b" \n" and 0x20 < pair[0] < 0x80 for pair in self.inner):
            raise ValueError("a token goes on with white space")
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        added = [t for t in spec.get("added_tokens", []) if t["content"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take in what is beside them aren't known here")
        self.added = {t["content"]: t["id"] for t in added}
        self.bytes |= {t["id"]: t["content"].encode() for t in added}
        self.split = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if added else None
        self.words = regex.compile(PATTERN)
        self.units = regex.compile(r"\s*\S+|\s+")
        #: Ids of units, packed, and in decimal; the older half of the cache has those that may go.
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}
        self.decimal = [str(i) for i in range(max(self.bytes) + 1)]
        lengths = np.zeros(max(self.bytes) + 1, np.int64)
        for i, token in self.bytes.items():
            lengths[i] = len(token)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.letters = np.frombuffer(b"".join(self.bytes.get(i, b"") for i in range(len(lengths))), np.uint8)

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of a fragment: the pair of lowest rank merges first, the leftmost of equals."""
        ids = self.single[list(fragment)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(*self.ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.ranks]
        heap = [(rank, i, new, p) for rank, new, i, p in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] != pair[0] or j >= len(ids) or ids[j] != pair[1]:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else len(ids)
                if right < len(ids) and (found := self.ranks.get(p := (ids[left], ids[right]))):
                    heapq.heappush(heap, (found[0], left, found[1], p))
        return [i for i in ids if i >= 0]

    def merge_many(self, ids: np.ndarray, fragment: np.ndarray) -> np.ndarray:
        """Bytes' ids after all merges, -1 where a symbol has gone into the one before it. ``fragment`` numbers each symbol's fragment.

        As :meth:`merge`, with one merge at a time in every fragment.
        """
        out = np.full(len(ids), -1, np.int64)
        place = np.arange(len(ids))
        none = len(self.pairs) + 1
        while len(ids):
            key = (ids[:-1] << 20) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            rank = np.append(np.where((self.pairs[at] == key) & (fragment[1:] == fragment[:-1]), self.pair_rank[at], none), none)
            begins = np.flatnonzero(np.diff(fragment, prepend=-1))
            sizes = np.diff(np.append(begins, len(ids)))
            best = np.repeat(np.minimum.reduceat(rank, begins), sizes)
            keep = best < none
            out[place[~keep]] = ids[~keep]
            hit = np.flatnonzero((rank == best) & keep)
            hit = hit[np.diff(fragment[hit], prepend=-1) != 0]
            ids[hit] = self.pair_id[at[hit]]
            keep[hit + 1] = False
            ids, fragment, place = ids[keep], fragment[keep], place[keep]
        return out

    def learn(self, units: set[str]) -> None:
        """Put units into the cache; when it is full, what is there becomes the older half."""
        if len(self.known) + len(units) > self.cache:
            self.older, self.known = self.known, {}
        fresh = []
        for unit in units:
            if (found := self.older.get(unit)) is not None:
                self.known[unit] = found
            else:
                fresh.append(unit)
        if not fresh:
            return
        words, owner = [], []
        for i, unit in enumerate(fresh):
            own = [unit] if (unit[1:] if unit[0] == " " else unit).isalpha() else self.words.findall(unit)
            words += [w.encode() for w in own]
            owner += [i] * len(own)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.holds[(data[:-1] << 8) + data[1:]]
        cut[np.cumsum(sizes) - sizes] = True
        fragment = np.cumsum(cut) - 1
        long = np.bincount(fragment) > _LONG
        short = ~long[fragment]
        ids = np.full(len(data), -1, np.int64)
        ids[short] = self.merge_many(self.single[data[short]], fragment[short])
        for f in np.flatnonzero(long).tolist():
            begin, end = np.searchsorted(fragment, [f, f + 1])
            found = self.merge(data[begin:end].astype(np.uint8).tobytes())
            ids[begin : begin + len(found)] = found
        kept = ids >= 0
        of = np.repeat(np.array(owner), sizes)[kept]
        ends = np.cumsum(np.bincount(of, minlength=len(fresh))).tolist()
        packed, names = ids[kept].astype(np.int32).tobytes(), [self.decimal[i] for i in ids[kept].tolist()] if self.names else []
        begin = 0
        for unit, end in zip(fresh, ends, strict=True):
            self.known[unit] = packed[4 * begin : 4 * end], ",".join(names[begin:end])
            begin = end

    def forget(self) -> None:
        """Empty the cache, and give back what Arrow holds unused."""
        self.known, self.older = {}, {}
        pa.default_memory_pool().release_unused()

    def into_units(self, text: str) -> list[str]:
        if not text:
            return []
        if _ODD.search(text):
            return self.units.findall(text)
        units = text.replace(" ", "\x01 ").replace("\n", "\x01\n").split("\x01")
        return units if units[0] else units[1:]

    def parts(self, text: str) -> list[str | int]:
        """Units of a text, and ids of the added tokens in it."""
        out: list = []
        at = 0
        for hit in self.split.finditer(text) if self.split else ():
            out += self.into_units(text[at : hit.start()])
            out.append(self.added[hit[0]])
            at = hit.end()
        return out + self.into_units(text[at:] if at else text)

    def encode_all(self, texts, piece: int = _PIECE) -> Iterator[tuple[np.ndarray, str]]:
        """Ids of each text, and the same in decimal, joined by commas (empty if none are kept)."""
        held: list = []
        size = 0
        for text in chain(texts, [None]):
            if text is not None:
                parts = self.parts(text)
                held.append((parts, list(map(self.known.get, parts))))
                size += len(text)
            if text is None or size > piece:
                self.learn({u for parts, found in held if None in found for u, f in zip(parts, found, strict=True) if f is None and type(u) is str})
                for parts, found in held:
                    if None in found:
                        found = [f or self.known.get(u) or (np.int32(u).tobytes(), str(u)) for u, f in zip(parts, found, strict=True)]
                    yield np.frombuffer(b"".join([f[0] for f in found]), np.int32), ",".join([f[1] for f in found]) if self.names else ""
                held, size = [], 0

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))[0].tolist()

    def decode(self, ids) -> str:
        """Text of ids; unknown ids are left out."""
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.lengths))]
        sizes = self.lengths[ids]
        place = np.repeat(self.starts[ids] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return self.letters[place].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def tokenizer(path: str, cache: int = CACHE, names: bool = True) -> ByteBpe:
    return ByteBpe(path, cache, names)


def encode_texts(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the ids of each text in ``ids_col``."""

    def run(text: pd.Series) -> pd.Series:
        return pd.Series([ids for ids, _ in tokenizer(path).encode_all(text)], dtype=object)

    return df.withColumn(ids_col, pandas_udf(run, "array<int>")(F.coalesce(F.col(text_col), F.lit(""))))


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of each row's ids (null: none) in ``text_col``."""

    def run(ids: pd.Series) -> pd.Series:
        return pd.Series(["" if x is None else tokenizer(path).decode(x) for x in ids], dtype=object)

    return df.withColumn(text_col, pandas_udf(run, "string")(F.col(ids_col)))


def encode_checked(df: DataFrame, path: str, keep: list[str], text_col: str = "text", ids_col: str = "ids", ok_col: str = "round_trip") -> DataFrame:
    """Columns ``keep`` of ``df``, the ids of each text, and whether they decode to it, from one encoding; these replace kept ones of their names.

    A task holds the ids of about ``_CHECKED`` characters at once, however many rows a batch has.
    """
    keep = [c for c in keep if c not in (ids_col, ok_col)]
    schema = StructType(df.select(*keep).schema.fields).add(ids_col, ArrayType(IntegerType(), False), False).add(ok_col, BooleanType(), False)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path, _SMALL, False)
        for batch in batches:
            *kept, column = batch.columns
            ends = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False))
            begin = 0
            while begin < len(batch):
                end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _CHECKED, "right")))
                texts = column.slice(begin, end - begin).to_pylist()
                ids, ok = [], []
                for text, (found, _) in zip(texts, own.encode_all(texts, _CHECKED), strict=True):
                    ids.append(found)
                    ok.append(own.decode(found) == text)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*(c.slice(begin, end - begin) for c in kept), lists, pa.array(ok)], names=names)
                begin = end
        own.forget()  # a worker may go on with other work

    return df.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text")).mapInArrow(run, schema)


def digests(path: str, text_col: str = "text"):
    """Struct (n_tokens, ids_sha256, decoded_sha256) of a text's encoding and of what that decodes to."""

    def run(text: pd.Series) -> pd.DataFrame:
        own = tokenizer(path)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        rows = [(len(ids), digest(decimal), digest(own.decode(ids))) for ids, decimal in own.encode_all(text)]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return pandas_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string")(F.coalesce(F.col(text_col), F.lit("")))
