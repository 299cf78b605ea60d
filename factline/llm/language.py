"""Language identification with bit-sliced Bloom filters of n-grams.

Texts are lower-cased, ASCII characters other than letters become spaces, and n-grams are four bytes of UTF-8.
Training counts every n-gram of every training text by language (vectors inside tasks, one partial sum per task
and language, then a shuffle on the n-gram). An n-gram belongs to a language if it makes up at least
``min_share`` of that language's n-grams, which bounds the number of n-grams by languages / min_share, and if
its share there is at least ``relative`` of its share in any other language.

The filter has one bit plane per language; position p of all planes is one word (of 64 languages; more words with more
languages), so that a lookup ANDs the words of an n-gram's positions and returns every language that may hold it. Each language's popcount over a text is
corrected for the false positives that its plane's fill predicts; the largest corrected share decides.

Defined results: a null text, or one without a letter, is ``und`` with score 0; training rows with null text or
language don't count; ties go to the language that sorts first; without training data everything is ``und``;
texts of any length are read whole, their n-grams in pieces; empty tables give empty results; other columns keep their values whatever their
names, only those of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from factline.sources.storage import write_shared

N = 4
#: Positions of a plane (a power of two), and hashes per n-gram.
POSITIONS, HASHES = 1 << 19, 3
#: Part of a language's median score below which a text isn't taken to be in it.
MIN_SHARE, RELATIVE, DOUBTFUL = 2e-5, 0.3, 0.3
_TABLE = bytes(c if chr(c).isalpha() or c >= 0x80 else 0x20 for c in range(256))
_PAD, _HELD, _PIECE = b" " * N, 1 << 20, 1 << 20
#: n-grams that are looked up at once.
_LOOKED_UP = 1 << 17


def pieces(texts: list[str], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """n-grams of texts as 32-bit numbers, those of spaces alone left out, and the place of the text that each begins in; of ``size`` bytes at a time.

    A gram that reaches into the next text's spaces belongs to the text it begins in.
    """
    data = [_PAD + x.lower().encode("utf-8", "replace").translate(_TABLE) for x in texts]
    ends = np.cumsum([len(x) for x in data])
    joined = np.frombuffer(b"".join(data) + _PAD, np.uint8)
    for at in range(0, len(joined) - N + 1, size):
        own = joined[at : at + size + N - 1].astype(np.uint32)
        codes = own[:-3] | own[1:-2] << np.uint32(8) | own[2:-1] << np.uint32(16) | own[3:] << np.uint32(24)
        kept = np.flatnonzero(codes != 0x20202020)
        yield codes[kept], np.searchsorted(ends, at + kept, "right")


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of texts as 32-bit numbers, those of spaces alone left out, and how many come from each text."""
    codes, own = (np.concatenate(x) for x in zip(*pieces(texts, _PIECE), strict=True))
    return codes, np.bincount(own, minlength=len(texts))


def positions(codes: np.ndarray, size: int = POSITIONS, hashes: int = HASHES) -> list[np.ndarray]:
    """Places of each n-gram in the planes: double hashing."""
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    a, b = mixed >> np.uint64(32), mixed & np.uint64(0xFFFFFFFF) | np.uint64(1)
    return [((a + np.uint64(i) * b) & np.uint64(size - 1)).astype(np.int64) for i in range(hashes)]


@dataclass
class Filter:
    """Words of the planes (positions, languages / 64), languages by bit, and each plane's false positive rate."""

    words: np.ndarray
    languages: list[str]
    false_positive: np.ndarray

    def shares(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): corrected share of a text's n-grams that the language's plane holds."""
        hits, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= _PIECE):
                size += len(texts[to])
                to += 1
            for codes, own in pieces(texts[at:to], _LOOKED_UP):
                if not len(codes):
                    continue
                found = np.full((len(codes), self.words.shape[1]), ~np.uint64(0))
                for place in positions(codes, len(self.words)):
                    found &= self.words[place]
                begins = np.flatnonzero(np.diff(own, prepend=-1))
                text = at + own[begins]
                counts[text] += np.diff(np.append(begins, len(own)))
                for i in range(len(self.languages)):
                    hits[text, i] += np.add.reduceat(found[:, i // 64] >> np.uint64(i % 64) & np.uint64(1), begins)
            at = to
        rate = self.false_positive
        shares = hits / np.maximum(counts, 1)[:, None]
        return np.where((counts > 0)[:, None] & (rate < 1), np.clip((shares - rate) / np.where(rate < 1, 1 - rate, 1), 0, 1), 0.0)


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of columns (lang, text), summed within the task until ``_HELD`` n-grams are held."""
    held: dict[str, list] = {}
    size = 0

    def reduced(lang):
        codes = np.concatenate([c for c, _ in held[lang]])
        n = np.concatenate([n for _, n in held[lang]])
        order = np.argsort(codes, kind="stable")
        codes, n = codes[order], n[order]
        begins = np.flatnonzero(np.diff(codes.astype(np.int64), prepend=-1))
        return codes[begins], np.add.reduceat(n, begins) if len(begins) else n

    def flush():
        for lang in held:
            codes, n = reduced(lang)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    for batch in batches:
        frame = pd.DataFrame({"lang": batch.column(0).to_pylist(), "text": batch.column(1).to_pylist()})
        for lang, texts in frame.groupby("lang")["text"]:
            texts = list(texts)
            while texts:
                piece, n = [], 0
                while texts and (not piece or n < _PIECE):
                    piece.append(texts.pop())
                    n += len(piece[-1])
                for codes, _ in pieces(piece, _PIECE):
                    codes = np.sort(codes)
                    begins = np.flatnonzero(np.diff(codes.astype(np.int64), prepend=-1))
                    counts = np.diff(np.append(begins, len(codes)))
                    held.setdefault(lang, []).append((codes[begins], counts))
                    size += len(begins)
                    if size > _HELD:
                        for k in held:
                            held[k] = [reduced(k)]
                        size = sum(len(v[0][0]) for v in held.values())
                        if size > _HELD // 2:
                            yield from flush()
                            held, size = {}, 0
    yield from flush()


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_share: float = MIN_SHARE, relative: float = RELATIVE, size: int = POSITIONS) -> Filter:
    """Filter of all rows of ``df`` whose text and language aren't null."""
    rows = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.mapInArrow(count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = write_shared(counted, "grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").collect()  # a row for each language
    languages = [r.lang for r in totals]
    words = np.zeros((size, max(-(-len(languages) // 64), 1)), np.uint64)
    if not languages:
        return Filter(words, [], np.zeros(0))
    known = df.sparkSession.createDataFrame([(r.lang, i, float(r.total)) for i, r in enumerate(totals)], "lang string, number int, total double")
    shares = counted.join(F.broadcast(known), "lang").select("gram", "number", (F.col("n") / F.col("total")).alias("share")).where(F.col("share") >= min_share)
    best = F.max("share").over(Window.partitionBy("gram"))
    member = shares.withColumn("best", best).where(F.col("share") >= relative * F.col("best"))
    held = member.select("gram", "number").toArrow()  # at most languages / min_share rows
    number = held["number"].to_numpy().astype(np.int64)
    for place in positions(held["gram"].to_numpy().astype(np.uint32), size):
        np.bitwise_or.at(words, (place, number // 64), np.uint64(1) << (number % 64).astype(np.uint64))
    fill = np.array([(words[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(languages))])
    return Filter(words, languages, fill**HASHES)


def _predicted(model: Filter, df: DataFrame, text_col: str):
    """Struct (lang, score) of a text column."""
    held = df.sparkSession.sparkContext.broadcast(model)  # of fixed size for each 64 languages

    def run(text: pd.Series, letters: pd.Series) -> pd.DataFrame:
        own = held.value
        shares = own.shares([x if ok else "" for x, ok in zip(text, letters, strict=True)])
        if not own.languages:
            return pd.DataFrame({"lang": ["und"] * len(text), "score": 0.0})
        best = shares.argmax(axis=1)
        lang = np.where(letters, np.array(own.languages, object)[best], "und")
        return pd.DataFrame({"lang": lang, "score": np.where(letters, shares[np.arange(len(best)), best], 0.0)})

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return pandas_udf(run, "lang string, score double")(F.coalesce(F.col(text_col), F.lit("")), letters)


def predict(df: DataFrame, model: Filter, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``df`` with the predicted language and its score, the corrected share of the text's n-grams; they replace columns of these names."""
    whole = df.select(F.struct("*").alias("row"), _predicted(model, df, text_col).alias("found"))
    own = [F.col("row")[c].alias(c) for c in df.columns if c not in (lang_col, score_col)]
    return whole.select(*own, F.col("found.lang").alias(lang_col), F.col("found.score").alias(score_col))


def held_out(id_col: str = "doc_id"):
    """Rows that aren't learned from: CRC-32 of the id as text leaves 2 modulo 4 (null ids are learned from)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_identified(df: DataFrame, model: Filter, text_col: str = "text", doubtful: float = DOUBTFUL) -> DataFrame:
    """The rows of ``df`` whose text has a language: not those without a letter, nor those with a score below ``doubtful`` times the median score, over all rows, of the language that fits best.

    Texts are scored once, beside two hashes of them alone; rows are read again and meet only the hashes of texts that go.
    """
    key = [F.xxhash64(F.lit(i), F.col(text_col).isNull(), F.col(text_col)).alias(f"k{i}") for i in (1, 2)]
    held = df.sparkSession.sparkContext.broadcast(model)  # of fixed size for each 64 languages

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            column, letters = batch.column(2), batch.column(3).to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(batch):  # about as many characters at once, however many rows a batch has
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PIECE, "right")))
                shares = None if not own.languages else own.shares([x if ok else "" for x, ok in zip(column.slice(at, to - at).to_pylist(), letters[at:to], strict=True)])
                best = shares.argmax(axis=1) if own.languages else np.zeros(to - at, np.int64)
                lang = [own.languages[b] if ok and own.languages else "und" for b, ok in zip(best.tolist(), letters[at:to], strict=True)]
                most = np.where(letters[at:to], shares[np.arange(to - at), best], 0.0) if own.languages else np.zeros(to - at)
                yield pa.RecordBatch.from_arrays([*(c.slice(at, to - at) for c in batch.columns[:2]), pa.array(lang, pa.string()), pa.array(most)], names=["k1", "k2", "lang", "score"])
                at = to

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = df.select(*key, F.coalesce(F.col(text_col), F.lit("")).alias("text"), letters.alias("letters"))
    scored = write_shared(rows.mapInArrow(score, "k1 long, k2 long, lang string, score double"), "scores")
    middle = scored.where("lang <> 'und'").groupBy("lang").agg(F.percentile_approx("score", 0.5, 10000).alias("middle")).collect()  # a row for each language
    least = F.create_map(*(F.lit(x) for r in middle for x in (r.lang, doubtful * r.middle))) if middle else F.create_map(F.lit("und"), F.lit(2.0))
    stays = (F.col("lang") != "und") & (F.col("score") > 0) & (F.col("score") >= least[F.col("lang")])
    gone = scored.where(~F.coalesce(stays, F.lit(False))).select("k1", "k2").distinct()
    return df.select(F.struct("*").alias("row"), *key).join(gone, ["k1", "k2"], "left_anti").select("row.*")
