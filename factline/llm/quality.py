"""Quality classification by co-training of two views.

One view sees the text's content (shares of characters, repetition, hashed words), the other the document's
metadata (source, language, length as stated). Both are logistic regressions. They start from labelled rows;
then, for some rounds, each gives labels to the unlabelled documents that it is most certain of, and the *other*
view learns from them. Views are calibrated on labelled rows that they haven't seen before they teach. A view teaches
a class only if, of further labelled rows that it would pick, it is right more often than the pupil, and a pupil
keeps what it learned only if its loss on those rows doesn't grow. At last the calibrated log odds of both are
combined by a regression on the rows kept apart. Every document is scored inside tasks.

The exchange covers all unlabelled documents: their features are written once as a table, each round scores all of it,
and the thresholds are shares of all rows. What is fitted are bounded samples of rows with labels: at most ``labelled``
given ones, and ``pseudo`` of the other view's for each class and round, both chosen by a hash of the id.

Defined results: null texts are empty; null metadata is a value of its own; several labels of a document
are averaged, ties count as good; labels without a document, or null, are left out; without labels of both
kinds, or below 20, every score is the share of good labels (0.5 without any); repeated rows are scored each; columns
of the input other than the named ones aren't looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from factline.sources.storage import write_shared

LABELLED, PSEUDO, ROUNDS, SHARE, CERTAIN, KEEP = 8000, 2000, 4, 0.05, 0.95, 0.5
#: Labelled rows that a teacher must have picked before it is judged; steps of the log odds, and how many make one of them.
LEAST, STEPS, FINE = 10, 4000, 20
HASHED, META = 256, 512
_PIECE = 1024
_CLASSES = [range(0x41, 0x5B), range(0x61, 0x7B), range(0x30, 0x3A), range(0x80, 0x100), [0x20], [0x0A], *([c] for c in range(0x21, 0x7F) if not chr(c).isalnum())]
_WHICH = np.full(256, len(_CLASSES))
for _i, _c in enumerate(_CLASSES):
    _WHICH[list(_c)] = _i
_LETTER = re.compile(r"\w")


def content(text: str) -> np.ndarray:
    """Features of a text: shares of character classes, repetition of words and lines, hashed words."""
    out = np.zeros(len(_CLASSES) + 7 + HASHED, np.float32)
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(data):
        return out
    per_byte = np.bincount(data, minlength=256)
    shares = np.bincount(_WHICH, per_byte, len(_CLASSES) + 1)[:-1] / len(data)
    out[: len(shares)] = np.sqrt(shares)
    words = Counter(text.split())
    n = sum(words.values())
    lines = text.split("\n")
    at = len(_CLASSES)
    out[at : at + 7] = (np.log1p(len(data)), np.log1p(n), len(words) / max(n, 1), max(words.values(), default=0) / max(n, 1), len(data) / (n + 1) / 10, len(set(lines)) / len(lines), sum(k for w, k in words.items() if not _LETTER.search(w)) / max(n, 1))
    if words:
        buckets = np.fromiter((crc32(w.lower().encode("utf-8", "replace")) % HASHED for w in words), np.int64, len(words))
        out[at + 7 :] = np.sqrt(np.bincount(buckets, np.fromiter(words.values(), float, len(words)), HASHED) / n)
    return out


def metadata_codes(source, lang, length) -> np.ndarray:
    """Places of hashed values and pairs of metadata, and the length's power of two (-1: none)."""
    size = -1 if length is None or pd.isna(length) else int(np.log2(max(float(length), 0) + 1))
    parts = (f"s{source}", f"l{lang}", f"n{size}", f"s{source} l{lang}", f"l{lang} n{size}")
    return np.array([*(crc32(x.encode("utf-8", "replace")) % META for x in parts), size], np.int16)


def metadata(codes: np.ndarray) -> np.ndarray:
    """Features of metadata, from rows of codes."""
    out = np.zeros((len(codes), META + 2), np.float32)
    for c in range(codes.shape[1] - 1):
        np.add.at(out, (np.arange(len(codes)), codes[:, c]), 1)
    out[:, META], out[:, META + 1] = codes[:, -1], codes[:, -1] < 0
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, decay: float = 1.0, steps: int = 12) -> Logistic:
        """Newton's method with a quadratic penalty."""
        mean, scale = x.mean(axis=0, dtype=np.float64), x.std(axis=0, dtype=np.float64)
        scale[scale < 1e-6] = 1.0
        z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
        w = np.zeros(z.shape[1])
        penalty = np.full(len(w), decay)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = sigmoid(z @ w)
            step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w[:-1], float(w[-1]))

    def odds(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias


@dataclass
class View:
    """A regression with the slope and intercept of its calibration."""

    model: Logistic
    slope: float
    intercept: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, apart_x: np.ndarray, apart_y: np.ndarray) -> View:
        model = Logistic.fit(x, y)
        c = Logistic.fit(model.odds(apart_x)[:, None], apart_y, decay=1e-2) if len(set(apart_y.tolist())) == 2 else None
        return cls(model, float(c.weights[0] / c.scale[0]), float(c.bias - c.weights[0] * c.mean[0] / c.scale[0])) if c else cls(model, 1.0, 0.0)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.model.odds(x) + self.intercept

    def steps(self, x: np.ndarray, good: int) -> np.ndarray:
        """How certain it is of a class: log odds in steps, from 0 to ``STEPS`` - 1."""
        return np.clip(np.floor((self.odds(x) if good else -self.odds(x)) * FINE), 0, STEPS - 1).astype(np.int64)

    def loss(self, x: np.ndarray, y: np.ndarray) -> float:
        return float(-np.log(np.clip(sigmoid(np.where(y == 1, 1, -1) * self.odds(x)), 1e-9, 1)).mean()) if len(y) else 0.0


@dataclass
class Model:
    """Two views, the regression that combines their log odds, the prior's log odds, and what was exchanged."""

    views: list[View]
    both: Logistic | None
    prior: float
    #: (round, teaching view, class, rows taught, share of the teacher's labels that is right on rows kept apart, the pupil's, whether the pupil kept it)
    exchanged: list[tuple] = field(default_factory=list)

    def scores(self, texts, sources, langs, lengths) -> np.ndarray:
        """Columns: the combined score, and each calibrated view's."""
        n = len(texts)
        if not self.views:
            return np.full((n, 3), sigmoid(np.array(self.prior)))
        if not n:
            return np.zeros((0, 3))
        x = [np.stack([content(t) for t in texts]), metadata(np.stack([metadata_codes(*m) for m in zip(sources, langs, lengths, strict=True)]))]
        odds = np.stack([v.odds(f) for v, f in zip(self.views, x, strict=True)], axis=1)
        return sigmoid(np.column_stack([self.both.odds(odds), odds]))


def least_step(certain: float) -> int:
    return int(np.ceil(np.log(certain / (1 - certain)) * FINE))


def co_train(views: list[np.ndarray], y: np.ndarray, pick: Callable, rounds: int = ROUNDS, certain: float = CERTAIN) -> Model:
    """Fit on labelled rows (features by view, labels 0 or 1), in the order of a hash.

    ``pick``: of views and (teacher, class) pairs to the pupil's features of rows that the teacher labels so.
    """
    prior = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if len(y) else 0.0
    if len(set(y.tolist())) < 2 or len(y) < 20:
        return Model([], None, float(prior))
    part = np.arange(len(y)) % 5
    own, apart, judge = part > 1, part == 0, part == 1

    def fit(v: int, more: list[tuple[np.ndarray, int]]) -> View:
        x = np.concatenate([views[v][own], *(m for m, _ in more)])
        return View.fit(x, np.concatenate([y[own], *(np.full(len(m), float(c)) for m, c in more)]), views[v][apart], y[apart])

    found, exchanged = [fit(0, []), fit(1, [])], []
    for number in range(rounds):
        teachers = {}
        for teacher, good in ((0, 1), (0, 0), (1, 1), (1, 0)):
            rows = found[teacher].steps(views[teacher][judge], good) >= least_step(certain)
            right = float((y[judge][rows] == good).mean()) if rows.sum() >= LEAST else 0.0
            pupils = float(((found[1 - teacher].odds(views[1 - teacher][judge][rows]) > 0) == y[judge][rows]).mean()) if rows.any() else 1.0
            if right > pupils:
                teachers[teacher, good] = right, pupils
        taught = pick(found, list(teachers)) if teachers else {}
        kept = False
        for pupil in (0, 1):
            more = [(x, good) for (teacher, good), x in taught.items() if teacher != pupil and len(x)]
            if more:
                new = fit(pupil, more)
                better = new.loss(views[pupil][judge], y[judge]) <= found[pupil].loss(views[pupil][judge], y[judge])
                exchanged += [(number, 1 - pupil, good, len(x), *teachers[1 - pupil, good], better) for x, good in more]
                if better:
                    found[pupil], kept = new, True
        if not kept:
            break
    rest = ~own
    odds = np.stack([v.odds(x[rest]) for v, x in zip(found, views, strict=True)], axis=1)
    return Model(found, Logistic.fit(odds, y[rest], decay=0.1), float(prior), exchanged)


_FIELDS = ("text", "source", "lang", "n_chars")


_WIDE = len(_CLASSES) + 7 + HASHED


def _features(rows: DataFrame) -> DataFrame:
    """(id, place, content, codes): a text's features as half floats, and the codes of its metadata."""

    def run(text: pd.Series, source: pd.Series, lang: pd.Series, size: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"content": [content(t).astype(np.float16).tobytes() for t in text], "codes": [metadata_codes(*m).tobytes() for m in zip(source, lang, size, strict=True)]}, columns=["content", "codes"])

    found = pandas_udf(run, "content binary, codes binary")(*_FIELDS)
    return rows.select("id", "place", found.alias("f")).select("id", "place", "f.*")


def _unpack(contents, codes) -> list[np.ndarray]:
    """Features by view, of columns of the features' table."""
    text = np.frombuffer(b"".join(contents), np.float16).reshape(-1, _WIDE).astype(np.float32)
    return [text, metadata(np.frombuffer(b"".join(codes), np.int16).reshape(-1, 6))]


def _some(rows: DataFrame, n: int, most: int) -> pd.DataFrame:
    """At most ``most`` of ``n`` rows, by the hash in ``place``."""
    bound = 2.0**63 * (2 * min(1.0, 1.2 * most / max(n, 1)) - 1)
    return rows.where(F.col("place") <= F.lit(min(bound, 2.0**63 - 1024)).cast("long")).orderBy("place").limit(most).toPandas()


def picker(free: DataFrame, share: float = SHARE, certain: float = CERTAIN, pseudo: int = PSEUDO) -> Callable:
    """``pick`` of :func:`co_train` over a table (place, content, codes) of unlabelled rows.

    Of all rows, a teacher picks the ``share`` that it is most certain to be of a class, in whole steps and one at least,
    if it is at least ``certain``.
    """
    spark = free.sparkSession

    def certainties(batch: pa.RecordBatch, views: list[View], pairs: list) -> list[np.ndarray]:
        x = _unpack(batch.column("content").to_pylist(), batch.column("codes").to_pylist())
        return [views[t].steps(x[t], good) for t, good in pairs]

    def pick(views: list[View], pairs: list) -> dict:
        held = spark.sparkContext.broadcast((views, pairs))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, pairs = held.value
            n = np.zeros((len(pairs), STEPS), np.int64)
            for batch in batches:
                for i, step in enumerate(certainties(batch, own, pairs) if len(batch) else []):
                    n[i] += np.bincount(step, minlength=STEPS)
            pair, step = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(step), pa.array(n[pair, step])], names=["pair", "step", "n"])

        steps = free.mapInArrow(count, "pair long, step long, n long").groupBy("pair", "step").agg(F.sum("n").alias("n")).collect()  # at most pairs * STEPS rows
        total = free.count()
        found = {}
        for i, (teacher, good) in enumerate(pairs):
            n = np.zeros(STEPS, np.int64)
            for r in steps:
                if r.pair == i:
                    n[r.step] = r.n
            above = np.cumsum(n[::-1])[::-1]
            sure = np.flatnonzero(n[least_step(certain) :]) + least_step(certain)
            if not len(sure):
                found[teacher, good] = np.zeros((0, 1))
                continue
            least = int(next((k for k in sure if above[k] <= share * total), sure[-1]))

            def chosen(batches: Iterator[pa.RecordBatch], i=i, least=least) -> Iterator[pa.RecordBatch]:
                own, pairs = held.value
                for batch in batches:
                    if len(batch):
                        yield batch.filter(pa.array(certainties(batch, own, pairs[i : i + 1])[0] >= least))

            rows = _some(free.mapInArrow(chosen, free.schema), int(above[least]), pseudo)
            found[teacher, good] = _unpack(rows["content"].map(bytes), rows["codes"].map(bytes))[1 - teacher] if len(rows) else np.zeros((0, 1))
        return found

    return pick


def _inputs(df: DataFrame, id_col, text_col, source_col, lang_col, size_col) -> DataFrame:
    size = F.col(size_col).cast("double") if size_col else F.lit(None).cast("double")
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), size.alias("n_chars"))


def train(df: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", source_col="source", lang_col="lang", size_col="n_chars", label_col="quality", labelled: int = LABELLED, pseudo: int = PSEUDO, **options) -> Model:
    rows = _inputs(df, id_col, text_col, source_col, lang_col, size_col).withColumn("place", F.xxhash64("id", F.lit(7)))
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.avg(F.col(label_col).cast("double")) >= 0.5).cast("double").alias("y"))
    table = write_shared(_features(rows).join(known, "id", "left").select("y", "place", "content", "codes"), "features")
    given = table.where("y IS NOT NULL")
    some = _some(given, given.count(), labelled)
    views = _unpack(some["content"].map(bytes), some["codes"].map(bytes))
    free = table.where("y IS NULL").select("place", "content", "codes")
    return co_train(views, some["y"].to_numpy(np.float64), picker(free, pseudo=pseudo), **options)


def classify(df: DataFrame, model: Model, id_col="doc_id", text_col="text", source_col="source", lang_col="lang", size_col="n_chars", threshold: float = KEEP) -> DataFrame:
    """One row per row of ``df``: ``id_col``, score (probability of good quality), keep, text_score, metadata_score."""
    held = df.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(text: pd.Series, source: pd.Series, lang: pd.Series, size: pd.Series) -> pd.DataFrame:
        pieces = [held.value.scores(*(x.iloc[i : i + _PIECE] for x in (text, source, lang, size))) for i in range(0, len(text), _PIECE)]
        return pd.DataFrame(np.concatenate([np.zeros((0, 3)), *pieces]), columns=["score", "text_score", "metadata_score"])

    rows = _inputs(df, id_col, text_col, source_col, lang_col, size_col)
    scored = rows.select("id", pandas_udf(run, "score double, text_score double, metadata_score double")(*_FIELDS).alias("s"))
    return scored.select(F.col("id").alias(id_col), "s.score", (F.col("s.score") >= threshold).alias("keep"), "s.text_score", "s.metadata_score")
