"""Alignment of two tokenizers against their libraries and plain loops."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from factline.llm import alignment
from factline.llm.bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "b", "the", " ", "  ", "\n", "\r", "\t", "é", "ü", "漢", "　", " ", "▁", "'s", "<|endoftext|>", "</s>", "<0x0A>", "1", "23", ".", ";", "\x00", "\x1f", "\x85", "🙂", "{\r\n"]


@pytest.fixture(scope="module")
def plain():
    """Groups of a text, by the libraries and the sets of their ends; None without tokens."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = byte_letters()

    def groups(text):
        if not text:
            return None
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        raw_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        raw_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return None
        ends = []
        for raw in (raw_a, raw_b):
            at = 0
            ends.append([at := at + len(x) for x in raw])
        out, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            m, n = ends[0].index(end) + 1, ends[1].index(end) + 1
            out.append((a[i:m], b[j:n]))
            i, j = m, n
        return out

    return groups


def _texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 40))) for _ in range(n)] + ["", " ", "\n", "  x ", " a", "a ", "\nx", "▁"]


def _word(groups):
    return ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups or [])


def test_groups(plain):
    texts = _texts(3000, 1)
    found = alignment.aligner(A, B).align(texts)
    expected = [plain(t) for t in texts]
    assert found.texts() == [_word(g) for g in expected]
    assert found.counts["n_links"].tolist() == [sum(len(a) * len(b) for a, b in g or []) for g in expected]


@pytest.mark.parametrize("seed", range(20))
def test_diagonals(seed):
    """Long one-to-one stretches, shifts to both sides, and groups with as many tokens on either side."""
    r = random.Random(seed)
    a, b, at, expected = [], [], 0, []
    for _ in range(r.randint(1, 30)):
        for _ in range(r.choice([0, 1, 2, 7, 100])):
            at += r.randint(1, 4)
            expected.append(([at], [at]))
        own = [sorted(r.sample(range(at + 1, at + 9), k)) for k in (r.randint(0, 3), r.randint(0, 3))]
        both = set(own[0]) & set(own[1])
        own = [[x for x in o if x not in both] + [at + 9] for o in own]
        at += 9
        expected.append(tuple(own))
    for x, y in expected:
        a += x
        b += y
    found = []
    for i, j, m, n in alignment.diagonal_groups(a, b):
        found += [(a[i + k : i + k + 1], b[j + k : j + k + 1]) for k in range(m)] if m == n else [(a[i : i + abs(m)], b[j : j + n])]
    assert found == expected


def test_small_cache(plain, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE", 16)
    own, texts = alignment.Aligner(A, B), _texts(200, 2)
    for at in range(0, 200, 20):
        assert own.align(texts[at : at + 20]).texts() == [_word(plain(t)) for t in texts[at : at + 20]]


def _votes(rows, plain):
    found = [(i, plain(t)) for i, t in rows]
    links = [Counter((x, y) for a, b in g or [] for x in a for y in b) for _, g in found]
    counts = Counter(p for x in links for p in x)
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (i, g), x in zip(found, links, strict=True):
        g = g or []
        best = sum(n for p, n in x.items() if counts[p] == most[p[0]])
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(x.values()), best, sum(n * counts[p] for p, n in x.items()), hashlib.sha256(_word(g).encode()).hexdigest() if g else ""))
    return Counter(out)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_votes_of_documents(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = alignment.link_votes(docs, A, B)
    assert Counter(map(tuple, found.select(*COLUMNS).collect())) == _votes([(r.doc_id, r.text) for r in docs.collect()], plain)


def test_votes_of_odd_rows(spark, plain, monkeypatch):
    """Nulls, repeated ids and texts, several chunks and tasks of a bucket, clashing names."""
    monkeypatch.setattr(alignment, "SPREAD", 2)
    rows = [(i % 70 or None, t) for i, t in enumerate(_texts(300, 3) + [None, "the same text"] + ["the same text"] * 50)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, chunk int, bucket string").repartition(6)
    assert Counter(map(tuple, alignment.link_votes(docs, A, B).select(*COLUMNS).collect())) == _votes(rows, plain)


def test_empty_and_arrays(spark, plain):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.link_votes(docs, A, B).collect() == []
    docs = spark.createDataFrame([(1, "Hello\nthere"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in alignment.align_texts(docs, A, B).collect()}
    assert found == {1: plain("Hello\nthere"), 2: []}
