"""The corpus pipeline, stage by stage, against brute force."""

import itertools
import os
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "exact_dedup", "near_dedup", "mixing", "bpe"]
    identified = stages["language"](spark, docs, DATA)
    texts = {r.doc_id: r.text for r in identified.collect()}
    assert identified.columns == columns and len(texts) >= 0.98 * docs.count()
    once = stages["exact_dedup"](spark, identified, DATA)
    best = {}
    for i, t in texts.items():
        best[t] = max(best.get(t, i), i)
    assert once.columns == columns and {r.doc_id for r in once.collect()} == set(best.values())
    near = stages["near_dedup"](spark, once, DATA)
    assert near.columns == columns
    # Of texts with a Jaccard index of 0.8 of five-word shingles one stays, and what is like no other stays.
    sets = {}
    for r in once.collect():
        words = (r.text or "").lower().split()
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}
    index = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sets, 2)}
    stays = {r.doc_id for r in near.collect()}
    assert all(a not in stays or b not in stays for (a, b), j in index.items() if j >= 0.9)
    alike = {x for pair, j in index.items() if j >= 0.6 for x in pair}
    assert stays >= set(sets) - alike and len(stays) < len(sets)
    mixed = stages["mixing"](spark, near, DATA)
    copies = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == columns and max(copies.values()) <= 3
    encoded = stages["bpe"](spark, mixed, DATA).collect()
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    assert Counter(r.doc_id for r in encoded) == copies and all(r.round_trip for r in encoded)
    for r in encoded[:50]:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run_repeats_itself(spark):
    a, b = (Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, DATA).collect()) for _ in range(2))
    assert a == b and a
