"""The trie of prefixes and its roll-up against plain loops."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from factline.llm import queries, trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(convs):
    """Rows of the trie of conversations {id: [(role, text), ...]}."""
    members = {}
    for c, said in convs.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
    name = {p: (min(m), len(p)) for p, m in members.items()}
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved, out = Counter(), Counter(), []
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.append((*name[p], name[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def _ordered(rows):
    convs = {}
    for c, _, role, text in sorted((x for x in rows if x[0] is not None), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", hashlib.md5((x[3] or "").encode()).hexdigest())):
        convs.setdefault(c, []).append((role or "", text or ""))
    return convs


def _rows(seed):
    r = random.Random(seed)
    rows = []
    for c in (0, 1, 2, 7, 99, 100, 101, 150, 333, 334, 10_001, 10_002, *range(500, 540)):
        own = [(c, t, r.choice(["user", "assistant", None]), r.choice([None, "", "a", "bé🙂", "long text"])) for t in range(r.randint(1, 9))]
        rows += own
    rows += [(3, None, "user", "null turn"), (3, 1, "user", "twice"), (3, 1, "user", "twice"), (None, 1, "user", "nobody's"), (600, 0, "us", "er"), (601, 0, "use", "r")]
    return rows


def _found(spark, rows, heads=True):
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "conv_id long, turn long, role string, text string, m long, top long").repartition(4)
    turns = trie.ordered_turns(df)
    args = trie.with_shared_heads(turns) if heads else (turns, turns.groupBy(turns.conv).agg({"rank": "max"}).toDF("conv", "length"))
    return Counter(map(tuple, trie.prefix_trie(*args).select(*COLUMNS).collect()))


def test_shared_heads(spark):
    rows = _rows(1)
    assert _found(spark, rows) == plain_trie(rebuilt(_ordered(rows)))


def test_split_by_joins(spark, monkeypatch):
    """Long chains, combs and bushes, whose components are split by several rounds of joins."""
    monkeypatch.setattr(trie, "LOCAL", 4)
    monkeypatch.setattr(trie, "NODES", 16)
    monkeypatch.setattr(trie, "PIECE", 3)
    r = random.Random(4)
    convs = {i: [("user", "a")] * (i + 1) for i in range(30)}  # a comb of ever longer conversations
    convs |= {100 - i: [("user", "b")] * (i + 1) for i in range(20)}
    convs |= {200 + i: [("user", r.choice("xyz")) for _ in range(r.randint(1, 6))] for i in range(60)}
    convs |= {300: [("user", str(i)) for i in range(90)], 301: [("user", str(i)) for i in range(50)] + [("user", "other")] * 40}
    convs |= {-5: [("user", "a")] * 3} | {400 + i: [("user", "a"), ("user", "q")] for i in range(20)}
    rows = [(c, t, *x) for c, said in convs.items() for t, x in enumerate(said)]
    assert _found(spark, rows, heads=False) == plain_trie(convs)


@pytest.mark.parametrize("seed", range(30))
def test_centroids(seed):
    r = random.Random(seed)
    n = r.randint(1, 300)
    parent = [-1 if r.random() < 0.02 or not i else (i - 1 if seed % 3 == 0 and r.random() < 0.95 and i else r.randrange(max(0, i - r.choice([1, 5, 300])), i)) for i in range(n)]
    values = np.array([[r.randint(0, 9), r.randint(0, 1000)] for _ in range(n)])
    expected = values.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            expected[parent[i]] += expected[i]
    assert (trie.centroid_sums(np.array(parent), values) == expected).all()


def test_no_turns_and_empty(spark):
    assert _found(spark, []) == Counter()
    rows = [(101, 0, "user", "x")]  # no conversation 100, and its own turn may be replaced
    assert _found(spark, rows) == plain_trie(rebuilt(_ordered(rows)))
    rows = [(c, 0, "user", "x") for c in range(101, 140)]
    assert _found(spark, rows) == plain_trie(rebuilt(_ordered(rows)))


def test_conversations(spark):
    """The whole table, by plain loops and by SQL."""
    folder = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = Counter(map(tuple, queries.op11_trie(spark, folder).select(*COLUMNS).collect()))
    assert found == plain_trie(rebuilt(_ordered(rows)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet')")
    result = con.execute(queries.ORACLE_SQL["op11_trie"])
    assert [d[0] for d in result.description] == COLUMNS
    assert Counter(result.fetchall()) == found
