"""Reply trees and formatted conversations against plain loops."""

import hashlib
import random
from collections import Counter

import duckdb
import pytest

from factline.llm import chat, queries

ODD = ["\\", "<turn>", "<text>", "</turn>", "\n", "\n</turn>\n", "\n<text>\n", "\\<turn>", "a", "é漢🙂", "", "x" * 50, "$1", "\\\\"]
SCHEMA = "tree long, node long, parent long, role string, text string, score double"


def _text(r):
    return "".join(r.choice(ODD) for _ in range(r.randint(0, 6)))


def _trees(seed, n=120):
    r = random.Random(seed)
    rows = []
    for tree in (None, *range(6)):
        nodes = []
        for _ in range(r.randint(1, n)):
            node = len(rows) * 7 % 100003
            parent = r.choice([None, 999_999] if not nodes else [*nodes[-3:], r.choice(nodes), None])
            nodes.append(node)
            rows.append((tree, node, parent, r.choice(["user", "assistant", None, _text(r)]), r.choice([None, _text(r)]), r.choice([None, 0.5, 1.0, -2.0])))
    return rows


def _branches(rows, best):
    by = {x[1]: x for x in rows}
    parents = {x[2] for x in rows}
    found = {}
    for x in rows:
        if x[1] not in parents:
            path, at = [], x
            while at:
                path.insert(0, at)
                at = by.get(at[2])
            found.setdefault(x[0], []).append((-sum(p[5] or 0 for p in path), x[1], path))
    return {leaf: (tree, rank, -score, path) for tree, own in found.items() for rank, (score, leaf, path) in enumerate(sorted(own, key=lambda b: b[:2]), 1) if best is None or rank <= best}


@pytest.mark.parametrize("best", [None, 2])
def test_trees(spark, monkeypatch, best):
    monkeypatch.setattr(chat, "BLOCK", 5)
    rows = _trees(5)
    deep = [(77, 500_000 + i, 500_000 + i - 1 if i else None, "assistant" if i % 2 else "user", f"turn {i}", 0.0) for i in range(70)]
    expected = _branches(rows + deep, best)
    df = chat.conversations(spark.createDataFrame(rows + deep, SCHEMA).repartition(5), best).withColumns({"whole": chat.formatted(), "loss": chat.loss_texts(), "said": chat.read_turns()})
    got = df.collect()
    assert {x.leaf for x in got} == set(expected) and len(got) == len(expected)
    for x in got:
        tree, rank, score, path = expected[x.leaf]
        assert (x.tree, x.rank, x.n_turns) == (tree, rank, len(path)) and abs(x.score - score) < 1e-9
        assert [tuple(t) for t in x.said] == [(p[3] or "", p[4] or "") for p in path]
        assert x.loss == [p[4] or "" for p in path if p[3] == "assistant"]
        plain = "".join(f"<turn>\n{_escaped(p[3])}\n<text>\n{_escaped(p[4])}\n</turn>\n" for p in path)
        assert x.whole == plain


def _escaped(text):
    text = (text or "").replace("\\", "\\\\")
    for mark in ("<turn>", "<text>", "</turn>"):
        text = text.replace(mark, "\\" + mark)
    return text


def test_conversations(spark):
    r = random.Random(2)
    rows = [(r.choice([None, *range(9)]), r.choice([None, *range(200)]), r.choice(["user", "assistant", None]), r.choice([None, _text(r)]), 1, 2, 3) for _ in range(300)]
    rows += [(0, 5, "user", "twice", 1, 2, 3)] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree long, node long, distance long").repartition(4)
    found = {x.tree: x for x in chat.read_back(chat.conversations(chat.turns(df))).collect()}
    groups = {}
    for x in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", hashlib.md5((x[3] or "").encode()).hexdigest())):
        groups.setdefault(x[0], []).append((x[2] or "", x[3] or ""))
    assert set(found) == set(groups)
    for k, said in groups.items():
        loss = "".join(t for role, t in said if role == "assistant")
        assert (found[k].n_turns, found[k].loss_chars) == (len(said), len(loss))
        assert found[k].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert found[k].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_empty_and_cycles(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.conversations(chat.turns(empty))).collect() == []
    with pytest.raises(ValueError, match="cycle"):
        chat.paths(spark.createDataFrame([(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0), (1, 3, 2, "user", "c", 0.0)], SCHEMA)).collect()


def test_native(spark, tmp_path):
    df = chat.conversations(chat.turns(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", [x for x in ("op11_trie", "op12_chat") if x in queries.ORACLE_SQL])
def test_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    found = queries.QUERIES[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet')")
    expected = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in expected.description]
    assert set(names) <= set(found.columns)
    assert Counter(map(tuple, found.select(*names).collect())) == Counter(expected.fetchall())
