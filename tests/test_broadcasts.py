"""Rows that grow are never broadcast because their file is small; plans are those made before anything is measured."""

import os

import pytest

from factline.operators import evidence
from factline.operators.relational import drop_contained, phrase_match
from factline.plans import eligibility, regions
from tests.test_eligibility import RAW, places, row

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, rows, schema):
    path = f"file://{tmp_path}/{len(rows)}-{len(schema)}"
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def test_phrases_and_texts(spark, tmp_path):
    texts = stored(spark, tmp_path, [(1, "new jersey or jersey"), (2, "x")], "id long, text string")
    phrases = spark.createDataFrame([("jersey",), ("new jersey",)], "phrase string")
    found = phrase_match(texts, "text", phrases, "phrase", "id")
    assert "BroadcastExchange" not in plan(found)
    assert {(r.id, r.phrase, r.n_matches) for r in found.collect()} == {(1, "jersey", 2), (1, "new jersey", 1)}
    matches = stored(spark, tmp_path, [(1, "jersey", "JE"), (1, "new jersey", "US"), (2, "mexico", "MX")], "id long, phrase string, code string")
    left = drop_contained(matches, ["id"], "phrase", "code")
    assert "BroadcastExchange" not in plan(left)
    assert {tuple(r) for r in left.collect()} == {(1, "new jersey", "US"), (2, "mexico", "MX")}


def test_group_mentions(spark, tmp_path):
    rows = stored(spark, tmp_path, [row("union", "EU and Latin America"), row("none", "x")], RAW)
    p = places(spark)
    found = evidence.group_text_match(evidence.prepare_texts(rows), p.groups).select("evidence_id", "group_code")
    assert "BroadcastExchange" not in plan(found)
    assert {tuple(r) for r in found.collect()} == {("union", "EU"), ("union", "LATAM")}


def test_every_step_of_a_resolution(spark, tmp_path, monkeypatch):
    onsite = {"role": "JOB_LOCATION", "remote": "ONSITE", "can": None, "subject": "u"}
    cases = [row("je", "JE", path="$.jobLocation.address.addressCountry", **onsite), row("helped", "St Helier, Jersey", subject="u"), row("anywhere", "Anywhere", platform="LEVER", path="$.jobLocation.name", **onsite)]
    raw = stored(spark, tmp_path, cases, RAW)
    seen = {}
    write = eligibility.write_shared

    def spied(df, label):
        seen.setdefault(label, []).append(plan(df))
        return write(df, label)

    monkeypatch.setattr(eligibility, "write_shared", spied)
    p = places(spark)
    found = eligibility.resolve(raw, p)
    for name in ("distrusted", "conflicts", "regions", "countries", "groups", "evidence"):
        seen.setdefault(name, []).append(plan(getattr(found, name)))
    seen["eligibility"] = [plan(evidence.rollup_eligibility(found.evidence, p.members))]
    assert {"evidence", "atomic", "context", "distrusted", "named", "conflicts", "regions", "countries", "groups", "matched", "eligibility"} == set(seen)
    assert [name for name, plans in seen.items() if any("BroadcastExchange" in x for x in plans)] == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_customers_of_the_queries(spark):
    made = plan(regions.raw_evidence(lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")))
    assert "SortMergeJoin [o_custkey" in made and "BroadcastHashJoin [o_custkey" not in made
