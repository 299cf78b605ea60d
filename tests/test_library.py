"""Golden cases of expressions and table operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from factline.functions import text, typed
from factline.operators import incremental, publication, relational
from factline.sources import landing
from factline.streaming.upserts import stream_upsert


def values(spark, col, kind, items):
    return [r[0] for r in spark.createDataFrame([(x,) for x in items], f"x {kind}").select(col).collect()]


def test_share_fraction(spark):
    got = values(spark, typed.share_fraction(F.col("x")), "string", [None, "1/2", "1/0", "3/2", "a/b", "1/2/3"])
    assert [None if x is None else float(x) for x in got] == [1.0, 0.5, None, None, None, None]


def test_clean_text_trims_unicode_space(spark):
    assert values(spark, text.clean_text(F.col("x"), "upper"), "string", ["  ab\t", "  ", None]) == ["AB", None, None]


def test_fold_text(spark):
    assert values(spark, text.fold_text(F.col("x")), "string", ["Straße—Ⅳ", "Éa, b", None]) == ["strasse iv", "éa b".replace("́", " "), None]


def test_strip_suffix(spark):
    got = values(spark, text.strip_suffix(F.col("x"), F.lit("Acme")), "string", ["Engineer - ACME", "Dev | Acme – acme", "Acme", None])
    assert got == ["Engineer", "Dev", "Acme", None]


def test_employment(spark):
    got = values(spark, text.normalize_employment(F.col("x")), "array<string>", [["Full-time", "Contract or full time"], ["other"], None])
    assert got == [["CONTRACTOR", "FULL_TIME"], [], []]
    assert values(spark, text.normalize_employment(F.col("x")), "array<string>", [["International staff", "Contemporary art", "Contractor", None]]) == [["CONTRACTOR"]]


def test_json_fields(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": 2}, "d": [1]}',), ("broken",), (None,)], "p string")
    got = typed.json_fields(df, "p", {"a": ("$.a", "int"), "b": ("$.b", "string"), "c": ("$.b.c", "string"), "d": ("$.d", "string")})
    assert [tuple(r)[1:] for r in got.collect()] == [(1, None, "2", None), (None,) * 4, (None,) * 4]


def test_phrase_match_counts_whole_words(spark):
    texts = spark.createDataFrame([(1, "new jersey or jersey jersey"), (2, "jerseys"), (3, None), (4, "")], "id int, t string")
    phrases = spark.createDataFrame([("jersey",), ("new jersey",), ("",), (None,)], "p string")
    got = {(r.id, r.p): r.n_matches for r in relational.phrase_match(texts, "t", phrases, "p", "id").collect()}
    assert got == {(1, "jersey"): 3, (1, "new jersey"): 1}


def test_drop_contained(spark):
    m = spark.createDataFrame([(1, "jersey", "JE"), (1, "new jersey", "US"), (2, "jersey", "JE")], "id int, phrase string, code string")
    assert {(r.id, r.code) for r in relational.drop_contained(m, ["id"], "phrase", "code").collect()} == {(1, "US"), (2, "JE")}


def test_snapshot_marks_what_is_gone_and_refuses_twins(spark):
    first = incremental.apply_snapshot(None, spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), F.lit("t1"))
    then = incremental.apply_snapshot(first, spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string"), F.lit("t2"))
    assert {(r.id, r.v, r._inserted_at, r._is_deleted) for r in then.collect()} == {(1, "a", "t1", True), (2, "c", "t1", False), (3, "d", "t2", False)}
    with pytest.raises(ValueError):
        incremental.apply_snapshot(None, spark.createDataFrame([(1,), (1,)], "id int"), F.lit("t"))


def test_replay_changes_nothing(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 7, None), (2, 1, "c"), (None, 9, "x")], "k int, ts int, v string")
    state = incremental.latest_per_key(rows, ["k"], ["ts"])
    assert {(r.k, r.v) for r in state.collect()} == {(1, None), (2, "c")}
    assert incremental.changed_keys(rows, state, ["k"], "ts").where("k = 1").isEmpty()
    assert incremental.changed_rows(state, state, ["k"], ["v"]).isEmpty()


def test_schemas(spark):
    schema = spark.createDataFrame([], "a int, b string").schema
    assert incremental.reconcile_schema(schema, spark.createDataFrame([], "a int, c date").schema).names == ["a", "b", "c"]
    with pytest.raises(ValueError):
        incremental.reconcile_schema(schema, spark.createDataFrame([], "a string").schema)


def test_expiry_of_dates_and_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), True), (dt.datetime(2024, 1, 1), False), (None, True)], "v timestamp_ntz, d boolean")
    got = df.select(publication.not_expired(F.col("v"), F.col("d"), F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))).collect()
    assert [r[0] for r in got] == [True, False, True]


def test_landing_and_contract(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    assert not landing.is_complete(spark, f"file://{tmp_path}", "r1")
    landing.write_landing(df, f"file://{tmp_path}", "r1", 1)
    assert landing.read_landing(spark, f"file://{tmp_path}", "r1", df.schema).count() == 2
    with pytest.raises(ValueError):
        landing.read_landing(spark, f"file://{tmp_path}", "r2", df.schema)
    raw = spark.createDataFrame([("row-1", "10.5", "true"), ("row-2", "", "0"), (" ", None, "")], "id string, amount string, is_active string")
    contract = {"id": ("string", True), "amount": ("double", False), "is_active": ("boolean", True)}
    valid, rejected = landing.validate_contract(raw, contract)
    assert [tuple(r) for r in valid.collect()] == [("row-1", 10.5, True), ("row-2", None, False)] and rejected.isEmpty()


def test_stream_upsert(spark, tmp_path):
    source, target, check = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    for batch in ([(1, 1, "a"), (2, 5, "b")], [(1, 3, "c"), (2, 4, "late")]):
        spark.createDataFrame(batch, "k int, ts int, v string").write.mode("append").json(source)
        stream_upsert(spark.readStream.schema("k int, ts int, v string").json(source), target, check, ["k"], ["ts"]).awaitTermination(120)
    assert {(r.k, r.v) for r in incremental.load_snapshot(spark, target).collect()} == {(1, "c"), (2, "b")}


def test_drop_contained_against_all_pairs(spark):
    phrases = ["a", "b", "a b", "b a", "a b a", "a a", "c", "b c", "a b c", " a", "", "a  b", None]
    data = [(k, p, c) for i, p in enumerate(phrases) for k in (1, 2, None) for c in ("X", "Y", None) if (i + (k or 0) + ord((c or "Z")[0])) % 3]
    m = spark.createDataFrame(data + data[:5], "id int, phrase string, code string").withColumn("__n", F.lit(1))

    def dropped(k, p, c):
        return None not in (k, p, c) and any(k == k2 and q is not None and d is not None and d != c and len(q) > len(p) and f" {p} " in f" {q} " for k2, q, d in data)

    want = [r for r in data + data[:5] if not dropped(*r)]
    got = relational.drop_contained(m, ["id"], "phrase", "code")
    assert got.columns == m.columns and 0 < len(want) < len(data)
    assert sorted(map(repr, ((r.id, r.phrase, r.code) for r in got.collect()))) == sorted(map(repr, want))


def test_positions_of_a_large_group_have_no_gap_and_follow_keys(spark):
    rows = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 100 == 99, None).when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(50).alias("g"))
    none = spark.createDataFrame([], "k long, g long, position long, bucket int")
    old = publication.assign_buckets(rows.where("k % 2 = 0"), none, "k", "g")
    got = {r.k: (r.g, r.position) for r in publication.assign_buckets(rows, old, "k", "g").collect()}
    groups: dict = {}
    for k, g in sorted(rows.collect(), key=lambda r: (r.k % 2, r.k)):
        groups.setdefault(g, []).append(k)
    want = {k: (g, i) for g, ks in groups.items() for i, k in enumerate(ks, 1)}
    null_group = {k: (g, i) for g, ks in groups.items() if g is None for part in (0, 1) for i, k in enumerate([x for x in ks if x % 2 == part], 1)}
    assert got == want | null_group
    assert publication.assign_buckets(rows.limit(0), none, "k", "g").count() == 0


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    """Files of several blocks and tasks, with blank lines, against reading them whole."""
    files = {}
    for i in range(4):
        lines = [f"line {j} " + "x" * (j * 7 % 90) if j % 5 else "" for j in range(200 * i)]
        (tmp_path / f"f{i}.txt").write_text("".join(x + "\n" for x in lines))
        files[f"f{i}.txt"] = lines
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = {(r.file.rsplit("/", 1)[-1], r.line): r.text for r in landing.read_numbered(spark, f"file://{tmp_path}").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {(f, n): x for f, lines in files.items() for n, x in enumerate(lines, 1)}


def test_a_broken_contract_names_file_and_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,amount\n1,2\n\n2,"x, y"\n3,many\n')
    rows = landing.read_csv_lines(spark, f"file://{tmp_path}")
    contract = {"id": ("int", True), "amount": ("double", False)}
    with pytest.raises(ValueError, match=r"_file file:.*a.csv, _line 4: \['amount is no double'\]"):
        landing.validate_contract(rows, contract, at=("_file", "_line"))
    valid, rejected = landing.validate_contract(rows, contract, fail_on_reject=False, at=("_line",))
    assert [tuple(r) for r in valid.collect()] == [(2, 1, 2.0)] and {r._line for r in rejected.collect()} == {4, 5}
    (tmp_path / "b.csv").write_text("id,other\n")
    with pytest.raises(ValueError, match="kinds of columns"):
        landing.read_csv_lines(spark, f"file://{tmp_path}")


def test_closures_and_job_scopes(spark):
    rows = [("CLOSED", "UNKNOWN"), ("TERMINAL", "TERMINAL"), ("TERMINAL", "CLOSED"), (None, None), ("CLOSED", None)]
    got = spark.createDataFrame(rows, "a string, b string").select(publication.closure_reason(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == ["LIFECYCLE_CLOSED", "LIFECYCLE_TERMINAL_CONFIRMED", None, None, "LIFECYCLE_CLOSED"]
    assert incremental.target_ready(spark.range(1), ["id"]) and not incremental.target_ready(spark.range(1), ["id", "x"])
