"""Streams against the batch result: late, repeated and out-of-order rows, ties, growing tables and two writers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from factline.operators import incremental, publication
from factline.sources.storage import create_file
from factline.streaming import receipts, upserts

ROW = "k int, ts int, v string"


def _upsert(spark, tmp_path, batch, **options):
    source, target, check = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    spark.createDataFrame(batch, ROW).coalesce(1).write.mode("append").json(source)
    upserts.stream_upsert(spark.readStream.schema(ROW).json(source), target, check, ["k"], ["ts"], **options).awaitTermination(300)
    return {(r.k, r.ts, r.v) for r in incremental.load_snapshot(spark, target).collect()}, incremental.current_parts(spark, target)


def _newest(rows):
    """One row of each key: those that are newest, of which any may stay."""
    best = {}
    for k, ts, v in rows:
        if k is not None:
            best.setdefault(k, {}).setdefault(ts, set()).add((k, ts, v))
    return {k: by[max(by, key=lambda t: (t is not None, t or 0))] for k, by in best.items()}


def test_parts_follow_the_table(spark, tmp_path):
    r = random.Random(1)
    rows = [(k, r.randint(1, 5), r.choice("abc")) for k in range(40)] + [(None, 1, "x")]
    state, parts = _upsert(spark, tmp_path, rows, part_rows=10)
    assert len(parts) >= 4 and {k for k, *_ in state} == set(range(40))
    more = [(k, r.choice([None, *range(8)]), r.choice("abc")) for k in range(200)] + rows[:20]
    state, grown = _upsert(spark, tmp_path, more, part_rows=10)
    assert len(grown) > len(parts)
    best = _newest(rows + more)
    assert len(state) == len(best) and all(row in best[row[0]] for row in state)
    one = [(7, 99, "only")]
    after, touched = _upsert(spark, tmp_path, one, part_rows=10)
    assert after == {x for x in state if x[0] != 7} | {(7, 99, "only")}
    assert len(touched) == len(grown) and len(set(touched) - set(grown)) == 1


def test_ties_and_replays(spark, tmp_path):
    rows = [(1, 5, "a"), (1, 5, "b"), (1, 5, None), (2, None, "x"), (2, None, "y")]
    first, _ = _upsert(spark, tmp_path, rows)
    for again in (rows[::-1], rows[2:], rows[:1], [(1, 4, "late")]):
        assert _upsert(spark, tmp_path, again)[0] == first
    target = f"file://{tmp_path}/out"
    known = incremental.current_parts(spark, target)
    spark.createDataFrame(rows, ROW).createOrReplaceTempView("replayed")
    assert incremental.current_parts(spark, target) == known


RECEIPT = "publication_id long, status string, received_at timestamp"


def test_receipts(spark, tmp_path):
    source, target, check = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    r = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    seen = []
    for batch in range(4):
        rows = [(r.randrange(12), r.choice(["APPLIED", "ACCEPTED", "FAILED"]), start + dt.timedelta(hours=r.randint(0, 60) + 10 * batch)) for _ in range(30)]
        rows += r.sample(seen, min(10, len(seen))) + [(None, "FAILED", start), (3, None, start), (3, "FAILED", None)] + [(99, "FAILED", start), (99, "APPLIED", start)]
        seen += [x for x in rows if None not in x]
        spark.createDataFrame(rows, RECEIPT).coalesce(1).write.mode("append").json(source)
        receipts.stream_receipts(spark.readStream.schema(RECEIPT).json(source), target, check, lateness="10 days").awaitTermination(300)
        want = {}
        for p, status, at in seen:
            want[p] = max(want.get(p, (at, status)), (at, status))
        assert {x.publication_id: (x.received_at, x.status) for x in receipts.received(spark, target).collect()} == want
        # The same question to the batch operator.
        for p in (0, 99, 555):
            control = spark.createDataFrame([(p, "READY", 1)], "publication_id long, status string, created_at int")
            batchwise = publication.verify_receipts(control, spark.createDataFrame(seen, RECEIPT).groupBy("publication_id").agg(F.max(F.struct("received_at", "status")).alias("r")).select("publication_id", "r.*"))
            assert receipts.unapplied(spark, control, target).count() == batchwise.count()


def test_too_late_receipts_are_dropped_and_state_is_bounded(spark, tmp_path):
    source, target, check = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
    query = None
    for rows in ([(1, "APPLIED", old)], [(2, "APPLIED", new)], [(3, "APPLIED", new)], [(1, "FAILED", old + dt.timedelta(hours=1)), (2, "FAILED", new + dt.timedelta(hours=1))]):
        spark.createDataFrame(rows, RECEIPT).coalesce(1).write.mode("append").json(source)
        query = receipts.stream_receipts(spark.readStream.schema(RECEIPT).json(source), target, check, horizon="7 days")
        query.awaitTermination(300)
    assert {x.publication_id: x.status for x in receipts.received(spark, target).collect()} == {1: "APPLIED", 2: "FAILED", 3: "APPLIED"}
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress) >= 1


def test_no_receipts(spark, tmp_path):
    control = spark.createDataFrame([(1, "READY", 1)], "publication_id long, status string, created_at int")
    assert receipts.received(spark, f"file://{tmp_path}/none") is None
    assert receipts.unapplied(spark, control, f"file://{tmp_path}/none").count() == 1


def test_two_writers(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    incremental.save_snapshot(spark.range(3).toDF("k"), path)
    assert create_file(spark, f"{path}/_claims/v={1:012d}")  # another writer is at it
    with pytest.raises(ValueError, match="another writer"):
        incremental.save_snapshot(spark.range(9).toDF("k"), path)
    assert incremental.load_snapshot(spark, path).count() == 3
    incremental.drop_claims(spark, path)
    incremental.save_snapshot(spark.range(9).toDF("k"), path)
    assert incremental.load_snapshot(spark, path).count() == 9
    with pytest.raises(ValueError, match="rebuilt"):
        incremental.save_snapshot(spark.range(1).toDF("k"), path, protected=True, full_refresh=True)


def test_bootstrap_and_materialize(spark, tmp_path):
    path = f"file://{tmp_path}/m"
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    then = spark.createDataFrame([(2, "c", 1), (3, "d", 2)], "k int, v string, more int")
    assert not incremental.target_ready(None, ["k"])
    made = incremental.materialize(first, "incremental", path, ["k"])
    assert incremental.target_ready(made, ["k", "v"]) and not incremental.target_ready(made, ["more"])
    for _ in range(2):
        grown = incremental.materialize(then, "incremental", path, ["k"])
        assert {tuple(r) for r in grown.select("k", "v", "more").collect()} == {(1, "a", None), (2, "c", 1), (3, "d", 2)}
    assert incremental.target_ready(grown, ["more"])
    assert incremental.materialize(first, "view", "some_view").count() == 2 and spark.table("some_view").count() == 2
    assert incremental.materialize(first, "table", path).count() == 2
    with pytest.raises(ValueError, match="no such mode"):
        incremental.materialize(first, "other", path)
