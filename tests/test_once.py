"""Lines are parsed once, and streams read what was landed once."""

import datetime as dt

from factline.sources import landing
from factline.streaming import receipts, upserts


def test_a_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,amount, note\n1,2,x\n \n3,n/a,y\n4\n")
    rows = landing.read_csv_lines(spark, f"file://{tmp_path}/in")
    contract = {"id": ("bigint", True), "amount": ("bigint", True), "note": ("string", False)}
    valid, rejected = landing.validate_contract(rows, contract, fail_on_reject=False, at=("_line",))
    assert valid._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
    assert [tuple(r) for r in valid.collect()] == [(2, 1, 2, "x")]
    assert sorted((r._line, r._errors) for r in rejected.collect()) == [(4, ["amount is no bigint"]), (5, ["amount is required"])]


def _read(query):
    query.awaitTermination(300)
    return sum(p["numInputRows"] for p in query.recentProgress)


def test_streams_read_rows_once(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(i % 5, str(i % 3), at + dt.timedelta(hours=i)) for i in range(40)], "publication_id long, status string, received_at timestamp").write.parquet(f"file://{tmp_path}/in")
    source = lambda: spark.readStream.schema("publication_id long, status string, received_at timestamp").parquet(f"file://{tmp_path}/in")
    assert _read(upserts.stream_upsert(source(), f"file://{tmp_path}/u", f"file://{tmp_path}/uc", ["publication_id"], ["received_at"])) == 40
    assert _read(receipts.stream_receipts(source(), f"file://{tmp_path}/r", f"file://{tmp_path}/rc", "10 days")) == 40
