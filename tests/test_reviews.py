"""Reviews meet rows of any width without sorting or broadcasting them."""

from pyspark.sql import functions as F

from factline.operators import publication


def test_rows_stream_past_hashed_reviews(spark, tmp_path):
    path = f"file://{tmp_path}/reviews"
    spark.createDataFrame([(1, 1, "approved"), (1, 2, "held"), (2, 1, "approved"), (None, 9, "held")], "id long, seen int, review_status string").write.parquet(path)
    reviews = spark.read.schema("id long, seen int, review_status string").parquet(path)
    rows = spark.range(1, 5).withColumn("text", F.repeat(F.lit("x"), F.lit(1000))).withColumn("closed", F.when(F.col("id") == 4, "LIFECYCLE_CLOSED"))
    found = publication.apply_reviews(rows, reviews, "id", [("NONE", F.col("id") > 0)], F.col("closed"), F.lit(False), updated="seen")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "BroadcastExchange" not in plan
    assert {(r.id, r.review_status, r.publication_status, r.reason, len(r.text)) for r in found.collect()} == {
        (1, "held", "NOT_PUBLISHABLE", "PUBLICATION_REVIEW_HELD", 1000),
        (2, "approved", "PUBLISHABLE", "PUBLICATION_READY", 1000),
        (3, None, "PUBLISHABLE", "PUBLICATION_READY", 1000),
        (4, None, "CLOSED", "LIFECYCLE_CLOSED", 1000),
    }
