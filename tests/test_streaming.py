"""The streamed week sums are those of the batch."""

from ledgerlens.streaming.weekly import week_sums

D = "/root/testdata/sf0.001"


def test_week_sums(spark, tmp_path):
    batch = spark.read.parquet(f"{D}/events.parquet").selectExpr("cast(ts as timestamp) ts", "user_id", "value")
    batch.write.parquet(str(tmp_path / "in"))
    q = week_sums(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("weeks").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    key = lambda df: sorted((r.user_id, str(r.week), round(r.amount, 6), r.cnt) for r in df.collect())
    assert key(spark.table("weeks")) == key(week_sums(batch))
