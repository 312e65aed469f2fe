from pyspark.sql import functions as F

from stripweave.operators import tracking
from stripweave.streaming import streams

DDL = "video string, side string, bag_id long, frame_index int, timestamp_seconds double, bag_index_in_frame int, center_norm double, quality_score double, segment_confidence double, descriptor array<float>"


def test_streamed_tracks_are_the_batch_tracks(spark, tmp_path):
    rows = [(v, "pill_side", 100 * k + i, i, i * 0.4, 0, 0.5, 0.1 * i, 0.5, [1.0, 0.1 * i]) for k, v in enumerate(("a", "b")) for i in range(6)]
    for part in range(3):
        spark.createDataFrame([r for r in rows if r[3] // 2 == part], DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = streams.tracked(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    key = lambda r: (r.bag_id, r.track_key, round(r.track_match_score, 9), r.is_best)
    batch = tracking.track(spark.createDataFrame(rows, DDL))
    assert sorted(map(key, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(key, batch.collect()))


def test_first_sightings_and_rates(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "2026-01-01 00:00:00", "v", 0.2), ("s1", "2026-01-01 00:00:10", "v", 0.4), ("s2", "2026-01-01 00:01:00", "v", 0.6)], "signature string, t string, video string, quality_score double")
    rows.select("signature", F.col("t").cast("timestamp").alias("seen_at"), "video", "quality_score").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("signature string, seen_at timestamp, video string, quality_score double").parquet(str(tmp_path / "in"))
    for name, frame, mode in (("first", streams.first_sightings(stream), "append"), ("rate", streams.quality_by_minute(stream.withColumnRenamed("seen_at", "captured_at")), "complete")):
        query = frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
    assert {r.signature for r in spark.table("first").collect()} == {"s1", "s2"} and spark.table("first").count() == 2
    assert sorted((round(r.mean_quality, 6), r.n) for r in spark.table("rate").collect()) == [(0.3, 2), (0.6, 1)]


def test_dead_letters(spark):
    good, bad = streams.dead_letters(spark.createDataFrame([(1, None), (2, "boom")], "k int, error string"))
    assert [r.k for r in good.collect()] == [1] and [r.k for r in bad.collect()] == [2] and "error" not in good.columns
