
from conftest import SF_SMALL
from tastemap.operators.popularity import popularity_scores
from tastemap.session import scratch_path
from tastemap.sources.interactions import interactions
from tastemap.streaming import popularity_stream
from tastemap.streaming.popularity import latest_snapshot


def test_stream_equals_batch(spark):
    rows = interactions(spark, SF_SMALL).filter("rating != 0").select("user_id", "item_id")
    src = scratch_path(spark, "stream-src")
    rows.repartition(4).write.parquet(src)
    q = popularity_stream(spark, src, "user_id LONG, item_id LONG", scratch_path(spark, "stream-ckpt"),
                          sink="memory", max_files_per_trigger=1)
    try:
        q.processAllAvailable()
        got = spark.sql("SELECT item_id, score FROM popularity_scores")
        want = popularity_scores(rows)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        q.stop()


def test_stream_snapshot_sink(spark):
    rows = interactions(spark, SF_SMALL).filter("rating != 0").select("user_id", "item_id")
    src, out = scratch_path(spark, "stream-src2"), scratch_path(spark, "stream-out")
    rows.repartition(3).write.parquet(src)
    q = popularity_stream(spark, src, "user_id LONG, item_id LONG", scratch_path(spark, "stream-ckpt2"),
                          output_path=out)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = latest_snapshot(spark, out)
    want = popularity_scores(rows)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
