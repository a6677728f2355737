"""Structured Streaming: stateless scoring and one-step-per-micro-batch online logistic."""

import tempfile

from pyspark.sql import functions as F

from tessera.streaming.online import EVENT_SCHEMA, online_logistic, score_stream

SF = "/root/testdata/sf0.001"


def _stream_source(spark, tmp):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    src = f"{tmp}/events"
    ev.repartition(3).write.mode("overwrite").parquet(src)   # several files → several rows per batch
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src), ev.count()


def test_score_stream(spark):
    tmp = tempfile.mkdtemp(prefix="tessera-stream-")
    stream, n = _stream_source(spark, tmp)
    q = (score_stream(stream, [0.1, 0.2, -0.3]).writeStream.format("memory").queryName("scored_events")
         .option("checkpointLocation", f"{tmp}/ck1").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.sql("SELECT * FROM scored_events")
    assert out.count() == n
    assert out.where((F.col("probability") < 0) | (F.col("probability") > 1)).count() == 0


def test_online_logistic_versions(spark):
    tmp = tempfile.mkdtemp(prefix="tessera-online-")
    stream, _ = _stream_source(spark, tmp)
    q = online_logistic(stream, f"{tmp}/model", 0.5, f"{tmp}/ck2")
    q.awaitTermination()
    m = spark.read.parquet(f"{tmp}/model")
    versions = sorted(r[0] for r in m.select("batch_id").distinct().collect())
    assert len(versions) == 3
    assert m.where(F.col("batch_id") == versions[-1]).count() == 3
