"""Structured Streaming forms of the online-learning idea.

* ``score_stream`` (Z2): stateless scoring of arriving rows with a fixed logistic model —
  one projection on the stream.
* ``online_logistic`` (Z1): one mini-batch gradient-ascent step per micro-batch inside
  ``foreachBatch``. The model is a small versioned table (batch_id, index, weight) in a
  shared folder; a batch reads the newest version below its id and writes its own version
  with overwrite of that id only, so a replayed batch (after a failure) recomputes the same
  weights — the sink is idempotent.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import logistic as LG

EVENT_SCHEMA = ("event_id long, ts timestamp, user_id long, event_type string, value double, "
                "props string")


def event_features(df: DataFrame) -> tuple[list, F.Column]:
    """Features 1, value/100, hour/24 and label +1 for purchases, −1 otherwise."""
    feats = [F.lit(1.0), F.col("value") / 100.0, F.hour("ts") / 24.0]
    label = F.when(F.col("event_type") == "purchase", 1).otherwise(-1)
    return feats, label


def score_stream(stream: DataFrame, weights) -> DataFrame:
    feats, _ = event_features(stream)
    m = LG.margin(weights, [f.cast("double") for f in feats])
    return stream.select("event_id", m.alias("margin"), LG.sigmoid(m).alias("probability"),
                         F.when(m > 0, 1).otherwise(-1).alias("prediction"))


def versions(spark: SparkSession, model_dir: str) -> list[int]:
    """Model versions in the folder, asked of its own file system (any URI)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(model_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def _latest_weights(spark: SparkSession, model_dir: str, below: int, d: int) -> np.ndarray:
    """Weights of the newest version below a batch; zeros before the first. Only that version's
    partition is read. A folder that can't be read raises."""
    earlier = [v for v in versions(spark, model_dir) if v < below]
    if not earlier:
        return np.zeros(d)
    m = spark.read.schema("index bigint, weight double").parquet(f"{model_dir}/batch_id={earlier[-1]}")
    return np.array([r["weight"] for r in m.orderBy("index").collect()])


def compact(spark: SparkSession, model_dir: str, keep: int) -> None:
    """Delete all versions but the newest ``keep``. A replayed batch needs the version before it, so
    keep at least two while a query runs."""
    root = spark._jvm.org.apache.hadoop.fs.Path(model_dir)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for v in versions(spark, model_dir)[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{model_dir}/batch_id={v}"), True)


def online_logistic(stream: DataFrame, model_dir: str, step: float, checkpoint: str,
                    trigger_once: bool = True, keep: int | None = None):
    """Start the online-learning query; returns the StreamingQuery. With ``keep`` (two or more) older
    model versions are deleted as new ones come."""
    spark = stream.sparkSession

    def step_batch(batch: DataFrame, batch_id: int) -> None:
        feats, label = event_features(batch)
        d = len(feats)
        w = _latest_weights(spark, model_dir, batch_id, d)
        g, _ = LG.gradient_and_loglik(batch, feats, label, w)
        n = batch.count()
        if n == 0:
            return
        w = w + step / n * g
        out = spark.createDataFrame([(int(batch_id), i, float(v)) for i, v in enumerate(w)],
                                    "batch_id bigint, index bigint, weight double")
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(model_dir))
        if keep is not None:
            compact(spark, model_dir, max(keep, 2))

    w = stream.writeStream.foreachBatch(step_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
