"""Table sources: the parquet star schema, CSV, JSON word lists, and model tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Attribute access to the tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def read_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """Header + inferred types; handles CR-only line ends and quoted commas in headers."""
    reader = spark.read.option("header", True).option("inferSchema", True)
    reader = reader.option("multiLine", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of strings (one document) → one-column table ``word``."""
    from pyspark.sql import functions as F
    raw = spark.read.option("multiLine", True).text(path, wholetext=True)
    return (raw.select(F.explode(F.from_json("value", "array<string>")).alias("word"))
            .dropDuplicates(["word"]))


def write_model_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_model_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread rows over the cluster before CPU-heavy per-row work (tokenising, vector math).

    Only when the scan yields fewer partitions than the cluster's parallelism
    (e.g. one large row group); a big multi-file table is left as scanned, so no
    extra shuffle is paid at scale.
    """
    sc = df.sparkSession.sparkContext
    target = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
