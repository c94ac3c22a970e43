"""Dictionaries that are kept up to date part by part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moniker.sources.scratch import settle


def _rows(rows: DataFrame, key: Column, order: Column, ids: str, buckets: int) -> DataFrame:
    keyed = rows.select(key.alias("key"), F.col(ids).alias("ids"), order.alias("load_order"))
    return keyed.where(F.col("key").isNotNull()).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))


def _winners(rows: DataFrame) -> DataFrame:
    """One row for each key, of its greatest order."""
    best = F.max_by(F.struct("ids", "load_order"), "load_order").alias("best")
    return rows.groupBy("bucket", "key").agg(best).select("key", "best.ids", "best.load_order", "bucket")


def _write(rows: DataFrame, path: str, dynamic: bool) -> None:
    """A folder for each bucket, written by one task each and sorted by key."""
    laid = rows.repartition("bucket").sortWithinPartitions("bucket", "key")
    mode = "dynamic" if dynamic else "static"
    laid.write.partitionBy("bucket").mode("overwrite").option("partitionOverwriteMode", mode).parquet(path)


def start_dictionary(rows: DataFrame, key: Column, order: Column, path: str, buckets: int, ids: str = "ids") -> DataFrame:
    """Build the dictionary at ``path`` with a folder for each bucket of keys; see ``build_dictionary``.

    The order of the row that won is kept, so that later parts can be weighed against it.
    """
    made = _winners(_rows(rows, key, order, ids, buckets))
    _write(made, path, dynamic=False)
    return read_dictionary(rows.sparkSession, path, made.schema)


def update_dictionary(rows: DataFrame, key: Column, order: Column, path: str, buckets: int, ids: str = "ids") -> DataFrame:
    """Merge a new part into the dictionary at ``path`` and rewrite only the buckets that have its keys.

    Only these buckets are read. Each key keeps the greatest order of old and new rows, so the result is that of a build
    from all parts, and merging a part again changes nothing. What is to be written is
    complete before the first folder is replaced.
    """
    spark = rows.sparkSession
    fresh = settle(spark, "dictionary-part", lambda: _winners(_rows(rows, key, order, ids, buckets)))
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # as many as there are buckets at most
    old = spark.read.schema(fresh.schema).parquet(path).where(F.col("bucket").isin(touched))
    merged = settle(spark, "dictionary-merged", lambda: _winners(old.unionByName(fresh)))
    _write(merged, path, dynamic=True)
    return read_dictionary(spark, path, fresh.schema)


def read_dictionary(spark: SparkSession, path: str, schema) -> DataFrame:
    """``(key, ids)`` of a dictionary that is kept in buckets."""
    return spark.read.schema(schema).parquet(path).select("key", "ids")
