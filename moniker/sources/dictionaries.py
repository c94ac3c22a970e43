"""Lookup tables ``(key, ids)`` built from parts of ``(raw key, ids)`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load_order(part: Column, row: Column) -> Column:
    """Sort key of a dictionary row; the greatest wins.

    A later row replaces an earlier one of its part. Between parts, part 1
    beats 2, 2 beats 3 and so on, and part 0 loses to all.
    """
    return F.struct((part != 0).alias("listed"), (-part).alias("earlier"), row.alias("row"))


def build_dictionary(rows: DataFrame, key: Column, order: Column, ids: str = "ids") -> DataFrame:
    """One row per key: the ids of its greatest ``order``. Rows without a key go."""
    keyed = rows.select(key.alias("key"), F.col(ids).alias("ids"), order.alias("load_order"))
    return keyed.where(F.col("key").isNotNull()).groupBy("key").agg(F.max_by("ids", "load_order").alias("ids"))


def merge_union(rows: DataFrame, key: Column, ids: str = "ids") -> DataFrame:
    """All ids of every key over all parts, as distinct ``(key, id)`` rows.

    The long form stays distributed however many ids a key has.
    """
    keyed = rows.select(key.alias("key"), F.explode(ids).alias("id"))
    return keyed.where(F.col("key").isNotNull()).distinct()


def union_dictionary(merged: DataFrame) -> DataFrame:
    """``(key, ids)`` of ``(key, id)`` rows, for a chain; ids in order.

    A list is as long as its key has ids in all parts together; every mention that
    the key answers carries it, so a chain wants keys with few.
    """
    return merged.groupBy("key").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def publish_dictionary(dictionary: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Bucketed and sorted by key, so that joins on the key leave the table in place."""
    (
        dictionary.repartition(buckets, "key")
        .write.bucketBy(buckets, "key")
        .sortBy("key")
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(table, format="parquet")
    )
    return dictionary.sparkSession.table(table)


def read_entity_json(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Entity dictionary ``(key, ids)`` from JSON objects of name to id.

    ``lines=False`` reads each file as one object, which is one task per file;
    a large dictionary comes as one object per line.
    """
    text = spark.read.text(path, wholetext=not lines)
    parsed = F.from_json("value", "map<string,string>")
    return text.select(F.explode(parsed).alias("key", "id")).select("key", F.array("id").alias("ids"))
