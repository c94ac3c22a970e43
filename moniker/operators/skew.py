"""Joins that stay even when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moniker.sources.scratch import packed as materialise

# A key with so many rows or more is spread, over PLACES places for each so many. Where such
# keys have over HOT_FLOOR * HOT_PARTS rows together, it takes a share of 1/HOT_PARTS of
# them, so that there are at most HOT_PARTS hot keys, which bounds the list of 12 bytes a
# key that is broadcast.
HOT_FLOOR = 1_000_000
HOT_PARTS = 100_000
PLACES = 4


def _hot(counted: DataFrame, floor: int) -> DataFrame:
    """``(hot_hash, fanout)`` of ``(hash, n)``: each hash above the floor and its number of places.

    Two keys with one hash are spread alike on both sides of the join, which is
    harmless.
    """
    hot = materialise(counted.where(F.col("n") >= floor), "hot")
    total = hot.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = max(floor, total // HOT_PARTS)
    places = F.ceil(PLACES * F.col("n") / rows).cast("int")
    return hot.where(F.col("n") >= rows).select(F.col("hash").alias("hot_hash"), places.alias("fanout"))


def top_keys(counted: DataFrame, key: str, n: str, floor: int = HOT_FLOOR) -> DataFrame:
    """Hot keys of rows that are counted already."""
    return _hot(counted.groupBy(F.xxhash64(key).alias("hash")).agg(F.sum(n).alias("n")), floor)


def hot_keys(rows: DataFrame, key: str, weight: Column | None = None, floor: int = HOT_FLOOR) -> DataFrame:
    """Hot keys of rows that are yet to be counted; a row counts as its ``weight``."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return _hot(rows.groupBy(F.xxhash64(key).alias("hash")).agg(n.alias("n")), floor)


def mark_hot(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Add ``fanout``, null for keys that are not hot. ``hot`` is bounded by its floor, so it is broadcast."""
    return rows.join(F.broadcast(hot), F.xxhash64(rows[key]) == hot["hot_hash"], "left").drop("hot_hash")


def spread_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    hot: DataFrame,
    spread_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Equi-join of ``many`` rows with at most ``one`` row per key.

    Keys that are not hot join on the key alone, so a bucketed ``one`` stays in
    place. Rows of a hot key go to several places by their ``spread_by`` columns
    and the single matching row, read once more, is copied to each.
    """
    if hot.isEmpty():
        return many.join(one, key, how)
    marked = mark_hot(many, key, hot)
    cold = marked.where(F.col("fanout").isNull()).drop("fanout").join(one, key, how)
    slot = F.pmod(F.xxhash64(*spread_by), F.col("fanout")).cast("int")
    salted = marked.where(F.col("fanout").isNotNull()).withColumn("salt", slot).drop("fanout")
    copies = mark_hot(one, key, hot).where(F.col("fanout").isNotNull())
    copies = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("fanout") - 1))).drop("fanout")
    return cold.unionByName(salted.join(copies, [key, "salt"], how).drop("salt"))
