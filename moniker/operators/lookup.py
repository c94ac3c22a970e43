"""Dictionary lookups as joins. A dictionary has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moniker.operators.skew import HOT_FLOOR, hot_keys, spread_join


def lookup_words(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Hits ``(word_orig, ids)`` of distinct words that are themselves the key.

    An empty id list is no hit.
    """
    found = dictionary.where(F.size("ids") > 0).withColumnRenamed("key", "word_orig")
    return words.select("word_orig").join(found, "word_orig").select("word_orig", "ids")


def lookup_keys(keyed: DataFrame, dictionary: DataFrame, hot_floor: int = HOT_FLOOR) -> DataFrame:
    """Hits of ``(word_orig, key)`` rows, where many words may share one key."""
    probes = keyed.select("word_orig", "key").where(F.col("key").isNotNull())
    found = dictionary.where(F.size("ids") > 0)
    hot = hot_keys(probes, "key", floor=hot_floor)
    hits = spread_join(probes, found, "key", hot, spread_by=["word_orig"])
    return hits.select("word_orig", "ids")
