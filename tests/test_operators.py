"""Flattening, re-nesting and joins under skew."""

import random

import pytest
from pyspark.sql import functions as F

from moniker.operators import flatten_mentions, hot_keys, lookup_keys, lookup_words, renest_mentions, spread_join

SCHEMA = "patent_id string, row_id long, infer_list array<struct<start_orig: int, end_orig: int, word_orig: string>>"


def documents(spark, n=40, seed=1):
    rng = random.Random(seed)
    rows = [
        (f"p{i % 30}", i, [(j, j + 1, rng.choice("abcdef") * rng.randint(1, 3)) for j in range(rng.randint(0, 12))])
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


def as_set(frame):
    return {(r.patent_id, r.row_id, tuple(tuple(m) for m in r.infer_list)) for r in frame.collect()}


def test_flat_and_back_is_the_identity(spark):
    docs = documents(spark)
    flat = flatten_mentions(docs).repartition(5, "word_orig")
    assert as_set(renest_mentions(flat, docs)) == as_set(docs)


def test_documents_without_mentions_survive(spark):
    docs = documents(spark)
    nested = renest_mentions(flatten_mentions(docs).where(F.lit(False)), docs)
    assert nested.count() == docs.count()
    assert nested.where(F.size("infer_list") != 0).count() == 0


def skewed(spark):
    rows = [("hot", i) for i in range(4000)] + [(f"k{i % 50}", i) for i in range(1000)] + [(None, 1)]
    return spark.createDataFrame(rows, "key string, n int")


def test_hot_keys(spark):
    rows = skewed(spark)
    hash_of = {r.key: r.h for r in rows.select("key", F.xxhash64("key").alias("h")).distinct().collect()}
    assert [r.hot_hash for r in hot_keys(rows, "key", floor=1000).collect()] == [hash_of["hot"]]
    assert hot_keys(rows, "key", floor=10_000).count() == 0
    assert {r.fanout for r in hot_keys(rows, "key", floor=1000).collect()} == {16}
    weighted = hot_keys(rows, "key", weight=F.when(F.col("key") == "k1", 1000).otherwise(0), floor=1000)
    assert [r.hot_hash for r in weighted.collect()] == [hash_of["k1"]]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("floor", [1, 15, 1000, 10_000])
def test_spread_join_equals_plain_join(spark, how, floor):
    many = skewed(spark)
    one = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("absent", 4)], "key string, v int")
    spread = spread_join(many, one, "key", hot_keys(many, "key", floor=floor), ["n"], how)
    plain = many.join(one, "key", how)
    assert sorted(map(str, spread.select("key", "n", "v").collect())) == sorted(map(str, plain.select("key", "n", "v").collect()))


def test_hot_rows_land_in_many_places(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = skewed(spark)
        one = spark.createDataFrame([("hot", 1)], "key string, v int")
        spread = spread_join(many, one, "key", hot_keys(many, "key", floor=1000), ["n"])
        sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and len(sizes) >= 6 and max(sizes) < 1500


def test_empty_id_lists_and_missing_keys_are_no_hits(spark):
    dictionary = spark.createDataFrame([("a", ["1"]), ("b", []), ("c", ["3", "4"])], "key string, ids array<string>")
    words = spark.createDataFrame([("a",), ("b",), ("x",)], "word_orig string")
    assert [(r.word_orig, r.ids) for r in lookup_words(words, dictionary).collect()] == [("a", ["1"])]
    keyed = spark.createDataFrame([("C", "c"), ("cc", "c"), ("B", "b"), ("?", None)], "word_orig string, key string")
    for floor in (1, 1_000_000):
        hits = {(r.word_orig, tuple(r.ids)) for r in lookup_keys(keyed, dictionary, floor).collect()}
        assert hits == {("C", ("3", "4")), ("cc", ("3", "4"))}


def test_many_hot_keys_are_all_spread(spark):
    rows = spark.range(200_000).select(F.concat(F.lit("k"), (F.col("id") % 2000).cast("string")).alias("key"), F.col("id").alias("n"))
    hot = hot_keys(rows, "key", floor=20)
    assert hot.count() == 2000 and {r.fanout for r in hot.collect()} == {20}
    one = spark.range(3000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("v"))
    joined = spread_join(rows, one, "key", hot, ["n"])
    assert joined.count() == 200_000 and joined.where("concat('k', v) <> key").count() == 0


def test_hot_list_is_bounded(spark, monkeypatch):
    monkeypatch.setattr("moniker.operators.skew.HOT_PARTS", 10)
    rows = spark.range(1000).select((F.col("id") % 100).cast("string").alias("key")).unionAll(
        spark.range(900).select(F.lit("hot").alias("key"))
    )
    hot = hot_keys(rows, "key", floor=1).collect()
    assert [r.fanout for r in hot] == [19]
