"""Plans that must not get worse."""

import re
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moniker.functions import cas_key, formula_key, rubbish_reason, strip_tags
from moniker.operators import flatten_mentions, lookup_words, renest_mentions
from moniker.plans import Discard, Lookup, distinct_words, resolve_words, standard_chain, tag_mentions
from moniker.plans.cascade import named_keys
from moniker.plans.publish import nest_by_bucket
from moniker.sources import build_dictionary, load_order, publish_dictionary, read_mentions, scratch_path, seen_fields
from moniker.sources.ner import NER_SCHEMA
from workload import inputs

SCHEMA = "patent_id string, infer_list array<struct<start_orig: int, end_orig: int, word_orig: string>>"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def stored(spark):
    path = scratch_path(spark, "docs")
    spark.createDataFrame([("p", [(0, 1, "a")])], SCHEMA).write.parquet(path)
    return read_mentions(spark, path)


def without_broadcast(spark, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(build())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_join_in_place(spark):
    def entries(name):
        rows = spark.range(50).select(F.col("id").cast("string").alias("key"), F.array(F.lit("x")).alias("ids"))
        return publish_dictionary(rows, name, scratch_path(spark, name), 4)

    names, words = entries("explain_names"), entries("explain_words").withColumnRenamed("key", "word_orig")
    found = without_broadcast(spark, lambda: lookup_words(words, names))
    assert "SortMergeJoin" in found and "Exchange" not in found


def test_chain_leaves_bucketed_dictionaries_in_place(spark):
    def entries(name, kind="string"):
        rows = spark.range(50).select(F.col("id").cast(kind).alias("key"), F.array(F.lit("x")).alias("ids"))
        return publish_dictionary(rows, f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name), 4)

    names = spark.createDataFrame([("a", "1")], "name string, key string")
    tables = dict(names=entries("n"), cas=entries("c", "bigint"), formulas=entries("f"), inchikeys=entries("i"), entities=entries("e"))
    chain = standard_chain(**tables, name_to_inchikey=names)
    words = distinct_words(stored(spark), chain)
    found = without_broadcast(spark, lambda: resolve_words(words, chain))
    lines = found.splitlines()
    scans = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
    assert len(scans) == 5
    for scan in scans:
        # Nothing between the scan of a dictionary and its join deals the rows anew.
        first = next(line for line in _above(lines, scan) if "Exchange" in line or "Join" in line)
        assert "Join" in first


def _above(lines, at):
    """What a line of a plan feeds, from the nearest up."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    least = depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < least:
            least = depth(line)
            yield line


def test_words_meet_the_names_before_the_second_dictionary(spark):
    names = spark.createDataFrame([("a", "k"), ("b", "l")], "name string, key string")
    words = spark.createDataFrame([("a",)], "word_orig string")
    assert [(r.word_orig, r.key) for r in named_keys(words, names).collect()] == [("a", "k")]


def test_dropped_mentions_stay_out_of_the_shuffle(spark):
    chain = [Discard("short", lambda w: F.length(w) < 2), Lookup("name", spark.createDataFrame([("ab", ["1"])], "key string, ids array<string>"))]
    docs = stored(spark)
    words = distinct_words(docs, chain)
    tagged = without_broadcast(spark, lambda: tag_mentions(flatten_mentions(docs), words, resolve_words(words, chain), "desc", chain=chain))
    generate = [i for i, line in enumerate(tagged.splitlines()) if "Generate" in line]
    above = tagged.splitlines()[: generate[0]]
    assert any("Filter" in line and "length" in line for line in above[-4:])


def test_keys_stay_in_the_engine(spark):
    w = F.col("w")
    keys = spark.createDataFrame([("x",)], "w string").select(formula_key(w), cas_key(w), rubbish_reason(w), strip_tags(w))
    assert not re.search("Python|Arrow", plan(keys).split("Scan ")[0])


def test_the_cas_rule_is_compiled(spark):
    """It is tried on mentions: a lambda would keep Spark from compiling the filter and all that it is part of."""
    words = spark.createDataFrame([("x",)], "w string").where(cas_key(F.col("w")).isNull())
    assert "lambda" not in plan(words) and re.search(r"\* ?(\([0-9]+\) )?Filter|Filter \[codegen id", plan(words))


def test_the_one_file_of_parts_is_spread(spark, tmp_path):
    """Compositions, and the lists of formulas, of a table that is one split are not all worked out by one task."""
    rows = [(i, f"name {i}", "Brand#1", i % 50) for i in range(40)]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert inputs.table(spark, str(tmp_path), "part").rdd.getNumPartitions() == 1
    assert inputs.formula_rows(spark, str(tmp_path)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_lists_without_a_lambda(spark):
    words = spark.createDataFrame([("ab", None), ("", "c")], "v string, w string")
    listed, transformed = inputs._listed(F.col("v"), F.col("w")), inputs._as_mentions(F.array("v", "w"))
    assert words.select(listed).collect() == words.select(transformed).collect()
    assert "lambda" not in plan(words.select(listed))


def test_words_read_nothing_but_words(spark):
    words = stored(spark).select(F.explode("infer_list.word_orig").alias("word_orig")).groupBy("word_orig").count()
    schema = re.search("ReadSchema: (.*)", plan(words)).group(1)
    assert "word_orig" in schema and "start_orig" not in schema and "patent_id" not in schema


def test_one_shuffle_builds_a_dictionary(spark):
    rows = spark.createDataFrame([("a", ["1"], 0, 0)], "raw string, ids array<string>, part int, row int")
    built = plan(build_dictionary(rows, strip_tags(F.col("raw")), load_order(F.col("part"), F.col("row"))))
    assert built.count("Exchange") == 1 and "partial_max_by" in built


def test_renesting_takes_one_shuffle_and_no_join(spark):
    docs = stored(spark)
    nested = plan(renest_mentions(flatten_mentions(docs), docs))
    assert nested.count("Exchange ") == 1 and "Join" not in nested


def test_bucket_layout_serves_the_aggregation(spark):
    docs = stored(spark)
    mentions = flatten_mentions(docs)
    nested = plan(nest_by_bucket(mentions, docs, ["word_orig"], 4))
    assert nested.count("REPARTITION_BY_NUM") == 1
    assert "hashpartitioning(bucket" in nested and "hashpartitioning(patent_id" not in nested


def test_levels_of_a_record_are_looked_at_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data": {"results_list": [{"infer_list": [{"start_orig": 1}]}]}}\n')
    seen = seen_fields(spark, str(tmp_path), StructType.fromDDL(NER_SCHEMA), "*.json")
    # One place for the declared containers of each of four levels, one for all else.
    assert len(re.findall("schemaOfVariant|schema_of_variant", plan(seen))) <= 9
    assert ("data.results_list.infer_list.start_orig", "int", 1) in {(r.field, r.kind, r.n) for r in seen.collect()}
