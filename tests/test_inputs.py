"""Words and files derived from tables of odd rows."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from moniker.plans import distinct_words
from workload import inputs, queries

TABLES = {
    "documents": ("doc_id long, text string", [(1, "Na b Na"), (2, ""), (3, None), (4, "C\nd  e"), (1, "Na b Na")]),
    "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long", [(1, 1, 7, 3), (1, 7, 7, None), (2, 1, None, 3)]),
    "part": ("p_partkey long, p_name string, p_size int, p_brand string", [(7, "red tin", 5, "B"), (8, None, None, None), (None, "x", 1, "B")]),
    "orders": ("o_orderkey long, o_custkey long", [(1, 4), (2, None)]),
    "labels": ("doc_id long, quality int, toxic int", [(1, 1, 1), (2, 0, 0)]),
}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_words_are_those_of_the_corpus(spark, tables):
    corpus = inputs.derived_corpus(spark, tables)
    expected = sorted(map(repr, corpus.select(F.explode("infer_list.word_orig")).collect()))
    assert expected == sorted(map(repr, inputs.mentioned_words(spark, tables).select(F.col("word_orig").alias("col")).collect()))

    def lists(documents):
        return sorted(map(repr, documents.select("patent_id", F.col("infer_list.word_orig").alias("words")).collect()))

    assert lists(corpus) == lists(inputs.word_documents(spark, tables))


def test_words_are_taken_without_lists_of_mentions(spark, tables, monkeypatch):
    monkeypatch.setattr(inputs, "corpus", lambda *_: pytest.fail("the corpus is written"))
    found = queries.registry()["formula_tokens"](spark, tables)
    assert "transform(split" not in plan(found) and found.count() == len({*map(tuple, inputs.mentioned_words(spark, tables).collect())})
    assert queries.registry()["lookup_formula"](spark, tables).where(F.col("ids").isNull()).count() == 0


def test_lists_are_derived_once_for_their_words(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("moniker.plans.cascade.materialise", lambda df, _: seen.append(plan(df)) or df)
    schema = "patent_id string, text string"
    texts = spark.createDataFrame([("a", "x y x"), ("b", None), ("c", "")], schema)
    nested = texts.select("patent_id", F.transform(F.split("text", " "), lambda w: F.struct(w.alias("word_orig"))).alias("infer_list"))
    empty = nested.withColumn("infer_list", F.slice("infer_list", 1, 0))
    words = distinct_words(nested.unionByName(empty))
    assert {(r.word_orig, r.n_mentions) for r in words.collect()} == {("x", 2), ("y", 1), ("", 1)}
    assert "size(" not in seen[0]


def test_texts_are_dealt_to_several_tasks_for_each_core(spark, tables):
    tasks = 2 * spark.sparkContext.defaultParallelism
    assert inputs.text_documents(spark, tables).rdd.getNumPartitions() == tasks
    assert inputs._ner_records(spark, tables).rdd.getNumPartitions() == tasks


def test_recogniser_files_hold_every_line(spark, tables, tmp_path):
    path = inputs.write_raw_ner(spark, tables)
    expected = sorted(r.value for r in inputs.raw_ner(spark, tables).collect())
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).collect()
    lines = sorted(line for f in files for line in gzip.decompress(f.content).decode().splitlines())
    assert lines == expected and json.loads(lines[-1])["patent_id"] == "4" and len(lines) == 6
