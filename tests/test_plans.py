"""The chain of lookups, routing and publication."""

import os
import random
import subprocess
import sys
import time
import uuid

import pytest
from pyspark.sql import functions as F

from moniker.functions import is_rubbish
from moniker.operators import flatten_mentions, renest_mentions
from moniker.plans import (
    Discard,
    Lookup,
    Output,
    compact,
    distinct_words,
    keep_resolved,
    link_documents,
    publish_documents,
    resolve_words,
    resolved_only,
    route_entity,
    route_substance,
    standard_chain,
    tag_mentions,
    write_bucketed,
)
from moniker.plans.cascade import answered_words, extend_resolution
from moniker.plans.publish import hot_patents
from moniker.plans import publish
from moniker.sources import scratch, scratch_job, scratch_path, store, union_dictionary

SCHEMA = "patent_id string, row_id long, infer_list array<struct<start_orig: int, end_orig: int, word_orig: string>>"


def documents(spark, lists):
    rows = [(p, i, [(j, j + len(w), w) for j, w in enumerate(ws)]) for i, (p, ws) in enumerate(lists)]
    return spark.createDataFrame(rows, SCHEMA)


def dictionary(spark, entries, kind="string"):
    return spark.createDataFrame(list(entries.items()), f"key {kind}, ids array<string>")


@pytest.fixture(scope="module")
def tables(spark):
    return dict(
        names=dictionary(spark, {"water": ["n1"], "64-17-5": [], "NaCl": ["n2"], "DMSO": ["n3"], "H2O": []}),
        cas=dictionary(spark, {64175: ["c1"], 7732185: ["c2"]}, "bigint"),
        formulas=dictionary(spark, {"1:2.00:2.00|8:1.00:1.00": ["f1", "f2"], "11:1.00:1.00|17:1.00:1.00": ["f3"]}),
        inchikeys=dictionary(spark, {"KEY1": ["i1"]}),
        entities=dictionary(spark, {"Acme": ["00000001"], "Short": ["7"], "water": ["00000002"]}),
        name_to_inchikey=spark.createDataFrame([("ethanoic acid", "KEY1"), ("nothing", "KEY9")], "name string, key string"),
    )


WORDS = ["water", "64-17-5", "7732-18-4", "NaCl", "OH2", "H2O", "ethanoic acid", "nothing", "Acme", "Short", "DMSO", "PCBs", "x", "miss"]
EXPECTED = {
    "water": ("name", ["n1"], "substance"),
    "64-17-5": ("cas", ["c1"], "substance"),
    "NaCl": ("name", ["n2"], "substance"),
    "OH2": ("formula", ["f1", "f2"], "substance"),
    "H2O": ("formula", ["f1", "f2"], "substance"),
    "ethanoic acid": ("inchikey", ["i1"], "substance"),
    "Acme": ("entity", ["00000001"], "entity"),
    "Short": ("entity", ["7"], "entity"),
}


def resolution(docs, chain):
    return {r.word_orig: (r.stage, r.ids, r.kind) for r in resolve_words(distinct_words(docs, chain), chain).collect()}


def test_first_hit_wins(spark, tables):
    assert resolution(documents(spark, [("p", WORDS)]), standard_chain(**tables)) == EXPECTED


def test_names_can_be_kept_from_the_rubbish_filter(spark, tables):
    chain = standard_chain(**tables, rubbish_scope="unresolved")
    assert resolution(documents(spark, [("p", WORDS)]), chain) == {**EXPECTED, "DMSO": ("name", ["n3"], "substance")}


def test_rubbish_without_a_name_goes_in_either_scope(spark, tables):
    docs = documents(spark, [("p", ["DMSO", "PCBs", "x", "miss"])])
    for scope, kept in (("all", {"miss"}), ("unresolved", {"DMSO", "miss"})):
        chain = standard_chain(**tables, rubbish_scope=scope)
        words = distinct_words(docs, chain)
        found = resolve_words(words, chain)
        assert {r.word_orig for r in answered_words(words, found).collect()} == kept
        tagged = tag_mentions(flatten_mentions(docs), words, found, "desc", unresolved=True, chain=chain)
        assert {r.word_orig for r in tagged.collect()} == kept


def test_cas_numbers_can_be_rubbish(spark, tables):
    expected = {word: hit for word, hit in EXPECTED.items() if word != "64-17-5"}
    assert resolution(documents(spark, [("p", WORDS)]), standard_chain(**tables, spare_cas=False)) == expected


def test_result_does_not_depend_on_layout(spark, tables):
    rng = random.Random(3)
    lists = [(f"p{i}", rng.sample(WORDS, len(WORDS))) for i in range(9)]
    chain = standard_chain(**tables)
    assert resolution(documents(spark, lists).repartition(9), chain) == EXPECTED
    assert resolution(documents(spark, lists).coalesce(1), chain) == EXPECTED


def test_resolver_sees_only_unresolved_words(spark, tables, tmp_path):
    def answer(names):
        # Runs in a worker process, so what it is given is written down.
        for name in names:
            (tmp_path / uuid.uuid4().hex).write_text(name)
        return ["KEY1" if name.startswith("eth") else None for name in names]

    given = dict(tables, name_to_inchikey=None)
    assert resolution(documents(spark, [("p", WORDS)]), standard_chain(**given, resolver=answer)) == EXPECTED
    asked = sorted(p.read_text() for p in tmp_path.iterdir())
    assert asked == sorted(["ethanoic acid", "nothing", "Acme", "Short", "miss"])


def test_own_chain(spark, tables):
    chain = [
        Discard("no x", lambda w: w.startswith("x")),
        Lookup("lower", tables["names"], key=F.lower),
        Discard("no capitals", lambda w: w.rlike("^[A-Z]"), resolved=False),
        Lookup("entity", tables["entities"], kind="entity"),
    ]
    docs = documents(spark, [("p", ["WATER", "Acme", "water", "x"])])
    words = distinct_words(docs, chain)
    assert {r.word_orig for r in words.where("dropped").collect()} == {"x"}
    assert resolution(docs, chain) == {"WATER": ("lower", ["n1"], "substance"), "water": ("lower", ["n1"], "substance")}


LISTS = [("p1", ["water", "miss", "Acme"]), ("p2", []), ("p3", ["miss"]), ("p1", ["64-17-5", "Short"]), ("p4", ["DMSO", "water"])]


def tagged(spark, tables, **options):
    docs, chain = documents(spark, LISTS), standard_chain(**tables)
    words = distinct_words(docs, chain)
    return docs, tag_mentions(flatten_mentions(docs), words, resolve_words(words, chain), "claims", **options)


@pytest.mark.parametrize("hot_floor", [1, 1_000_000])
def test_tagging_and_routing(spark, tables, hot_floor):
    _, found = tagged(spark, tables, hot_floor=hot_floor)
    _, everything = tagged(spark, tables, unresolved=True, hot_floor=hot_floor)
    assert {(r.row_id, r.pos, r.word_orig) for r in everything.collect()} == {
        (0, 0, "water"), (0, 1, "miss"), (0, 2, "Acme"), (2, 0, "miss"), (3, 0, "64-17-5"), (3, 1, "Short"), (4, 1, "water"),
    }
    assert {r.section for r in everything.collect()} == {"claims"}
    assert sorted(map(str, resolved_only(everything).collect())) == sorted(map(str, found.collect()))
    assert {(r.row_id, r.word_orig, tuple(r.subs_ids)) for r in route_substance(found).collect()} == {
        (0, "water", ("n1",)), (3, "64-17-5", ("c1",)), (4, "water", ("n1",)),
    }
    assert {(r.row_id, r.word_orig, r.ppi_id) for r in route_entity(found).collect()} == {(0, "Acme", "00000001")}


def test_unresolved_mentions_leave_nested_lists(spark):
    rows = [("p", [("a", ["1"]), ("b", None), ("c", [])]), ("q", [])]
    nested = spark.createDataFrame(rows, "patent_id string, infer_list array<struct<word_orig: string, subs_ids: array<string>>>")
    assert {r.patent_id: [m.word_orig for m in r.infer_list] for r in keep_resolved(nested).collect()} == {"p": ["a"], "q": []}


def lists_of(table, field):
    return sorted((r.patent_id, [(m.word_orig, m[field]) for m in r.infer_list]) for r in table.collect())


@pytest.mark.parametrize("hot_floor", [1, 1_000_000])
def test_publication(spark, tables, hot_floor):
    docs, found = tagged(spark, tables)
    fields = ["start_orig", "end_orig", "word_orig", "subs_ids"]
    name = f"substances_{hot_floor}"
    table = publish_documents(route_substance(found), docs, fields, name, scratch_path(spark, name), 4, hot=hot_patents(docs, hot_floor))
    assert lists_of(table, "subs_ids") == [
        ("p1", [("64-17-5", ["c1"])]), ("p1", [("water", ["n1"])]), ("p2", []), ("p3", []), ("p4", [("water", ["n1"])]),
    ]
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert detail["Num Buckets"] == "4" and detail["Bucket Columns"] == "[`patent_id`]" == detail["Sort Columns"]


def test_whole_job_writes_two_tables(spark, tables):
    outputs = [Output(f"job_{kind}", scratch_path(spark, kind)) for kind in ("substance", "entity")]
    substances, entities = link_documents(documents(spark, LISTS), standard_chain(**tables), "desc", *outputs, buckets=4)
    assert [len(ms) for _, ms in lists_of(substances, "subs_ids")] == [1, 1, 0, 0, 1]
    assert lists_of(entities, "ppi_id") == [("p1", []), ("p1", [("Acme", "00000001")]), ("p2", []), ("p3", []), ("p4", [])]
    assert spark.table("job_substance").count() == spark.table("job_entity").count() == 5


def test_hot_patent_is_written_by_several_tasks(spark):
    docs = documents(spark, [("hot", ["a"])] * 400 + [(f"p{i}", ["b"]) for i in range(40)])
    path = scratch_path(spark, "hot")
    table = write_bucketed(docs, "hot_docs", path, buckets=8, hot_floor=100)
    assert table.count() == 440
    shares = [r["count"] for r in table.where("patent_id = 'hot'").groupBy(F.input_file_name()).count().collect()]
    assert sum(shares) == 400 and len(shares) >= 5 and max(shares) < 200
    cold = table.where("patent_id <> 'hot'").select("patent_id", F.input_file_name().alias("f")).distinct()
    assert cold.count() == 40
    assert cold.select("f").distinct().count() <= 8


def test_large_buckets_are_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr("moniker.operators.mentions.PART_ROWS", 50)
    docs = documents(spark, [(f"p{i % 300}", ["a"] * (i % 3)) for i in range(400)])
    path = scratch_path(spark, "large")
    table = write_bucketed(docs, "large_docs", path, buckets=2)
    sizes = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 400 and len(sizes) >= 8 and max(sizes) <= 100
    files = table.select("patent_id", F.input_file_name().alias("f")).distinct()
    assert files.count() == 300


def test_frequent_words_meet_their_answers_without_a_shuffle(spark, tables, monkeypatch):
    chain = standard_chain(**tables)
    lists = LISTS + [("p5", ["water", "miss", "Acme", "64-17-5", "PP"]), ("p6", [None, "DMSO"])]
    docs = documents(spark, [(p, [w for w in ws if w is not None]) for p, ws in lists])
    words = distinct_words(docs, chain)

    def found(unresolved):
        rows = tag_mentions(flatten_mentions(docs), words, resolve_words(words, chain), "claims", unresolved, chain=chain)
        return rows, sorted(map(str, rows.select("row_id", "pos", "word_orig", "ids", "stage", "kind", "section").collect()))

    plain = [found(u)[1] for u in (False, True)]
    for floor, chars in ((1, 256), (2, 256), (1, 14)):
        monkeypatch.setattr("moniker.plans.cascade.FREQUENT_FLOOR", floor)
        monkeypatch.setattr("moniker.plans.cascade.ANSWER_CHARS", chars)
        assert [found(u)[1] for u in (False, True)] == plain
    monkeypatch.setattr("moniker.plans.cascade.FREQUENT_FLOOR", 1)
    assert "BroadcastHashJoin" in found(True)[0]._jdf.queryExecution().executedPlan().toString()


def test_compaction_in_more_files_than_asked(spark, monkeypatch):
    parts = [scratch_path(spark, "part") for _ in range(2)]
    for part in parts:
        documents(spark, [(f"p{i}", ["a", "b"]) for i in range(40)]).drop("row_id").repartition(10).write.parquet(part)
    schema = "patent_id string, infer_list array<struct<start_orig: int, end_orig: int, word_orig: string>>"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        monkeypatch.setattr("moniker.plans.publish.FILE_BYTES", 5000)
        whole = compact(spark, parts, schema, scratch_path(spark, "target"), 2)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert whole.count() == 80 and whole.select(F.input_file_name()).distinct().count() > 2


def test_compaction(spark):
    parts = [scratch_path(spark, "part") for _ in range(3)]
    for i, part in enumerate(parts):
        documents(spark, [(f"p{i}", ["a", "b"]), (f"q{i}", [])]).drop("row_id").write.parquet(part)
    target = scratch_path(spark, "target")
    schema = "patent_id string, infer_list array<struct<start_orig: int, end_orig: int, word_orig: string>>"
    for files in (2, None):
        whole = compact(spark, parts, schema, target, files)
        assert sorted(r.patent_id for r in whole.collect()) == ["p0", "p1", "p2", "q0", "q1", "q2"]
        assert whole.select(F.input_file_name()).distinct().count() <= 2


def test_failed_compaction_leaves_the_target(spark, tmp_path):
    schema = "patent_id string, infer_list array<struct<start_orig: int, end_orig: int, word_orig: string>>"
    good, target = scratch_path(spark, "part"), str(tmp_path / "target")
    documents(spark, [("p", ["a"])]).drop("row_id").write.parquet(good)
    compact(spark, [good], schema, target)
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        compact(spark, [good, str(bad)], schema, target)
    with pytest.raises(ValueError):
        compact(spark, [good, target + "/"], schema, target)
    assert [r.patent_id for r in spark.read.parquet(target).collect()] == ["p"]
    assert [p.name for p in tmp_path.iterdir() if "new" in p.name] == []


def test_scratch_of_a_job_is_deleted(spark):
    with pytest.raises(RuntimeError), scratch_job(spark):
        path = scratch_path(spark, "inside")
        spark.range(1).write.parquet(path)
        raise RuntimeError
    outside = scratch_path(spark, "outside")
    assert not os.path.exists(path.removeprefix("file:")) and "job-" in path and "job-" not in outside


def test_entities_with_several_ids(spark):
    rows = [("p", 0, ["00000001", "00000002", "3"], "entity")]
    tagged = spark.createDataFrame(rows, "patent_id string, pos int, ids array<string>, kind string")
    assert sorted(r.ppi_id for r in route_entity(tagged).collect()) == ["00000001", "00000002"]


def test_rubbish_flag_is_a_function_of_the_word(spark):
    words = spark.createDataFrame([("x",), ("ethanol",)], "word_orig string")
    assert [r.f for r in words.select(is_rubbish(F.col("word_orig")).alias("f")).collect()] == [True, False]


def test_sample_resolver_needs_no_module_on_the_workers(tmp_path):
    from pyspark import cloudpickle

    from workload.queries import _digest_keys

    (tmp_path / "resolver").write_bytes(cloudpickle.dumps(_digest_keys()))
    program = "import pickle; print(pickle.load(open('resolver', 'rb'))(['a b', 'ab']))"
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env={}, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip().endswith(", None]"), done.stderr


def test_earlier_answers_are_not_looked_up_again(spark, tables):
    docs = documents(spark, [("p", WORDS)])
    chain = standard_chain(**tables)
    words = distinct_words(docs, chain)
    whole = {r.word_orig: (r.stage, r.ids) for r in answered_words(words, resolve_words(words, chain)).collect()}
    earlier = spark.createDataFrame(
        [("water", ["old"], "name", "substance"), ("miss", None, None, None), ("gone", ["x"], "name", "substance")],
        "word_orig string, ids array<string>, stage string, kind string",
    )
    found = {r.word_orig: (r.stage, r.ids) for r in extend_resolution(words, chain, earlier).collect()}
    assert found == {**whole, "water": ("name", ["old"])}


def test_union_dictionary_is_a_step(spark):
    rows = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "3")], "key string, id string")
    words = spark.createDataFrame([("a", 1, False, False)], "word_orig string, n_mentions long, dropped boolean, doubtful boolean")
    found = resolve_words(words, [Lookup("name", union_dictionary(rows))]).collect()
    assert [(r.word_orig, r.ids) for r in found] == [("a", ["1", "2"])]


# --- slices -----------------------------------------------------------------------------


def shuffle_files(spark):
    names = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("|")
    return names.count("shuffle_")


def test_shuffle_files_go_with_what_is_written(spark):
    spark.sparkContext._jvm.System.gc()
    rows = spark.range(1000).repartition(3, "id")
    rows.write.parquet(scratch_path(spark, "kept"))
    before = shuffle_files(spark)
    assert before > 0
    path = scratch_path(spark, "packed")
    store(rows, path)
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before and spark.read.parquet(path).count() == 1000
    assert spark.conf.get(scratch.RELEASE) == "false"


def test_slices_together_are_the_whole(spark, tables, monkeypatch):
    """Documents that are worked off slice by slice give the tables that they give at once."""
    lists = LISTS + [(f"s{i}", ["water", "miss", "Acme", "NaCl"][: i % 5]) for i in range(20)] + [("s1", ["DMSO"]), (None, ["water"])]
    docs, chain = documents(spark, lists), standard_chain(**tables)

    def made():
        outputs = [Output(f"sliced_{n}_{uuid.uuid4().hex}", scratch_path(spark, n)) for n in ("substance", "entity", "whole")]
        linked = link_documents(docs, chain, "desc", *outputs[:2], buckets=4)
        whole = write_bucketed(docs, outputs[2].table, outputs[2].path, buckets=4)
        nested = renest_mentions(flatten_mentions(docs), docs)
        mentions = flatten_mentions(docs).withColumnRenamed("word_orig", "w")
        published = publish_documents(mentions, docs, ["w"], f"published_{uuid.uuid4().hex}", scratch_path(spark, "published"), buckets=4)
        assert all(t.count() == len(lists) for t in (*linked, whole, nested, published))
        return [sorted(map(repr, t.select(*sorted(t.columns)).collect())) for t in (*linked, whole, nested, published)]

    at_once, saved = made(), []
    monkeypatch.setattr("moniker.operators.mentions.SLICE_ROWS", 20)
    monkeypatch.setattr("moniker.sources.scratch.store", lambda df, *rest: saved.append(rest[0]) or store(df, *rest))
    assert made() == at_once
    assert len([path for path in saved if "/tagged-" in path]) == 4  # one for each bucket
    assert len([path for path in saved if "/nested-" in path]) > 2


def test_a_failed_slice_leaves_no_table(spark, monkeypatch):
    docs = documents(spark, [(f"p{i}", ["a", "b"]) for i in range(20)])
    monkeypatch.setattr("moniker.operators.mentions.SLICE_ROWS", 20)
    placed, name = publish._place, f"failing_{uuid.uuid4().hex}"

    def failing(rows, *rest):
        made.append(rows)
        return placed(rows, *rest) if len(made) < 2 else placed(rows.where(F.raise_error(F.lit("lost")).isNull()), *rest)

    made = []
    monkeypatch.setattr("moniker.plans.publish._place", failing)
    with pytest.raises(Exception, match="lost"):
        write_bucketed(docs, name, scratch_path(spark, "failing"), buckets=4)
    assert [t.name for t in spark.catalog.listTables() if name in t.name] == []


def test_parts_with_splits_enough_are_put_together_without_a_shuffle(spark):
    part = scratch_path(spark, "part")
    documents(spark, [(f"p{i}", ["a", "b"]) for i in range(40)]).drop("row_id").repartition(10).write.parquet(part)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        table = spark.read.parquet(part)
        assert "Exchange" not in publish.in_files(table, [part], 3)._jdf.queryExecution().executedPlan().toString()
        assert publish.in_files(table, [part], 3).rdd.getNumPartitions() == 3 and publish.in_files(table, [part], 3).count() == 40
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
