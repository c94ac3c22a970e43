"""Batches that are made again, streams that are delivered twice, dictionaries and tables that are replaced in parts."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moniker.plans import Lookup, compact_table, current_version, drop_versions, link_batches, publish_version, versions
from moniker.plans.cascade import distinct_words, failed_names, resolve_words, resolver_answers, resolver_keys
from moniker.sources import build_dictionary, file_manifest, load_order, schema_drift, seen_fields, start_dictionary, store, update_dictionary
from moniker.sources.ner import MENTION_SCHEMA, NER_SCHEMA
from moniker.streaming import batch_resolver, resolve_available

FIELDS = "patent_id string, infer_list array<struct<start_orig: int, end_orig: int, word_orig: string>>"


def mention_files(spark, folder, lists):
    rows = [(k, [(i, i + len(w), w) for i, w in enumerate(words)]) for k, words in lists]
    spark.createDataFrame(rows, FIELDS).coalesce(1).write.mode("append").parquet(str(folder))


def names(spark, **ids):
    return spark.createDataFrame([(k, [v]) for k, v in ids.items()], "key string, ids array<string>")


def stamps(folder):
    """Time of change of every data file below a folder."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet")}


# --- batches ----------------------------------------------------------------------------


@pytest.fixture
def batches(spark, tmp_path):
    for part, lists in enumerate([[("a", ["x", "y"])], [("b", ["x", "z"]), ("c", [])], [("d", ["y"])]]):
        mention_files(spark, tmp_path / "in" / f"p{part}", lists)
    files = file_manifest(spark, str(tmp_path / "in" / "*"), "*.parquet")
    return files.withColumn("batch_id", F.when(F.col("path").contains("/p2/"), 7).otherwise(3))


def published(table):
    return {(r["batch_id"], r["patent_id"], tuple(m["word_orig"] for m in r["infer_list"]), tuple({m["section"] for m in r["infer_list"]})) for r in table.collect()}


def test_one_batch_is_made_again(spark, batches, tmp_path):
    outputs = [str(tmp_path / n) for n in ("substance", "entity")]
    chain = [Lookup("name", names(spark, x="X", y="Y"))]
    first, _ = link_batches(spark, batches.select("path", "batch_id"), chain, "one", *outputs, parts=2)
    assert published(first) == {(3, "a", ("x", "y"), ("one",)), (3, "b", ("x",), ("one",)), (3, "c", (), ()), (7, "d", ("y",), ("one",))}
    before = stamps(tmp_path / "substance")
    again, _ = link_batches(spark, batches.select("path", "batch_id"), chain, "two", *outputs, only=[7], parts=2)
    assert published(again) == {(3, "a", ("x", "y"), ("one",)), (3, "b", ("x",), ("one",)), (3, "c", (), ()), (7, "d", ("y",), ("two",))}
    after = stamps(tmp_path / "substance")
    same = {p for p in before if "batch_id=3" in p}
    assert same and all(after[p] == before[p] for p in same) and not {p for p in before if "batch_id=7" in p} & set(after)
    with pytest.raises(ValueError, match="no files"):
        link_batches(spark, batches.select("path", "batch_id"), chain, "two", *outputs, only=[99])


def test_a_batch_opens_its_own_files_only(spark, batches, tmp_path):
    other = next((tmp_path / "in" / "p0").glob("*.parquet"))
    other.write_bytes(b"no parquet")
    (tmp_path / "in" / "p0" / f".{other.name}.crc").unlink()
    chain = [Lookup("name", names(spark, y="Y"))]
    made, _ = link_batches(spark, batches.select("path", "batch_id"), chain, "s", str(tmp_path / "s"), str(tmp_path / "e"), only=[7])
    assert published(made) == {(7, "d", ("y",), ("s",))}


def test_slices_of_batches_take_their_places_together(spark, batches, tmp_path, monkeypatch):
    monkeypatch.setattr("moniker.operators.mentions.SLICE_ROWS", 1)
    outputs = [str(tmp_path / n) for n in ("substance", "entity")]
    chain, files = [Lookup("name", names(spark, x="X", y="Y"))], batches.select("path", "batch_id")
    link_batches(spark, files, chain, "one", *outputs, parts=4)
    want = {(3, "a", ("x", "y"), ("one",)), (3, "b", ("x",), ("one",)), (3, "c", (), ()), (7, "d", ("y",), ("one",))}
    assert published(spark.read.parquet(outputs[0])) == want
    before, written = stamps(tmp_path), []

    def failing(df, *rest):
        written.append(rest[0])
        if len([path for path in written if "_staged" in path]) > 2:
            raise OSError("lost")
        store(df, *rest)

    with monkeypatch.context() as patch:
        patch.setattr("moniker.sources.scratch.store", failing)
        with pytest.raises(OSError, match="lost"):
            link_batches(spark, files, chain, "two", *outputs, parts=4)
    assert stamps(tmp_path) == before and published(spark.read.parquet(outputs[0])) == want
    assert len([path for path in written if "/tagged-" in path]) > 1


def test_slices_of_a_feed_equal_one_job(spark, tmp_path, monkeypatch):
    chain, found = [Lookup("name", names(spark, x="X"))], []
    for rows in (8_000_000, 2):
        monkeypatch.setattr("moniker.operators.mentions.SLICE_ROWS", rows)
        paths = [str(tmp_path / f"{n}{rows}") for n in ("answers", "target", "offsets")]
        mention_files(spark, tmp_path / f"in{rows}", [("a", ["x", "r", "none"]), ("b", ["x", "new"]), ("c", []), ("d", ["x"])])
        resolve_available(spark, str(tmp_path / f"in{rows}"), chain, "desc", *paths)
        found.append(sorted(repr((r["patent_id"], r["pos"], r["word_orig"], r["stage"])) for r in spark.read.parquet(paths[1]).collect()))
    assert found[0] == found[1] and len(found[0]) == 6
    assert not [p for p in (tmp_path / "target2").iterdir() if "_staged" in p.name]


# --- streaming resolution ---------------------------------------------------------------


def test_feeds_and_a_replay_equal_one_job(spark, tmp_path):
    seen = tmp_path / "asked"
    seen.mkdir()
    folder = str(seen)

    def resolver(asked):
        with open(f"{folder}/{os.getpid()}-{id(asked)}", "a") as file:
            file.writelines(f"{name}\n" for name in asked)
        return ["K" if name == "r" else None for name in asked]

    chain = [Lookup("name", names(spark, x="X")), Lookup("resolver", names(spark, K="R"), resolver=resolver)]
    paths = [str(tmp_path / n) for n in ("answers", "target", "offsets")]
    source = str(tmp_path / "in")
    feeds = [[("a", ["x", "r", "none"])], [("b", ["r", "x", "new", "none"]), ("c", [])]]
    for feed in feeds:
        mention_files(spark, source, feed)
        resolve_available(spark, source, chain, "desc", *paths)
        resolve_available(spark, source, chain, "desc", *paths)  # nothing new
    want = {("a", 0, "x", "name"), ("a", 1, "r", "resolver"), ("a", 2, "none", None), ("b", 0, "r", "resolver"), ("b", 1, "x", "name"), ("b", 2, "new", None), ("b", 3, "none", None)}

    def found():
        return sorted(((r["patent_id"], r["pos"], r["word_orig"], r["stage"]) for r in spark.read.parquet(paths[1]).collect()), key=repr)

    assert found() == sorted(want, key=repr)
    asked = [name for file in seen.iterdir() for name in file.read_text().split()]
    assert sorted(asked) == ["new", "none", "r"]  # no word is asked for twice
    again = spark.createDataFrame([(k, 10 + i, [(j, j, w) for j, w in enumerate(ws)]) for i, (k, ws) in enumerate(feeds[1])], "patent_id string, row_id bigint, " + FIELDS.split(", ", 1)[1])
    batch_resolver(chain, "desc", *paths[:2])(again, 1)
    assert found() == sorted(want, key=repr)
    answers = spark.read.parquet(paths[0])
    assert answers.count() == answers.select("word_orig").distinct().count() == 4


# --- dictionary upkeep ------------------------------------------------------------------


def part_rows(spark, part, keys):
    return spark.createDataFrame([(k, [f"{part}:{i}"], part, i) for i, k in enumerate(keys)], "raw string, ids array<string>, part int, row int")


def test_a_part_rewrites_its_buckets_only(spark, tmp_path):
    key, order, path = F.lower("raw"), load_order(F.col("part"), F.col("row")), str(tmp_path / "dict")
    parts = [part_rows(spark, 2, [f"k{i}" for i in range(200)]), part_rows(spark, 1, ["K3", "k3", "new", None]), part_rows(spark, 0, ["k5", "zero"])]
    start_dictionary(parts[0], key, order, path, 16)
    before = stamps(path)
    assert len(before) == 16
    for _ in range(2):
        update_dictionary(parts[1], key, order, path, 16)
    kept = update_dictionary(parts[2], key, order, path, 16)
    after = stamps(path)
    touched = {r[0] for r in parts[1].union(parts[2]).where("raw is not null").select(F.pmod(F.xxhash64(key), F.lit(16))).collect()}
    untouched = {p for p in before if int(p.split("bucket=")[1].split("/")[0]) not in touched}
    assert untouched and all(after[p] == before[p] for p in untouched) and len(after) == 16
    whole = build_dictionary(parts[0].union(parts[1]).union(parts[2]), key, order)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, whole.collect()))
    told = {r["key"]: r["ids"] for r in kept.collect()}
    assert told["k3"] == ["1:1"] and told["k5"] == ["2:5"] and told["zero"] == ["0:1"]


def test_upkeep_reads_only_the_buckets_it_needs(spark, tmp_path):
    key, order, path = F.col("raw"), load_order(F.col("part"), F.col("row")), str(tmp_path / "dict")
    start_dictionary(part_rows(spark, 1, [f"k{i}" for i in range(100)]), key, order, path, 8)
    own = spark.range(1).select(F.pmod(F.xxhash64(F.lit("k7")), F.lit(8))).first()[0]
    for file in stamps(path):
        if f"bucket={own}/" not in file:
            with open(file, "wb") as broken:  # would fail if it were read
                broken.write(b"no parquet")
    update_dictionary(part_rows(spark, 2, ["k7"]), key, order, path, 8)
    kept = spark.read.parquet(f"{path}/bucket={own}")
    assert {r["key"]: r["ids"] for r in kept.collect()}["k7"] == ["1:7"]


# --- versions ---------------------------------------------------------------------------


def test_readers_always_find_a_version(spark, tmp_path, monkeypatch):
    root, table = str(tmp_path / "versions"), "versioned_table"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    assert current_version(spark, table) is None
    publish_version(spark.range(3), table, root)
    first = current_version(spark, table)

    with pytest.raises(Exception):  # the new version cannot be written
        publish_version(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), table, root)
    assert spark.table(table).count() == 3

    monkeypatch.setattr(versions, "_switch", lambda *_: (_ for _ in ()).throw(OSError("no catalogue")))
    with pytest.raises(OSError):  # it is written and cannot be switched to
        publish_version(spark.range(5), table, root)
    monkeypatch.undo()
    assert spark.table(table).count() == 3 and current_version(spark, table) == first

    held = spark.table(table)
    publish_version(spark.range(7), table, root)
    assert spark.table(table).count() == 7 and held.count() == 3  # who has begun to read goes on
    assert len(drop_versions(spark, table, root)) == 3
    assert spark.table(table).count() == 7
    with pytest.raises(ValueError):
        drop_versions(spark, "no_such_table", root)


def test_parts_as_a_versioned_table(spark, tmp_path):
    mention_files(spark, tmp_path / "p0", [("a", ["x"])])
    mention_files(spark, tmp_path / "p1", [("b", [])])
    spark.sql("DROP TABLE IF EXISTS versioned_parts")
    parts = [str(tmp_path / "p0"), str(tmp_path / "p1")]
    assert compact_table(spark, parts[:1], MENTION_SCHEMA, "versioned_parts", str(tmp_path / "v")).count() == 1
    assert compact_table(spark, parts, MENTION_SCHEMA, "versioned_parts", str(tmp_path / "v"), files=1).count() == 2


# --- resolvers that fail ----------------------------------------------------------------


def shaky():
    def answer(asked):
        if any(n.startswith("bad") for n in asked):
            raise RuntimeError(next(n for n in asked if n.startswith("bad")))
        return [None if n == "none" else n.upper() for n in asked][: -1 if "short" in asked and len(asked) > 1 else None]

    return answer


def test_failing_names_are_isolated(spark):
    words = spark.createDataFrame([(w,) for w in ["a", "bad1", "b", "none", "bad2", "c", "short", *(f"w{i}" for i in range(50))]], "word_orig string")
    told = {r["word_orig"]: r for r in resolver_answers(words.coalesce(1), shaky()).collect()}
    assert len(told) == 57 and told["bad1"]["error"] == "RuntimeError: bad1" and told["bad1"]["key"] is None
    assert {w for w, r in told.items() if r["error"]} == {"bad1", "bad2"}
    assert told["a"]["key"] == "A" and told["none"]["key"] is None and told["short"]["key"] == "SHORT"
    assert told["bad1"]["attempts"] > told["w49"]["attempts"] >= 1
    assert failed_names(resolver_answers(words, shaky())).count() == 2
    assert resolver_answers(words.where("false"), shaky()).count() == 0
    with pytest.raises(Exception, match="bad"):
        resolver_keys(words, shaky()).collect()


def test_quarantine_of_a_step(spark, tmp_path):
    docs = spark.createDataFrame([("p", 0, [(0, 1, w) for w in ["a", "bad", "b"]])], "patent_id string, row_id bigint, " + FIELDS.split(", ", 1)[1])
    chain = [Lookup("resolver", names(spark, A="1", B="2"), resolver=shaky(), quarantine=str(tmp_path / "q"))]
    found = resolve_words(distinct_words(docs, chain), chain)
    assert sorted(r["word_orig"] for r in found.collect()) == ["a", "b"]
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "q")).collect()] == [("bad", "RuntimeError: bad")]


# --- schema drift -----------------------------------------------------------------------


def test_drift_by_file(spark, tmp_path):
    schema = StructType.fromDDL("id string, n int, tags array<string>, data struct<list: array<struct<a: int, b: double>>>")
    files = {
        "same": [{"id": "x", "n": 1, "tags": [], "data": {"list": [{"a": 1, "b": 0.5}, {"a": 2, "b": 1.5}]}}],
        "moved": [{"ID": "x", "n": "1", "tags": ["t"], "data": {"list": [{"a": 1, "c": True}, 5]}}, {"n": None, "data": {"list": "none"}}],
        "broken": None,
    }
    for name, records in files.items():
        (tmp_path / f"{name}.json").write_text("{no json\n" if records is None else "\n".join(map(json.dumps, records)))
    seen = seen_fields(spark, str(tmp_path), schema, "*.json")
    told = {(os.path.basename(r["file"]), r["field"], r["declared"], r["kind"], r["drift"], r["n"]) for r in schema_drift(seen, schema).collect()}
    assert told == {
        ("moved.json", "ID", None, "string", "unknown", 1),
        ("moved.json", "id", "string", None, "missing", 0),
        ("moved.json", "n", "int", "string", "retyped", 1),
        ("moved.json", "data.list", "array", "string", "retyped", 1),
        ("moved.json", "data.list.c", None, "boolean", "unknown", 1),
        ("moved.json", "data.list.b", "number", None, "missing", 0),
    }


def test_types_that_hide_a_kind_are_taken_apart(spark, tmp_path):
    """Lines are counted by their merged type; where that hides a kind, each object is looked at."""
    inner = "data.results_list.infer_list."

    def line(*starts):
        return json.dumps({"patent_id": "null", "data": {"results_list": [{"infer_list": [{"start_orig": s} for s in starts]}]}})

    lines = [line(1, 2), line(3), line(1, 2.5), line(1, None), line(1, "x"), line(12345678901234567890123), "no json"]
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    schema = StructType.fromDDL(NER_SCHEMA)
    seen = seen_fields(spark, str(tmp_path), schema, "*.json")
    told = {(r.field, r.kind): r.n for r in seen.collect()}
    starts = {kind: n for (field, kind), n in told.items() if field == f"{inner}start_orig"}
    assert starts == {"int": 5, "number": 2, "null": 1, "string": 1} and told["patent_id", "string"] == 6
    # The files are read for the fields once, though the drift is told from them twice.
    assert "FileScan text" not in schema_drift(seen, schema)._jdf.queryExecution().executedPlan().toString()
