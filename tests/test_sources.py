"""Reading recogniser files, manifests and dictionaries."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from moniker.functions import strip_tags
from moniker.sources import (
    assign_batches,
    build_dictionary,
    cem_mentions,
    count_ingest,
    file_manifest,
    load_order,
    materialise,
    merge_union,
    part_id,
    misnamed_files,
    pending_files,
    publish_dictionary,
    quarantined,
    read_entity_json,
    read_mentions,
    read_ner,
    scratch_path,
    write_mentions,
)
from moniker.streaming import ingest_available


def mention(word, group="CEM", start=0):
    return {"start_orig": start, "end_orig": start + len(word), "word_orig": word, "word": word.lower(), "entity_group": group}


def record(patent_id, *results):
    return json.dumps({"patent_id": patent_id, "data": {"results_list": [{"infer_list": list(r)} for r in results]}})


def write_gz(path, *members):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"".join(gzip.compress("".join(f"{line}\n" for line in m).encode()) for m in members))


def words(frame):
    return {r.patent_id: [m.word_orig for m in r.infer_list] for r in frame.collect()}


def test_ner_records_become_mentions(spark, tmp_path):
    write_gz(
        tmp_path / "in" / "a_b_1.json.gz",
        [record("p1", [mention("H2O"), mention("Bob", "PER")], [mention("NaCl", start=9)]), record("p2", [])],
        [record("p3"), record("p4", [mention("tree", "OTH")]), json.dumps({"patent_id": "p5"})],
    )
    write_gz(tmp_path / "in" / "notes.txt", ["not a record"])
    found = cem_mentions(read_ner(spark, str(tmp_path / "in")))
    assert words(found) == {"p1": ["H2O", "NaCl"], "p2": [], "p3": [], "p4": [], "p5": []}
    assert found.where("patent_id = 'p1'").first().infer_list[1].asDict() == {
        "start_orig": 9, "end_orig": 13, "word_orig": "NaCl",
    }


def test_bad_lines_are_kept_aside(spark, tmp_path):
    lines = [record("p1", [mention("H2O")]), '{"patent_id": "p2", "da', "no json", record("p3")]
    write_gz(tmp_path / "in" / "a_b_1.json.gz", lines)
    found = cem_mentions(read_ner(spark, str(tmp_path / "in")))
    out = str(tmp_path / "out")
    counts = write_mentions(found, out, files=2)
    assert counts == {"n_docs": 2, "n_mentions": 1, "n_empty_docs": 1, "n_bad_lines": 2}
    assert sorted(r.bad_line for r in quarantined(spark, out).collect()) == sorted(lines[1:3])
    stored = read_mentions(spark, out)
    assert words(stored) == {"p1": ["H2O"], "p3": []}
    assert count_ingest(stored).first().asDict() == {"n_docs": 2, "n_mentions": 1, "n_empty_docs": 1, "n_bad_lines": 0}


def test_rows_of_one_patent_stay_apart(spark, tmp_path):
    for part in ("a", "b"):
        rows = [("p1", [(0, 1, "x")]), ("p1", [(0, 1, "x")])]
        spark.createDataFrame(rows, "patent_id string, infer_list array<struct<start_orig:int,end_orig:int,word_orig:string>>").coalesce(
            1
        ).write.parquet(str(tmp_path / part))
    stored = read_mentions(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    first = sorted(r.row_id for r in stored.collect())
    assert len(set(first)) == 4
    assert first == sorted(r.row_id for r in stored.repartition(3).collect())


def test_new_files_only(spark, tmp_path):
    source, target, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))

    def run():
        ingest_available(spark, source, target, offsets)
        return words(read_mentions(spark, target))

    write_gz(tmp_path / "in" / "a_b_1.json.gz", [record("p1", [mention("H2O")])])
    assert run() == {"p1": ["H2O"]}
    write_gz(tmp_path / "in" / "a_b_10.json.gz", [record("p10", [mention("NaCl")])])
    assert run() == {"p1": ["H2O"], "p10": ["NaCl"]}
    assert read_mentions(spark, target).count() == 2
    assert run() == words(cem_mentions(read_ner(spark, source)))
    assert read_mentions(spark, target).count() == 2


def test_streamed_bad_lines_are_kept_aside(spark, tmp_path):
    write_gz(tmp_path / "in" / "a_b_1.json.gz", [record("p1", [mention("H2O")]), "broken"])
    target = str(tmp_path / "out")
    ingest_available(spark, str(tmp_path / "in"), target, str(tmp_path / "offsets"))
    assert words(read_mentions(spark, target)) == {"p1": ["H2O"]}
    assert [r.bad_line for r in quarantined(spark, target).collect()] == ["broken"]


def test_manifest(spark, tmp_path):
    for part in (1, 2, 10, 21):
        write_gz(tmp_path / f"ner_part_{part}.json.gz", ["{}"])
    (tmp_path / "ner_part_3.txt").write_text("")
    files = file_manifest(spark, str(tmp_path), "*.json.gz")
    assert {r.part for r in files.select(part_id(F.col("file")).alias("part")).collect()} == {"1", "2", "10", "21"}
    done = spark.createDataFrame([("ner_part_1.json.gz",), ("ner_part_2.json.gz",)], "file string")
    assert {r.file for r in pending_files(files, done).collect()} == {"ner_part_10.json.gz", "ner_part_21.json.gz"}
    for name in ("alt_part_1", "stray", "stray_two"):
        write_gz(tmp_path / f"{name}.json.gz", ["{}"])
    files = file_manifest(spark, str(tmp_path), "*.json.gz")
    left = {"ner_part_10.json.gz", "ner_part_21.json.gz", "alt_part_1.json.gz"}
    assert {r.file for r in pending_files(files, done).collect()} == left
    assert {r.file for r in misnamed_files(files).collect()} == {"stray.json.gz", "stray_two.json.gz"}
    by_path = files.where("file = 'alt_part_1.json.gz'").select("path")
    assert "alt_part_1.json.gz" not in {r.file for r in pending_files(files, by_path, by="path").collect()}


@pytest.mark.parametrize("count, size", [(0, 3), (1, 3), (100, 7), (6, 3)])
def test_batches_are_full_but_for_the_last(spark, count, size):
    files = spark.range(count).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("file"))
    sizes = {r.batch_id: r["count"] for r in assign_batches(files, size).groupBy("batch_id").count().collect()}
    expected = {i: min(size, count - i * size) for i in range(-(-count // size))}
    assert sizes == expected


ROWS = [
    ("<b>a</b>", ["p0"], 0, 0), ("a", ["p3"], 3, 0), ("a", ["p2"], 2, 5), ("a", ["p2 early"], 2, 4),
    ("b", ["p0 last"], 0, 9), ("b", ["p0 first"], 0, 1),
    ("c", ["p1"], 1, 0), ("c", ["p2"], 2, 99), ("c", ["p0"], 0, 99),
    ("", ["none"], 1, 1), (None, ["none"], 1, 2), ("d", [], 1, 3),
]


def dictionary_rows(spark):
    return spark.createDataFrame(ROWS, "raw string, ids array<string>, part int, row long")


def test_dictionary_precedence(spark):
    built = build_dictionary(dictionary_rows(spark), strip_tags(F.col("raw")), load_order(F.col("part"), F.col("row")))
    expected = {"a": ["p2"], "b": ["p0 last"], "c": ["p1"], "d": []}
    assert {r.key: r.ids for r in built.collect()} == expected
    table = publish_dictionary(built, "names_test", scratch_path(spark, "names"), 4)
    assert {r.key: r.ids for r in table.collect()} == expected


def test_dictionary_does_not_depend_on_row_order(spark):
    order = load_order(F.col("part"), F.col("row"))
    plain = build_dictionary(dictionary_rows(spark), F.col("raw"), order).collect()
    mixed = build_dictionary(dictionary_rows(spark).repartition(5).orderBy(F.rand(3)), F.col("raw"), order).collect()
    assert sorted(plain) == sorted(mixed)


def test_union_of_parts(spark):
    merged = merge_union(dictionary_rows(spark), strip_tags(F.col("raw")))
    found = {(r.key, r.id) for r in merged.collect()}
    assert found == {("a", "p0"), ("a", "p3"), ("a", "p2"), ("a", "p2 early"), ("b", "p0 last"), ("b", "p0 first"),
                     ("c", "p1"), ("c", "p2"), ("c", "p0")}


def test_entity_dictionary(spark, tmp_path):
    names = {"Acme": "00000001", "Bolt & Co": "00000002"}
    (tmp_path / "one.json").write_text(json.dumps(names, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({k: v}) for k, v in names.items()))
    for name, lines in (("one.json", False), ("lines.json", True)):
        found = read_entity_json(spark, str(tmp_path / name), lines)
        assert {r.key: r.ids for r in found.collect()} == {k: [v] for k, v in names.items()}


class _Unset:
    """A session that names no folder."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder_of_its_own_only_on_one_machine():
    first, second = (scratch_path(_Unset("local[2]"), "x") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    with pytest.raises(ValueError):
        scratch_path(_Unset("yarn"), "x")


def test_scratch_is_below_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    path = scratch_path(spark, "x")
    assert path.startswith(base) and path != scratch_path(spark, "x")
    stored = materialise(spark.range(5), "five")
    assert sorted(r.id for r in stored.collect()) == list(range(5))
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()
