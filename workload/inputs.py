"""Mentions, dictionaries and files derived from the test tables.

Every table is used whole. FIXTURES.md describes what is derived and why.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moniker.functions import composition_key, strip_tags
from moniker.functions.cas import check_digit
from moniker.plans import Discard, Lookup, standard_chain
from moniker.sources import build_dictionary, load_order, packed, read_entity_json, read_mentions, scratch_path, store

# Strings the formula rules reject, one per rule, and one that is a formula of a million atoms.
REJECTED_FORMULAS = [
    "CaAc", ":H2O", "(H2O", "Na=O", "(OH)1000", "Xx2", "D2O", "C12", "NaNa", "HO1", "C100", "aB", "Fe-O",
    "((HO)999)500Na",
]


# Tasks for each core where the texts of documents are taken apart.
TEXT_TASKS = 2

_STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """What ``build`` derives from the tables, written once in a session for all queries that need it."""
    key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
    if key not in _STORED:
        _STORED[key] = packed(build(spark, sf_dir), build.__name__)
    return _STORED[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, per_core: int = 1) -> DataFrame:
    """Rows of a table that has fewer splits than ``per_core`` for each core of the cluster, spread out.

    For texts that are taken apart right after the scan. A large table has
    splits enough and is left as it is. Where a split is long work, several for a
    core keep the cores from waiting for the last ones.
    """
    tasks = per_core * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(tasks) if rows.rdd.getNumPartitions() < tasks else rows


def _as_mentions(words: Column) -> Column:
    """Mention list of a word list; the place of a word is its start."""
    return F.transform(
        words,
        lambda w, i: F.struct(
            i.alias("start_orig"), (i + F.length(w)).alias("end_orig"), w.alias("word_orig")
        ),
    )


def _listed(*words: Column) -> Column:
    """The same list of a fixed number of words, without a lambda, which Spark would not compile."""
    return F.array(
        *(
            F.struct(F.lit(i).alias("start_orig"), (F.length(w) + i).alias("end_orig"), w.alias("word_orig"))
            for i, w in enumerate(words)
        )
    )


def _text(column: Column) -> Column:
    return column.cast("string")


def cas_word(partkey: Column, linenumber: Column | None = None) -> Column:
    """CAS-style number of a part; on line 7 the check digit is wrong."""
    n = partkey + 10000
    check = check_digit(n)
    if linenumber is not None:
        check = check + F.when(linenumber == 7, 1).otherwise(0)
    middle = F.lpad(_text(n % 100), 2, "0")
    return F.concat(_text(F.call_function("div", n, F.lit(100))), F.lit("-"), middle, F.lit("-"), _text(check % 10))


def inchikey(part: DataFrame) -> Column:
    """Stand-in for the InChIKey of a part."""
    return F.upper(F.left(F.md5(F.concat_ws("/", part["p_name"], _text(part["p_size"]))), F.lit(14)))


def iupac_name(part: DataFrame) -> Column:
    return F.concat_ws(" ", part["p_name"], _text(part["p_size"]), part["p_brand"])


def _formula_words(part: DataFrame) -> list[Column]:
    o = _text(part["p_partkey"] % 7 + 2)
    r = _text(part["p_size"] % 3 + 2)
    rejected = F.array(*map(F.lit, REJECTED_FORMULAS))
    milli = F.lpad(_text(part["p_partkey"] % 1000), 3, "0")
    return [
        F.concat(F.lit("O<sub>"), o, F.lit("</sub>Fe₂(NH)"), r, F.lit("Na")),
        F.concat(F.lit("Na Fe2(HN)"), r, F.lit("O"), o),
        F.concat(F.lit("FeO1-"), o),
        F.concat(F.lit("Fe0."), milli, F.lit("O")),
        F.concat(o, F.lit("(KCl)"), r, F.lit("(I)Br")),
        F.get(rejected, (part["p_partkey"] % len(REJECTED_FORMULAS)).cast("int")),
    ]


def _texts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column, Column]:
    """The documents, their ``patent_id`` and their words."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), TEXT_TASKS)
    return documents, F.concat(F.lit("D"), _text(F.col("doc_id"))), F.split("text", " ", -1)


def _rows_with_words(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, Column, list[Column]]]:
    """Tables whose rows have a fixed number of words each, the ``patent_id`` and the words."""
    lineitem = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    supplier = F.concat(F.lit("Supplier#"), F.lpad(_text(F.col("l_suppkey")), 9, "0"))
    cas = cas_word(F.col("l_partkey"), F.col("l_linenumber"))
    part = spread(table(spark, sf_dir, "part"))
    orders = table(spark, sf_dir, "orders")
    customer = F.concat(F.lit("Customer#"), F.lpad(_text(F.col("o_custkey")), 9, "0"))
    return [
        (lineitem, F.concat(F.lit("O"), _text(F.col("l_orderkey"))), [cas, supplier]),
        (part, F.concat(F.lit("P"), _text(part["p_partkey"])), [*_formula_words(part), iupac_name(part)]),
        (orders, F.concat(F.lit("C"), _text(F.col("o_orderkey"))), [customer]),
    ]


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mention per word of the documents."""
    documents, patent_id, words = _texts(spark, sf_dir)
    return documents.select(patent_id.alias("patent_id"), _as_mentions(words).alias("infer_list"))


def derived_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested mention documents ``(patent_id, infer_list)`` of all kinds.

    Texts (D), the CAS number and the supplier name of an order line (O), formulas
    and chemical names of parts (P), customer names of orders (C). The lines of
    an order are documents of one ``patent_id``.
    """
    nested = text_documents(spark, sf_dir)
    for rows, patent_id, words in _rows_with_words(spark, sf_dir):
        nested = nested.unionByName(rows.select(patent_id.alias("patent_id"), _listed(*words).alias("infer_list")))
    return nested


def word_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with nothing of its mentions but the words, for one reading that asks for no more.

    As places are not needed, the lists are made without a lambda, which Spark would not compile.
    """
    documents, patent_id, words = _texts(spark, sf_dir)
    split = documents.select(patent_id.alias("patent_id"), words.alias("word_orig"))
    nested = split.select("patent_id", F.arrays_zip("word_orig").alias("infer_list"))
    for rows, patent_id, words in _rows_with_words(spark, sf_dir):
        mentions = F.array(*(F.struct(w.alias("word_orig")) for w in words))
        nested = nested.unionByName(rows.select(patent_id.alias("patent_id"), mentions.alias("infer_list")))
    return nested


def mentioned_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word_orig`` of each mention of the corpus.

    The lists of mentions are neither made nor written for it. Each kind is exploded by
    itself: of a list that is a column Spark would ask the size first, and so make it twice.
    """
    documents, _, words = _texts(spark, sf_dir)
    mentioned = documents.select(F.explode(words).alias("word_orig"))
    for rows, _, words in _rows_with_words(spark, sf_dir):
        mentioned = mentioned.unionByName(rows.select(F.explode(F.array(*words)).alias("word_orig")))
    return mentioned


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, derived_corpus)


def _mention_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "corpus")
    store(derived_corpus(spark, sf_dir), path)
    return read_mentions(spark, path)


def stored_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as a mention table with ``row_id``."""
    key = (spark.sparkContext.applicationId, sf_dir, "mentions")
    if key not in _STORED:
        _STORED[key] = _mention_table(spark, sf_dir)
    return _STORED[key]


def _ner_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recogniser output: ``(doc_id, value)``, one record per document."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), TEXT_TASKS)

    def inferred(line: Column) -> Column:
        return F.transform(
            F.split(line, " ", -1),
            lambda w, i: F.struct(
                i.alias("start_orig"),
                (i + F.length(w)).alias("end_orig"),
                w.alias("word_orig"),
                F.lower(w).alias("word"),
                F.when(w.rlike("^[A-Z]"), "CEM").otherwise("OTH").alias("entity_group"),
            ),
        )

    results = F.transform(F.split("text", "\n", -1), lambda line: F.struct(inferred(line).alias("infer_list")))
    record = F.struct(
        _text(F.col("doc_id")).alias("patent_id"), F.struct(results.alias("results_list")).alias("data")
    )
    return documents.select("doc_id", F.to_json(record).alias("value"))


def raw_ner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recogniser output lines: one record per document, a cut-off line per toxic label."""
    lines = _ner_records(spark, sf_dir).select("value")
    labels = table(spark, sf_dir, "labels").where(F.col("toxic") == 1)
    broken = labels.select(F.concat(F.lit('{"patent_id": "L'), _text(F.col("doc_id")), F.lit('", "data')).alias("value"))
    return lines.unionByName(broken)


def drifting_ner(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Recogniser lines of even documents as they are, and of odd ones with ``entity_group`` renamed and ``start_orig`` as text."""
    whole = _ner_records(spark, sf_dir)
    changed = F.regexp_replace(F.replace("value", F.lit('"entity_group":'), F.lit('"label":')), '"start_orig":([0-9]+)', '"start_orig":"$1"')
    return {
        "kept": whole.where("doc_id % 2 = 0").select("value"),
        "changed": whole.where("doc_id % 2 = 1").select(changed.alias("value")),
    }


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines as gzip files. Most of the work on files that are read once is packing them, hence the fastest level."""
    lines.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def write_raw_ner(spark: SparkSession, sf_dir: str) -> str:
    """The same as gzip JSON lines; the path of the folder."""
    path = scratch_path(spark, "ner")
    write_lines(raw_ner(spark, sf_dir), path)
    return path


def name_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name dictionary parts: a part per conversation turn, and the benchmark as part 8.

    Names that begin with I have no ids.
    """

    def words(df: DataFrame, text: str, source: Column, part: Column, number: Column) -> DataFrame:
        exploded = df.select(
            source.alias("source"), part.cast("int").alias("part"), number.alias("number"),
            F.posexplode(F.split(text, " ", -1)).alias("pos", "word"),
        )
        no_ids = F.array().cast("array<string>")
        return exploded.select(
            F.concat(F.lit("<i>"), F.col("word"), F.lit("</i>")).alias("raw_key"),
            F.when(F.col("word").startswith("I"), no_ids).otherwise(F.array("source")).alias("ids"),
            "part",
            (F.col("number") * 1000000 + F.col("pos")).alias("row"),
        )

    turns = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    items = table(spark, sf_dir, "benchmark")
    spoken = words(turns, "text", F.concat(F.lit("S"), _text(turns["conv_id"])), turns["turn"], turns["conv_id"])
    listed = words(items, "text", F.concat(F.lit("B"), _text(items["item_id"])), F.lit(8), items["item_id"])
    return spoken.unionByName(listed)


def name_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = name_rows(spark, sf_dir)
    return build_dictionary(rows, strip_tags(F.col("raw_key")), load_order(F.col("part"), F.col("row")))


def cas_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    rows = part.select(
        F.replace(cas_word(part["p_partkey"]), F.lit("-"), F.lit("")).cast("bigint").alias("raw_key"),
        F.array(_text(part["p_partkey"])).alias("ids"),
        part["p_partkey"].alias("row"),
    )
    return build_dictionary(rows, F.col("raw_key"), load_order(F.lit(0), F.col("row")))


def formula_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formula dictionary parts of ``(element, upper, lower)`` rows.

    Part 0: the composition of the part's formula with a missing row; part 1:
    single elements; part 2: pairs of elements; part 3: oxides with a range.
    """
    part = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    key, size = part["p_partkey"], part["p_size"]

    def row(element: Column, upper: Column, lower: Column | None = None) -> Column:
        def amount(n: Column) -> Column:
            return F.concat(_text(n), F.lit(".00"))

        low = upper if lower is None else lower
        return F.struct(_text(element).alias("element"), amount(upper).alias("upper"), amount(low).alias("lower"))

    one = F.lit(1)
    o, r = key % 7 + 2, size % 3 + 2
    first, second = key % 118 + 1, F.floor(key / 118) % 118 + 1
    missing = F.lit(None).cast("struct<element: string, upper: string, lower: string>")
    compositions = [
        F.array(row(F.lit(8), o), row(F.lit(26), F.lit(2)), missing, row(F.lit(7), r), row(one, r), row(F.lit(11), one)),
        F.array(row(first, one)),
        F.array(row(first, one), row(second, one)),
        F.array(row(F.lit(8), o, one), row(F.lit(26), one)),
    ]
    numbered = F.array(*(F.struct(F.lit(i).alias("part"), c.alias("elements")) for i, c in enumerate(compositions)))
    rows = part.select(key.alias("row"), F.explode(numbered).alias("c")).select("row", "c.*")
    return rows.withColumn("ids", F.array(F.concat(F.lit("F"), _text(F.col("part")), F.lit("_"), _text(F.col("row")))))


def formula_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = formula_rows(spark, sf_dir)
    return build_dictionary(rows, composition_key(F.col("elements")), load_order(F.col("part"), F.col("row")))


def inchikey_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    rows = part.select(
        inchikey(part).alias("raw_key"), F.array(_text(part["p_partkey"])).alias("ids"), part["p_partkey"].alias("row")
    )
    return build_dictionary(rows, F.col("raw_key"), load_order(F.lit(0), F.col("row")))


def name_to_inchikey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """InChIKey by chemical name; blue parts have none."""
    part = table(spark, sf_dir, "part")
    named = part.where(~part["p_name"].startswith("blue"))
    return named.select(iupac_name(named).alias("name"), inchikey(named).alias("key")).distinct()


def entity_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers have ids of 8 characters, suppliers shorter ones. Read from JSON lines."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.lpad(_text(F.col("c_custkey")), 8, "0").alias("id")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.concat(F.lit("S"), _text(F.col("s_suppkey"))).alias("id")
    )
    path = scratch_path(spark, "entities")
    objects = customer.unionByName(supplier).select(F.to_json(F.create_map("name", "id")).alias("value"))
    objects.write.text(path)
    return read_entity_json(spark, path)


def file_name(prefix: Column) -> Column:
    """Name of the file of an order."""
    return F.concat(prefix, F.lit("_"), _text(F.col("o_orderkey")), F.lit(".json.gz"))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file manifest: one recogniser file per order.

    Urgent orders have a second one of the same part under another prefix, and
    those of low priority one whose name has no part.
    """
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", file_name(F.lit("alt_part")))
    low = F.when(F.col("o_orderpriority") == "5-LOW", file_name(F.lit("stray")))
    names = F.array(file_name(F.lit("ner_part")), urgent, low)
    return table(spark, sf_dir, "orders").select(F.explode(F.filter(names, lambda f: f.isNotNull())).alias("file"))


def chain(spark: SparkSession, sf_dir: str, **options: str | bool) -> list[Lookup | Discard]:
    """The standard chain; the dictionaries are built once in a session."""
    return standard_chain(
        names=stored(spark, sf_dir, name_dictionary),
        cas=stored(spark, sf_dir, cas_dictionary),
        formulas=stored(spark, sf_dir, formula_dictionary),
        inchikeys=stored(spark, sf_dir, inchikey_dictionary),
        entities=stored(spark, sf_dir, entity_dictionary),
        name_to_inchikey=stored(spark, sf_dir, name_to_inchikey),
        **options,
    )
