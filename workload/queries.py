"""One query per operator; each takes the session and the folder of the tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moniker.functions import (
    cas_key,
    formula_clean,
    formula_expand,
    formula_key,
    formula_reject,
    formula_tokens,
    is_rubbish,
    rubbish_reason,
    strip_tags,
)
from moniker.operators import flatten_mentions, lookup_words, renest_mentions
from moniker.plans import (
    Lookup,
    Output,
    compact,
    compact_table,
    distinct_words,
    keep_resolved,
    link_batches,
    link_documents,
    publish_documents,
    publish_version,
    resolve_words,
    resolved_only,
    route_entity,
    route_substance,
    tag_mentions,
    write_bucketed,
)
from moniker.plans.cascade import answered_words, extend_resolution, resolver_answers, resolver_keys
from moniker.sources import (
    MENTION_SCHEMA,
    assign_batches,
    build_dictionary,
    cem_mentions,
    count_ingest,
    file_manifest,
    load_order,
    materialise,
    merge_union,
    part_id,
    pending_files,
    publish_dictionary,
    quarantined,
    read_mentions,
    read_ner,
    schema_drift,
    scratch_path,
    seen_fields,
    start_dictionary,
    store,
    union_dictionary,
    update_dictionary,
    write_mentions,
)
from moniker.sources.ner import NER_SCHEMA
from moniker.streaming import batch_resolver, ingest_available, resolve_available
from workload import inputs

Query = Callable[[SparkSession, str], DataFrame]

SECTION = "desc"
BATCH_SIZE = 45
BUCKETS = 8
PARTS = "DOPC"  # first letters of patent ids by the part of the mention files they are in
KEYS = ["patent_id", "row_id"]
_REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn

    return register


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _ids_text() -> Column:
    return F.array_join("ids", ",").alias("ids")


def _flat(documents: DataFrame) -> DataFrame:
    keys = [c for c in KEYS if c in documents.columns]
    return flatten_mentions(documents, keys).select(*keys, "pos", "start_orig", "end_orig", "word_orig")


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.mentioned_words(spark, sf_dir).distinct()


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


# User-defined resolvers


def _digest_keys() -> Callable[[list[str]], list[str | None]]:
    """A stand-in for a name parser: a digest of names of several words.

    An inner function travels to the workers by value, so they need no copy of
    this module.
    """

    def answer(names: list[str]) -> list[str | None]:
        return [hashlib.md5(name.encode()).hexdigest()[:14].upper() if " " in name else None for name in names]

    return answer


@query("custom_resolver")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resolver that answers for names of several words, run on what no name matches."""
    words = _words(spark, sf_dir)
    named = lookup_words(words, inputs.stored(spark, sf_dir, inputs.name_dictionary))
    return resolver_keys(words, _digest_keys(), named)


@query("custom_resolver_chain")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resolver as a step between two lookups."""
    part = inputs.table(spark, sf_dir, "part")
    name = inputs.iupac_name(part)
    rows = part.select(
        F.upper(F.left(F.md5(name), F.lit(14))).alias("raw_key"),
        F.array(F.col("p_partkey").cast("string")).alias("ids"),
        F.col("p_partkey").alias("row"),
    )
    resolved = build_dictionary(rows, F.col("raw_key"), load_order(F.lit(0), F.col("row")))
    chain = [
        Lookup("name", inputs.stored(spark, sf_dir, inputs.name_dictionary)),
        Lookup("resolver", resolved, resolver=_digest_keys()),
        Lookup("entity", inputs.stored(spark, sf_dir, inputs.entity_dictionary), kind="entity"),
    ]
    words = distinct_words(inputs.word_documents(spark, sf_dir), chain)
    return resolve_words(words, chain).select("word_orig", "stage", _ids_text())


def _failing_keys() -> Callable[[list[str]], list[str | None]]:
    """The same, but names that begin with blue make it raise."""

    def answer(names: list[str]) -> list[str | None]:
        for name in names:
            if name.startswith("blue"):
                raise ValueError(name)
        return [hashlib.md5(name.encode()).hexdigest()[:14].upper() if " " in name else None for name in names]

    return answer


@query("resolver_failing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names a resolver cannot take are told apart; all others are answered."""
    return resolver_answers(_words(spark, sf_dir), _failing_keys()).select("word_orig", "key", "error")


@query("resolver_quarantine")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same resolver as a step of a chain: what it resolves, and what it leaves in the quarantine."""
    path = scratch_path(spark, "quarantine")
    part = inputs.table(spark, sf_dir, "part")
    name = inputs.iupac_name(part)
    rows = part.select(F.upper(F.left(F.md5(name), F.lit(14))).alias("key"), F.array(F.lit("R")).alias("ids")).distinct()
    chain = [Lookup("resolver", rows, resolver=_failing_keys(), quarantine=path)]
    words = distinct_words(inputs.word_documents(spark, sf_dir), chain)
    found = resolve_words(words, chain).select("word_orig", "stage")
    return found.unionByName(spark.read.parquet(path).select("word_orig", F.lit("quarantine").alias("stage")))


# Sources and sinks


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "mentions")
    write_mentions(cem_mentions(read_ner(spark, inputs.write_raw_ner(spark, sf_dir), "*.txt.gz")), path)
    return path


@query("ner_ingest")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(read_mentions(spark, _ingested(spark, sf_dir))).drop("row_id")


@query("ner_ingest_stream")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, offsets = scratch_path(spark, "stream"), scratch_path(spark, "offsets")
    ingest_available(spark, inputs.write_raw_ner(spark, sf_dir), target, offsets, "*.txt.gz")
    return _flat(read_mentions(spark, target)).drop("row_id")


@query("ner_quarantine")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined(spark, _ingested(spark, sf_dir))


@query("ingest_counts")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_ingest(cem_mentions(read_ner(spark, inputs.write_raw_ner(spark, sf_dir), "*.txt.gz")))


@query("mentions_flat")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(inputs.corpus(spark, sf_dir))


@query("part_id")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.file_names(spark, sf_dir).select("file", part_id(F.col("file")).alias("part"))


@query("pending_files")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    done = orders.where(F.col("o_orderstatus") == "F").select(inputs.file_name(F.lit("ner_part")).alias("file"))
    return pending_files(inputs.file_names(spark, sf_dir), done)


@query("batch_assign")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_batches(inputs.file_names(spark, sf_dir), BATCH_SIZE)


@query("compact")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [scratch_path(spark, "part") for _ in range(2)]
    store(inputs.text_documents(spark, sf_dir), parts[0])
    store(inputs.derived_corpus(spark, sf_dir), parts[1])
    whole = compact(spark, parts, MENTION_SCHEMA, scratch_path(spark, "compact"), files=BUCKETS)
    return whole.select("patent_id", F.size("infer_list").alias("n"))


@query("compact_versions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a table that is switched from a first version to the whole."""
    parts = [scratch_path(spark, "part") for _ in range(2)]
    documents, root, name = inputs.text_documents(spark, sf_dir), scratch_path(spark, "versions"), _table_name("versions")
    store(documents, parts[0])
    store(inputs.derived_corpus(spark, sf_dir), parts[1])
    publish_version(spark.read.schema(MENTION_SCHEMA).parquet(parts[0]), name, root)
    whole = compact_table(spark, parts, MENTION_SCHEMA, name, root, files=BUCKETS)
    return whole.select("patent_id", F.size("infer_list").alias("n"))


@query("schema_drift")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recogniser files as declared, and those of odd documents with a renamed and a retyped field."""
    root = scratch_path(spark, "drift")
    for folder, lines in inputs.drifting_ner(spark, sf_dir).items():
        inputs.write_lines(lines, f"{root}/{folder}")
    schema = StructType.fromDDL(NER_SCHEMA)
    seen = seen_fields(spark, [f"{root}/kept", f"{root}/changed"], schema, "*.txt.gz")
    folder = F.element_at(F.split("file", "/"), -2).alias("file")
    return schema_drift(seen.groupBy(folder, "field", "kind").agg(F.sum("n").alias("n")), schema)


@query("batch_outputs")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mention files in two batches with an output each; the second batch is made again for another section."""
    source, outputs = scratch_path(spark, "parts"), [scratch_path(spark, n) for n in ("substance", "entity")]
    part = F.call_function("locate", F.left("patent_id", F.lit(1)), F.lit(PARTS)) - 1
    store(inputs.derived_corpus(spark, sf_dir).withColumn("part", part), source, by=["part"])
    number = F.regexp_extract("path", "part=([0-9]+)", 1).cast("int")
    batches = file_manifest(spark, source, "*.parquet").select("path", F.floor(number / 2).cast("int").alias("batch_id"))
    chain = inputs.chain(spark, sf_dir)
    link_batches(spark, batches, chain, SECTION, *outputs)
    made = link_batches(spark, batches, chain, "again", *outputs, only=[1])
    flat = [t.select(F.lit(n).alias("output"), "batch_id", F.explode("infer_list.section").alias("section")) for n, t in zip(("substance", "entity"), made, strict=True)]
    return flat[0].unionByName(flat[1]).groupBy("output", "batch_id", "section").agg(F.count(F.lit(1)).alias("n"))


@query("bucketed_roundtrip")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.corpus(spark, sf_dir)
    stored = write_bucketed(documents, _table_name("mentions"), scratch_path(spark, "bucketed"), BUCKETS)
    return stored.select("patent_id", F.size("infer_list").alias("n"))


# Keys and predicates


@query("rubbish_reasons")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).select("word_orig", rubbish_reason(F.col("word_orig")).alias("reason"))


@query("rubbish_filter")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.corpus(spark, sf_dir)
    dropped = F.size(F.filter("infer_list", lambda m: is_rubbish(m["word_orig"])))
    return documents.select("patent_id", dropped.alias("dropped"), F.size("infer_list").alias("n")).select(
        "patent_id", (F.col("n") - F.col("dropped")).alias("kept"), "dropped"
    )


@query("strip_tags")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", F.md5(strip_tags(F.col("html"))).alias("text_md5"))


@query("cas_key")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = inputs.spread(
        inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    )
    words = lineitem.withColumn("word", inputs.cas_word(F.col("l_partkey"), F.col("l_linenumber")))
    return words.select("l_orderkey", "l_linenumber", cas_key(F.col("word")).alias("cas"))


@query("formula_clean")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).select("word_orig", formula_clean(F.col("word_orig")).alias("cleaned"))


@query("formula_expand")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = formula_clean(F.col("word_orig"))
    return _words(spark, sf_dir).select("word_orig", formula_expand(cleaned).alias("expanded"))


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _words(spark, sf_dir)
        .withColumn("cleaned", formula_clean(F.col("word_orig")))
        .withColumn("expanded", formula_expand(F.col("cleaned")))
        .withColumn("tokens", formula_tokens(F.col("expanded")))
    )


@query("formula_tokens")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens(spark, sf_dir).select("word_orig", F.array_join("tokens", " ").alias("tokens"))


@query("formula_rejects")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = formula_reject(F.col("cleaned"), F.col("expanded"), F.col("tokens"))
    return _tokens(spark, sf_dir).select("word_orig", reason.alias("reason"))


@query("formula_key")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).select("word_orig", formula_key(F.col("word_orig")).alias("key"))


# Dictionaries


def _dictionary_text(dictionary: DataFrame) -> DataFrame:
    return dictionary.select("key", _ids_text())


@query("dict_name")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dictionary_text(inputs.name_dictionary(spark, sf_dir))


@query("dict_name_bucketed")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = inputs.name_dictionary(spark, sf_dir)
    return _dictionary_text(
        publish_dictionary(dictionary, _table_name("names"), scratch_path(spark, "names"), BUCKETS)
    )


@query("dict_cas")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dictionary_text(inputs.cas_dictionary(spark, sf_dir))


@query("dict_formula")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dictionary_text(inputs.formula_dictionary(spark, sf_dir))


@query("dict_inchikey")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dictionary_text(inputs.inchikey_dictionary(spark, sf_dir))


@query("dict_entity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dictionary_text(inputs.entity_dictionary(spark, sf_dir))


@query("dict_upkeep")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary of seven parts to which the eighth is added, twice."""
    rows, path = inputs.name_rows(spark, sf_dir), scratch_path(spark, "upkeep")
    key, order = strip_tags(F.col("raw_key")), load_order(F.col("part"), F.col("row"))
    start_dictionary(rows.where("part <> 8"), key, order, path, BUCKETS)
    for _ in range(2):
        kept = update_dictionary(rows.where("part = 8"), key, order, path, BUCKETS)
    return _dictionary_text(kept)


@query("dict_merge_union")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_union(inputs.name_rows(spark, sf_dir), strip_tags(F.col("raw_key")))


# Lookups


def _hits_text(hits: DataFrame) -> DataFrame:
    return hits.select("word_orig", _ids_text())


@query("lookup_name")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits_text(lookup_words(_words(spark, sf_dir), inputs.name_dictionary(spark, sf_dir)))


def _lookup(spark: SparkSession, sf_dir: str, step: Lookup) -> DataFrame:
    words = distinct_words(inputs.word_documents(spark, sf_dir), [step])
    return _hits_text(resolve_words(words, [step]))


@query("lookup_union")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain step on a dictionary that keeps the ids of all parts."""
    merged = merge_union(inputs.name_rows(spark, sf_dir), strip_tags(F.col("raw_key")))
    return _lookup(spark, sf_dir, Lookup("name", union_dictionary(merged)))


@query("lookup_cas")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, Lookup("cas", inputs.cas_dictionary(spark, sf_dir), key=cas_key))


@query("lookup_formula")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, Lookup("formula", inputs.formula_dictionary(spark, sf_dir), key=formula_key))


@query("lookup_inchikey")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, dictionary = inputs.name_to_inchikey(spark, sf_dir), inputs.inchikey_dictionary(spark, sf_dir)
    return _lookup(spark, sf_dir, Lookup("inchikey", dictionary, names=names))


@query("lookup_entity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits_text(lookup_words(_words(spark, sf_dir), inputs.entity_dictionary(spark, sf_dir)))


# The chain


def _resolved_words(spark: SparkSession, sf_dir: str, **options: str | bool) -> DataFrame:
    chain = inputs.chain(spark, sf_dir, **options)
    words = distinct_words(inputs.word_documents(spark, sf_dir), chain)
    resolved = answered_words(words, resolve_words(words, chain))
    return resolved.select("word_orig", "stage", _ids_text(), F.lit(SECTION).alias("section"))


@query("cascade")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved_words(spark, sf_dir)


@query("cascade_keep_names")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rubbish words that are dictionary names stay, other rubbish goes."""
    return _resolved_words(spark, sf_dir, rubbish_scope="unresolved")


@query("tagged_keep_names")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of the words that stay, resolved or not."""
    _, tagged = _tagged(spark, sf_dir, unresolved=True, rubbish_scope="unresolved")
    return tagged.select("patent_id", "pos", "word_orig", _ids_text(), "stage")


@query("cascade_drop_cas")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CAS numbers are rubbish like all words of digits."""
    return _resolved_words(spark, sf_dir, spare_cas=False)


@query("cascade_extended")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the words resolved by a former job, the others now."""
    chain = inputs.chain(spark, sf_dir)
    words = distinct_words(inputs.word_documents(spark, sf_dir), chain)
    half = words.where(F.pmod(F.xxhash64("word_orig"), F.lit(2)) == 0)
    earlier = materialise(answered_words(half, resolve_words(half, chain)), "earlier")
    return extend_resolution(words, chain, earlier).select("word_orig", "stage", _ids_text())


def _tagged(
    spark: SparkSession, sf_dir: str, unresolved: bool = False, **options: str | bool
) -> tuple[DataFrame, DataFrame]:
    """The mention documents and their tagged mentions."""
    chain = inputs.chain(spark, sf_dir, **options)
    documents = inputs.stored_corpus(spark, sf_dir)
    words = distinct_words(documents, chain)
    mentions = flatten_mentions(documents, KEYS)
    return documents, tag_mentions(mentions, words, resolve_words(words, chain), SECTION, unresolved, chain=chain)


@query("tagged_mentions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All mentions that are not rubbish, resolved or not."""
    _, tagged = _tagged(spark, sf_dir, unresolved=True)
    return tagged.select("patent_id", "pos", "word_orig", _ids_text(), "stage", "section")


@query("resolve_stream")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mention files that come in two feeds, the second of which is delivered twice."""
    source, answers, target, checkpoint = (scratch_path(spark, n) for n in ("source", "answers", "target", "offsets"))
    chain = inputs.chain(spark, sf_dir)
    second = F.left("patent_id", F.lit(1)).isin("P", "C")
    for feed in (~second, second):
        store(inputs.derived_corpus(spark, sf_dir).where(feed), source, "append")
        resolve_available(spark, source, chain, SECTION, answers, target, checkpoint)
    again = read_mentions(spark, source).where(second)
    batch_resolver(chain, SECTION, answers, target)(again, 1)
    tagged = spark.read.parquet(target)
    return tagged.select("patent_id", "pos", "word_orig", _ids_text(), "stage", "section")


@query("resolved_only")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tagged = _tagged(spark, sf_dir, unresolved=True)
    return resolved_only(tagged).select("patent_id", "pos", "word_orig", _ids_text())


@query("route_substance")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tagged = _tagged(spark, sf_dir)
    routed = route_substance(tagged).withColumnRenamed("subs_ids", "ids")
    return routed.select("patent_id", "pos", "word_orig", _ids_text())


@query("route_entity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tagged = _tagged(spark, sf_dir)
    return route_entity(tagged).select("patent_id", "pos", "word_orig", "ppi_id")


def _published(documents: DataFrame, mentions: DataFrame, field: str) -> DataFrame:
    fields = ["start_orig", "end_orig", "word_orig", field, "section"]
    path = scratch_path(documents.sparkSession, "published")
    stored = publish_documents(mentions, documents, fields, _table_name("published"), path, BUCKETS, KEYS)
    return stored.select("patent_id", F.size("infer_list").alias("n"), F.col(f"infer_list.{field}").alias("found"))


@query("publish_substance")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, tagged = _tagged(spark, sf_dir)
    stored = _published(documents, route_substance(tagged), "subs_ids")
    return stored.select("patent_id", "n", F.md5(F.array_join(F.flatten("found"), ",")).alias("ids_md5"))


@query("publish_entity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, tagged = _tagged(spark, sf_dir)
    stored = _published(documents, route_entity(tagged), "ppi_id")
    return stored.select("patent_id", "n", F.array_join("found", ",").alias("ids"))


@query("link_documents")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job; mentions per document in each of the two tables."""
    outputs = [Output(_table_name(name), scratch_path(spark, name)) for name in ("substance", "entity")]
    substances, entities = link_documents(
        inputs.stored_corpus(spark, sf_dir), inputs.chain(spark, sf_dir), SECTION, *outputs, BUCKETS, KEYS
    )
    counted = [
        published.select(F.lit(name).alias("output"), "patent_id", F.size("infer_list").alias("n"))
        for name, published in (("substance", substances), ("entity", entities))
    ]
    return counted[0].unionByName(counted[1])


@query("renest")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their rubbish mentions; some are left with none."""
    documents = inputs.stored_corpus(spark, sf_dir)
    kept = _flat(documents).where(~is_rubbish(F.col("word_orig")))
    nested = renest_mentions(kept, documents)
    return nested.select(
        "patent_id", F.size("infer_list").alias("n"), F.md5(F.array_join("infer_list.word_orig", "|")).alias("words_md5")
    )


@query("nested_resolved_only")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unresolved mentions dropped inside the nested lists."""
    documents, tagged = _tagged(spark, sf_dir, unresolved=True)
    mentions = tagged.withColumnRenamed("ids", "subs_ids")
    nested = keep_resolved(renest_mentions(mentions, documents, KEYS, ["word_orig", "subs_ids"]))
    return nested.select("patent_id", F.size("infer_list").alias("n"))


# User-defined steps


@query("custom_stage")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A one-step chain: the key is the word in small letters."""
    chain = [Lookup("lower", inputs.stored(spark, sf_dir, inputs.name_dictionary), key=F.lower)]
    words = distinct_words(inputs.word_documents(spark, sf_dir), chain)
    return resolve_words(words, chain).select("word_orig", "stage", _ids_text())


