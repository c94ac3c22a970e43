"""Documents made ready for training, stage by stage.

Every stage works on all that the one before it kept, and returns the columns of
``documents``; the last adds the ids of the pieces. SQL cannot express the first and the
last, so the whole is tested stage by stage against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moniker.llm.jaccard import Rule, linked_classes
from moniker.llm.mixing import mixed_documents
from moniker.llm.pieces import encode_pieces
from moniker.llm.queries import piece_model, table, toxicity_model
from moniker.llm.secrets import mask_secrets
from moniker.llm.toxicity import score_toxicity
from moniker.sources import scratch_job, settle

ORACLE_SQL = None
NEAR = Rule(words=5, least=80)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half. Repeated rows and null texts are scored like all."""
    with scratch_job(spark):  # the model is held by the driver
        model = toxicity_model(spark, docs, sf_dir)
    scored = score_toxicity(docs, model, docs.columns, score="__score")
    return scored.where(F.col("__score") < 0.5).drop("__score")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id; links are by shingles of five words and a similarity of 0.8.

    Rows with one id are one document: one of them stays, if any does. Rows without an id
    cannot be told apart and all stay, as do documents without words.
    """


    def least_of_groups() -> DataFrame:
        told = linked_classes(docs, NEAR).where(F.col("id").isNotNull()).groupBy("id")
        told = told.agg(F.count(F.lit(1)).alias("__rows"), F.max((F.col("id") == F.col("component")).cast("int")).alias("__stays"))
        return told.where("__stays = 1").select(F.col("id").alias("__id"), "__rows")

    stays = settle(spark, "stays", least_of_groups)
    match = F.col("doc_id") == F.col("__id")
    single = docs.join(stays.where("__rows = 1"), match, "left_semi")
    several = docs.join(stays.where("__rows > 1"), match, "left_semi").dropDuplicates(["doc_id"])
    return single.unionAll(several).unionAll(docs.where(F.col("doc_id").isNull()))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; ``n_chars`` follows the text."""
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixed_documents(docs)


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their pieces and the number of ids."""
    encoded = encode_pieces(docs, piece_model())
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("pieces", in_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(spark, name, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
