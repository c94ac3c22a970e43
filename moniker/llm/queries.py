"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moniker.llm.audit import AUDIT_SQL, audit_filters
from moniker.llm.cotrain import fit_quality, score_quality
from moniker.llm.jaccard import linked_classes
from moniker.llm.lattice import linked_vectors
from moniker.llm.licenses import find_licenses, license_sql
from moniker.llm.maxent import ROUNDS, score_texts
from moniker.llm.middle import MIDDLE_SQL, fill_in_middle
from moniker.llm.mixing import mix_sources
from moniker.llm.nearest import nearest
from moniker.llm.pages import main_texts
from moniker.llm.pieces import piece_digests
from moniker.llm.secrets import find_secrets
from moniker.llm.toxicity import ToxicityModel, fit_toxicity, score_toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def fold(folds: int) -> Column:
    """Number of the fold of a document; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, meta = table(spark, sf_dir, "documents"), ["lang", "source", "n_chars"]
    model = fit_quality(docs, table(spark, sf_dir, "labels").where(fold(5) != 0), meta, learnable=fold(5) != 0)
    scored = score_quality(docs, model, meta, ["doc_id"])
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", predicted)


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> ToxicityModel | float:
    """Learnt from the labels outside of fold 0."""
    return fit_toxicity(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, toxicity_model(spark, docs, sf_dir), ["doc_id"])
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", predicted)


def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_classes(table(spark, sf_dir, "documents")).toDF("doc_id", "n_shingles", "component_id")


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "finish")


MIXING_SQL = r"""
WITH own AS (
    SELECT doc_id, source, md5(coalesce(text, '')) AS digest, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents
),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM own GROUP BY source),
weighed AS (
    SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight FROM sizes
),
ends AS (SELECT *, 3 * source_size AS most, CAST(3 * source_size AS DOUBLE) / weight AS ends FROM weighed),
levels AS (
    SELECT *,
        CAST(sum(source_size) OVER () - coalesce(sum(most) OVER before, 0) AS DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM ends WINDOW before AS (ORDER BY ends, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
    SELECT source, source_size, weight,
        least(CAST(most AS DOUBLE), weight * (SELECT max(level) FROM levels WHERE level <= ends)) AS target
    FROM levels
),
served AS (
    SELECT own.*, source_size, weight, target, CAST(round(target) AS BIGINT) AS goal,
        CAST(coalesce(sum(size) OVER (
            PARTITION BY own.source ORDER BY draw, doc_id, size, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
        ), 0) AS BIGINT) AS start
    FROM own JOIN targets ON own.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    CAST(least(size, greatest(goal - start, 0)) + least(size, greatest(goal - start - source_size, 0))
        + least(size, greatest(goal - start - 2 * source_size, 0)) AS BIGINT) AS taken,
    CAST(start + size AS DOUBLE) / weight AS finish
FROM served
"""


def lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linked_vectors(table(spark, sf_dir, "embeddings")).toDF("vec_id", "n_links", "component_id")
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.toDF("query_id", "rank", "vec_id", "score")


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), piece_model(), ["doc_id"])


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(10) == 0)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS))
    return score_texts(docs, ~F.col("held_out"), ["doc_id", "held_out"], part)


def middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents"), digests=True).withColumnRenamed("id", "doc_id")


def extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_texts(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_cotraining": cotraining,
        "op2_licenses": licenses,
        "op3_secrets": secrets,
        "op4_toxicity": toxicity,
        "op5_jaccard": jaccard,
        "op6_mixing": mixing,
        "op7_neighbours": neighbours,
        "op8_lattice": lattice,
        "op9_pieces": pieces,
        "op10_language_model": language_model,
        "op11_middle": middle,
        "op12_extraction": extraction,
        "op13_audit": audit,
    }


def statements() -> dict[str, str]:
    return {"op2_licenses": license_sql(), "op6_mixing": MIXING_SQL, "op11_middle": MIDDLE_SQL, "op13_audit": AUDIT_SQL}
