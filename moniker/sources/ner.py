"""Recogniser output (gzip JSON lines) and the mention table made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

NER_SCHEMA = (
    "patent_id string, data struct<results_list: array<struct<infer_list: array<struct<"
    "start_orig: int, end_orig: int, word_orig: string, entity_group: string>>>>>"
)
MENTION_SCHEMA = (
    "patent_id string, infer_list array<struct<start_orig: int, end_orig: int, word_orig: string>>"
)
BAD_LINE = "bad_line"


def read_ner(spark: SparkSession, path: str | list[str], glob: str = "*.json.gz") -> DataFrame:
    """Scan JSON lines. A line that is no such record is kept in ``bad_line``.

    The schema names only what is used, so the parser skips all other fields. A
    gzip file is one task whatever its size.
    """
    return (
        spark.read.schema(f"{NER_SCHEMA}, {BAD_LINE} string")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .option("pathGlobFilter", glob)
        .json(path)
    )


def cem_mentions(ner: DataFrame) -> DataFrame:
    """One row per record with its chemical mentions in order, an empty list if none."""
    inferred = F.flatten(F.transform("data.results_list", lambda r: F.coalesce(r["infer_list"], F.array())))
    chemical = F.filter(inferred, lambda m: m["entity_group"] == "CEM")
    projected = F.transform(
        chemical,
        lambda m: F.struct(*(m[name].alias(name) for name in ("start_orig", "end_orig", "word_orig"))),
    )
    rest = [F.col(BAD_LINE)] if BAD_LINE in ner.columns else []
    return ner.select("patent_id", F.coalesce(projected, F.array()).alias("infer_list"), *rest)


def quarantined(spark: SparkSession, *paths: str) -> DataFrame:
    """The lines that could not be read, from the written mention table."""
    table = spark.read.schema(f"{BAD_LINE} string").option("pathGlobFilter", "*.parquet").parquet(*paths)
    return table.where(F.col(BAD_LINE).isNotNull())


def _ingest_counts(documents: DataFrame) -> list[Column]:
    readable = F.col(BAD_LINE).isNull() if BAD_LINE in documents.columns else F.lit(True)
    n_mentions = F.coalesce(F.size("infer_list"), F.lit(0))
    return [
        F.count_if(readable).alias("n_docs"),
        F.coalesce(F.sum(n_mentions), F.lit(0)).alias("n_mentions"),
        F.count_if(readable & (n_mentions == 0)).alias("n_empty_docs"),
        F.count_if(~readable).alias("n_bad_lines"),
    ]


def count_ingest(documents: DataFrame) -> DataFrame:
    return documents.agg(*_ingest_counts(documents))


def write_mentions(documents: DataFrame, path: str, files: int | None = None) -> dict[str, int]:
    """Write the mention table and return its counts, observed during the write.

    ``files`` spreads the rows again after the scan; without it every input
    file gives one output file.
    """
    seen = Observation("ingest")
    watched = documents.observe(seen, *_ingest_counts(documents))
    if files is not None:
        watched = watched.repartition(files)
    watched.write.mode("overwrite").parquet(path)
    return seen.get


def row_number_hash() -> Column:
    """Hash of file and row number, the same in a recomputed task."""
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def read_mentions(spark: SparkSession, *paths: str, file: str | None = None) -> DataFrame:
    """Mention table with ``row_id``, which tells rows of one ``patent_id`` apart.

    With a name as ``file`` the path of each row's file is a column too.
    """
    table = (
        spark.read.schema(f"{MENTION_SCHEMA}, {BAD_LINE} string")
        .option("pathGlobFilter", "*.parquet")
        .parquet(*paths)
    )
    more = [] if file is None else [F.col("_metadata.file_path").alias(file)]
    return table.where(F.col(BAD_LINE).isNull()).select("patent_id", row_number_hash().alias("row_id"), "infer_list", *more)
