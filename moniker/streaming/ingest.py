"""Convert only the recogniser files that have not been converted yet."""

from __future__ import annotations

from pyspark.sql import SparkSession

from moniker.sources.ner import BAD_LINE, NER_SCHEMA, cem_mentions


def ingest_available(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    glob: str = "*.json.gz",
    files_per_batch: int | None = None,
) -> None:
    """Append the mentions of all new files to the table at ``target`` and stop.

    The checkpoint remembers files by their full name, and the parquet sink
    commits every micro-batch once, also after a failure in between.
    """
    reader = (
        spark.readStream.schema(f"{NER_SCHEMA}, {BAD_LINE} string")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .option("pathGlobFilter", glob)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        cem_mentions(reader.json(source))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
