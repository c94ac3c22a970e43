"""Tables that are replaced by one switch, so that readers always find a whole one."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moniker.plans.publish import in_files
from moniker.sources.scratch import delete, folders, store


def current_version(spark: SparkSession, table: str) -> str | None:
    """Folder that the table's files are in; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where(F.col("col_name") == "Location")
    return described.first()["data_type"]


def publish_version(df: DataFrame, table: str, root: str) -> DataFrame:
    """Write ``df`` as a new version of ``table`` in a folder of its own under ``root``, then point the table to it.

    Until the switch, which is one change in the catalogue, readers see the version before;
    a failure at any step leaves the table as it was, and at most a folder that
    ``drop_versions`` clears away.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    store(df, path)
    if spark.catalog.tableExists(table):
        _switch(spark, table, path)
    else:
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
    return spark.table(table)


def _switch(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def drop_versions(spark: SparkSession, table: str, root: str) -> list[str]:
    """Delete the folders under ``root`` that the table does not point to; call it when no reader uses them any more."""
    current = current_version(spark, table)
    if current is None:
        raise ValueError(f"there is no table {table}")
    name = current.rstrip("/").rsplit("/", 1)[-1]
    old = [p for p in folders(spark, root) if (own := p.rsplit("/", 1)[-1]).startswith("v-") and own != name]
    for path in old:
        delete(spark, path)
    return old


def compact_table(spark: SparkSession, parts: Sequence[str], schema: str, table: str, root: str, files: int | None = None) -> DataFrame:
    """Many parquet parts as one table, see ``compact``, published as a new version."""
    rows = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(*parts)
    return publish_version(in_files(rows, parts, files), table, root)
