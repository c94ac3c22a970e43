"""Between nested documents and flat mention rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moniker.sources.scratch import gathered


# A patent may come in several rows, each a document of its own.
DOCUMENT_KEYS = ("patent_id", "row_id")


# What has more mentions than these is dealt to several tasks.
PART_ROWS = 1_000_000


# A job on more mentions than these is done in slices of the patents, at most so many, each of which
# has its shuffle files to itself: what a job needs of the disk besides its tables does not grow with them
# until there are SLICES, each of which reads the documents once more.
SLICE_ROWS = 8_000_000
SLICES = 8


def mention_weight() -> Column:
    """Mentions of a document and itself; reads one number per mention."""
    return F.coalesce(F.size("infer_list.start_orig"), F.lit(0)) + 1


def task_parts(rows: int, tasks: int = 1) -> int:
    """Parts that each of so many tasks is cut into, so that one has about ``PART_ROWS`` rows at most."""
    return max(1, math.ceil(rows / (tasks * PART_ROWS)))


def weighed(documents: DataFrame) -> int:
    """Mentions of all documents and the documents themselves."""
    return documents.agg(F.coalesce(F.sum(mention_weight()), F.lit(0))).first()[0]


def slice_count(rows: int, most: int | None = None) -> int:
    """Slices that a job on so many mentions is done in."""
    return max(1, min(SLICES if most is None else min(SLICES, most), math.ceil(rows / SLICE_ROWS)))


def slices(place: Column, count: int) -> list[Column]:
    """One condition for each slice of rows by a number that rows of one document share."""
    return [F.pmod(place, F.lit(count)) == i for i in range(count)] if count > 1 else [F.lit(True)]


def flatten_mentions(documents: DataFrame, keys: Sequence[str] = DOCUMENT_KEYS) -> DataFrame:
    """One row per mention; ``pos`` is its place in the document's list."""
    exploded = documents.select(*keys, F.posexplode("infer_list").alias("pos", "mention"))
    return exploded.select(*keys, "pos", "mention.*")


def gather_mentions(fields: Sequence[str | Column]) -> Column:
    """Aggregate that puts the mentions of a group back in their order.

    Rows without ``pos`` stand for a document itself and add nothing, so a
    document that has only such a row gets an empty list.
    """
    mention = F.struct("pos", *fields)
    ordered = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), mention)))
    return F.transform(ordered, lambda m: m.dropFields("pos"))


def with_all_documents(mentions: DataFrame, documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mention rows plus one row per document that has nothing but its keys."""
    return mentions.unionByName(documents.select(*keys), allowMissingColumns=True)


def _dealt(rows: DataFrame, mentions: int, keys: Sequence[str]) -> DataFrame:
    """Rows of a document brought together before they are gathered, so that no task sorts more than ``PART_ROWS`` or so."""
    parts = task_parts(mentions)
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(*keys) if parts <= usual else rows.repartition(parts, *keys)


def renest_mentions(
    mentions: DataFrame,
    documents: DataFrame,
    keys: Sequence[str] = DOCUMENT_KEYS,
    fields: Sequence[str] = ("start_orig", "end_orig", "word_orig"),
) -> DataFrame:
    """Documents with their mention lists, in one shuffle and without a join.

    A list is never longer than the one its document came with, so a group is
    bounded by a row of the input. Of many mentions one slice after the other is shuffled, and the lists are written.
    """
    rows = with_all_documents(mentions.select(*keys, "pos", *fields), documents, keys)
    weight = weighed(documents) if "infer_list" in documents.columns else None
    count = slice_count(weight or 0)

    def nested(part: DataFrame) -> DataFrame:
        dealt = part if weight is None else _dealt(part, math.ceil(weight / count), keys)
        return dealt.groupBy(*keys).agg(gather_mentions(fields).alias("infer_list"))

    if count == 1:
        return nested(rows)
    return gathered((nested(rows.where(part)) for part in slices(F.hash(*keys), count)), "nested")
