"""Audit of how filters act upon each other, for every order in which they can be applied.

A document is known by the set of filters it fails, a mask of five bits. Documents of one
part (``lang``) and one mask are counted, and all orders are worked out from these counts.

The orders are numbered lexicographically, as Lehmer codes number permutations. A document
with a given mask is removed in step ``s`` of exactly those orders whose first ``s - 1``
filters it passes and whose next it fails; the orders that begin with one such row of ``s``
filters have consecutive ranks, (5 - s)! of them. So each mask has a short list of intervals
for each step. Its counts are added at the begin of each interval and taken off at its end,
in an array of differences for each step, whose running sums over the ranks are the numbers
removed by every order.

Defined results: a null text is empty, a null ``lang`` counts with the empty one. Rows with
one id are separate documents; copies among them have no smaller id than each other, so they
do not fail filter E through each other. A row without an id is smaller than none and larger
than none: it never fails E. Of several labels of a document the largest counts; a missing or
null label is none. Without documents there are no rows.

Copies of one text meet by a digest of the text. They are combined before each shuffle, by
id and then by part, mask and labels, so that a text which a third of all rows share arrives
as one row from each task. What is joined by id is one short row for each document.
"""

from __future__ import annotations

from functools import cache
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moniker.sources import materialise

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
COUNTS = ["n", "good", "toxic"]
COLUMNS = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def text_mask(text: Column) -> Column:
    """Bits of the filters that look at the text alone, A to D."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    size = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    fails = [
        size < 100,
        100 * F.size(F.array_distinct(words)) < 80 * size,
        100 * capitals > 10 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0)).cast("int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and mask, and how many of them have each label."""
    text = F.coalesce(F.col("text"), F.lit(""))
    part = F.coalesce(F.col("lang"), F.lit("")).alias("part")
    digest = F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    slim = docs.select(F.col("doc_id").alias("id"), part, digest, text_mask(F.col("text")).alias("mask"))
    keys = ["id", "digest", "part", "mask"]
    slim = materialise(slim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "audit")
    marks = [F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(*marks)
    known = slim.where("id is not null").join(told, "id", "left").na.fill(0, ["good", "toxic"])
    group = ["digest", "part", "mask", "good", "toxic"]
    first = F.min(F.struct("id", "n"))
    copies = known.groupBy(*group).agg(F.sum("n").alias("n"), first.alias("first"))
    least = F.min("first.id").over(Window.partitionBy("digest"))
    free = F.when(F.col("first.id") == least, F.col("first.n")).otherwise(0)
    parted = copies.withColumn("free", free).select("part", "mask", "good", "toxic", "n", "free")
    parted = parted.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.sum("free").alias("free"))
    copied = F.col("mask").bitwiseOR(F.lit(1 << FILTERS.index("E")))
    both = F.array(F.struct("mask", F.col("free").alias("n")), F.struct(copied.alias("mask"), (F.col("n") - F.col("free")).alias("n")))
    rows = parted.select("part", "good", "toxic", F.explode(both).alias("x"))
    rows = rows.select("part", "good", "toxic", "x.mask", "x.n")
    nameless = slim.where("id is null").select("part", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "mask", "n")
    rows = rows.unionByName(nameless).groupBy("part", "mask")
    return rows.agg(*[F.sum(x).alias(c) for c, x in zip(COUNTS, (F.col("n"), F.col("n") * F.col("good"), F.col("n") * F.col("toxic")), strict=True)])


@cache
def orders() -> np.ndarray:
    """Number of the filter of each order (row, by rank) and step."""
    return np.array(list(permutations(range(len(FILTERS)))))


@cache
def intervals(mask: int) -> list[tuple[int, int, int]]:
    """(step from 0, first rank, rank after the last) of all orders in which a mask is removed in that step."""
    total, found = len(FILTERS), []

    def descend(taken: tuple[int, ...], rank: int) -> None:
        left = [f for f in range(total) if f not in taken]
        width = factorial(len(left) - 1) if left else 0
        for place, f in enumerate(left):
            begin = rank + place * width
            if mask >> f & 1:
                found.append((len(taken), begin, begin + width))
            else:
                descend((*taken, f), begin)

    descend((), 0)
    return found


def audit_part(part: str, counts: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part from its ``counts`` (mask, n, good, toxic), at most one row a mask."""
    order, steps = orders(), len(FILTERS)
    change = np.zeros((len(COUNTS), steps, len(order) + 1), np.int64)
    fails, alone = np.zeros(steps, np.int64), np.zeros(steps, np.int64)
    for mask, *own in counts[["mask", *COUNTS]].itertuples(index=False):
        for step, begin, end in intervals(int(mask)):
            change[:, step, begin] += own
            change[:, step, end] -= own
        failing = [f for f in range(steps) if int(mask) >> f & 1]
        fails[failing] += own[0]
        if len(failing) == 1:
            alone[failing] += own[0]
    lost, good, toxic = change.cumsum(axis=2)[:, :, :-1].transpose(0, 2, 1)
    shapley = np.array([lost[order == f].sum() for f in range(steps)])
    own = order.ravel()
    return pd.DataFrame({
        "part": part,
        "filter_order": np.repeat(["".join(FILTERS[f] for f in row) for row in order], steps),
        "step": np.tile(np.arange(1, steps + 1, dtype=np.int32), len(order)),
        "kept": (int(counts["n"].sum()) - lost.cumsum(axis=1)).ravel(),
        "removed": lost.ravel(),
        "redundant": fails[own] - lost.ravel(),
        "unique_fails": alone[own],
        "good_lost": good.ravel(),
        "toxic_lost": toxic.ravel(),
        "shapley": shapley[own],
    })


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step, see ``COLUMNS``."""

    def run(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        return audit_part(key[0], counts)

    return mask_counts(docs, labels).groupBy("part").applyInPandas(run, COLUMNS)


AUDIT_SQL = r"""
WITH own AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
told AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
masks AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
        len(w) < 100,
        100 * len(list_distinct(w)) < 80 * len(w),
        100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t),
        regexp_matches(t, '[#$%&*|]'),
        coalesce(own.doc_id > min(own.doc_id) OVER (PARTITION BY t), false)
    ] AS fails
    FROM own LEFT JOIN told ON own.doc_id = told.doc_id
),
counts AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, fails),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
orders AS (
    SELECT [a.f, b.f, c.f, d.f, e.f] AS o
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
steps AS (SELECT o, f AS step, o[f] AS f FROM orders, letters),
told_steps AS (
    SELECT part, o, step, f, n, good, toxic, fails[f] AS fail,
        len(list_filter(o[1:step - 1], lambda x: fails[x])) > 0 AS gone,
        len(list_filter(fails, lambda x: x)) AS many
    FROM counts, steps
),
summed AS (
    SELECT part, o, step, f, sum(n) FILTER (NOT gone AND NOT fail) AS kept, sum(n) FILTER (NOT gone AND fail) AS removed,
        sum(n) FILTER (gone AND fail) AS redundant, sum(n) FILTER (fail AND many = 1) AS unique_fails,
        sum(good) FILTER (NOT gone AND fail) AS good_lost, sum(toxic) FILTER (NOT gone AND fail) AS toxic_lost
    FROM told_steps GROUP BY part, o, step, f
)
SELECT part, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') AS filter_order, CAST(step AS INTEGER) AS step,
    CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
    CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM summed
"""
