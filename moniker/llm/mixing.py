"""Mixing sources to target weights by weighted fair queueing.

Every source shuffles its documents by a digest of their ids and serves them in this
order, over and over; a copy of a document is finished at the virtual time (words its
source has served up to its end) / (weight of the source). Serving goes on until the
words of all sources together, the budget, are served. A source stops after ``TIMES``
rounds, and then the others go on at their weights; so the virtual time at which the
budget is spent, and with it the words each source gets, follow from the totals of the
sources alone. What is finished by then is taken whole, and of the one document that each
source is serving then, the words served.

Sources are ordered by code point, null last, and get the ``WEIGHTS`` in turn. Only their
totals meet in one place, one row for each source. Running sums within a source are taken
in 4096 slices of the digest, whose totals are summed on their own, so that no source has
to pass through one task.

Null texts have no words; a source without words has the target 0. Documents with equal
ids and texts are served one after the other. Nothing depends on the order of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moniker.sources import materialise

WEIGHTS = (5, 2, 1)
TIMES = 3
SLICE = 3  # hexadecimal digits of the digest that number a slice
WORD = r"[^\x20\x09-\x0D]+"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: int = TIMES) -> DataFrame:
    """``sizes`` (source, source_size, and more), one row for each source, with its ``weight`` and ``target``.

    Sources by the time at which they are served out: all before the first that the budget
    does not serve out are, and the budget that is left goes to the others by weight.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    shares = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("weight", F.get(shares, F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights)))))
    out = rows.withColumn("most", times * F.col("source_size")).withColumn("ends", F.col("most") / F.col("weight"))
    order = Window.orderBy("ends", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    going = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = out.withColumn("level", left / going)
    level = level.withColumn("level", F.max(F.when(F.col("level") <= F.col("ends"), F.col("level"))).over(everything))
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.col("level"))
    return level.withColumn("target", target).drop("most", "ends", "level")


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    times: int = TIMES,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """(id, size, source_size, target, taken, finish, digest) of every row of ``docs``, in order of ``finish``.

    ``finish`` is the virtual time at which the first copy is finished and ``taken`` the
    words that all copies give. ``digest`` is that of the text.
    """
    own = docs.select(
        F.col(f"`{key}`").alias("id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        count_words(F.col(f"`{text}`")).alias("size"),
        F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("digest"),
    )
    drawn = own.withColumn("draw", F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))))
    drawn = drawn.withColumn("slice", F.left("draw", F.lit(SLICE)))
    drawn = materialise(drawn.withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))), "mix")
    slices = drawn.groupBy("name", "source", "slice").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("offset", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    targets = source_targets(slices.groupBy("name", "source").agg(F.sum("n").alias("source_size")), weights, times)
    slices = slices.select("name", "slice", "offset").join(targets.drop("source"), "name")
    # Equal rows are served one after the other, whichever comes first.
    inside = Window.partitionBy("name", "slice").orderBy("draw", "id", "size", "digest")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    served = drawn.select("name", "slice", "id", "size", "digest", before.alias("before")).join(slices, ["name", "slice"])
    served = served.withColumn("start", F.col("offset") + F.col("before"))
    goal = F.round("target").cast("long")
    copies = [F.least(F.col("size"), F.greatest(goal - F.col("start") - i * F.col("source_size"), F.lit(0))) for i in range(times)]
    taken = sum(copies[1:], copies[0])
    finish = (F.col("start") + F.col("size")) / F.col("weight")
    rows = served.select("id", "size", "source_size", "target", taken.alias("taken"), finish.alias("finish"), "digest")
    return rows.orderBy("finish", "id", "digest")


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` as often as they are taken: whole copies, and of the document being served last its first words.

    Columns stay; ``n_chars``, if there, follows the text. Documents not taken are left out.
    Of rows with equal id and text one stands for all, as often as all are taken.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    plan = mix_sources(docs, key=key, text=text, **options).groupBy("id", "digest")
    plan = plan.agg(F.max("size").alias("__size"), F.sum("taken").alias("__taken"), F.count(F.lit(1)).alias("__rows"))
    plan = materialise(plan.where("__taken > 0").withColumnsRenamed({"id": "__id", "digest": "__digest"}), "mix-plan")
    match = F.col(f"`{key}`").eqNullSafe(F.col("__id")) & (F.md5(body) == F.col("__digest"))
    single = docs.join(plan.where("__rows = 1"), match)
    several = docs.join(plan.where("__rows > 1"), match).dropDuplicates(["__id", "__digest"])
    joined = single.unionByName(several)
    whole = F.floor(F.col("__taken") / F.col("__size")).cast("int")
    part = F.col("__taken") - whole * F.col("__size")
    copies = F.array_repeat(F.col("__size"), whole)
    taken = joined.withColumn("__words", F.explode(F.when(part > 0, F.array_append(copies, part)).otherwise(copies)))
    own = F.col(f"`{text}`")
    pieces = F.arrays_zip(F.split(own, WORD, -1).alias("gap"), F.regexp_extract_all(own, F.lit(WORD), F.lit(0)).alias("word"))
    first = F.slice(pieces, F.lit(1), F.col("__words").cast("int"))
    cut = F.array_join(F.transform(first, lambda x: F.concat(x["gap"], x["word"])), "")
    cut = F.when(F.col("__words") == F.col("__size"), own).otherwise(cut)
    columns = [cut.alias(c) if c == text else F.length(cut).cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return taken.select(*columns)
