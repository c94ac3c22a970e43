"""Toxicity as the difference of two class-conditional Kneser-Ney models.

Each class (toxic, ordinary) has a bigram model of continuation counts: after how many
different words a pair stands, less an absolute discount. It backs off to the continuation
counts of single words, and these back off to counts that both classes share: in how many
classes a word stands. As a pair is counted once for each word before it, copies of a text
weigh no more than the text. The discounts are below 1 and estimated for each class from
how many pairs (words) stand after one and after two different words (pairs), so that
something is left of every expression a class has.

The evidence of a document are the log-likelihood ratios of all its words, what each word
says alone and what its context adds, and ``POWERS`` of them, summed and taken per word
and per square root of the words. The score is the logistic function of these sums; the
coefficients, and how strongly they are held back, come from labelled rows that the counts
they are told by have not seen. So no ratio is left out, and how much small and large ones
say is learnt.

The models are fitted on at most ``SAMPLE`` labelled rows of each class, picked by a hash
of their id. They are arrays of fixed size (words hash to 2**20 places, bigrams to 2**21),
so what is broadcast does not grow with the corpus. All documents are scored whole, in
the tasks that read them.

Null texts are empty; an empty text has the score that the share of toxic labels gives.
Rows whose label is null are not learnt from; of several labels of one id the highest
counts, of several texts the greatest. With too few labels of a class for all folds
every score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moniker.llm.logistic import fit_logistic, probability
from moniker.llm.words import hashed_words, mix, row_chunks
from moniker.sources import materialise

SAMPLE = 8192
CHUNK = 1 << 19  # bytes of text at a time: a task holds some thirty arrays of numbers for their words
SHORT = 20.0  # texts of fewer words are treated as if they were longer
WORD_BITS, PAIR_BITS = 20, 21
FOLDS = 4
POWERS = (1, 2, 3)  # of log-likelihood ratios; their coefficients say how much more large ones count
KINDS = 4 * len(POWERS)  # of evidence: alone or by context, for either class
RIDGES = [10.0, 1.0, 0.1, 0.01, 0.001]  # the strongest is taken that tells the folds as well as the best, within the error
START = np.uint64(0x243F6A8885A308D3)


@dataclass
class ToxicityModel:
    """Arrays by place; first index: 0 ordinary, 1 toxic."""

    word: np.ndarray  # probability of a word without context
    seen: np.ndarray  # how often a context was seen
    rest: np.ndarray  # share of a context that goes to the model without context
    pair: np.ndarray  # discounted counts of pairs
    weights: np.ndarray  # of 1, each kind of evidence per word, each per root of words


def _places(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the words of all rows, each with the two words before it.

    (word before the context, context, word, first of each row and one more at the end)
    """
    words, begins = hashed_words(column, letters=True)
    shift = np.uint64(64 - WORD_BITS)
    place = (mix(words) >> shift).astype(np.int64)
    start = int(mix(START) >> shift)
    context, ahead = np.full_like(place, start), np.full_like(place, start)
    context[1:], ahead[2:] = place[:-1], place[:-2]
    first = begins[:-1][begins[:-1] < begins[1:]]
    context[first] = ahead[first] = start
    second = first + 1
    ahead[second[second < len(place)]] = start
    return ahead, context, place, begins


def _pair_place(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (mix(context << WORD_BITS | word) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _ratios(model: ToxicityModel, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Evidence of each row, and its number of words.

    The log-likelihood ratio of a word is that without its context and what the context adds;
    the ``POWERS`` of both are summed over all words, for either class apart. The first powers
    together are the ratio of the whole text.
    """
    sums, counts = [np.empty((0, KINDS))], [np.empty(0, np.int64)]
    for a, b in row_chunks(column, CHUNK):
        _, context, word, begins = _places(column.slice(a, b - a))
        place = _pair_place(context, word)
        alone, logs = [], []
        for k in (0, 1):
            own = model.word[k][word]
            alone.append(np.log(own))
            logs.append(np.log(model.pair[k][place] / np.maximum(model.seen[k][context], 1) + model.rest[k][context] * own))
        alone, whole = alone[1] - alone[0], logs[1] - logs[0]
        row, told = np.repeat(np.arange(b - a), np.diff(begins)), []
        for ratio in (alone, whole - alone):
            for side in (np.maximum(ratio, 0), np.minimum(ratio, 0)):
                told += [np.bincount(row, weights=side * np.abs(side) ** (p - 1), minlength=b - a) for p in POWERS]
        sums.append(np.stack(told, axis=1))
        counts.append(np.diff(begins))
    return np.concatenate(sums), np.concatenate(counts)


def _features(evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
    n = (words + SHORT)[:, None]
    return np.concatenate([np.ones((len(n), 1)), evidence / n, evidence / np.sqrt(n)], axis=1)


def _labelled(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, sample: int) -> DataFrame:
    """(id, toxic, text) of at most ``sample`` rows of each class. The list of ids is so bounded, hence broadcast.

    Both classes give equally many: continuation counts grow slower than the text, so that
    those of unequal samples could not be compared.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("id")).agg((F.max(label) > 0).cast("int").alias("toxic"))
    order = [F.xxhash64("id"), "id"]
    most = known.agg(F.least(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1))).first()[0]
    picked = [known.where(F.col("toxic") == k).orderBy(*order).limit(min(sample, most)) for k in (0, 1)]
    ids = picked[0].unionAll(picked[1])
    own = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return own.join(F.broadcast(ids), "id").groupBy("id").agg(F.max("toxic").alias("toxic"), F.max("text").alias("text"))


def _pairs(rows: DataFrame) -> DataFrame:
    """(context, word, place of the pair, and counts): after how many different words each class has a pair of places.

    ``n0`` and ``n1`` are counted in all rows, ``n0_f`` and ``n1_f`` in all but those of fold f.
    """
    mask = (1 << WORD_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("toxic", "fold"))
            for a, b in row_chunks(batch.column("text"), CHUNK):
                ahead, context, word, begins = _places(batch.column("text").slice(a, b - a))
                triple = ahead << 2 * WORD_BITS | context << WORD_BITS | word
                mark = np.repeat(toxic[a:b] * FOLDS + fold[a:b], np.diff(begins)).astype(np.int64)
                found = np.unique(triple << 3 | mark)
                arrays = [pa.array(found >> 3), pa.array((1 << (found & 7)).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, names=["triple", "marks"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, word = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("context", "word"))
            own = pa.array(_pair_place(context, word).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, "place"])

    found = rows.select("toxic", "fold", "text").mapInArrow(run, "triple bigint, marks int")
    triples = found.groupBy("triple").agg(F.bit_or("marks").alias("marks"))
    context = F.shiftright("triple", WORD_BITS).bitwiseAND(mask).alias("context")
    counts = []
    for k in (0, 1):
        for f in (None, *range(FOLDS)):
            own = sum(1 << (k * FOLDS + g) for g in range(FOLDS) if g != f)
            counts.append(F.count_if(F.col("marks").bitwiseAND(own) != 0).cast("int").alias(_name(k, f)))
    pairs = triples.select(context, F.col("triple").bitwiseAND(mask).alias("word"), "marks")
    pairs = pairs.groupBy("context", "word").agg(*counts)
    return pairs.mapInArrow(placed, pairs.withColumn("place", F.lit(0)).schema)


def _name(kind: int, fold: int | None) -> str:
    return f"n{kind}" if fold is None else f"n{kind}_{fold}"


def _discount(once: int, twice: int) -> float:
    """Absolute discount by how many counts are 1 and 2; always between 0 and 1."""
    return (once + 0.5) / (once + 2 * twice + 1)


def _arrays(pairs: DataFrame, fold: int | None) -> ToxicityModel:
    """Fill the arrays of the model from counted pairs.

    All words, contexts and pairs come to the driver summed by their places, whose number is fixed.
    """
    pairs = pairs.select("context", "word", "place", *[F.col(_name(k, fold)).alias(f"n{k}") for k in (0, 1)])
    few = [F.count_if(F.col(f"n{k}") == i).alias(f"f{k}_{i}") for k in (0, 1) for i in (1, 2)]
    few = pairs.agg(*few).first()
    pair_discount = [_discount(few[f"f{k}_1"], few[f"f{k}_2"]) for k in (0, 1)]
    left = [F.greatest(F.col(f"n{k}") - F.lit(pair_discount[k]), F.lit(0.0)).alias(f"d{k}") for k in (0, 1)]
    kinds = [F.count_if(F.col(f"n{k}") > 0).cast("int").alias(f"c{k}") for k in (0, 1)]
    word = pairs.groupBy(F.col("word").cast("int").alias("word")).agg(*kinds).toArrow().to_pandas()
    size = 1 << WORD_BITS
    known = (word["c0"] > 0).to_numpy(int) + (word["c1"] > 0).to_numpy(int)
    shared = np.full(size, 0.5 / (known.sum() + 0.5 * size))
    shared[word["word"]] = (known + 0.5) / (known.sum() + 0.5 * size)
    model = ToxicityModel(
        np.empty((2, size), np.float32), np.zeros((2, size), np.float32), np.ones((2, size), np.float32),
        np.zeros((2, 1 << PAIR_BITS), np.float32), np.zeros(1 + 2 * KINDS),
    )
    for k in (0, 1):
        own = word[f"c{k}"].to_numpy()
        kept, total = np.maximum(own - _discount((own == 1).sum(), (own == 2).sum()), 0), max(own.sum(), 1)
        model.word[k] = (1 - kept.sum() / total) * shared
        model.word[k][word["word"]] += (kept / total).astype(np.float32)
    context = pairs.select(F.col("context").cast("int").alias("context"), "n0", "n1", *left).groupBy("context")
    context = context.agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "d0", "d1")]).toArrow().to_pandas()
    for k in (0, 1):
        seen = context[f"n{k}"].to_numpy()
        model.seen[k][context["context"]] = seen
        model.rest[k][context["context"]] = np.where(seen > 0, 1 - context[f"d{k}"] / np.maximum(seen, 1), 1)
    often = pairs.select("place", *left).groupBy("place").agg(*[F.sum(c).cast("float").alias(c) for c in ("d0", "d1")]).toArrow().to_pandas()
    for k in (0, 1):
        model.pair[k][often["place"]] = often[f"d{k}"]
    return model


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> ToxicityModel | float:
    """A model from labelled rows, or the share of toxic labels where a class has too few.

    The evidence of each of ``FOLDS`` parts of the sample is told by a model of the others.
    All parts together set the coefficients, weighted so that the classes have the shares
    they have among all labels. The model returned has counted the whole sample.
    """
    spark = docs.sparkSession
    shares = labels.where(F.col(label).isNotNull()).agg(F.count_if(F.col(label) > 0), F.count(F.lit(1))).first()
    rows = materialise(_labelled(docs, labels, text, key, label, sample), "toxicity-sample")
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS)).cast("int"))
    if rows.select("toxic", "fold").distinct().count() < 2 * FOLDS:
        return shares[0] / max(shares[1], 1)
    pairs = materialise(_pairs(rows), "toxicity-pairs")
    parts = []
    for f in range(FOLDS):
        shipped = spark.sparkContext.broadcast(_arrays(pairs, f))
        parts.append(_told(rows.where(F.col("fold") == f), shipped, ["toxic", "fold"]).toArrow().to_pandas())
        shipped.destroy()
    told = pd.concat(parts)
    toxic = told["toxic"].to_numpy()
    weight = np.where(toxic == 1, shares[0] / (toxic == 1).sum(), (shares[1] - shares[0]) / (toxic == 0).sum())
    x = _features(np.stack(told["__evidence"].to_list()), told["__words"].to_numpy())
    model = _arrays(pairs, None)
    model.weights = _fit_weights(x, toxic, weight / weight.sum() * len(weight), told["fold"].to_numpy())
    return model


def _fit_weights(x: np.ndarray, y: np.ndarray, weight: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Coefficients with a ridge by the loss on each fold of those from the other folds.

    The strongest whose loss is the least but for one standard error, so that few rows say little.
    """
    losses = []
    for ridge in RIDGES:
        loss = np.zeros(len(y))
        for f in range(FOLDS):
            own = fold == f
            logit = x[own] @ fit_logistic(x[~own], y[~own], weight[~own], ridge)
            loss[own] = weight[own] * np.logaddexp(0, np.where(y[own] > 0, -1, 1) * logit)
        losses.append(loss)
    best = min(losses, key=np.sum)
    good = [np.sum(loss - best) <= np.std(loss - best) * np.sqrt(len(y)) for loss in losses]
    return fit_logistic(x, y, weight, RIDGES[good.index(True)])


def _told(rows: DataFrame, shipped, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, the evidence and the number of words of each row."""
    own = rows.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    more = [F.lit(None).cast("array<double>").alias("__evidence"), F.lit(0).cast("long").alias("__words")]
    schema = own.select(*[F.col(f"`{c}`") for c in keep], *more).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence, words = _ratios(shipped.value, batch.column(len(keep)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32) * KINDS), pa.array(evidence.ravel()))
            found = [*batch.columns[:-1], lists, pa.array(words.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(found, names=[*keep, "__evidence", "__words"])

    return own.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, model: ToxicityModel | float, keep: list[str], text: str = "text", score: str = "score") -> DataFrame:
    """Columns ``keep`` and the ``score`` (0 to 1) under that name for every row of ``docs``."""
    kept = [F.col(f"`{c}`") for c in keep]
    if not isinstance(model, ToxicityModel):
        return docs.select(*kept, F.lit(float(model)).alias(score))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    # A text that is kept is not sent to the workers twice.
    own = docs.select(*kept) if text in keep else docs.select(*kept, F.col(f"`{text}`").alias("__text"))
    schema = own.select(*kept, F.lit(0.0).alias(score)).schema
    at = keep.index(text) if text in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = probability(_features(*_ratios(shipped.value, batch.column(at))) @ shipped.value.weights)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(told)], names=[*keep, score])

    return own.mapInArrow(run, schema)
