"""Quality by co-training: a classifier of the text and one of the page's metadata teach each other.

The text view has the frequencies of characters, of hashed words, and some ratios; the
metadata view has language, source and length. Both are logistic. They start from labelled
rows; in each round each labels the rows of the unlabelled pool it is surest of, ``GROW`` of
each class at most and only beyond ``SURE``, for the other view. Both views are then
calibrated on labelled rows set aside, and their logits combined, to score all documents.

Labelled rows and pool are samples of at most ``SAMPLE`` and ``POOL`` rows, picked by a hash
of the id; only they come to the driver, as numbers of a fixed size. All documents are
scored whole, in the tasks that read them.

Null texts are empty; null metadata are a value of their own. Rows without id or label are
not learnt from; of several labels of one id the highest counts. Without labels of both
classes every score is the share of good labels (0 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moniker.llm.logistic import fit_logistic, probability
from moniker.llm.words import hashed_words, is_letter, is_space, lower_ascii, mix, row_chunks, text_bytes
from moniker.sources import materialise

SAMPLE, POOL = 8192, 8192
ROUNDS, GROW, SURE = 5, 256, 0.95
WORD_BINS, CHARACTERS, META_BINS = 64, 129, 64
RIDGE = 1.0


def text_view(column: pa.Array) -> np.ndarray:
    """Features of whole texts."""
    out = []
    for a, b in row_chunks(column):
        data, begins = text_bytes(column.slice(a, b - a))
        rows, n = b - a, np.maximum(np.diff(begins), 1)[:, None]
        row = np.repeat(np.arange(rows), np.diff(begins))
        kind = np.minimum(data, 128).astype(np.int64)
        characters = np.bincount(row * CHARACTERS + kind, minlength=rows * CHARACTERS).reshape(rows, -1) / n
        lowered = lower_ascii(data)
        marks = [lowered != data, ~is_letter(lowered) & ~is_space(data)]
        ratios = [np.bincount(row[m], minlength=rows)[:, None] / n for m in marks]
        words, first = hashed_words(column.slice(a, b - a))
        count = np.maximum(np.diff(first), 1)[:, None]
        owner = np.repeat(np.arange(rows), np.diff(first))
        bins = np.bincount(owner * WORD_BINS + (words >> np.uint64(58)).astype(np.int64), minlength=rows * WORD_BINS)
        distinct = np.unique(mix(words + owner.astype(np.uint64)), return_index=True)[1]
        variety = np.bincount(owner[distinct], minlength=rows)[:, None] / count
        sizes = [np.log1p(np.diff(first))[:, None] / 10, np.diff(begins)[:, None] / count / 50]
        out.append(np.hstack([np.ones((rows, 1)), np.sqrt(characters), bins.reshape(rows, -1) / count, *ratios, variety, *sizes]))
    return np.vstack(out) if out else np.empty((0, 1 + CHARACTERS + WORD_BINS + 5))


def meta_view(columns: list[pa.Array]) -> np.ndarray:
    """Features of metadata: hashed values, and the logarithm of numbers."""
    rows = len(columns[0]) if columns else 0
    out = [np.ones((rows, 1))]
    for column in columns:
        if pa.types.is_integer(column.type) or pa.types.is_floating(column.type):
            value = np.nan_to_num(column.to_numpy(zero_copy_only=False).astype(np.float64))
            size = np.log1p(np.maximum(value, 0))[:, None]
            out += [size / 10, (size / 10) ** 2]
        else:
            hashed, first = hashed_words(pa.array([f"={x}".replace(" ", "_") for x in column.to_pylist()], pa.string()))
            bins = np.zeros((rows, META_BINS))
            bins[np.arange(rows), (hashed[first[:-1]] >> np.uint64(58)).astype(np.int64)] = 1
            out.append(bins)
    return np.hstack(out)


@dataclass
class QualityModel:
    text: np.ndarray
    meta: np.ndarray
    mixed: np.ndarray  # of 1 and both logits

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        logits = [np.ones(len(text)), text @ self.text, meta @ self.meta]
        return probability(np.clip(np.stack(logits, axis=1), -20, 20) @ self.mixed)


def _views(rows: DataFrame, meta: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels (null: -1) and both views of a bounded sample (id, label, text and ``meta``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                views = [text_view(batch.column("__text")), meta_view([batch.column(c) for c in meta])]
                arrays = [pa.array(list(v), pa.list_(pa.float64())) for v in views]
                yield pa.RecordBatch.from_arrays([batch.column("__label"), *arrays], names=["label", "text", "meta"])

    got = rows.mapInArrow(run, "label int, text array<double>, meta array<double>").toArrow().to_pandas()
    stacked = [np.stack(got[c]) if len(got) else np.empty((0, 1)) for c in ("text", "meta")]
    return got["label"].to_numpy(), *stacked


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    meta: list[str],
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    sample: int = SAMPLE,
    pool: int = POOL,
    rounds: int = ROUNDS,
    learnable: Column | None = None,
) -> QualityModel | float:
    """Co-train on ``labels`` (and on unlabelled rows of ``docs`` that are ``learnable``)."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = materialise(known.groupBy(F.col(key).alias("__id")).agg((F.max(label) > 0).cast("int").alias("__label")), "labels")
    order = [F.xxhash64("__id"), "__id"]
    told = known.orderBy(*order).limit(sample)
    free = docs.where(F.lit(True) if learnable is None else learnable).select(F.col(f"`{key}`").alias("__id"))
    free = free.join(known, "__id", "left_anti").where(F.col("__id").isNotNull()).distinct().orderBy(*order).limit(pool)
    picked = F.broadcast(told.unionAll(free.withColumn("__label", F.lit(-1))))  # bounded by the two samples
    own = docs.select(F.col(f"`{key}`").alias("__id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"), *[F.col(f"`{c}`") for c in meta])
    rows = own.join(picked, "__id").groupBy("__id").agg(F.max_by(F.struct("__label", "__text", *[F.col(f"`{c}`") for c in meta]), "__text").alias("row"))
    label_, words, about = _views(rows.select("__id", "row.*"), meta)
    if not {0, 1} <= set(label_.tolist()):
        return float((label_ == 1).sum() / max(1, (label_ >= 0).sum()))
    apart = (np.arange(len(label_)) % 4 == 0) & (label_ >= 0)
    views = [words, about]
    taught = [np.where((label_ >= 0) & ~apart, label_, -1) for _ in views]
    fits = [np.zeros(v.shape[1]) for v in views]
    for turn in range(rounds + 1):
        for k, view in enumerate(views):
            use = taught[k] >= 0
            fits[k] = fit_logistic(view[use], taught[k][use].astype(float), np.ones(use.sum()), RIDGE)
        if turn == rounds:
            break
        sure = [probability(v @ w) for v, w in zip(views, fits, strict=True)]
        for k in (0, 1):
            other = 1 - k
            open_ = (label_ < 0) & (taught[other] < 0)
            for value, doubt in ((1, 1 - sure[k]), (0, sure[k])):
                best = np.argsort(np.where(open_, doubt, np.inf), kind="stable")[:GROW]
                best = best[open_[best] & (doubt[best] <= 1 - SURE)]
                taught[other][best] = value
                open_[best] = False
    logits = np.clip(np.stack([np.ones(len(label_)), *(v @ w for v, w in zip(views, fits, strict=True))], axis=1), -20, 20)
    if len(set(label_[apart].tolist())) < 2:
        apart = label_ >= 0
    mixed = fit_logistic(logits[apart], label_[apart].astype(float), np.ones(apart.sum()), 1e-2)
    return QualityModel(fits[0], fits[1], mixed)


def score_quality(docs: DataFrame, model: QualityModel | float, meta: list[str], keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``score`` (0 to 1, higher is better) of every row of ``docs``."""
    kept = [F.col(f"`{c}`") for c in keep]
    if not isinstance(model, QualityModel):
        return docs.select(*kept, F.lit(float(model)).alias("score"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"__m{i}" for i in range(len(meta))]
    own = docs.select(*kept, F.col(f"`{text}`").alias("__text"), *[F.col(f"`{c}`").alias(n) for c, n in zip(meta, names, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for a, b in row_chunks(batch.column("__text")):
                part = batch.slice(a, b - a)
                scores.append(shipped.value.score(text_view(part.column("__text")), meta_view([part.column(n) for n in names])))
            found = pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], found], names=[*keep, "score"])

    return own.mapInArrow(run, docs.select(*kept, F.lit(0.0).alias("score")).schema)
