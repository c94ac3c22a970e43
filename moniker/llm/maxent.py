"""A hashed maximum-entropy language model with a class-factored softmax.

Tokens are lower-cased words and one end for each text. The most frequent words are leaves
of their own; all others share ``BUCKETS`` leaves, picked by the end of the word, and have
within their leaf the share of their smoothed count. Leaves are dealt to classes, and

    P(word) = P(class | before) * P(leaf | class, before) * P(word | leaf)

where both softmaxes sum the weights of hashed features of what stands before: the last word
(bigram) and the word before it (skip). A word with ``OFTEN`` or more training tokens that
is among the known stands for itself there, others for their leaf. The places of the features follow the number of distinct words, up to ``MOST_SLOTS``, which bounds what is broadcast.
Unknown words count as one more word of their leaf, as in the base score they count as one
more word of all.

Word counts, and with them the base score, cover all training texts exactly (words are
known by 64-bit hashes). The counts of the ``KNOWN`` most frequent words are broadcast and
scored where the texts are read; the words of a text that are not among them are joined
with the table of all counts. Both give the same sums; only a bounded table is broadcast.

Training goes over all training texts once, in ``ROUNDS`` parts by a hash of the id. Each
part is dealt, again by a hash, to pieces of about ``PIECE`` tokens, so that their number
follows the tokens and not the cores, and the weights are the same on any cluster. In each
round every piece starts from the shared weights, makes gradient updates over its texts in
the order of the hash, in batches of ``BATCH`` tokens, and sends its weights back; their
mean, by tokens, is the next start. The mean is taken in slices of the weights, row by row.

Null texts are empty and have the end only. Rows are scored one by one, so that repeated
rows are repeated results. Without training texts all counts are 0 and the model uniform.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moniker.llm.words import hash_ranges, lower_ascii, mix, row_chunks, text_bytes, words_of
from moniker.sources import materialise

BUCKETS = 256
CLASSES, LEAVES = 32, 32
WORDS = CLASSES * LEAVES - BUCKETS
KNOWN = 1 << 19
LEAST_SLOTS, MOST_SLOTS = 1 << 12, 1 << 15
ROUNDS, PIECE, SLICES = 3, 1 << 22, 64
OFTEN = 50
BATCH = 1 << 15
IN_CACHE = 1 << 11  # rows of weights held at a time, which stay in the cache
FEW = 8  # rows of one slot summed without reduceat
RATE = 0.15
SMOOTH = 0.1
END = (np.uint64(0x452821E638D01377) >> np.uint64(8) << np.uint64(8)).view(np.int64)
START = np.int64(0x13198A2E03707344)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all rows, each ended by ``END``, and the first of each row (one more at the end).

    The last 8 bits of a token tell its bucket, by the last three bytes of the word.
    """
    data, begins = text_bytes(column)
    lowered = lower_ascii(data)
    starts, ends, rows = words_of(lowered, begins)
    suffix = np.zeros(len(starts), np.uint64)
    for back in (1, 2, 3) if len(starts) else ():
        byte = lowered[np.maximum(ends - back, 0)].astype(np.uint64) + np.uint64(1)
        suffix = suffix * np.uint64(257) + np.where(ends - back >= starts, byte, np.uint64(0))
    bucket = mix(suffix) >> np.uint64(56)
    words = (hash_ranges(lowered, starts, ends) >> np.uint64(8) << np.uint64(8) | bucket).view(np.int64)
    first = rows + np.arange(len(rows))
    out = np.empty(first[-1], np.int64)
    last = np.zeros(len(out), bool)
    last[first[1:] - 1] = True
    out[last], out[~last] = END, words
    return out, first


@dataclass
class Lexicon:
    """What is known of the words: exact totals, the frequent words with counts, and the leaves."""

    total: int  # training tokens
    distinct: int
    known: np.ndarray  # sorted tokens
    counts: np.ndarray
    leaf: np.ndarray  # of each known token
    mass: np.ndarray  # log10 of the smoothed size of each bucket's leaf
    prior: np.ndarray  # training tokens of each leaf

    @property
    def slots(self) -> int:
        """Places of the features of one kind, one for about 32 words."""
        return min(max(1 << (self.distinct // 32).bit_length(), LEAST_SLOTS), MOST_SLOTS)

    def look_up(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (-1: not among the known) and leaf of tokens."""
        leaf = WORDS + (token & 255)
        if not len(self.known):
            return np.full(len(token), -1), leaf
        order = np.argsort(token)  # looked up in order, as far apart places are slow to reach
        at = np.empty(len(token), np.int64)
        at[order] = np.searchsorted(self.known, token[order])
        at = np.minimum(at, len(self.known) - 1, out=at)
        hit = self.known[at] == token
        return np.where(hit, self.counts[at], -1), np.where(hit, self.leaf[at], leaf)


class Model:
    """Weights: of classes and of leaves, by slots of features."""

    def __init__(self, prior: np.ndarray, slots: int = LEAST_SLOTS):
        prior = (prior.reshape(CLASSES, LEAVES) + 1.0).astype(np.float64)
        whole = prior.sum(axis=1)
        self.class_bias = np.log(whole / whole.sum()).astype(np.float32)
        self.leaf_bias = np.log(prior / whole[:, None]).astype(np.float32)
        self.shift = np.uint64(65 - slots.bit_length())
        self.by_class = np.zeros((2 * slots, CLASSES), np.float32)
        self.by_leaf = np.zeros((2 * slots, LEAVES), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.class_bias, self.leaf_bias, self.by_class, self.by_leaf]

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights()])

    def load(self, flat: np.ndarray) -> Model:
        at = 0
        for w in self.weights():
            w[...] = flat[at : at + w.size].reshape(w.shape)
            at += w.size
        return self

    def forward(self, before: np.ndarray, ahead: np.ndarray, leaf: np.ndarray) -> tuple:
        """Slots, and probabilities of classes and of the leaves in the class of ``leaf``."""
        kind, place = leaf // LEAVES, leaf % LEAVES
        words = (mix(before), mix(ahead ^ np.int64(0x5BD1E995)))
        slots = tuple((w >> self.shift).astype(np.int64) + k * (len(self.by_class) // 2) for k, w in enumerate(words))
        inner = tuple((mix(w + kind.astype(np.uint64)) >> self.shift - np.uint64(1)).astype(np.int64) for w in words)
        outer = _softmax(self.by_class, *slots, self.class_bias)
        below = _softmax(self.by_leaf, *inner, self.leaf_bias, kind)
        return kind, place, slots, inner, outer, below

    def logs(self, before: np.ndarray, ahead: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """log10 P(leaf | before), in batches."""
        out = np.empty(len(leaf))
        for a in range(0, len(leaf), BATCH):
            own = slice(a, a + BATCH)
            kind, place, _, _, outer, below = self.forward(before[own], ahead[own], leaf[own])
            rows = np.arange(len(kind))
            out[own] = np.log10(outer[rows, kind].astype(np.float64)) + np.log10(below[rows, place].astype(np.float64))
        return out


def _softmax(weights: np.ndarray, first: np.ndarray, second: np.ndarray, bias: np.ndarray, kind: np.ndarray | None = None) -> np.ndarray:
    """Of the sums of two rows of ``weights`` and ``bias`` (its row ``kind``), ``IN_CACHE`` rows at a time."""
    out = np.empty((len(first), weights.shape[1]), np.float32)
    for a in range(0, len(first), IN_CACHE):
        own = slice(a, a + IN_CACHE)
        x = weights.take(first[own], axis=0, out=out[own], mode="clip")
        x += weights.take(second[own], axis=0)
        x += bias if kind is None else bias.take(kind[own], axis=0)
        x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)
        x /= x.sum(axis=1, keepdims=True)
    return out


class Trainer:
    """Gradient updates with a step size for each weight that falls with its past gradients."""

    def __init__(self, model: Model):
        self.model = model
        self.past = [np.full(w.shape, 0.5, np.float32) for w in model.weights()]

    def learn(self, before: np.ndarray, ahead: np.ndarray, leaf: np.ndarray) -> None:
        kind, place, slots, inner, outer, below = self.model.forward(before, ahead, leaf)
        rows = np.arange(len(kind))
        outer[rows, kind] -= 1
        below[rows, place] -= 1
        bias, leaf_bias, by_class, by_leaf = self.model.weights()
        self._step(bias[None], self.past[0][None], np.zeros(1, np.int64), outer.sum(axis=0, keepdims=True))
        self._step(leaf_bias, self.past[1], *_summed(kind, below))
        for s in slots:
            self._step(by_class, self.past[2], *_summed(s, outer))
        for s in inner:
            self._step(by_leaf, self.past[3], *_summed(s, below))

    def _step(self, weights: np.ndarray, past: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
        own = past.take(rows, axis=0)
        own += gradient * gradient
        past[rows] = own
        gradient *= RATE
        gradient /= np.sqrt(own, out=own)
        weights[rows] -= gradient


def _summed(slot: np.ndarray, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of ``gradient`` by slot.

    ``reduceat`` costs as much for each slot and column as for many rows, so slots of up to ``FEW``
    rows, which are most, are summed all at once, in the order in which it would: the first
    row is added to the sum of the others.
    """
    order = np.argsort(slot.astype(np.uint16), kind="stable")
    own = slot[order]
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    counts = np.diff(starts, append=len(own))
    sums = np.empty((len(starts), gradient.shape[1]), gradient.dtype)
    many = np.flatnonzero(counts > FEW)
    if len(many):
        rows = np.repeat(counts > FEW, counts)
        begins = np.cumsum(counts[many]) - counts[many]
        sums[many] = np.add.reduceat(gradient.take(order[rows], axis=0), begins, axis=0)
    for n in range(1, FEW + 1):
        at = np.flatnonzero(counts == n)
        first = starts[at]
        total = gradient.take(order[first], axis=0)
        if n > 1:
            rest = gradient.take(order[first + 1], axis=0)
            for k in range(2, n):
                rest += gradient.take(order[first + k], axis=0)
            total += rest
        sums[at] = total
    return own[starts], sums


def contexts(token: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What stands before each, and before that; ``START`` where a text has none."""
    before, ahead = np.full_like(token, START), np.full_like(token, START)
    before[1:], ahead[2:] = token[:-1], token[:-2]
    before[first[:-1]] = ahead[first[:-1]] = START
    second = first[:-1] + 1
    ahead[second[second < first[1:]]] = START
    return before, ahead


def _named(schema, more: str) -> str:
    own = schema.simpleString()[len("struct<") : -1].replace(":", " ")
    return f"{own}, {more}" if own else more


def word_counts(texts: DataFrame) -> DataFrame:
    """(token, n) of all rows of ``texts`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_chunks(batch.column(0)):
                found, n = np.unique(tokens(batch.column(0).slice(a, b - a))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["token", "n"])

    return texts.mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def fit_lexicon(counts: DataFrame) -> Lexicon:
    """From the table of all counts. What comes to the driver are ``KNOWN`` words and ``BUCKETS`` sums at most."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # Counts by steps of a sixteenth of a power of two, from the most frequent down, as long as all fits.
    step = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(((r["step"], r["m"]) for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("m")).collect()), reverse=True)
    least, kept = None, 0
    for at, m in sizes:
        kept += m
        if kept > KNOWN:
            break
        least = at
    frequent = counts.where(F.lit(False) if least is None else step >= least).toArrow().to_pandas().sort_values("token")
    known, n = frequent["token"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64)
    leaf = WORDS + (known & 255)
    most = np.lexsort((known, -n))[:WORDS]
    leaf[most] = np.arange(len(most))
    buckets = counts.groupBy(F.col("token").bitwiseAND(255).alias("bucket")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("m")).toArrow().to_pandas()
    size, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
    size[buckets["bucket"]], kinds[buckets["bucket"]] = buckets["n"], buckets["m"]
    np.subtract.at(size, known[most] & 255, n[most])
    np.subtract.at(kinds, known[most] & 255, 1)
    prior = np.concatenate([np.zeros(WORDS), size])
    prior[: len(most)] = n[most]
    return Lexicon(int(total), int(distinct), known, n, leaf, np.log10(size + SMOOTH * (kinds + 1)), prior)


def fit_model(texts: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> Model:
    """Train on all rows of ``texts`` (text, part, order); ``part`` (0 to ``rounds`` - 1) says in which round."""
    context = texts.sparkSession.sparkContext
    shipped, model = context.broadcast(lexicon), Model(lexicon.prior, lexicon.slots)
    size, pieces = len(model.flat()), max(1, round(lexicon.total / rounds / PIECE))
    cuts = [size * i // SLICES for i in range(SLICES + 1)]
    dealt = texts.withColumn("piece", F.pmod(F.xxhash64("order"), F.lit(pieces)).cast("int"))
    for r in range(rounds):
        start = context.broadcast(model.flat())

        def run(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            def sent(piece: int, own: Model, n: int) -> pa.RecordBatch:
                flat = own.flat()
                rows = [flat[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                columns = [pa.array(range(SLICES), pa.int32()), pa.array([piece] * SLICES, pa.int32()), pa.array([float(n)] * SLICES), pa.array(rows, pa.binary())]
                return pa.RecordBatch.from_arrays(columns, names=["slice", "piece", "n", "weights"])

            last, own, trainer, n = None, None, None, 0
            for batch in batches:
                piece = batch.column("piece").to_numpy()
                ends = [*(np.flatnonzero(piece[1:] != piece[:-1]) + 1).tolist(), batch.num_rows] if batch.num_rows else []
                for low, high in zip([0, *ends], ends, strict=False):
                    if piece[low] != last:
                        if n:
                            yield sent(last, own, n)
                        last, n = int(piece[low]), 0
                        own = Model(shipped.value.prior, shipped.value.slots).load(start.value)
                        trainer = Trainer(own)
                    column = batch.column("text").slice(low, high - low)
                    for a, b in row_chunks(column):
                        token, first = tokens(column.slice(a, b - a))
                        count, leaf = shipped.value.look_up(token)
                        before, ahead = contexts(np.where(count >= OFTEN, token, leaf), first)
                        for at in range(0, len(token), BATCH):
                            trainer.learn(*(x[at : at + BATCH] for x in (before, ahead, leaf)))
                        n += len(token)
            if n:
                yield sent(last, own, n)

        def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def done(at: int, total: np.ndarray, n: float) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())], names=["slice", "weights"])

            last, total, n = None, None, 0.0
            for batch in batches:
                for at, own, weights in zip(*(batch.column(c) for c in ("slice", "n", "weights")), strict=True):
                    if at.as_py() != last:
                        if n:
                            yield done(last, total, n)
                        last, total, n = at.as_py(), 0.0, 0.0
                    total = total + np.frombuffer(weights.as_buffer(), np.float32).astype(np.float64) * own.as_py()
                    n += own.as_py()
            if n:
                yield done(last, total, n)

        part = dealt.where(F.col("part") == r).select("piece", "order", "text")
        part = part.repartition(pieces, "piece").sortWithinPartitions("piece", "order")
        sent = part.mapInArrow(run, "slice int, piece int, n double, weights binary").repartition("slice").sortWithinPartitions("slice", "piece")
        got = sent.mapInArrow(mean, "slice int, weights binary").collect()  # one model
        if got:
            model.load(np.concatenate([np.frombuffer(x["weights"], np.float32) for x in sorted(got, key=lambda x: x["slice"])]))
    return model


def score_texts(docs: DataFrame, trained: Column, keep: list[str], part: Column, text: str = "text") -> DataFrame:
    """Columns ``keep`` and n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    Learns from the rows for which ``trained`` holds; ``keep`` should tell equal texts apart, as an id does.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    learnt = docs.where(F.coalesce(trained, F.lit(False)))
    counts = materialise(word_counts(learnt.select(body)), "counts")
    lexicon = fit_lexicon(counts)
    order = F.xxhash64(*[F.col(f"`{c}`") for c in keep], body)
    model = fit_model(learnt.select(body, part.alias("part"), order.alias("order")), lexicon)
    spark = docs.sparkSession.sparkContext
    shipped, weights = spark.broadcast(lexicon), spark.broadcast(model.flat())
    own = docs.select(*[F.col(f"`{c}`") for c in keep], body)
    more = "__row bigint, n_tokens bigint, __known bigint, __base double, __score double, __rare array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        shared = Model(known.prior, known.slots).load(weights.value)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b in row_chunks(batch.column(len(keep))):
                token, first = tokens(batch.column(len(keep)).slice(a, b - a))
                count, leaf = known.look_up(token)
                before, ahead = contexts(np.where(count >= OFTEN, token, leaf), first)
                seen = count >= 0
                own_log = np.where(seen, np.log10(np.maximum(count, 0) + SMOOTH), 0.0)
                shared_leaf = leaf >= WORDS
                inside = np.where(shared_leaf, own_log - known.mass[np.maximum(leaf - WORDS, 0)], 0.0)
                score = shared.logs(before, ahead, leaf) + inside
                sums = [np.add.reduceat(x, first[:-1]) for x in (seen.astype(np.int64), own_log, score)]
                rare_first = np.concatenate([[0], np.cumsum(~seen)])[first]
                rare = pa.ListArray.from_arrays(pa.array(rare_first.astype(np.int32)), pa.array(token[~seen]))
                rows = np.arange(row, row + b - a)
                row += b - a
                found = [pa.array(rows), pa.array(np.diff(first)), *map(pa.array, sums), rare]
                names = [*keep, "__row", "n_tokens", "__known", "__base", "__score", "__rare"]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[:-1], *found], names=names)

    scored = materialise(own.mapInArrow(run, _named(own.drop("text").schema, more)), "scored")
    rare = scored.select("__row", F.explode("__rare").alias("token")).groupBy("__row", "token").agg(F.count(F.lit(1)).alias("times"))
    rare = rare.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rare = rare.groupBy("__row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + F.lit(SMOOTH))).alias("__log"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("__more"),
    )
    all_mass = float(np.log10(lexicon.total + SMOOTH * (lexicon.distinct + 1)))
    log, extra = F.coalesce("__log", F.lit(0.0)), F.coalesce("__more", F.lit(0))
    return scored.drop("__rare").join(rare, "__row", "left").select(
        *[F.col(f"`{c}`") for c in keep],
        "n_tokens",
        (F.col("__known") + extra).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col("__base") + log - F.col("n_tokens") * F.lit(all_mass)).alias("base_score"),
        (F.col("__score") + log).alias("score"),
    )
