"""Exact join of documents by the Jaccard similarity of their word shingles.

The universe of shingles is cut into segments, as many for a band of set sizes as two
sets that are similar enough can differ in elements, plus one (pigeonhole), so that such
sets agree in some segment. A set shows a signature for each segment of its band, and of
the next lower band where it has partners there.

Which segments it shows is a matter of cost. Signatures are ordered by what they say: a
segment with many shingles rarely agrees by chance, an empty one always does. As the
order depends on the signature alone, two sets that agree in enough segments also share
one of their first ``H + 1``, H the most in which they can differ, and the others need
not be shown. The other way is to use half as many segments and to show each whole and with
every one of its shingles left out; then similar sets have a segment in which they differ by
one shingle at most. That shows more signatures, but longer ones, which meet less often by
chance. Which way is cheaper is measured for each band on a sample of ``MEASURED`` documents;
both ways keep every link.

In every bucket of a signature the least set is compared with all others; nothing else is
needed where they prove linked. A set that lies in another component than the least one is
an outsider and still has to be compared with all sets that share a bucket with the same
least one, as far as they lie in other components. This is done in blocks: the parities of
how many shingles fall on each of some bits differ in no more bits than the sets differ in
shingles, which rules out nearly all pairs exactly. A block in which few pairs stay gives them all, to be decided
on the full lists of 64-bit shingle hashes. Of many pairs, as near copies have, it gives only a
spanning forest; then components have grown, and the blocks are compared again, ``FORESTS`` times
at most, after which all pairs between components that are left are decided. So no group of
linked copies is written as pairs, and no link between components is lost.

Equal sets are one class, known by a 64-bit hash of the set. Signatures that a large
share of the documents have are found on a sample of ``PROBED`` documents, at most
``HOT_LIST`` of them; the sample decides only where the work is done: their least sets are
aggregated before the shuffle and their rows are matched where they are, so that no task
gets them all.

Null and empty texts have no set and are linked with nothing. Fewer words than a shingle
has are one shingle. Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moniker.llm.graph import components
from moniker.llm.words import groups, hashed_words, mix, row_chunks, spread
from moniker.sources import materialise

PROBED = 1 << 14
HOT_SHARE, HOT_LIST = 1024, 1 << 17
BLOCK = 1024
FORESTS, FEW = 4, 4
MEASURED, COMMON = 1 << 11, 20.0
CHUNK = 1 << 19  # bytes of text at a time: their shingles and signatures are many times as large
STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """Sets are linked if ``parts`` * intersection >= ``least`` * union."""

    words: int = 4
    least: int = 85
    parts: int = 100

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The most elements in which linked sets of sizes ``a`` and ``b`` differ."""
        return (self.parts - self.least) * (a + b) // (self.parts + self.least)

    def largest(self, n: np.ndarray) -> np.ndarray:
        """The largest set that can be linked with one of ``n`` elements."""
        return self.parts * n // self.least


def band_of(n: np.ndarray) -> np.ndarray:
    """Band b has the sizes from 2**b to 2**(b+1) - 1."""
    return np.frexp(n.astype(np.float64))[1] - 1


@dataclass(frozen=True)
class Ways:
    """For each band its segments, and whether they are shown with one shingle left out."""

    segments: np.ndarray
    leave_out: np.ndarray


def ways_of(rule: Rule, leave_out: np.ndarray | bool = False, bands: int = 48) -> Ways:
    """Both ways keep the pigeonhole: plain has one segment more than the differences, the other half as many."""
    low = 2 ** np.arange(bands, dtype=np.int64)
    high = 2 * low - 1
    differ = rule.differ(high, rule.largest(high))
    leave_out = np.broadcast_to(leave_out, (bands,))
    return Ways(np.where(leave_out, (differ + 2) // 2, differ + 1), leave_out)


def allocation(docs: DataFrame, rule: Rule, rows: int, key: str, text: str) -> Ways:
    """The cheaper way for each band by what a sample of ``MEASURED`` documents shows in either way.

    A row costs 1. A signature that another set shows as well costs ``COMMON``, and as most of these meet by
    chance, as often as there are more documents than in the sample.
    """
    share = min(1.0, MEASURED / max(rows, 1))
    picked = F.pmod(F.xxhash64(F.col(f"`{key}`"), F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20))
    own = docs.where(picked).select(F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_chunks(batch.column(0), CHUNK):
                shingles, begins = shingle_sets(batch.column(0).slice(a, b - a), rule)
                classes, n = _class_of(shingles, begins), np.diff(begins)
                for leave_out in (False, True):
                    shown, first = signatures(shingles, begins, rule, ways_of(rule, leave_out))
                    counts = np.diff(first)
                    columns = [np.repeat(band_of(np.maximum(n, 1)), counts).astype(np.int32), np.full(len(shown), leave_out)]
                    columns += [shown.view(np.int64), np.repeat(classes, counts)]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["band", "less", "signature", "class"])

    shown = own.mapInArrow(run, "band int, less boolean, signature bigint, class bigint")
    met = shown.groupBy("band", "less", "signature").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("a"), F.max("class").alias("b"))
    cost = F.sum("n") + F.lit(COMMON / max(share, 1e-9)) * F.sum(F.when(F.col("a") < F.col("b"), F.col("n")).otherwise(0))
    costs = {(r["band"], r["less"]): r["cost"] for r in met.groupBy("band", "less").agg(cost.alias("cost")).collect()}
    less = [costs.get((band, True), 1.0) < costs.get((band, False), 0.0) for band in range(48)]
    return ways_of(rule, np.array(less))


def shingle_sets(column: pa.Array, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and the first of each row (one more at the end)."""
    words, begins = hashed_words(column)
    k, sizes = rule.words, np.diff(begins)
    counts = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    first = np.concatenate([[0], np.cumsum(counts)])
    shingles = np.empty(first[-1], np.uint64)
    full = np.repeat(sizes >= k, counts)
    at = np.repeat(begins[:-1] - first[:-1], counts) + np.arange(first[-1])
    own = np.zeros(int(full.sum()), np.uint64)
    for i in range(k):
        own = mix(own * STEP + words[at[full] + i])
    shingles[full] = own
    for row in np.flatnonzero((sizes > 0) & (sizes < k)).tolist():
        whole = mix(words[begins[row] : begins[row + 1]] + np.arange(1, sizes[row] + 1, dtype=np.uint64) * STEP)
        shingles[first[row]] = mix(whole.sum(keepdims=True) + np.uint64(sizes[row]))[0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        shingles[a:b].sort()
    keep = np.ones(len(shingles), bool)
    keep[1:] = shingles[1:] != shingles[:-1]
    keep[first[:-1][first[:-1] < first[1:]]] = True
    return shingles[keep], np.concatenate([[0], np.cumsum(keep)])[first]


def _show(shingles: np.ndarray, row: np.ndarray, n: np.ndarray, band: np.ndarray, shown: np.ndarray, ways: Ways) -> tuple:
    """Signatures of sets in given bands: (set number, signature). ``shown``: how many segments each shows."""
    segments, leave_out = ways.segments[band], ways.leave_out[band]
    base = np.concatenate([[0], np.cumsum(segments)])
    salt = mix(band.astype(np.uint64) + np.uint64(77))[row]
    token = mix(shingles ^ salt)
    slot = base[row] + (token % segments[row].astype(np.uint64)).astype(np.int64)
    count = np.bincount(slot, minlength=base[-1])
    content = np.zeros(base[-1], np.uint64)
    token = mix(token + STEP)
    np.add.at(content, slot, token)
    owner = np.repeat(np.arange(len(n)), segments)
    place = mix((np.arange(base[-1]) - base[owner]).astype(np.uint64) + (band[owner].astype(np.uint64) << np.uint64(40)))
    whole = mix(content ^ place)
    # The first by content: many shingles first, then by hash, then by segment (the sort is stable).
    order = owner.astype(np.uint64) << np.uint64(40) | (255 - np.minimum(count, 255)).astype(np.uint64) << np.uint64(32)
    order = np.argsort(order | whole >> np.uint64(32), kind="stable")
    kept = order[np.arange(len(order)) - base[owner[order]] < np.where(leave_out, segments, shown)[owner[order]]]
    loose = leave_out[row]
    less = mix((content[slot[loose]] - token[loose]) ^ place[slot[loose]])
    return np.concatenate([owner[kept], row[loose]]), np.concatenate([whole[kept], less])


def signatures(shingles: np.ndarray, begins: np.ndarray, rule: Rule, ways: Ways) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets, and the first of each set (one more at the end)."""
    n = np.diff(begins)
    rows, found = [], []
    own_band = band_of(np.maximum(n, 1))
    below = 2**own_band - 1
    least = -(-rule.least * n // rule.parts)
    cases = [
        (rule.differ(n, rule.largest(n)) > 0, own_band, rule.differ(n, rule.largest(n)) + 1),
        ((least <= below) & (rule.differ(n, below) > 0), own_band - 1, rule.differ(n, below) + 1),
    ]
    for case, band, shown in cases:
        picked = np.flatnonzero(case & (n > 0))
        if not len(picked):
            continue
        sizes = n[picked]
        row = np.repeat(np.arange(len(picked)), sizes)
        at = np.repeat(begins[picked] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        owner, signature = _show(shingles[at], row, sizes, band[picked], shown[picked], ways)
        rows.append(picked[owner])
        found.append(signature)
    if not rows:
        return np.empty(0, np.uint64), np.zeros(len(n) + 1, np.int64)
    row, signature = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    return signature[order], np.searchsorted(row[order], np.arange(len(n) + 1))


def _class_of(shingles: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """64-bit hash of each set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(shingles + STEP), dtype=np.uint64)])
    return mix(sums[begins[1:]] - sums[begins[:-1]] + np.diff(begins).astype(np.uint64) * STEP).astype(np.int64)


def document_sets(docs: DataFrame, rule: Rule, ways: Ways, key: str, text: str) -> DataFrame:
    """(id, n, class, signatures) of each row; null class for an empty set.

    Each task lists the signatures of a class once, however many copies it reads.
    """
    own = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = f"id {own.schema['id'].dataType.simpleString()}, n bigint, class bigint, signatures array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = np.empty(0, np.int64)
        for batch in batches:
            for a, b in row_chunks(batch.column(1), CHUNK):
                shingles, begins = shingle_sets(batch.column(1).slice(a, b - a), rule)
                n, classes = np.diff(begins), _class_of(shingles, begins)
                fresh = np.zeros(len(n), bool)
                fresh[np.unique(classes, return_index=True)[1]] = True
                fresh &= (n > 0) & ~_among(listed, classes)
                listed = np.union1d(listed, classes[fresh])
                picked, sizes = np.flatnonzero(fresh), n[fresh]
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                shown, some = signatures(shingles[spread(begins[picked], sizes)], bounds, rule, ways)
                counts = np.zeros(len(n), np.int64)
                counts[picked] = np.diff(some)
                first = np.concatenate([[0], np.cumsum(counts)])
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(shown.view(np.int64)))
                columns = [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(classes, pa.int64(), mask=n == 0), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "class", "signatures"])

    return own.mapInArrow(run, schema)


def _among(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def bit_count(n: int) -> int:
    """Bits of a set's parities: four or more for each shingle, so that few differences hide each other."""
    return 1 << min(max((4 * n - 1).bit_length(), 9), 18)


def parities(shingles: np.ndarray) -> bytes:
    """For each bit, whether an odd number of shingles falls on it."""
    size = bit_count(len(shingles))
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(bits: bytes, size: int) -> np.ndarray:
    """Parities for fewer bits: halves laid over each other."""
    words = np.frombuffer(bits, np.uint64)
    while len(words) > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def _candidates(docs: DataFrame, wanted: DataFrame, rule: Rule, key: str, text: str) -> DataFrame:
    """(class, n, bits, set) of the documents in ``wanted`` (id, class)."""
    own = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).join(wanted, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_chunks(batch.column(1), CHUNK):
                shingles, begins = shingle_sets(batch.column(1).slice(a, b - a), rule)
                lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(shingles.view(np.int64)))
                bits = [parities(shingles[x:y]) for x, y in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
                # Another row may have the same id and another text; it is no set of this class.
                same = pa.array(_class_of(shingles, begins) == batch.column(0).slice(a, b - a).to_numpy())
                columns = [batch.column(0).slice(a, b - a), pa.array(np.diff(begins)), pa.array(bits, pa.binary()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["class", "n", "bits", "set"]).filter(same)

    found = own.select("class", "text").mapInArrow(run, "class bigint, n bigint, bits binary, set array<bigint>")
    return found.dropDuplicates(["class"])


def _near(rule: Rule, left: list[np.ndarray], right: list[np.ndarray], n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Which sets (rows) the parities leave as partners of which (columns)."""
    size = min(min(map(len, left)), min(map(len, right)))
    a, b = (np.stack([_folded(x.tobytes(), size) for x in rows]) for rows in (left, right))
    step = max(1, (1 << 20) // max(1, b.size))
    apart = [np.bitwise_count(a[i : i + step, None, :] ^ b[None]).sum(axis=2, dtype=np.int32) for i in range(0, len(a), step)]
    n, m = n[:, None], m[None]
    fits = rule.parts * np.minimum(n, m) >= rule.least * np.maximum(n, m)
    return fits & (np.concatenate(apart) <= rule.differ(n, m))


def _pruned(pairs: DataFrame, candidates: DataFrame, rule: Rule) -> DataFrame:
    """``pairs`` (a, b) that sizes and parities leave."""
    own = candidates.select("class", "n", "bits")
    both = pairs.join(own.toDF("a", "n", "x"), "a").join(own.toDF("b", "m", "y"), "b")
    both = both.where(f"{rule.parts}L * least(n, m) >= {rule.least}L * greatest(n, m)").select("a", "b", "n", "m", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            apart = np.empty(len(n), np.int64)
            for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)):
                size = min(len(x), len(y)) // 8
                apart[i] = np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum()
            yield batch.select(["a", "b"]).filter(pa.array(apart <= rule.differ(n, m)))

    return both.mapInArrow(run, "a bigint, b bigint")


def _links(pairs: DataFrame, candidates: DataFrame, rule: Rule) -> DataFrame:
    """Linked ``pairs`` (a, b), by their full sets."""
    left, right = (candidates.select("class", "set").toDF(*c) for c in (("a", "set_a"), ("b", "set_b")))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("common")
    measured = both.select("a", "b", (F.size("set_a") + F.size("set_b")).alias("sizes"), common)
    return measured.where(f"{rule.parts}L * common >= {rule.least}L * (sizes - common)").select("a", "b")


def _spanning(x: np.ndarray, y: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Numbers of edges (x, y) that join what all of them join, none twice. ``part``: what is joined already."""
    part = np.unique(part, return_inverse=True)[1]
    taken = []
    while True:
        a, b = part[x], part[y]
        open_ = np.flatnonzero(a != b)
        if not len(open_):
            return np.concatenate(taken) if taken else open_
        low, high = np.minimum(a[open_], b[open_]), np.maximum(a[open_], b[open_])
        order = np.lexsort((low, high))
        first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
        taken.append(open_[first])
        to = np.arange(part.max() + 1)
        to[high[first]] = low[first]
        while (to[to] != to).any():
            to = to[to]
        part = to[part]


def _with_roots(stars: DataFrame, roots: DataFrame) -> DataFrame:
    """(rep, class, root, home): each class beside the least one of its buckets, with the components of both."""
    rows = stars.join(roots.toDF("class", "root"), "class", "left").join(roots.toDF("rep", "home"), "rep", "left")
    root, home = F.coalesce("root", "class"), F.coalesce("home", "rep")
    return rows.select("rep", "class", root.alias("root"), home.alias("home"))


def _outsiders(stars: DataFrame, candidates: DataFrame, roots: DataFrame, rule: Rule, forest: bool) -> DataFrame:
    """Pairs (a, b, cut) of sets that share the least set of some bucket, not the component, and that parities leave.

    One of each pair is an outsider of the star. Outsiders and members are dealt to
    blocks of ``BLOCK``; each pair of blocks is a group of its own. With ``forest`` a group with more
    than ``FEW`` pairs for each row is ``cut`` to as many as would join all that the others would.
    """
    rows = _with_roots(stars, roots).withColumn("out", F.col("root") != F.col("home")).drop("home")
    sizes = rows.groupBy("rep").agg(F.count(F.lit(1)).alias("k"), F.count_if("out").alias("o")).where("o > 0 and k > 1")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    sizes = sizes.select("rep", blocks("k").alias("k"), blocks("o").alias("o"))
    own = rows.join(sizes, "rep").join(candidates.select("class", "n", "bits"), "class")
    spot = lambda c: F.pmod(F.xxhash64("class"), F.col(c)).cast("int")
    member = own.select("*", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("o") - 1)).alias("x"), spot("k").alias("y"))
    asking = own.where("out").select("*", F.lit(True).alias("asks"), spot("o").alias("x"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("y"))
    dealt = member.unionByName(asking).select("rep", "x", "y", "asks", "class", "root", "out", "n", "bits")
    dealt = dealt.repartition("rep", "x", "y").sortWithinPartitions("rep", "x", "y")

    def compared(group: pa.Table) -> pa.RecordBatch:
        asks = group.column("asks").to_numpy()
        value = {c: group.column(c).to_numpy() for c in ("class", "root", "out", "n")}
        bits = [np.frombuffer(x, np.uint64) for x in group.column("bits").to_pylist()]
        i, j = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(i) or not len(j):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2 + [pa.array([], pa.bool_())], names=["a", "b", "cut"])
        near = _near(rule, [bits[k] for k in i], [bits[k] for k in j], value["n"][i], value["n"][j])
        near &= value["root"][i][:, None] != value["root"][j][None]
        near &= ~value["out"][j][None] | (value["class"][i][:, None] < value["class"][j][None])
        x, y = np.nonzero(near)
        x, y = i[x], j[y]
        cut = forest and len(x) > FEW * group.num_rows
        if cut:
            kept = _spanning(x, y, value["root"])
            x, y = x[kept], y[kept]
        a, b = value["class"][x], value["class"][y]
        return pa.RecordBatch.from_arrays(list(map(pa.array, (np.minimum(a, b), np.maximum(a, b), np.full(len(x), cut)))), names=["a", "b", "cut"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["rep", "x", "y"]):
            yield compared(group)

    return dealt.mapInArrow(run, "a bigint, b bigint, cut boolean").groupBy("a", "b").agg(F.max("cut").alias("cut"))


def _listed(sets: DataFrame, hot: np.ndarray, inside: bool) -> DataFrame:
    """(class, signature) of all signatures that are hot, or of all that are not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            value = lists.flatten().to_numpy()
            classes = np.repeat(batch.column(0).to_numpy(), lists.value_lengths().to_numpy())
            picked = _among(hot, value) == inside
            yield pa.RecordBatch.from_arrays([pa.array(classes[picked]), pa.array(value[picked])], names=["class", "signature"])

    return sets.where(F.size("signatures") > 0).select("class", "signatures").mapInArrow(run, "class bigint, signature bigint")


def _with_hot(sets: DataFrame, hot: np.ndarray, least: np.ndarray) -> DataFrame:
    """(rep, class): each class with the least classes of its ``hot`` signatures, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            value = lists.flatten().to_numpy()
            classes = np.repeat(batch.column(0).to_numpy(), lists.value_lengths().to_numpy())
            picked = _among(hot, value)
            pairs = np.stack([least[np.searchsorted(hot, value[picked])], classes[picked]])
            rep, own = np.unique(pairs[:, pairs[0] != pairs[1]], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(own)], names=["rep", "class"])

    return sets.where(F.size("signatures") > 0).select("class", "signatures").mapInArrow(run, "rep bigint, class bigint")


def _buckets(sets: DataFrame, rows: int) -> DataFrame:
    """(rep, class): every class that shares a signature with others, with the least class that has it.

    What comes to the driver are at most ``HOT_LIST`` signatures, and the least class of each.
    """
    share = min(1.0, PROBED / max(rows, 1))
    probe = sets.where(F.pmod(F.xxhash64("class", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)))
    often = _listed(probe, np.empty(0, np.int64), False).groupBy("signature").agg(F.count(F.lit(1)).alias("n"))
    often = often.where(F.col("n") >= max(16, share * rows / HOT_SHARE)).orderBy(F.desc("n"), "signature").limit(HOT_LIST)
    hot = np.sort(often.select("signature").toArrow().column(0).to_numpy())
    own = Window.partitionBy("signature")
    found = _listed(sets, hot, False).withColumn("rep", F.min("class").over(own)).where("rep <> class").select("rep", "class")
    if len(hot):
        known = _listed(sets, hot, True).groupBy("signature").agg(F.min("class").alias("least")).toArrow().sort_by("signature")
        found = found.union(_with_hot(sets, *(known.column(c).to_numpy() for c in ("signature", "least"))))
    return materialise(found.distinct(), "stars")


def linked_classes(docs: DataFrame, rule: Rule = Rule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, component) of every row of ``docs``: the size of its set and the least id linked with it."""
    rows = docs.count()
    ways = allocation(docs, rule, rows, key, text)
    sets = materialise(document_sets(docs, rule, ways, key, text), "sets")
    stars = _buckets(sets, rows)
    some = sets.where("class is not null").groupBy("class").agg(F.min("id").alias("id"))
    asked = stars.select("class").union(stars.select("rep")).distinct()
    candidates = materialise(_candidates(docs, asked.join(some, "class"), rule, key, text), "candidates")
    links = materialise(_links(_pruned(stars.toDF("a", "b"), candidates, rule), candidates, rule), "links")
    roots = components(links)
    for turn in range(FORESTS + 1):
        more = materialise(_outsiders(stars, candidates, roots, rule, forest=turn < FORESTS), "outsiders")
        found = materialise(_links(more.select("a", "b"), candidates, rule), "links")
        if not found.isEmpty():
            links = links.union(found)
            roots = components(links)
        if more.where("cut").isEmpty():
            break
    joined = some.join(roots.toDF("class", "root"), "class")
    least = joined.groupBy("root").agg(F.min("id").alias("component"))
    known = joined.join(least, "root").select("class", "component")
    known = some.join(known, "class", "left").select("class", F.coalesce("component", "id").alias("component"))
    full = sets.where("class is not null").select("id", "n", "class").join(known, "class").select("id", "n", "component")
    return full.unionAll(sets.where("class is null").select("id", "n", F.col("id").alias("component")))
