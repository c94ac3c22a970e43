"""Encoding and decoding with a public SentencePiece BPE model, merged in numpy rounds.

``encode_pieces`` gives every row its ids, ``decode_pieces`` gives ids their text back.
The text is cut where a run of spaces begins. No piece has a space behind another
character (checked when the model is loaded), so no merge crosses such a cut, and each
distinct unit of a chunk is merged once.

A round of merges works on flat arrays of the symbols of all units: the least pair rank
of each unit is found by a segmented minimum, all pairs of that rank are merged at once, from
the left and without overlaps, and the arrays are compacted; units without a pair left drop
out. Where a merged piece has a pair of a lower rank than its own, which would come before the
places further right, only the leftmost place is merged in that round. Units of more than ``WHOLE`` characters are cut where
two characters stand that no piece has side by side. A segment of more than ``LONG`` characters,
as hardly occurs in text, could need thousands of rounds over all of it; it is merged with a
heap instead, in the same order, so that its cost stays n log n. Units are told apart by their
bytes; hashes only bring equal ones together.

Null text is empty; an empty text has no piece but the end id. Texts are never cut.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moniker.llm.words import hash_ranges, row_chunks, spread, text_bytes

SPACE = "▁"
WHOLE, LONG = 48, 4096
CHUNK = 1 << 20
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NONE = np.int64(1) << 62
WIDE = {x: pa.scalar(x, pa.large_string()) for x in ("", " ")}


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol-buffer message: number and value (int, 4 or 8 bytes, or bytes)."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7)
            size = varint() if size is None else size
            yield tag >> 3, data[at : at + size]
            at += size


class Table:
    """Byte strings by number, one after the other in one array."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ``numbers``, and where each begins (one more at the end)."""
        sizes = self.sizes[numbers]
        return self.flat[spread(self.starts[numbers], sizes)], np.concatenate([[0], np.cumsum(sizes)])


class PieceModel:
    """Tables of a BPE model whose normaliser changes nothing but spaces.

    Raises ``ValueError`` for any other model.
    """

    def __init__(self, model: bytes):
        pieces, kinds, scores, trainer, normaliser = [], [], [], {}, {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        plain = not normaliser.get(2) and normaliser.get(3, 1) and not normaliser.get(4, 1) and normaliser.get(5, 1)
        if trainer.get(3) != 2 or not plain or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models without normalisation and user-defined pieces can be used")
        self.size = len(pieces)
        self.unknown = kinds.index(UNKNOWN)
        self.end = pieces.index("</s>")
        known = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in known):
            raise ValueError("pieces with a space inside are not supported")
        self.bytes = [pieces.index(f"<0x{b:02X}>") for b in range(256)] if BYTE in kinds else []
        self.character = np.arange(self.size, self.size + 0x110000, dtype=np.int64)
        for p, i in known.items():
            if len(p) == 1:
                self.character[ord(p)] = i
        self.character[ord(" ")] = self.character[ord(SPACE)]
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in known.values()}, reverse=True))}
        pairs = {}
        for p, i in known.items():
            for cut in range(1, len(p)):
                left, right = (self._symbol(known, x) for x in (p[:cut], p[cut:]))
                if left is not None and right is not None:
                    pairs[left << 21 | right] = (order[scores[i]], i)
        self.keys = np.fromiter(sorted(pairs), np.int64, len(pairs))
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)
        # A merge is safe to make everywhere at once if what it makes has no pair of a lower rank,
        # so that none of its pairs would come before the places still to be merged.
        first = np.full(self.size, NONE)
        for side in (self.keys >> 21, self.keys & ((1 << 21) - 1)):
            whole = side < self.size
            np.minimum.at(first, side[whole], self.ranks[whole])
        own = np.full(self.size, NONE)
        own[self.merged] = self.ranks
        often = np.bincount(self.ranks[np.unique(self.merged, return_index=True)[1]]) if len(pairs) else np.zeros(1, np.int64)
        self.safe = (first > own) & (own < NONE) & (often[np.minimum(own, len(often) - 1)] == 1)
        beside = {ord(a) << 21 | ord(b) for p in known for a, b in zip(p, p[1:], strict=False)}
        self.beside = np.array(sorted(beside) or [-1], np.int64)
        text = {NORMAL: lambda p: p.replace(SPACE, " ").encode(), UNKNOWN: lambda p: " ⁇ ".encode()}
        text |= {CONTROL: lambda p: b"", BYTE: lambda p: bytes([int(p[3:5], 16)])}
        self.text = [text[k](p) for p, k in zip(pieces, kinds, strict=True)]
        self.texts = Table(self.text)
        self.numbers = Table([b" %d" % i for i in range(self.size)])
        self.kinds = np.array(kinds)

    def _symbol(self, known: dict[str, int], text: str) -> int | None:
        return known.get(text, int(self.character[ord(text)]) if len(text) == 1 else None)

    def pairs(self) -> dict[int, tuple[int, int]]:
        """Rank and merged id of each pair of symbols."""
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist(), strict=True), strict=True))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE``: no piece) and merged id of pairs of symbols."""
        key = left << 21 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE >> 31), self.merged[at]

    def together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two characters stand side by side in some piece."""
        key = left << 21 | right
        return self.beside[np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)] == key

    def ids_of(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the merged symbols of units and their number; a character without a piece becomes its bytes."""
        odd = symbols >= self.size
        if not odd.any():
            return symbols, counts
        unit = np.repeat(np.arange(len(counts)), counts)
        if self.bytes:
            kinds, which = np.unique(symbols[odd], return_inverse=True)
            table = Table([chr(x - self.size).encode() for x in kinds.tolist()])
            size = np.ones(len(symbols), np.int64)
            size[odd] = table.sizes[which]
            ids = np.repeat(symbols, size)
            ids[np.repeat(odd, size)] = np.array(self.bytes)[table.gather(which)[0]]
            unit = np.repeat(unit, size)
        else:
            ids = np.where(odd, self.unknown, symbols)
            again = np.zeros(len(ids), bool)
            again[1:] = odd[1:] & odd[:-1] & (unit[1:] == unit[:-1])
            ids, unit = ids[~again], unit[~again]
        return ids, np.bincount(unit, minlength=len(counts))

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the space before the first word goes, bytes that are no UTF-8 become U+FFFD each."""
        out, run, first = [], bytearray(), True
        for i in ids:
            if self.kinds[i] == BYTE:
                run += self.text[i]
                first = False
                continue
            out.append(_characters(run))
            run = bytearray()
            own = self.text[i].decode()
            if first and self.kinds[i] == NORMAL:
                own = own.removeprefix(" ")
            first = first and self.kinds[i] == CONTROL
            out.append(own)
        return "".join(out) + _characters(run)


def _characters(run: bytearray) -> str:
    """UTF-8 of byte pieces, with one U+FFFD for each byte that fits no character."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def _leftmost(found: np.ndarray) -> np.ndarray:
    """Of places of pairs in order, the leftmost that do not overlap."""
    fresh = np.concatenate([[True], np.diff(found) != 1])
    at = np.arange(len(found))
    return found[(at - at[fresh][np.cumsum(fresh) - 1]) % 2 == 0]


def merge_rounds(model: PieceModel, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols of segments that lie one after the other in ``symbols``, and how many each has."""
    done = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    unit = np.repeat(np.arange(len(lengths)), lengths)
    rank, merged = np.full(len(symbols), NONE >> 31), np.zeros(len(symbols), np.int64)
    if len(symbols) > 1:
        rank[:-1], merged[:-1] = model.look_up(symbols[:-1], symbols[1:])
    last = np.empty(len(symbols), bool)
    if len(symbols):
        last[-1], last[:-1] = True, unit[1:] != unit[:-1]
    rank[last] = NONE >> 31
    while len(symbols):
        starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        best = np.minimum.reduceat(rank << 31 | np.arange(len(rank)), starts)
        busy = best < NONE
        sizes = np.diff(np.append(starts, len(symbols)))
        keep = np.repeat(busy, sizes)
        done.append((unit[~keep], symbols[~keep]))
        least = best & ((1 << 31) - 1)
        at = np.flatnonzero(keep & (rank == np.repeat(best >> 31, sizes)))
        at = at[model.safe[merged[at]] | (at == np.repeat(least, sizes)[at])]
        if not len(at):
            break
        at = _leftmost(at)
        symbols[at] = merged[at]
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        symbols, unit, rank, merged = symbols[keep], unit[keep], rank[keep], merged[keep]
        at = place[at]
        last = np.concatenate([unit[1:] != unit[:-1], [True]])
        near = np.concatenate([at, at[at > 0] - 1])
        near = near[~last[near]]
        rank[near], merged[near] = model.look_up(symbols[near], symbols[near + 1])
        rank[last] = NONE >> 31
    unit, symbols = map(np.concatenate, zip(*done, strict=True))
    return symbols[np.argsort(unit, kind="stable")], np.bincount(unit, minlength=len(lengths))


def merge_heap(model: PieceModel, symbols: list[int]) -> list[int]:
    """The same merges for one long unit, least rank and leftmost first, from a heap."""
    n = len(symbols)
    symbols, before, after = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1))
    heap, pairs = [], model.pairs()

    def push(left: int) -> None:
        right = after[left] if left >= 0 else n
        if left >= 0 and right < n and (found := pairs.get(symbols[left] << 21 | symbols[right])):
            heapq.heappush(heap, (found[0], left, right, symbols[left], symbols[right], found[1]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, left, right, a, b, new = heapq.heappop(heap)
        if symbols[left] != a or after[left] != right or symbols[right] != b:
            continue
        symbols[left], symbols[right] = new, -1
        after[left] = after[right]
        if after[left] < n:
            before[after[left]] = left
        push(before[left])
        push(left)
    return [s for s in symbols if s >= 0]


def merge_units(model: PieceModel, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of units given as ranges of UTF-8 bytes, none of them empty, and how many each has."""
    own = data[spread(starts, ends - starts)]
    begins = np.concatenate([[0], np.cumsum(ends - starts)])
    counted = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
    places = counted[begins]
    points = np.frombuffer(own.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    points[points == ord(" ")] = ord(SPACE)
    symbols = model.character[points]
    firsts, lengths = _segments(model, points, places)
    short = lengths <= LONG
    if short.all():
        symbols, counts = merge_rounds(model, symbols, lengths)
    else:
        merged, sizes = merge_rounds(model, symbols[spread(firsts[short], lengths[short])], lengths[short])
        parts = iter(np.split(merged, np.cumsum(sizes)[:-1]) if short.any() else ())
        whole = [next(parts) if s else merge_heap(model, symbols[a : a + n].tolist()) for s, a, n in zip(short.tolist(), firsts.tolist(), lengths.tolist(), strict=True)]
        symbols, counts = np.concatenate(whole).astype(np.int64), np.fromiter(map(len, whole), np.int64, len(whole))
    if len(counts) > len(starts):
        counts = np.diff(np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(firsts, places)])
    return model.ids_of(symbols, counts)


def _segments(model: PieceModel, points: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and length of each segment: whole units, the longer ones cut where nothing can be merged."""
    firsts, lengths = places[:-1], np.diff(places)
    if (lengths <= WHOLE).all():
        return firsts, lengths
    own = np.flatnonzero(np.repeat(lengths > WHOLE, lengths))
    own = own[own + 1 < len(points)]
    cuts = own[~model.together(points[own], points[own + 1])] + 1
    firsts = np.union1d(firsts, cuts)
    return firsts, np.diff(np.append(firsts, len(points)))


class Units:
    """Ids of the distinct units of a chunk, and where the rows have them."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, which: np.ndarray, begins: np.ndarray):
        self.ids, self.counts, self.which, self.begins = ids, counts, which, begins

    def flat_ids(self, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, each ended by ``end``, and the first of each row (one more at the end)."""
        whole, sizes = np.append(self.ids, end).astype(np.int32), np.append(self.counts, 1)
        placed = np.insert(self.which, self.begins[1:], len(self.counts))
        starts, sizes = (np.cumsum(sizes) - sizes)[placed], sizes[placed]
        first = np.concatenate([[0], np.cumsum(sizes)])[self.begins + np.arange(len(self.begins))]
        return whole[spread(starts, sizes)], first


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct unit, and for every unit which of them it is. Units cover ``data``."""
    hashes, where, which = np.unique(hash_ranges(data, starts, ends), return_index=True, return_inverse=True)
    first, lengths = where[which], ends - starts
    if (lengths[first] == lengths).all() and np.array_equal(data, data[spread(starts[first], lengths)]):
        return where, which
    whole, places = data.tobytes(), {}  # two units with one hash
    which = np.array([places.setdefault(whole[a:b], len(places)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return np.unique(which, return_index=True)[1], which


class Encoder:
    """Encodes chunks of rows."""

    def __init__(self, model: bytes):
        self.model = PieceModel(model)

    def units(self, column: pa.Array) -> Units:
        """Units of all rows."""
        column = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), SPACE, " ")
        empty = pc.equal(pc.binary_length(column), 0)
        prefix = pc.if_else(empty, WIDE[""], WIDE[" "])
        data, begins = text_bytes(pc.binary_join_element_wise(prefix, column, WIDE[""]))
        space = data == 32
        first = np.zeros(len(data) + 1, bool)
        first[begins] = True
        before = np.concatenate([[False], space[:-1]]) if len(data) else space
        starts = np.flatnonzero((space & ~before) | first[:-1]) if len(data) else np.empty(0, np.int64)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        where, which = _distinct(data, starts, ends)
        return Units(*merge_units(self.model, data, starts[where], ends[where]), which, np.searchsorted(starts, begins))


def encode_pieces(df: DataFrame, model: bytes, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns of ``df`` and ``ids`` (array<int>), ended by the end id.

    A column that is already called ``ids`` is replaced.
    """
    rest = [c for c in df.columns if c != ids]
    schema = df.select(*[F.col(f"`{c}`") for c in rest], F.array(F.lit(0)).alias(ids)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            column = batch.column(rest.index(text))
            for a, b in row_chunks(column, CHUNK):
                flat, first = encoder.units(column.slice(a, b - a)).flat_ids(encoder.model.end)
                found = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, found], names=[*rest, ids])

    return df.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)


def decode_pieces(df: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``df`` and ``text``, the text of ``ids``. Null ids have null text."""
    rest = [c for c in df.columns if c != text]
    schema = df.select(*[F.col(f"`{c}`") for c in rest], F.lit("").cast("string").alias(text)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = PieceModel(model)
        for batch in batches:
            found = [None if row is None else tables.decode(row) for row in batch.column(rest.index(ids)).to_pylist()]
            columns = [*batch.columns, pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, text])

    return df.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)


def _digests(table: Table, ids: np.ndarray, first: np.ndarray) -> Iterator[str]:
    """SHA-256 of what ``table`` has for the ids of each row, without the space it may begin with."""
    data, begins = table.gather(ids)
    whole, bounds = data.tobytes(), begins[first].tolist()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield hashlib.sha256(whole[a:b].removeprefix(b" ")).hexdigest()


def piece_digests(df: DataFrame, model: bytes, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, the number of ids, and SHA-256 of the ids and of the text decoded from them, for each row.

    Both are put together from tables of the pieces' numbers and texts.
    """
    own = df.select(*[F.col(f"`{c}`") for c in keys], F.col(f"`{text}`").alias("__text"))
    more = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema = own.drop("__text").schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", " + more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        tables = encoder.model
        for batch in batches:
            column = batch.column(len(keys))
            counts, written, decoded = [], [], []
            for a, b in row_chunks(column, CHUNK):
                ids, first = encoder.units(column.slice(a, b - a)).flat_ids(tables.end)
                counts.append(np.diff(first))
                written.extend(_digests(tables.numbers, ids, first))
                decoded.extend(_digests(tables.texts, ids, first))
            total = np.concatenate(counts) if counts else np.empty(0, np.int64)
            found = [pa.array(total, pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())]
            names = [*keys, "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=names)

    return own.mapInArrow(run, schema)
