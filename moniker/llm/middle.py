"""Fill-in-the-middle: a document is cut in prefix, middle and suffix and put in another order.

A text is cut in units, each a word with the white space before it, and white space at the
end of the text. Two cuts among them are drawn from a digest of the id, so that reruns agree.
The blocks are exchanged in place: sentinels are put into a bytearray before each segment,
which gives ``<P>prefix<M>middle<S>suffix``, and two neighbouring blocks change places by
three reversals (each block, then both together). ``psm`` turns the last two blocks around,
``spm`` brings the suffix before the two others. Restoring finds the sentinels, turns the
same blocks back and takes the sentinels out.

Texts that are empty or have a sentinel in them stay ``plain``, as does the share of
documents that is to stay as it is. Null texts are empty; a null id is drawn for as the empty
text. Rows with one id and one text give equal results. Texts are handled whole, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moniker.llm.words import CHUNK, is_space

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)


@dataclass(frozen=True)
class Draw:
    """Of each 100 documents ``moved`` are rearranged, and of each 100 of those ``spm`` begin with the suffix."""

    seed: int = 42
    moved: int = 50
    spm: int = 80

    def numbers(self, key: object) -> list[int]:
        told = hashlib.sha256(f"{self.seed}:{'' if key is None else key}".encode()).hexdigest()
        return [int(told[i : i + 8], 16) for i in range(0, 32, 8)]


def unit_ends(data: np.ndarray) -> np.ndarray:
    """Place after each unit of a text in bytes."""
    if not len(data):
        return np.empty(0, np.int64)
    space = is_space(data)
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    return np.append(ends, len(data)) if space[-1] else ends


def rotate(view: np.ndarray, begin: int, middle: int, end: int) -> None:
    """Let the blocks ``begin:middle`` and ``middle:end`` change places, by three reversals."""
    for a, b in ((begin, middle), (middle, end), (begin, end)):
        half = (b - a) // 2
        low, high = view[a : a + half], view[b - half : b][::-1]
        held = low.copy()
        low[:] = high
        high[:] = held


def arrange(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text with its cuts at bytes ``first`` and ``second`` in the order of ``form``."""
    out = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        out[at:at] = sentinel
    view = np.frombuffer(out, np.uint8)
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(view, 0 if form == "spm" else middle, suffix, len(out))
    return out


def restore(output: bytes, form: str) -> bytes:
    """The text from an output and its form alone."""
    if form == "plain":
        return bytes(output)
    out = bytearray(output)
    view = np.frombuffer(out, np.uint8)
    if form == "psm":
        begin, middle = out.index(SUFFIX), out.index(MIDDLE)
    else:
        begin, middle = 0, out.index(PREFIX)
    rotate(view, begin, middle, len(out))
    del view  # a bytearray that is looked at cannot shrink
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = out.index(sentinel)
        del out[at : at + len(sentinel)]
    return bytes(out)


def transform(text: bytes, key: object, draw: Draw = Draw()) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, characters of the prefix, of the middle, output) of one text."""
    data = np.frombuffer(text, np.uint8)
    ends = unit_ends(data)
    n = len(ends)
    h = draw.numbers(key)
    if not text or any(s in text for s in SENTINELS) or h[2] % 100 >= draw.moved:
        return n, "plain", None, None, text
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    form = "spm" if h[3] % 100 < draw.spm else "psm"
    begins = (data & 0xC0) != 0x80
    chars = [int(np.count_nonzero(begins[a:b])) for a, b in ((0, first), (first, second))]
    return n, form, *chars, bytes(arrange(text, first, second, form))


SCHEMA = "n bigint, form string, prefix_chars bigint, middle_chars bigint"


def fill_in_middle(docs: DataFrame, draw: Draw = Draw(), key: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row, or in place of the output its digest and that of the text restored."""
    own = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    last = ["output_sha256 string", "restored_sha256 string"] if digests else ["output string"]
    schema = ", ".join([f"id {own.schema['id'].dataType.simpleString()}", SCHEMA, *last])
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * len(last)]
    names = [x.split()[0] for x in schema.split(", ")]

    def told(key: object, text: bytes) -> tuple:
        n, form, prefix, middle, output = transform(text, key, draw)
        if not digests:
            return n, form, prefix, middle, output.decode()
        return n, form, prefix, middle, *(hashlib.sha256(x).hexdigest() for x in (output, restore(output, form)))

    def packed(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([ids, *columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size, begin = [], 0, 0
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or b""
                rows.append(told(batch.column(0)[i].as_py(), text))
                size += len(text)
                if size >= CHUNK or i + 1 == batch.num_rows:  # what is sent back stays as small as a chunk of texts
                    yield packed(batch.column(0).slice(begin, len(rows)), rows)
                    rows, size, begin = [], 0, i + 1

    return own.mapInArrow(run, schema)


MIDDLE_SQL = r"""
WITH own AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents
),
drawn AS (
    SELECT *, CASE WHEN t = '' THEN 0 ELSE len(u) END AS n,
        CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM own
),
cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
            WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
),
parts AS (
    SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""
