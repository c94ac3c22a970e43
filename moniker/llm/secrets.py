"""Secrets in texts, and which of them look alive.

Native expressions only. A text is cut at the matches of each pattern; the running sum of
the lengths of its pieces and matches gives every span its place, in code points. Spans
below the least length of their kind are dropped after matching, so that what the pattern
takes stays the leftmost non-overlapping match.

Ownership: the hash of every candidate value is counted over distinct repositories and
owners of the whole corpus. A value that ``WIDE`` or more owners have is a copied example;
one that fewer have is owner-specific, and alive if it also looks random (no placeholder
word, enough different characters). Spans of the fixed kinds are always reported. The
method adds spans of kind ``opaque``: long runs of mixed letters and digits that are
alive and overlap no other span. ``n_live`` and ``n_copied`` count what was found.

Counts are combined before each shuffle (first by hash, owner and repository), so that a
value that a third of all rows have is one row from each task. Looking the counts up is a
plain join, whose busy partitions Spark splits.

Null and empty texts have no spans. Null owners and repositories count as the empty name.
Equal rows (same id and text) get equal results, each its own row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moniker.sources import materialise

# Fixed by contract: kinds in the order in which they are listed, with their patterns,
# the group that holds the value, and the least length of the value.
KINDS = ["assign", "access", "hex", "opaque"]
BASE = 3
PATTERNS = [
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    r"AKIA[A-Z0-9]{16,}",  # 20 characters or more; a shorter run has no longer one inside
    r"[0-9a-f]{24,}",
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{28,}",
]
GROUPS = [2, 0, 0, 0]
LEAST = [6, 20, 24, 28]
WIDE = 3
PLACEHOLDER = r"(?i)example|sample|placeholder|changeme|dummy|xxxx|your[_-]|redacted|0123456|abcdefg"
VARIED = 8


def _pattern(kind: int) -> Column:
    return F.lit(PATTERNS[kind])


def _has(text: Column) -> Column:
    """Whether any pattern matches."""
    found = F.lit(False)
    for kind in range(len(KINDS)):
        found = found | F.rlike(text, _pattern(kind))
    return F.coalesce(found, F.lit(False))


def _is_opaque(value: Column) -> Column:
    return F.rlike(value, F.lit("[0-9].*[0-9]")) & F.rlike(value, F.lit("[A-Z]")) & F.rlike(value, F.lit("[a-z]"))


def _valid(kind: int, value: Column) -> Column:
    enough = F.length(value) >= LEAST[kind]
    return enough & _is_opaque(value) if KINDS[kind] == "opaque" else enough


def _cuts(text: Column, kind: int) -> Column:
    """Length of the text before each match, of the match, and its value; the rest of the text comes last."""
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), F.length)
    wholes = F.regexp_extract_all(text, _pattern(kind), F.lit(0))
    values = F.regexp_extract_all(text, _pattern(kind), F.lit(GROUPS[kind]))
    zipped = F.arrays_zip(gaps.alias("gap"), F.transform(wholes, F.length).alias("size"), values.alias("value"))
    cuts = F.transform(
        zipped,
        lambda x: F.struct(F.lit(kind).alias("kind"), x["gap"].alias("gap"), x["size"].alias("size"), x["value"].alias("value")),
    )
    none = F.array().cast("array<struct<kind:int,gap:int,size:int,value:string>>")
    return F.when(F.rlike(text, _pattern(kind)), cuts).otherwise(none)


def _row(key: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.coalesce(key.cast("string"), F.lit("?")), F.lit(":"), text), 256)


def _hash(value: Column) -> Column:
    return F.sha2(value, 256)


def scan(docs: DataFrame, key: str, text: str, owner: Column, repository: Column) -> DataFrame:
    """(id, row, owner, repository, cuts) of every row; no text. ``row`` tells rows with matches apart."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    named = docs.select(
        F.col(f"`{key}`").alias("id"),
        body.alias("body"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
    )
    cuts = F.concat(*[_cuts(F.col("body"), k) for k in range(len(KINDS))])
    cut = named.select("id", "owner", "repository", "body", cuts.alias("cuts"))
    row = F.when(F.size("cuts") > 0, _row(F.col("id"), F.col("body")))
    return materialise(cut.select("id", row.alias("row"), "owner", "repository", "cuts"), "secret-cuts")


def spans_of(scanned: DataFrame) -> DataFrame:
    """(row, owner, repository, kind, start, end, value, hash) of every valid span."""
    cuts = scanned.where("row is not null").select("row", "owner", "repository", F.posexplode("cuts").alias("at", "cut"))
    cuts = cuts.select("row", "owner", "repository", "at", "cut.*").distinct()
    before = Window.partitionBy("row", "owner", "repository", "kind").orderBy("at")
    ended = cuts.withColumn("end", F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(before))
    valid = F.lit(False)
    for kind in range(len(KINDS)):
        valid = valid | ((F.col("kind") == kind) & _valid(kind, F.col("value")))
    spans = ended.where(F.col("value").isNotNull() & valid)
    start = (F.col("end") - F.col("size")).alias("start")
    return spans.select("row", "owner", "repository", "kind", start, "end", "value", _hash(F.col("value")).alias("hash"))


def ownership(spans: DataFrame, by: str = "hash") -> DataFrame:
    """(hash, owners, repositories): over how many distinct ones each value is spread."""
    places = spans.groupBy(by, "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owned = places.groupBy(by, "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return owned.groupBy(by).agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def judged(spans: DataFrame, wide: int = WIDE) -> DataFrame:
    """(row, kind, start, end, hash, status) with status ``copied``, ``live`` or ``weak``, each span of a row once."""
    counted = spans.join(ownership(spans), "hash")
    varied = F.size(F.array_distinct(F.split("value", ""))) >= VARIED
    alive = varied & ~F.rlike("value", F.lit(PLACEHOLDER))
    status = F.when(F.col("owners") >= wide, "copied").when(alive, "live").otherwise("weak")
    return counted.select("row", "kind", "start", "end", "hash", status.alias("status")).distinct()


def reported(told: DataFrame) -> DataFrame:
    """All spans of the fixed kinds, and the opaque ones that are alive and overlap none of them."""
    fixed = F.col("kind") < BASE
    ahead = Window.partitionBy("row").orderBy("start", "kind")
    behind = Window.partitionBy("row").orderBy(F.desc("start"), "kind")
    marked = told.where(fixed | (F.col("status") == "live"))
    marked = marked.withColumn("left", F.max(F.when(fixed, F.col("end"))).over(ahead))
    marked = marked.withColumn("right", F.min(F.when(fixed, F.col("start"))).over(behind))
    free = (F.coalesce("left", F.lit(0)) <= F.col("start")) & (F.coalesce("right", F.col("end")) >= F.col("end"))
    return marked.where(fixed | free).drop("left", "right")


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    lines = F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"]))
    return F.array_join(lines, ",")


def _count(field: str, value: int | str) -> Column:
    return F.size(F.filter("spans", lambda x: x[field] == value)).cast("long")


def find_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
    wide: int = WIDE,
) -> DataFrame:
    """Spans of every row: ``key``, counts by kind, their digest, all spans as text, live and copied ones.

    ``owner`` is the column ``source`` by default and ``repository`` an owner's part in one language.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    scanned = scan(docs, key, text, owner, repository)
    spans = reported(judged(materialise(spans_of(scanned), "secret-spans"), wide))
    gathered = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "status"))).alias("spans"))
    base = F.filter("spans", lambda x: x["kind"] < BASE)
    counts = [_count("kind", k).alias(f"n_{KINDS[k]}") for k in range(len(KINDS))]
    kept = [_count("status", s).alias(f"n_{s}") for s in ("live", "copied")]
    result = [*counts[:BASE], F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"), counts[BASE], *kept]
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,status:string>>")
    id_ = F.col("id").alias(key)
    found = scanned.where("row is not null").select("id", "row").join(gathered, "row", "left")
    found = found.select("id", F.coalesce("spans", none).alias("spans")).select(id_, *result)
    clean = scanned.where("row is null").select("id", none.alias("spans")).select(id_, *result)
    return found.unionAll(clean)


def mask_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
    wide: int = WIDE,
) -> DataFrame:
    """``docs`` with every reported secret masked: ``[EXAMPLE]`` for copied values, ``[SECRET]`` for others.

    Columns and rows stay; a null text stays null.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    told = reported(judged(materialise(spans_of(scan(docs, key, text, owner, repository)), "secret-spans"), wide))
    gone = lambda s: F.collect_set(F.when(s, F.col("hash")))
    lists = told.groupBy(F.col("row").alias("__row")).agg(
        gone(F.col("status") == "copied").alias("__copied"), gone(F.col("kind") >= BASE).alias("__opaque")
    )
    body = F.col(f"`{text}`")
    dirty = docs.where(_has(body)).withColumn("__row", _row(F.col(f"`{key}`"), body)).join(lists, "__row", "left")
    own = body
    for kind in range(len(KINDS)):
        parts = F.arrays_zip(
            F.split(own, PATTERNS[kind], -1).alias("gap"),
            F.regexp_extract_all(own, _pattern(kind), F.lit(0)).alias("whole"),
            F.regexp_extract_all(own, _pattern(kind), F.lit(GROUPS[kind])).alias("value"),
        )
        own = F.array_join(F.transform(parts, _joined(kind)), "")
    columns = [own.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return dirty.select(*columns).unionAll(docs.where(~_has(body)))


def _joined(kind: int) -> Callable[[Column], Column]:
    return lambda part: F.concat(part["gap"], _masked(part, kind))


def _masked(part: Column, kind: int) -> Column:
    hashed = _hash(part["value"])
    none = F.array().cast("array<string>")
    tag = F.when(F.array_contains(F.coalesce("__copied", none), hashed), "[EXAMPLE]").otherwise("[SECRET]")
    hit = _valid(kind, part["value"])
    if kind >= BASE:
        hit = hit & F.array_contains(F.coalesce("__opaque", none), hashed)
    before = F.left(part["whole"], F.length(part["whole"]) - F.length(part["value"]))
    return F.when(part["whole"].isNull(), "").when(hit, F.concat(before, tag)).otherwise(part["whole"])
