"""Fields of JSON lines compared with the declared schema, file by file."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from moniker.functions.text import let
from moniker.sources.scratch import materialise

# Names of JSON kinds by the types that a parsed value can have.
KINDS = {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "int": "BIGINT", "number": "DOUBLE|DECIMAL|FLOAT", "boolean": "BOOLEAN", "null": "VOID"}


def _kind(told: Column) -> Column:
    """Name of the kind that ``_told`` has found."""
    found = F.lit("other")
    for name, prefix in KINDS.items():
        found = F.when(told.rlike(f"^(?:{prefix})"), name).otherwise(found)
    return found


def _object(value: Column) -> Column:
    """The fields of an object, null for any other value. What is below them is not looked at."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _array(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _told(value: Column, container: Column) -> Column:
    """Type of a value. The type of a container is that of all below it, so those declared as one are told by a look at the top."""
    told = F.schema_of_variant(value)
    top = F.when(_object(value).isNotNull(), "OBJECT").when(_array(value).isNotNull(), "ARRAY").otherwise(told)
    return F.when(container, top).otherwise(told)


def declared_kind(kind: DataType) -> str:
    """JSON kind of a declared type."""
    name = kind.typeName()
    if isinstance(kind, StructType):
        return "object"
    return {"array": "array", "string": "string", "boolean": "boolean"}.get(name, "number" if name in ("double", "float", "decimal") else "int")


def declared_fields(schema: StructType, prefix: str = "") -> Iterator[tuple[str, str]]:
    """(field, kind) of all fields of a schema, nested ones with a dotted name."""
    for field in schema.fields:
        yield f"{prefix}{field.name}", declared_kind(field.dataType)
        inner = field.dataType.elementType if isinstance(field.dataType, ArrayType) else field.dataType
        if isinstance(inner, StructType):
            yield from declared_fields(inner, f"{prefix}{field.name}.")


def _present(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull())


def _below(maps: Column, name: str) -> Column:
    return _present(F.transform(maps, lambda m: m[name]))


def _shapes(values: Column) -> Column:
    """One value of each type: without declared containers the type of an object says all of its fields."""

    def first(all_of: Column) -> Column:
        def of(told: Column) -> Column:
            return F.transform(F.array_distinct(told), lambda t: F.get(all_of, (F.array_position(told, t) - 1).cast("int")))

        return let(F.transform(all_of, F.schema_of_variant), of)

    return let(_present(values), first)


def _fields(values: Column, schema: StructType, prefix: str = "") -> Column:
    """(field, told) of the fields that objects in ``values`` have, down to where the schema declares objects. Each level is parsed once."""
    containers = [f.name for f in schema.fields if isinstance(f.dataType, (StructType, ArrayType))]

    def own(entry: Column) -> Column:
        told = _told(entry["value"], entry["key"].isin(containers))
        return F.struct(F.concat(F.lit(prefix), entry["key"]).alias("field"), told.alias("told"))

    def found(maps: Column) -> Column:
        levels = [F.array_distinct(F.flatten(F.transform(maps, lambda m: F.transform(F.map_entries(m), own))))]
        for field in schema.fields:
            inner, below = field.dataType, _below(maps, field.name)
            if isinstance(inner, ArrayType):
                inner, below = inner.elementType, F.flatten(_present(F.transform(below, _array)))
            if isinstance(inner, StructType):
                levels.append(_fields(below, inner, f"{prefix}{field.name}."))
        return F.concat(*levels)

    objects = values if containers else _shapes(values)
    return let(_present(F.transform(objects, _object)), found)


# Types that a merged type tells exactly: numbers with a fraction would hide whole ones, and null any other type.
_MERGED = r"^[A-Za-z0-9_:, <>]*$"
_HIDES = r"VARIANT|DOUBLE|DECIMAL|FLOAT"
_NULL = r"(?:^|[:\[,])\s*null"
# Containers that a merged type may have to be written out as an example.
_DEPTH = 16


def _exact(told: Column, line: Column) -> Column:
    """Whether the merged type of a whole line says which kinds each of its fields has. If in doubt it does not."""
    null = F.contains(line, F.lit("null")) & line.rlike(_NULL)
    few = F.length(F.regexp_replace(told, "[^<]", "")) <= _DEPTH
    return told.rlike(_MERGED) & ~told.rlike(_HIDES) & few & ~null


def _example(told: Column) -> Column:
    """JSON of an exact type: each field once, each array with one element."""
    text = F.regexp_replace(told, "([A-Za-z0-9_]+): ", r'"$1": ')
    for name, value in (("VOID", ""), ("STRING", '""'), ("BIGINT", "0"), ("BOOLEAN", "true")):
        text = F.regexp_replace(text, f'(?<!["A-Za-z0-9_]){name}(?![A-Za-z0-9_"])', value)

    def innermost(rest: Column, _: Column) -> Column:
        objects = F.regexp_replace(rest, r'(?<!["A-Za-z0-9_])OBJECT<([^<>]*)>', "{$1}")
        return F.regexp_replace(objects, r'(?<!["A-Za-z0-9_])ARRAY<([^<>]*)>', "[$1]")

    return F.aggregate(F.sequence(F.lit(1), F.lit(_DEPTH)), text, innermost)


def _shown(record: Column, line: Column) -> Column:
    """A record, or an example of its type if that says all about its fields, which has one object where the record may have thousands."""
    return let(F.schema_of_variant(record), lambda told: F.when(_exact(told, line), F.try_parse_json(_example(told))).otherwise(record))


def seen_fields(spark: SparkSession, path: str | list[str], schema: StructType, glob: str = "*.json.gz") -> DataFrame:
    """(file, field, kind, n): in how many lines of each file a field has which kind.

    Lines that are no JSON have none. A line is parsed once; counts are combined before the shuffle.
    """
    shown = let(F.try_parse_json("value"), lambda record: _shown(record, F.col("value")))
    kinds = F.transform(_fields(F.array(shown), schema), lambda f: F.struct(f["field"].alias("field"), _kind(f["told"]).alias("kind")))
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    # Without ``outer`` Spark asks the size of each list first, and makes it once more for that.
    fields = lines.select(F.col("_metadata.file_path").alias("file"), F.explode_outer(F.array_distinct(kinds)).alias("f")).where(F.col("f").isNotNull())
    return fields.groupBy("file", "f.field", "f.kind").agg(F.count(F.lit(1)).alias("n"))


def schema_drift(seen: DataFrame, schema: StructType) -> DataFrame:
    """(file, field, declared, kind, drift, n) where ``seen`` fields (file, field, kind, n) and the schema part.

    ``drift`` is ``missing`` (declared, not in the file), ``unknown`` (not declared) or
    ``retyped`` (another kind; null is none). A field that is optional is reported as missing too.
    """
    declared = list(declared_fields(schema))
    seen = materialise(seen, "seen")  # it is asked twice
    expected = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(k).alias("declared")) for f, k in declared])
    files = seen.select("file").distinct()
    wanted = files.select("file", F.explode(expected).alias("e")).select("file", "e.*")
    both = wanted.join(seen, ["file", "field"], "full")
    drift = (
        F.when(F.col("kind").isNull(), "missing")
        .when(F.col("declared").isNull(), "unknown")
        .when((F.col("kind") != F.col("declared")) & (F.col("kind") != "null"), "retyped")
    )
    found = both.withColumn("drift", drift).where(F.col("drift").isNotNull())
    return found.select("file", "field", "declared", "kind", "drift", F.coalesce("n", F.lit(0)).alias("n"))
