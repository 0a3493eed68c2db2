"""One schema for files whose schemas differ.

Types of a column widen along a lattice: whole numbers to longer ones and to decimals, floats to doubles, dates to
timestamps; what has no common type becomes text. A column that only some files have is NULL in the others.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.tables import storage

# Fixed value: how many files of a table are sampled unless the caller says otherwise.
SAMPLED_FILES = 10
_SCHEMAS_AT_ONCE = 8
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_FLOATS = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def common_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """The least type that holds values of both; text if there is none."""
    if one == other:
        return one
    kinds = {type(one), type(other)}
    if kinds <= set(_WHOLE):
        return max(one, other, key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {*_WHOLE, T.DecimalType}:
        return _common_decimal(_as_decimal(one), _as_decimal(other))
    if kinds <= {*_WHOLE, *_FLOATS, T.DecimalType}:
        return T.DoubleType()
    if kinds <= set(_TIMES):
        return max(one, other, key=lambda t: _TIMES.index(type(t)))
    if kinds == {T.NullType, type(one)} or kinds == {T.NullType, type(other)}:
        return other if isinstance(one, T.NullType) else one
    if kinds == {T.StructType}:
        return common_schema([one, other])
    if kinds == {T.ArrayType}:
        return T.ArrayType(common_type(one.elementType, other.elementType), True)
    if kinds == {T.MapType} and one.keyType == other.keyType:
        return T.MapType(one.keyType, common_type(one.valueType, other.valueType), True)
    return T.StringType()


def _as_decimal(kind: T.DataType) -> T.DecimalType:
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(_DIGITS[type(kind)], 0)


def _common_decimal(one: T.DecimalType, other: T.DecimalType) -> T.DataType:
    scale = max(one.scale, other.scale)
    digits = max(one.precision - one.scale, other.precision - other.scale) + scale
    return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()


def common_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """Columns in the order in which they turn up, oldest schema first; names are told apart without regard to case."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            known = found.get(field.name.lower())
            kind = field.dataType if known is None else common_type(known.dataType, field.dataType)
            found[field.name.lower()] = T.StructField(known.name if known else field.name, kind, True)
    return T.StructType(list(found.values()))


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the parquet files below a folder, by path: days in order."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    return [r["path"] for r in listed.select("path").orderBy("path").collect()]


def sampled(files: Sequence[str], most: int | None) -> list[str]:
    """The first, the last and files evenly between, ``most`` in all; all of them with None."""
    if most is None or len(files) <= most:
        return list(files)
    if most < 2:
        return [files[-1]]
    return [files[round(k * (len(files) - 1) / (most - 1))] for k in range(most)]


def file_schemas(spark: SparkSession, files: Sequence[str]) -> list[T.StructType]:
    """The schema in each file's footer. Each footer is read by a task of its own, a few at a time."""
    with ThreadPoolExecutor(_SCHEMAS_AT_ONCE) as pool:
        return list(pool.map(lambda file: spark.read.parquet(file).schema, files))


def merged_schema(spark: SparkSession, folder: str, most_files: int | None = SAMPLED_FILES) -> T.StructType | None:
    """The common schema of a table's files (of a sample of them, as its size is given); None without files."""
    if not storage.exists(spark, folder):
        return None
    files = sampled(data_files(spark, folder), most_files)
    return common_schema(file_schemas(spark, files)) if files else None


def read_merged(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of a table whose files differ, under their common schema.

    Every footer is looked at; files that share a schema make up one scan, and each scan is cast to the common types.
    """
    files = data_files(spark, folder)
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for file, schema in zip(files, file_schemas(spark, files)):
        groups.setdefault(schema.json(), (schema, []))[1].append(file)
    target = common_schema(schema for schema, _ in groups.values())
    frames = [spark.read.schema(schema).parquet(*paths).select(*_cast(schema, target)) for schema, paths in groups.values()]
    return reduce(DataFrame.unionByName, frames)


def _cast(schema: T.StructType, target: T.StructType) -> list[Column]:
    mine = {f.name.lower(): f for f in schema}

    def column(field: T.StructField) -> Column:
        found = mine.get(field.name.lower())
        if found is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return _converted(F.col(f"`{found.name}`"), found.dataType, field.dataType).alias(field.name)

    return [column(f) for f in target]


def _converted(value: Column, found: T.DataType, target: T.DataType) -> Column:
    """A value under a wider type; fields that a struct lacks are NULL."""
    if found == target:
        return value
    if isinstance(target, T.StringType) and isinstance(found, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    if isinstance(target, T.StructType):
        mine = {f.name.lower(): f for f in found}
        fields = []
        for field in target:
            known = mine.get(field.name.lower())
            part = F.lit(None).cast(field.dataType) if known is None else _converted(value.getField(known.name), known.dataType, field.dataType)
            fields.append(part.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType):
        return F.transform(value, lambda v: _converted(v, found.elementType, target.elementType))
    if isinstance(target, T.MapType):
        return F.transform_values(value, lambda _, v: _converted(v, found.valueType, target.valueType))
    return value.cast(target)
