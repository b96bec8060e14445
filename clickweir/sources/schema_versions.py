"""Tables whose schema has changed over time: what changed, and one reader for all versions.

A version is a folder of Parquet files with a schema of its own. From one version to the next a column is added, dropped,
widened, narrowed, or changed to a type that holds neither. The reader gives every column the narrowest type that holds all
versions' values; versions without it have NULL. A narrowing, or a type without a common one, is refused by name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Types in which each holds the values of those before it; two of one chain have the wider as their common type.
_CHAINS = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DecimalType(20, 0), T.DecimalType(38, 0)),
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()),
    (T.FloatType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType()),
)


class IncompatibleSchema(ValueError):
    pass


@dataclass(frozen=True)
class Change:
    """How `column` differs between a version and the one before it."""
    version: int
    column: str
    kind: str          # added, dropped, widened, narrowed, changed
    before: str | None
    after: str | None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds both, if there is one."""
    if a == b:
        return a
    for chain in _CHAINS:
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(scale + whole, scale) if scale + whole <= 38 else None
    return None


def compare(before: T.StructType, after: T.StructType, version: int = 1) -> list[Change]:
    """All changes from one schema to the next, by column name."""
    was, now = ({f.name: f.dataType for f in s} for s in (before, after))
    out = []
    for name in sorted(was.keys() | now.keys()):
        a, b = was.get(name), now.get(name)
        if a == b:
            continue
        wide = common_type(a, b) if a and b else None
        kind = "added" if a is None else "dropped" if b is None else "widened" if wide == b else "narrowed" if wide == a else "changed"
        out.append(Change(version, name, kind, a and a.simpleString(), b and b.simpleString()))
    return out


def stored_schemas(spark: SparkSession, paths: Sequence[str]) -> list[T.StructType]:
    """The schema of each version, from the footer of one of its files."""
    return [spark.read.option("mergeSchema", "false").parquet(p).schema for p in paths]


def history(spark: SparkSession, paths: Sequence[str]) -> list[Change]:
    schemas = stored_schemas(spark, paths)
    return [c for i in range(1, len(schemas)) for c in compare(schemas[i - 1], schemas[i], i)]


def unified_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns in the order they first came, each in the type that holds all versions. Refuses what would lose values."""
    types: dict[str, T.DataType] = {}
    for version, schema in enumerate(schemas):
        for f in schema:
            if f.name not in types:
                types[f.name] = f.dataType
                continue
            wide = common_type(types[f.name], f.dataType)
            if wide is None or wide != f.dataType:
                word = "has no common type with" if wide is None else "is narrower than"
                raise IncompatibleSchema(f"{f.name}: {f.dataType.simpleString()} of version {version} {word} {types[f.name].simpleString()}")
            types[f.name] = wide
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def read_versions(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows of all versions in the unified schema, with the number of their version."""
    schemas = stored_schemas(spark, paths)
    target = unified_schema(schemas)
    frames = [spark.read.schema(s).parquet(p).select(
        *[(F.col(f.name) if f.name in s.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in target], F.lit(i).alias("version"))
        for i, (p, s) in enumerate(zip(paths, schemas))]
    return reduce(DataFrame.unionAll, frames)
