"""Schema drift between a source and its target, and type mapping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import FRAMEWORK_COLUMNS, quoted

# Source type name -> type per system, as the type-mapping table
# gives them, with the Spark type used here in the last column. Decimal stays
# exact in Spark, although the mapping's own targets call it float.
TYPE_MAPPING = (
    # snowflake, databricks, sqlserver, teradata, spark
    ("number", "int", "int", "I", "int"),
    ("number", "smallint", "smallint", "SI", "smallint"),
    ("number", "int", "tinyint", "TI", "int"),
    ("varchar", "string", "varchar", "CV", "string"),
    ("float", "float", "decimal", "D", "decimal(38,10)"),
    ("date", "date", "date", "DA", "date"),
    ("timestampntz", "timestamp", "datetime", "TS", "timestamp_ntz"),
)
TYPE_MAPPING_COLUMNS = ("SNOWFLAKE", "DATABRICKS", "SQLSERVER", "TERADATA", "SPARK")


#: Decimal digits that hold every value of an integral type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_INTEGRAL = tuple(_DIGITS)


class TypeChangeError(ValueError):
    """Two states of a column have types without a common type that holds both without loss."""


class UnmappedTypeError(ValueError):
    """A source type has no counterpart in the mapping."""


@dataclass(frozen=True)
class Drift:
    """Differences of a source schema against a target schema."""

    added: dict[str, T.DataType] = field(default_factory=dict)
    removed: list[str] = field(default_factory=list)
    retyped: dict[str, tuple[T.DataType, T.DataType]] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.retyped)


def schema_drift(source: DataFrame, target: DataFrame, ignore: Iterable[str] = FRAMEWORK_COLUMNS) -> Drift:
    """Columns the target lacks, no longer gets, or gets with another type (names in any case)."""
    skip = {c.lower() for c in ignore}
    src = {f.name.lower(): f for f in source.schema.fields if f.name.lower() not in skip}
    tgt = {f.name.lower(): f for f in target.schema.fields if f.name.lower() not in skip}
    return Drift(
        added={f.name: f.dataType for k, f in src.items() if k not in tgt},
        removed=[f.name for k, f in tgt.items() if k not in src],
        retyped={
            tgt[k].name: (tgt[k].dataType, f.dataType)
            for k, f in src.items()
            if k in tgt and tgt[k].dataType != f.dataType
        },
    )


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both without loss, or None.

    Integers widen among themselves, into decimals with room for them and, up to 32 bits, into doubles; decimals
    into one with the digits of both sides of the point; float into double; dates into zone-free times. Whatever
    has one text in every session (numbers, booleans, dates, zone-free times) widens into string. Arrays, maps of
    one key type and structs (by field name, in any case) widen part by part. A zoned time, binary data and a mix of
    long or decimal with floating point have nothing but themselves.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    kinds = (a, b)
    if all(isinstance(x, _INTEGRAL) for x in kinds):
        return max(kinds, key=lambda x: _DIGITS[type(x)])
    if all(isinstance(x, (*_INTEGRAL, T.DecimalType)) for x in kinds):
        whole = max(_DIGITS[type(x)] if isinstance(x, _INTEGRAL) else x.precision - x.scale for x in kinds)
        scale = max(0 if isinstance(x, _INTEGRAL) else x.scale for x in kinds)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if all(isinstance(x, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)) for x in kinds):
        exact = all(isinstance(x, (T.ByteType, T.ShortType, T.FloatType)) for x in kinds)
        return T.FloatType() if exact else T.DoubleType()
    if {type(x) for x in kinds} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = wider_type(a.elementType, b.elementType)
        return None if element is None else T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        value = wider_type(a.valueType, b.valueType) if a.keyType == b.keyType else None
        return None if value is None else T.MapType(a.keyType, value, a.valueContainsNull or b.valueContainsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = _wider_fields(a, b, lambda name, x, y: None)
        return None if fields is None else T.StructType(fields)
    plain = (*_INTEGRAL, T.DecimalType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType, T.TimestampNTZType, T.StringType)
    if any(isinstance(x, T.StringType) for x in kinds) and all(isinstance(x, plain) for x in kinds):
        return T.StringType()
    return None


def _wider_fields(a: T.StructType, b: T.StructType, fail) -> list[T.StructField] | None:
    """Fields of ``a``, each as wide as its namesake in ``b`` needs, and then those of ``b`` alone."""
    other, fields = {f.name.lower(): f for f in b.fields}, []
    for f in a.fields:
        mate = other.pop(f.name.lower(), None)
        kind = f.dataType if mate is None else wider_type(f.dataType, mate.dataType)
        if kind is None:
            fail(f.name, f.dataType, mate.dataType)
            return None
        fields.append(T.StructField(f.name, kind, True))
    return [*fields, *other.values()]


def common_schema(first: T.StructType, second: T.StructType) -> T.StructType:
    """Columns of ``first`` and then those of ``second`` alone, each in a type that holds both without loss.

    A column that has none is an error that names it, so that nothing is written of values that could be cut.
    """

    def fail(name: str, a: T.DataType, b: T.DataType) -> None:
        raise TypeChangeError(f"column {name!r}: no type holds both {a.simpleString()} and {b.simpleString()} without loss")

    return T.StructType(_wider_fields(first, second, fail))


def cast_up(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with its columns in the types that ``schema`` has for their names; the others stay as they are."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    wanted = {f.name: types[f.name.lower()] for f in df.schema.fields if types.get(f.name.lower(), f.dataType) != f.dataType}
    return df.withColumns({c: _cast(quoted(c), df.schema[c].dataType, t) for c, t in wanted.items()}) if wanted else df


def _cast(column: Column, old: T.DataType, new: T.DataType) -> Column:
    """A cast that takes the fields of structs by name."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        have = {f.name.lower(): f for f in old.fields}
        parts = [
            (_cast(column[have[f.name.lower()].name], have[f.name.lower()].dataType, f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in new.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(column, lambda x: _cast(x, old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return F.transform_values(column, lambda _, x: _cast(x, old.valueType, new.valueType))
    return column.cast(new)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and wider types of ``schema``: those it lacks are NULL, others are left out."""
    have = {f.name.lower(): f for f in df.schema.fields}
    return df.select(
        *[
            (_cast(quoted(have[f.name.lower()].name), have[f.name.lower()].dataType, f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


@dataclass(frozen=True)
class Widening:
    """What a source's schema does to a stored one: ``schema`` holds both, ``rehashed`` tells whether values that did
    not change get another row hash, ``rebucketed`` whether keys get another bucket."""

    schema: T.StructType
    rehashed: bool = False
    rebucketed: bool = False


def widening(stored: T.StructType, source: T.StructType, keys: Iterable[str], buckets_kept) -> Widening:
    """How ``stored`` widens to take ``source``; an error if it cannot without loss.

    ``buckets_kept`` tells of an old and a new type whether a key keeps its bucket.
    """
    both = common_schema(stored, source)
    new = {f.name.lower(): f.dataType for f in both.fields}
    key = {k.lower() for k in keys}
    changed = [(f.name.lower(), f.dataType, new[f.name.lower()]) for f in stored.fields if new[f.name.lower()] != f.dataType]
    return Widening(
        T.StructType([T.StructField(f.name, new[f.name.lower()], True) for f in source.fields]),
        any(not same_text(old, now) for _, old, now in changed),
        any(n in key and not buckets_kept(old, now) for n, old, now in changed),
    )


def same_text(old: T.DataType, new: T.DataType) -> bool:
    """Whether a value keeps its text, and so its hash, when its type is widened from ``old`` to ``new``."""
    if old == new or isinstance(old, T.NullType):
        return True
    if isinstance(new, T.StringType):
        return not isinstance(old, (T.FloatType, T.DoubleType))  # -0.0 is hashed as 0.0 but told as it is
    return isinstance(old, _INTEGRAL) and isinstance(new, (*_INTEGRAL, T.DecimalType)) and getattr(new, "scale", 0) == 0


def add_columns(target: DataFrame, columns: Mapping[str, T.DataType | str]) -> DataFrame:
    """Add missing columns as typed NULLs; existing ones (any case) stay."""
    have = {c.lower() for c in target.columns}
    new = {n: F.lit(None).cast(t) for n, t in columns.items() if n.lower() not in have}
    return target.withColumns(new) if new else target


def drop_column(target: DataFrame, name: str) -> DataFrame:
    """Remove one column; it is an error if there is none of that name."""
    if name.lower() not in {c.lower() for c in target.columns}:
        raise ValueError(f"no column {name!r} to drop")
    return target.drop(name)


def union_drift(first: DataFrame, second: DataFrame) -> DataFrame:
    """UNION ALL by name: columns missing on either side become NULL, differing types become their wider one."""
    types = common_schema(first.schema, second.schema)
    return cast_up(first, types).unionByName(cast_up(second, types), allowMissingColumns=True)


def append_like(first: DataFrame, second: DataFrame) -> DataFrame:
    """UNION ALL by name with the columns of ``first``: others of ``second`` are dropped."""
    have = {c.lower() for c in first.columns}
    return union_drift(first, second.drop(*[c for c in second.columns if c.lower() not in have]))


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``; others are ignored."""
    have = {c.lower() for c in df.columns}
    return df.select(
        *[
            (quoted(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def mapping_table(spark: SparkSession) -> DataFrame:
    """The built-in type mapping as a DataFrame, with each row's ``position`` in it."""
    rows = [(*row, k) for k, row in enumerate(TYPE_MAPPING)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in TYPE_MAPPING_COLUMNS) + ", position int")


def map_types(
    columns: DataFrame,
    mapping: DataFrame,
    type_column: str = "data_type",
    source: str = "SQLSERVER",
    target: str = "SPARK",
    name: str = "mapped_type",
) -> DataFrame:
    """Look up the target type of each row's source type, ignoring case; NULL if unknown.

    The mapping is reduced to one row per type name: the first listed one, if it
    has a column ``position``, else the smallest name. Spark broadcasts it if
    its size estimate is under the limit and otherwise joins by shuffle.
    """
    chosen = F.min_by(target, "position") if "position" in mapping.columns else F.min(target)
    lookup = mapping.groupBy(F.lower(F.col(source)).alias("__type")).agg(chosen.alias(name))
    return columns.join(lookup, F.lower(quoted(type_column)) == F.col("__type"), "left").drop("__type")


def alter_table_add(
    spark: SparkSession, table: str, types: Mapping[str, str], source: str = "SQLSERVER"
) -> list[str]:
    """Add the columns a catalog table lacks, by source type; returns their names.

    A type without counterpart is an error before anything is changed.
    """
    mapped = spark_types(types, source)
    have = {c.lower() for c in spark.table(table).columns}
    new = {n: t for n, t in mapped.items() if n.lower() not in have}
    if new:
        columns = ", ".join(f"`{n}` {t}" for n, t in new.items())
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return list(new)


def spark_types(types: Mapping[str, str], source: str = "SQLSERVER") -> dict[str, str]:
    """Spark type per column name for a few source columns; unknown types raise."""
    at = TYPE_MAPPING_COLUMNS.index(source.upper())
    known: dict[str, str] = {}
    for row in TYPE_MAPPING:
        known.setdefault(row[at].lower(), row[-1])
    unknown = {n: t for n, t in types.items() if t.lower() not in known}
    if unknown:
        raise UnmappedTypeError(f"no mapping for {unknown}")
    return {n: known[t.lower()] for n, t in types.items()}
