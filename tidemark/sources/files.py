"""Pick-up of Parquet files into a landing table, with per-file validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import quoted
from tidemark.functions.scalars import timestamp_literal


class LoadError(RuntimeError):
    """Files could not be loaded, or nothing was loaded."""


class EmptyLoad(LoadError):
    """There were no rows to load."""


def ingest_files(
    spark: SparkSession,
    directory: str | Sequence[str],
    schema: T.StructType | None = None,
    pattern: str = "*.parquet",
    recursive: bool = True,
    merge_schema: bool = False,
    drop: Sequence[str] = (),
    match: str = "insensitive",
    load_ts: object | None = None,
    skip_corrupt: bool = False,
    file_name: str | None = None,
) -> DataFrame:
    """Rows of all matching files below ``directory``, columns matched by name.

    With ``schema`` the result has exactly its columns: extra file columns are
    ignored and never read, missing ones are NULL. ``match="sensitive"`` takes
    only columns whose case agrees. Without ``schema`` it is inferred, merged
    over the files if asked. ``drop`` ignores absent names; ``load_ts``
    overwrites or adds that column; ``file_name`` adds each row's file.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    if skip_corrupt:
        reader = reader.option("ignoreCorruptFiles", True)
    paths = [directory] if isinstance(directory, str) else list(directory)
    if schema is None or match == "sensitive":
        df = reader.option("mergeSchema", merge_schema).parquet(*paths)
    else:
        df = reader.schema(schema).parquet(*paths)
    if file_name is not None:
        df = df.withColumn(file_name, F.col("_metadata.file_path"))
    if schema is not None:
        df = _by_name(df, schema, match, keep=[file_name] if file_name else [])
    df = df.drop(*drop)
    if load_ts is not None:
        df = df.withColumn("load_ts", timestamp_literal(load_ts))
    return df


#: Files that an error message names; ``load_differences`` gives all.
SHOWN_FILES = 20


def _by_name(df: DataFrame, schema: T.StructType, match: str, keep: Sequence[str]) -> DataFrame:
    if match not in ("sensitive", "insensitive"):
        raise ValueError(f"match must be 'sensitive' or 'insensitive', not {match!r}")
    fold = (lambda s: s) if match == "sensitive" else str.lower
    have = {fold(c): c for c in df.columns}
    return df.select(
        *[
            (quoted(have[fold(f.name)]) if fold(f.name) in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *[quoted(c) for c in keep],
    )


def file_counts(df: DataFrame, file_column: str | None = None) -> DataFrame:
    """Rows loaded per file."""
    source = F.col("_metadata.file_path") if file_column is None else quoted(file_column)
    return df.select(source.alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))


def load_differences(df: DataFrame, expected: DataFrame, file_column: str | None = None) -> DataFrame:
    """Files not loaded as expected: ``file``, ``rows`` loaded and ``want``, either NULL where there are none."""
    want = expected.select("file", F.col("rows").alias("want"))
    both = file_counts(df, file_column).join(want, "file", "full_outer")
    return both.where(~F.col("rows").eqNullSafe(F.col("want")))


def validate_load(
    df: DataFrame,
    expected: DataFrame | None = None,
    on_empty: str = "fail",
    file_column: str | None = None,
) -> int:
    """Number of rows loaded; raises on an empty load or on files loaded only in part.

    ``expected`` holds ``file, rows`` to compare with. ``on_empty="skip"``
    returns 0 instead of raising, so that the caller can skip its merge.
    Counting Parquet rows reads file footers only.
    """
    counts = file_counts(df, file_column)
    if expected is not None:
        partial = load_differences(df, expected, file_column)
        bad = partial.orderBy("file").limit(SHOWN_FILES).collect()
        if bad:
            raise LoadError(
                f"files not fully loaded, {partial.count()} in all (see load_differences): "
                + "; ".join(f"{r['file']}: {r['rows'] or 0} of {r['want'] or 0} rows" for r in bad)
            )
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]
    if total == 0 and on_empty == "fail":
        raise EmptyLoad("no rows were loaded; check the path and the file pattern")
    if on_empty not in ("fail", "skip"):
        raise ValueError(f"on_empty must be 'fail' or 'skip', not {on_empty!r}")
    return total
