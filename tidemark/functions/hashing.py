"""Row hashes, hash buckets and order-insensitive fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import BUCKET, HASH, content_columns, key_columns, quoted

# The separator of the compatible row hash and the bucket sizing defaults.
SEPARATOR = "||"
ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 64
#: Stored bytes of a bucket where a run chooses their number: few directories, each of many row groups.
BYTES_PER_BUCKET = 2 << 30


def _as_text(name: str, dtype: T.DataType) -> Column:
    """Text of a value, whatever the session's time zone; -0.0 as 0.0."""
    column = quoted(name)
    in_utc = {"timeZone": "UTC"}
    if isinstance(dtype, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(column)), in_utc)
    if isinstance(dtype, (T.ArrayType, T.StructType, T.VariantType)):
        return F.to_json(column, in_utc)
    if isinstance(dtype, T.BinaryType):
        return F.hex(column)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(column == 0, F.lit(0.0).cast(dtype)).otherwise(column).cast("string")
    return column.cast("string")


def _canonical(df: DataFrame, key: str) -> Column:
    """A key column in the widest type of its kind, so that its hash stays when the type is widened."""
    dtype = next((f.dataType for f in df.schema.fields if f.name.lower() == key.lower()), None)
    column = quoted(key)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return column.cast("bigint")
    if isinstance(dtype, T.FloatType):
        return column.cast("double")
    if isinstance(dtype, T.DecimalType):
        return column.cast(T.DecimalType(38, dtype.scale))
    return column


def same_bucket(old: T.DataType, new: T.DataType) -> bool:
    """Whether a key column keeps its hash bucket when its type is widened."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if old == new or isinstance(old, whole) and isinstance(new, whole):
        return True
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return old.scale == new.scale
    return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)


def encoded(df: DataFrame, columns: Sequence[str]) -> Column:
    """One string that is equal for two rows only if all ``columns`` are equal.

    Each value that is not NULL is written as ``name=length:text`` (length in
    bytes, the name in lower case and with its own length), so empty strings
    and any separator inside the data stay distinct. NULL leaves no trace, and
    so does a column missing from ``df``: a column that comes or goes with
    NULLs alone changes nothing.
    """
    fields = {f.name.lower(): f for f in df.schema.fields}
    parts = []
    for name in columns:
        field = fields.get(name.lower())
        if field is None:
            continue
        text = _as_text(field.name, field.dataType)
        label = f"{len(name.encode())}:{name.lower()}="
        parts.append(F.coalesce(F.concat(F.lit(label), F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def row_hash(
    df: DataFrame,
    keys: Sequence[str],
    name: str = HASH,
    mode: str = "safe",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add the md5 of the non-key columns.

    ``safe`` hashes an unambiguous encoding, columns in name order, so it
    neither confuses NULL positions nor reacts to column reordering.
    ``compat`` is ``md5(concat_ws('||', ...))`` in table order: it drops
    NULLs, and values holding the separator can collide.
    """
    if columns is None:
        columns = content_columns(df, keys)
    if mode == "compat":
        return df.withColumn(name, F.md5(F.concat_ws(SEPARATOR, *[quoted(c).cast("string") for c in columns])))
    if mode != "safe":
        raise ValueError(f"unknown hash mode: {mode!r}")
    return df.withColumn(name, F.md5(encoded(df, sorted(columns, key=str.lower))))


def packed_hash(df: DataFrame) -> DataFrame:
    """Rows with the md5 of ``row_hash`` as bytes, half as long on their way through a shuffle."""
    return df.withColumn(HASH, F.unhex(HASH))


def unpacked_hash(df: DataFrame) -> DataFrame:
    """Rows of ``packed_hash`` with the md5 as text again."""
    return df.withColumn(HASH, F.lower(F.hex(HASH)))


def _portable_number(hex_text: Column, digits: int) -> Column:
    return F.conv(F.substring(hex_text, 1, digits), 16, 10).cast("decimal(20,0)")


def hash_bucket(
    df: DataFrame, keys: Sequence[str], buckets: int, name: str = BUCKET, portable: bool = False
) -> DataFrame:
    """Add the hash bucket ``0 .. buckets-1`` of the key, in one pass over the data.

    The default is xxhash64; ``portable`` derives the number from md5 so that
    another engine can compute the same bucket.
    """
    if portable:
        number = _portable_number(F.md5(encoded(df, keys)), 8).cast("bigint")
    else:
        number = F.xxhash64(*[_canonical(df, k) for k in keys])
    return df.withColumn(name, F.pmod(number, F.lit(buckets)).cast("int"))


def bucket_count(
    rows: Column | int, rows_per_bucket: int = ROWS_PER_BUCKET, most: int | None = MAX_BUCKETS
) -> Column | int:
    """Number of buckets for a table of ``rows``; a column in gives a column out.

    ``most`` bounds directories, not rows: a bucket may hold any number of
    rows and is written as many files. Runs that are given no number go by stored
    bytes instead (see ``bucket_count_of``).
    """
    if isinstance(rows, Column):
        wanted = F.ceil(rows / F.lit(rows_per_bucket)).cast("int")
        return F.greatest(F.lit(1), wanted if most is None else F.least(F.lit(most), wanted))
    wanted = -(-rows // rows_per_bucket)
    return max(1, wanted if most is None else min(most, wanted))


def bucket_count_of(stored: int, bytes_per_bucket: int = BYTES_PER_BUCKET) -> int:
    """Number of buckets for a table of so many stored bytes, so that wide rows and narrow ones give buckets alike."""
    return max(1, -(-stored // bytes_per_bucket))


def bucket_fingerprint(
    df: DataFrame,
    keys: Sequence[str],
    buckets: int | None = None,
    portable: bool = False,
) -> DataFrame:
    """Per bucket: ``rows`` and an order-insensitive ``fingerprint``.

    The key is part of the fingerprint, so values swapped between keys
    change it. Uses the ``bucket`` and ``hash_val`` columns when present.
    Partial aggregation leaves at most one row per bucket and task to shuffle.
    """
    if HASH not in df.columns:
        df = row_hash(df, keys)
    if buckets is not None or BUCKET not in df.columns:
        df = hash_bucket(df, keys, buckets or 1, portable=portable)
    if portable:
        number = _portable_number(F.md5(encoded(df, [*keys, HASH])), 15)
    else:
        number = F.xxhash64(*key_columns(keys), F.col(HASH)).cast("decimal(20,0)")
    return (
        df.select(F.col(BUCKET), number.alias("n"))
        .groupBy(BUCKET)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("n").cast("decimal(38,0)").alias("fingerprint"))
    )


def changed_buckets(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """Buckets whose fingerprints differ or that exist on one side only.

    Inputs are the outputs of :func:`bucket_fingerprint`, one row per bucket.
    """
    p = prev.select(BUCKET, F.col("rows").alias("p_rows"), F.col("fingerprint").alias("p_fingerprint"))
    c = curr.select(BUCKET, F.col("rows").alias("c_rows"), F.col("fingerprint").alias("c_fingerprint"))
    same = F.col("p_rows").eqNullSafe(F.col("c_rows")) & F.col("p_fingerprint").eqNullSafe(F.col("c_fingerprint"))
    return p.join(c, BUCKET, "full_outer").where(~same).select(BUCKET)


def differing_buckets(index: Sequence[Row], stats: Sequence[Row], buckets: int, anew: bool = False) -> set[int]:
    """Buckets that differ between a stored index and new statistics, one row per bucket each.

    With another bucket count, or other hashes (``anew``), nothing lines up, so all count as differing.
    """
    now = {r["bucket"]: (r["rows"], r["fingerprint"]) for r in stats}
    before = {r["bucket"]: (r["rows"], r["fingerprint"]) for r in index if r["bucket"] is not None}
    if anew or index[0]["buckets"] != buckets:
        return set(now) | set(before)
    return {b for b in set(now) | set(before) if now.get(b) != before.get(b)}
