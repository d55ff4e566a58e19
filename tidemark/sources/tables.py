"""Table scans: JDBC queries and tables, and Parquet datasets that may not exist yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def query_options(options: Mapping[str, str], query: str) -> dict[str, str]:
    """Reader options for a SQL text run at the database.

    The caller's options carry URL, driver and credentials; none are stored or logged.
    """
    if "dbtable" in {k.lower() for k in options}:
        raise ValueError("give either a query or dbtable, not both")
    return {**options, "query": query}


def read_query(spark: SparkSession, options: Mapping[str, str], query: str) -> DataFrame:
    """The result of a SQL text at a JDBC source."""
    return spark.read.format("jdbc").options(**query_options(options, query)).load()


def partition_options(column: str, lower: object, upper: object, partitions: int) -> dict[str, str]:
    """Options that split a table scan into ``partitions`` parallel range reads."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """SQL predicates, one per parallel read, that together select every row once.

    ``bounds`` are ascending split points; NULLs belong to the first predicate.
    """
    values = [_sql_literal(b) for b in bounds]
    if not values:
        return ["1 = 1"]
    first = f"{column} < {values[0]} OR {column} IS NULL"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(values, values[1:])]
    return [first, *middle, f"{column} >= {values[-1]}"]


def bucket_predicates(expression: str, buckets: int) -> list[str]:
    """Predicates for one parallel read per hash bucket, hashed by the database.

    ``expression`` is a non-negative integer there, e.g. ``ABS(CHECKSUM(order_id))``.
    """
    return [f"{expression} % {buckets} = {b}" for b in range(buckets)]


def _sql_literal(value: object) -> str:
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def read_table(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A whole JDBC table, read in parallel by ``predicates`` or by partition options.

    Filters, column lists and global aggregates are pushed to the database by Spark.
    """
    rest = dict(options)
    url = rest.pop("url")
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=rest)
    options = {"pushDownAggregate": "true", **rest, "url": url, "dbtable": table}
    return spark.read.format("jdbc").options(**options).load()


def read_if_exists(spark: SparkSession, *paths: str, **options: object) -> DataFrame | None:
    """A Parquet dataset, or None if its path does not exist; other errors are raised."""
    try:
        return spark.read.options(**options).parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The previous snapshot at ``path``; None on a first run."""
    return read_if_exists(spark, path)
