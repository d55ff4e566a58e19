"""Registration of queries, and table states written once for both engines."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if given, the SQL text with the same result."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def state(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A table state as a DataFrame; ``{name}`` stands for a test table, ``#ts`` for the timestamp type."""
    names = set(re.findall(r"\{(\w+)\}", text))
    tables = {n: table(spark, sf_dir, n) for n in names}
    return spark.sql(text.replace("#ts", "timestamp_ntz"), **tables)


def oracle(text: str) -> str:
    """The same text for the other engine."""
    return re.sub(r"\{(\w+)\}", r"\1", text).replace("#ts", "timestamp")


def scratch(spark: SparkSession) -> str:
    """A new directory in the shared folder of the cluster; a local one only where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return f"{base or tempfile.mkdtemp(prefix='tidemark-')}/{uuid4().hex}"


# -- SQL fragments of the other engine -----------------------------------


def encoded_sql(*columns: str) -> str:
    """Unambiguous text of several columns, as the row hash uses it."""
    return " || ".join(
        f"coalesce('{len(c)}:{c.lower()}=' || cast(strlen(cast({c} as string)) as string) || ':' || cast({c} as string), '')"
        for c in columns
    )


def row_hash_sql(*columns: str) -> str:
    return f"md5({encoded_sql(*sorted(columns, key=str.lower))})"


def hex_number_sql(text: str, digits: int) -> str:
    return f"cast('0x' || substr({text}, 1, {digits}) as bigint)"


def bucket_sql(buckets: int, *keys: str) -> str:
    return f"cast({hex_number_sql(f'md5({encoded_sql(*keys)})', 8)} % {buckets} as int)"
