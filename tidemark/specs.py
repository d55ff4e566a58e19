"""Which tables to keep in step, and how."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import POLICIES, MergePolicy
from tidemark.functions.columns import require_columns
from tidemark.functions.scalars import EMPTY_WORDS, none_if_empty, parse_list

# Columns of the table list, those that must be present, and
# the two ways of finding changes.
SPEC_COLUMNS = (
    "ID",
    "SRC_DB_TYPE",
    "DATABASE_NAME",
    "SCHEMA_NAME",
    "OBJ_TYPE",
    "SRC_TBL_NAME",
    "PRIMARY_KEY_COL",
    "COL_NAMES",
    "TRG_TBL_NAME",
    "INCR_LOGIC_COL_NAME",
)
REQUIRED_SPEC_COLUMNS = (
    "SRC_TBL_NAME",
    "DATABASE_NAME",
    "SCHEMA_NAME",
    "PRIMARY_KEY_COL",
    "INCR_LOGIC_COL_NAME",
)
#: Columns of options that the list may have besides, each empty where the whole list's option holds.
OPTION_COLUMNS = ("TRUST_TIMESTAMPS", "NULL_TIMESTAMPS", "STABLE_SOURCE", "CHECK_KEYS", "BUCKETS", "MERGE_POLICY")
_YES, _NO = frozenset({"y", "yes", "true", "1"}), frozenset({"n", "no", "false", "0"})
SNAPSHOT = "SNAPSHOT"
TIMESTAMP = "TIMESTAMP"


@dataclass(frozen=True)
class TableSpec:
    """One table of the list, with the options of its runs; None leaves an option to the whole list's."""

    database: str
    schema: str
    table: str
    keys: tuple[str, ...]
    ts_cols: tuple[str, ...] = ()
    source_type: str = "sqlserver"
    columns: str = "*"
    target: str | None = None
    trust_timestamps: bool = False
    nulls: str = "exclude"
    stable_source: bool = False
    check_keys: bool = True
    buckets: int | None = None
    policy: MergePolicy | None = None

    @property
    def name(self) -> str:
        return f"{self.database}.{self.schema}.{self.table}"


def split_names(text: str | None) -> tuple[str, ...]:
    """Python counterpart of ``parse_list`` for single values; empty markers give no names."""
    if text is None or text.strip().lower() in EMPTY_WORDS:
        return ()
    return tuple(n for n in (p.strip() for p in text.replace('"', "").split(",")) if n)


def read_spec_table(spark: SparkSession, path: str) -> DataFrame:
    """The table list as a DataFrame of text columns.

    Fields beyond the header are dropped; required columns are checked.
    """
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    return require_columns(df, REQUIRED_SPEC_COLUMNS)


def parsed_specs(specs: DataFrame) -> DataFrame:
    """Key and increment column lists split into arrays (NULL where nothing is given)."""
    return specs.withColumns(
        {
            "keys": parse_list(none_if_empty(F.col("PRIMARY_KEY_COL"))),
            "ts_cols": parse_list(none_if_empty(F.col("INCR_LOGIC_COL_NAME"))),
        }
    )


def read_specs(spark: SparkSession, path: str) -> list[TableSpec]:
    """Table list as specs; a table without keys gets an empty key tuple.

    Options come from the columns of ``OPTION_COLUMNS`` that the list has; one that cannot be read is an error that
    names its table, before any table is touched.
    """
    rows = parsed_specs(read_spec_table(spark, path)).collect()
    return [
        TableSpec(
            database=r["DATABASE_NAME"],
            schema=r["SCHEMA_NAME"],
            table=r["SRC_TBL_NAME"],
            keys=tuple(r["keys"] or ()),
            ts_cols=tuple(r["ts_cols"] or ()),
            source_type=_field(r, "SRC_DB_TYPE") or "sqlserver",
            columns=_field(r, "COL_NAMES") or "*",
            target=_field(r, "TRG_TBL_NAME"),
            **_options(r),
        )
        for r in rows
    ]


class SpecError(ValueError):
    """An entry of the table list has an option that cannot be read."""


def _options(row) -> dict[str, object]:
    """Options of one entry by field of ``TableSpec``; those left empty are not in it."""
    given = {c: v.strip() for c in OPTION_COLUMNS if (v := _field(row, c)) is not None and v.strip().lower() not in EMPTY_WORDS}
    found: dict[str, object] = {}
    for column, value in given.items():
        word = value.lower()
        if column == "BUCKETS" and word.isdecimal() and int(word) > 0:
            found["buckets"] = int(word)
        elif column == "NULL_TIMESTAMPS" and word in ("exclude", "include"):
            found["nulls"] = word
        elif column == "MERGE_POLICY" and word in POLICIES:
            found["policy"] = POLICIES[word]
        elif column in ("TRUST_TIMESTAMPS", "STABLE_SOURCE", "CHECK_KEYS") and word in _YES | _NO:
            found[column.lower()] = word in _YES
        else:
            raise SpecError(f"{row['SRC_TBL_NAME']}: {column} cannot be {value!r}")
    return found


def _field(row, name: str) -> str | None:
    return row[name] if name in row else None


def choose_load_type(ts_cols: Sequence[str], columns: Sequence[str] | None) -> str:
    """TIMESTAMP if increment columns are given and all exist (exact names), else SNAPSHOT.

    ``columns`` None means that the source could not be probed.
    """
    if not ts_cols or columns is None:
        return SNAPSHOT
    return TIMESTAMP if set(ts_cols) <= set(columns) else SNAPSHOT
