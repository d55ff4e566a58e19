"""A table kept as numbered generations of Parquet, replaced bucket by bucket.

Layout under the base path::

    live/generation=N/bucket=B/*.parquet     rows of bucket B as of generation N
    history/generation=N/*.parquet           rows replaced or deleted in N
    index/generation=N/*.parquet             which live directories make up N
    work/generation=N/...                    intermediate tables until N is committed
    claims/generation=N                      the number N is taken by a writer
    commits/after=P                          names the one generation that follows P
    commits/generation=N                     N has been committed; holds the schema of its history

A generation is committed once its marker in ``commits`` is there; it is the
last thing written, after the index, and stays when the generation expires.
Readers of an older generation are never disturbed, nothing is
overwritten in place, and a run that fails midway leaves no trace in what is
read. A bucket left alone by a run costs nothing: the new index points at the
old directory, and tells the types its files were written with, so that they are
read as such and widened to those of the generation.

Writers may meet: each takes a number of its own, and of two that began from the
same generation the first to name its successor wins, while the other gets a
:class:`CommitConflict` and can begin again. This is as safe as the file
system's refusal to create a file twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import BUCKET, HASH, SOFT_DELETE
from tidemark.functions.hashing import hash_bucket
from tidemark.operators.drift import conform, union_drift, wider_type
from tidemark.sinks.datasets import stored_bytes, write_partitioned
from tidemark.sources.storage import children, create_new, delete

GENERATION = "generation"
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("data_generation", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("fingerprint", T.DecimalType(38, 0)),
        T.StructField("batches", T.StringType()),
        T.StructField("live_schema", T.StringType()),
        T.StructField("file_schema", T.StringType()),
    ]
)


class CommitConflict(RuntimeError):
    """Another writer has committed a generation since this one began."""


class GenerationStore:
    """Reads and writes the generations of one table."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self._parents: dict[int, int] = {}
        self._histories: dict[int, str] = {}

    # -- generations -----------------------------------------------------

    def generations(self) -> list[int]:
        """Numbers of all committed generations that have not expired, ascending. Two directory listings."""
        return sorted(set(self._numbers("commits")) & set(self._numbers("index")))

    def current(self) -> int | None:
        committed = self.generations()
        return committed[-1] if committed else None

    def next_generation(self, parent: int | None = None) -> int:
        """A number that no other attempt has, for a generation that follows ``parent`` (0: none; default: the current one)."""
        used = [n for kind in ("live", "history", "index", "work", "commits", "claims") for n in self._numbers(kind)]
        number = max(used, default=0) + 1
        while not self._create(self._dir("claims", number)):
            number += 1
        self._parents[number] = (self.current() or 0) if parent is None else parent
        return number

    def index(self, generation: int | None = None) -> list[Row]:
        """Index rows, one per non-empty bucket; a single row with bucket NULL if the table is empty."""
        generation = self.current() if generation is None else generation
        if generation is None:
            return []
        return self.spark.read.schema(INDEX_SCHEMA).parquet(self._dir("index", generation)).collect()

    # -- reading ---------------------------------------------------------

    def read(
        self,
        generation: int | None = None,
        buckets: Iterable[int] | None = None,
        keep_bucket: bool = False,
    ) -> DataFrame | None:
        """Live rows of a committed generation (default: the current one), or None if there is none.

        ``buckets`` restricts the read to their directories. Buckets written with other types than the generation's
        are read by their own and widened.
        """
        index = self.index(generation)
        if not index:
            return None
        wanted = None if buckets is None else set(buckets)
        live = index[0].live_schema
        paths: dict[str, list[str]] = {}
        for r in index:
            if r.bucket is not None and (wanted is None or r.bucket in wanted):
                place = f"{self._dir('live', r.data_generation)}/{BUCKET}={r.bucket}"
                paths.setdefault(r.file_schema or live, []).append(place)
        schema = _schema(live)
        rows = self._read_live(paths.pop(live, []), schema, keep_bucket) if live in paths or not paths else None
        shape = _with_bucket(schema) if keep_bucket else schema
        for told, own in paths.items():
            part = conform(self._read_live(own, _schema(told), keep_bucket), shape)
            rows = part if rows is None else rows.unionByName(part)
        return rows

    def schema(self, generation: int | None = None) -> T.StructType | None:
        """Columns and types of a committed generation, or None if there is none."""
        index = self.index(generation)
        return _schema(index[0].live_schema) if index else None

    def read_staged(self, generation: int, schema: T.StructType, buckets: Iterable[int] | None = None) -> DataFrame:
        """Live rows written for ``generation``, committed or not, with their ``bucket``."""
        if buckets is None:
            df = self.spark.read.schema(_with_bucket(schema)).parquet(self._dir("live", generation))
            return df
        paths = [f"{self._dir('live', generation)}/{BUCKET}={b}" for b in buckets]
        return self._read_live(paths, schema, keep_bucket=True)

    def read_history(self, generation: int | None = None, only: bool = False) -> DataFrame | None:
        """Rows replaced or deleted up to ``generation`` (``only``: in that one)."""
        generation = self.current() if generation is None else generation
        if generation is None:
            return None
        committed = set(self._numbers("commits"))  # history outlives the generation that wrote it
        numbers = [
            n
            for n in self._numbers("history")
            if n in committed and (n == generation if only else n <= generation)
        ]
        if not numbers:
            return None
        told = self._history_schemas(numbers)
        by_schema: dict[str | None, list[str]] = {}
        for n in numbers:
            by_schema.setdefault(told.get(n), []).append(self._dir("history", n))
        found: DataFrame | None = None
        for text, paths in sorted(by_schema.items(), key=lambda x: max(x[1])):
            reader = self.spark.read.option("basePath", f"{self.base}/history")
            reader = reader.option("mergeSchema", True) if text is None else reader.schema(_with_generation(_schema(text)))
            part = reader.parquet(*paths)
            found = part if found is None else union_drift(found, part)
        return found

    def _history_schemas(self, numbers: Sequence[int]) -> dict[int, str]:
        """What the commit markers tell of their history, read by one job; older markers are empty."""
        paths = [self._dir("commits", n) for n in numbers]
        rows = self.spark.read.option("wholetext", True).text(paths).select(F.col("_metadata.file_path").alias("file"), "value")
        return {int(r["file"].rsplit("=", 1)[1]): r["value"] for r in rows.collect() if r["value"]}

    def read_snapshot(self, generation: int | None = None, only_last_deletes: bool = False) -> DataFrame | None:
        """Live rows with ``soft_delete`` 0 and history rows with 1.

        ``only_last_deletes`` takes the rows deleted by that generation alone.
        """
        rows = self.read(generation)
        if rows is None:
            return None
        rows = rows.withColumn(SOFT_DELETE, F.lit(0))
        old = self.read_history(generation, only=only_last_deletes)
        if old is None:
            return rows
        old = old.drop(GENERATION, "change_kind").withColumn(SOFT_DELETE, F.lit(1))
        return union_drift(rows, old)

    # -- writing ---------------------------------------------------------

    def write_live(
        self, df: DataFrame, generation: int, keys: Sequence[str], buckets: int, gather: bool = False, scattered: bool = False
    ) -> None:
        """Write live rows by hash bucket of the key; invisible until committed.

        A table of one bucket is written as it comes, without a shuffle,
        unless its rows are to be gathered into files of even size. So is a
        ``scattered`` one (see ``scatters``), a file for each task and bucket.
        """
        if BUCKET not in df.columns:
            df = hash_bucket(df, keys, buckets)
        path = self._dir("live", generation)
        if scattered or buckets == 1 and not gather:
            df.write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        else:
            write_partitioned(df, path, BUCKET)

    def write_in_place(
        self, kept: DataFrame, added: DataFrame, generation: int, keys: Sequence[str], buckets: int
    ) -> None:
        """Write rows read from this store by bucket, and new rows beside them.

        ``kept`` must come from ``read(keep_bucket=True)`` without a shuffle
        in between: every task then holds rows of the few buckets whose files
        it has scanned, and can write them where it is. Only ``added`` moves.
        """
        path = self._dir("live", generation)
        kept.write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        write_partitioned(hash_bucket(added.drop(BUCKET), keys, buckets), path, BUCKET, mode="append")

    def is_fragmented(self, df: DataFrame, bytes_per_file: int = 128 * 1024 * 1024) -> bool:
        """Whether rows of this store lie in many more files than their size asks for."""
        files = df.inputFiles()
        folders = {f.rsplit("/", 1)[0] for f in files}
        size = sum(stored_bytes(self.spark, f) for f in folders)
        return len(files) > 4 * (len(folders) + size // bytes_per_file)

    def write_history(self, df: DataFrame, generation: int) -> DataFrame:
        """Write replaced rows and return them as written."""
        path = self._dir("history", generation)
        df.write.mode("overwrite").parquet(path)
        self._histories[generation] = T.StructType([f for f in df.schema.fields if f.name != GENERATION]).json()
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(
        self,
        generation: int,
        schema: T.StructType,
        buckets: int,
        written: Iterable[Row],
        kept: Iterable[Row] = (),
        batches: dict[str, int] | None = None,
    ) -> None:
        """Make ``generation`` current.

        ``written`` are its own buckets (``bucket, rows, fingerprint``),
        ``kept`` index rows of the previous generation to carry over,
        ``batches`` the last merged batch per stream (see ``last_batches``).
        """
        if generation in self.generations():
            raise ValueError(f"generation {generation} is already committed")
        parent = self._parents.get(generation, self.current() or 0)
        live = _schema_json(schema)
        entries = [(r["bucket"], generation, r["rows"], r["fingerprint"], live) for r in written]
        entries += [
            (r.bucket, r.data_generation, r["rows"], r.fingerprint, r.file_schema or r.live_schema)
            for r in kept
            if r.bucket is not None
        ]
        for text in {e[-1] for e in entries} - {live}:
            _assert_holds(schema, _schema(text))
        index = self.spark.createDataFrame(_index_table(entries or [(None, generation, 0, None, live)]))
        index = index.withColumns(
            {
                "buckets": F.lit(buckets),
                "batches": F.lit(json.dumps(batches or {})),
                "live_schema": F.lit(live),
            }
        )
        index.select(*INDEX_SCHEMA.fieldNames()).coalesce(1).write.mode("overwrite").parquet(self._dir("index", generation))
        self._succeed(parent, generation)
        if generation not in self.generations():
            raise OSError(f"generation {generation} of {self.base} was written but not committed")
        self._delete(self._dir("work", generation))

    def _succeed(self, parent: int, generation: int) -> None:
        """Commit ``generation`` as the one that follows ``parent``, or raise if there is another.

        The successor's name is written first and settles the matter; its history schema goes with it, so that a
        writer that finds a successor without a marker (its writer died in between) completes it.
        """
        link = f"{self.base}/commits/after={parent}"
        content = json.dumps({"generation": generation, "history": self._histories.get(generation, "")})
        if not self._create(link, content):
            told = json.loads(self._content(link))
            if told["generation"] != generation:
                self._create(self._dir("commits", told["generation"]), told["history"])
                raise CommitConflict(f"generation {told['generation']} of {self.base} was committed after {parent}")
        self._create(self._dir("commits", generation), self._histories.get(generation, ""))

    def drop_staged(self, generation: int, buckets: Iterable[int]) -> None:
        """Remove buckets written for a generation that is going to refer to older ones instead."""
        if generation in self.generations():
            raise ValueError(f"generation {generation} is committed")
        for b in buckets:
            self._delete(f"{self._dir('live', generation)}/{BUCKET}={b}")

    def discard(self, generation: int) -> None:
        """Remove what was written for a generation that will not be committed."""
        if generation in self.generations():
            raise ValueError(f"generation {generation} is committed")
        for kind in ("live", "history", "work", "index"):
            self._delete(self._dir(kind, generation))

    def work(self, generation: int, name: str) -> str:
        """Path of an intermediate table of a generation in the making."""
        return f"{self._dir('work', generation)}/{name}"

    def expire(self, keep: int) -> list[int]:
        """Drop all but the newest ``keep`` generations, the directories only they
        used, and the leftovers of runs that failed before.

        History rows of committed generations are kept; they belong to every later snapshot.
        """
        if keep < 1:
            raise ValueError("keep at least one generation")
        committed = self.generations()
        dropped, kept = committed[:-keep], committed[-keep:]
        if not kept:
            return []
        used = {(r.data_generation, r.bucket) for g in kept for r in self.index(g)}
        for generation in dropped:
            self._delete(self._dir("index", generation))
        ever = set(self._numbers("commits"))
        for kind in ("history", "work"):
            for generation in self._numbers(kind):
                if generation < kept[-1] and generation not in ever:
                    self._delete(self._dir(kind, generation))
        for generation in self._numbers("live"):
            if generation > kept[-1]:
                continue
            for name in self._children(self._dir("live", generation)):
                if name.startswith(f"{BUCKET}=") and (generation, int(name.split("=", 1)[1])) not in used:
                    self._delete(f"{self._dir('live', generation)}/{name}")
            if not any(g == generation for g, _ in used):
                self._delete(self._dir("live", generation))
        return dropped

    # -- file system -----------------------------------------------------

    def _dir(self, kind: str, generation: int) -> str:
        return f"{self.base}/{kind}/{GENERATION}={generation}"

    def _read_live(self, paths: list[str], schema: T.StructType, keep_bucket: bool) -> DataFrame:
        if not paths:
            df = self.spark.createDataFrame([], _with_bucket(schema))
        else:
            df = (
                self.spark.read.option("basePath", f"{self.base}/live")
                .schema(_with_bucket(schema))
                .parquet(*paths)
                .drop(GENERATION)
            )
        return df if keep_bucket else df.drop(BUCKET)

    def _create(self, path: str, content: str = "") -> bool:
        return create_new(self.spark, path, content)

    def _content(self, path: str) -> str:
        return "".join(r[0] for r in self.spark.read.option("wholetext", True).text(path).collect())

    def _children(self, path: str) -> list[str]:
        return children(self.spark, path)

    def _numbers(self, kind: str) -> list[int]:
        prefix = f"{GENERATION}="
        return sorted(
            int(n[len(prefix):]) for n in self._children(f"{self.base}/{kind}") if n.startswith(prefix)
        )

    def _delete(self, path: str) -> None:
        delete(self.spark, path)


def _index_table(entries: Sequence[tuple]) -> pa.Table:
    """Index entries as an Arrow table, one row per bucket, which Spark takes without Python workers."""
    types = (pa.int32(), pa.int64(), pa.int64(), pa.decimal128(38, 0), pa.string())
    names = ("bucket", "data_generation", "rows", "fingerprint", "file_schema")
    return pa.table({n: pa.array(v, t) for n, t, v in zip(names, types, zip(*entries))})


def without_hash(schema: T.StructType) -> T.StructType:
    """A snapshot's schema without the row hash that runs add."""
    return T.StructType([f for f in schema.fields if f.name != HASH])


def last_batches(index: Sequence[Row]) -> dict[str, int]:
    """The last batch merged from each stream, as recorded with a generation."""
    return json.loads(index[0].batches or "{}") if index else {}


def _assert_holds(schema: T.StructType, files: T.StructType) -> None:
    """Every column of the files that ``schema`` has can be read in its type there."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    for f in files.fields:
        live = types.get(f.name.lower(), f.dataType)
        if wider_type(f.dataType, live) is None or wider_type(f.dataType, live).simpleString() != live.simpleString():
            raise ValueError(f"files hold {f.name} as {f.dataType.simpleString()}, which {live.simpleString()} cannot take without loss")


def _schema_json(schema: T.StructType) -> str:
    return T.StructType([f for f in schema.fields if f.name not in (BUCKET, GENERATION)]).json()


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _with_generation(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(GENERATION, T.IntegerType())])


def _with_bucket(schema: T.StructType) -> T.StructType:
    fields = [f for f in schema.fields if f.name not in (BUCKET, GENERATION)]
    return T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())])
