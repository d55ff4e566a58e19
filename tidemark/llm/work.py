"""What the operators share: written intermediate tables and batches of texts."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The bytes that separate words: space and the controls from tab to carriage return.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"


@functools.lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="corpus-")


def shared_folder(spark: SparkSession) -> str:
    """A new path under ``spark.checkpoint.dir``; a local folder only on a local master that sets none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/corpus-{uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows, from a table written to the shared folder: computed once, and safe from lost executors.

    What was shuffled on the way is not needed any more. Spark removes such files when the driver collects its
    garbage, which it is told to do here, since on large inputs they would pile up on the executors' disks.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table of ``written`` that is not read any more."""
    for path in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        place = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def text_of(column: str = "text") -> Column:
    """A text as string, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def columns_of(df: DataFrame) -> list[Column]:
    """Its columns, whatever characters their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def texts_by_id(documents: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` and ``text`` alone (with what else is asked for), whatever other columns there are."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *more)


@functools.lru_cache(maxsize=1)
def _package() -> str:
    """This package as an archive, for workers that do not have it installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="corpus-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path


def in_batches(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    context = df.sparkSession.sparkContext
    if getattr(context, "_corpus_package", None) is None:
        context.addPyFile(_package())
        context._corpus_package = True
    return df.mapInArrow(function, schema)


def filtered(df: DataFrame, seen: dict[str, Column], keep: Callable[[pa.RecordBatch], list[bool]], most: int = 1 << 24) -> DataFrame:
    """The rows of ``df`` for which ``keep`` is true, each judged for itself, with all columns as they are.

    ``keep`` gets batches of the columns ``seen``, of which one is called ``text``, with about ``most`` bytes of text each.
    """
    # by numbers, since Spark's batches do not take every name
    own, shown = [f"c{k}" for k in range(len(df.columns))], [f"s{k}" for k in range(len(seen))]
    numbered = df.select(*[c.alias(n) for c, n in zip(columns_of(df), own)], *[c.alias(n) for c, n in zip(seen.values(), shown)])
    names = list(seen)
    text = shown[names.index("text")]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text, most):
                view = pa.RecordBatch.from_arrays([part.column(n) for n in shown], names)
                yield part.filter(pa.array(keep(view), pa.bool_())).select(own)

    return in_batches(numbered, pick, numbered.select(*own).schema).toDF(*df.columns)


def text_slices(batch: pa.RecordBatch, name: str = "text", most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``most`` bytes of text each, or a single row."""
    sizes = pa.compute.binary_length(batch.column(name)).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + (n or 0) > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < len(sizes):
        yield batch.slice(start)
