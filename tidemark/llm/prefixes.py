"""A prefix trie of conversations by count-min screening.

Every first ``d`` turns of a conversation are a node of the trie, named by a digest. A count-min sketch over all digests
never counts too few, so an estimate of one proves that a prefix stands in one conversation alone: such tails are put
out where they are. Only prefixes that may be shared are shuffled by digest and grouped exactly.

Conversations are never gathered: order, places and running digests come from sorted rows in parts, and digests add up
from hashes of a turn and its place, so the part of a long conversation that a task holds needs only the sum before it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.repair import stream_digests
from tidemark.llm.work import WORD, in_batches, written

#: Rows of the sketch, and the bounds of its columns as powers of two. At the upper one, the marks that are sent to tasks
#: take 8 MB; beyond it more prefixes are grouped exactly, with the same result.
SKETCH_ROWS = 4
SKETCH_BITS = (12, 24)
#: Cells of the sketch that are added up together.
CELLS = 1 << 16
#: Places of a conversation whose running sums are taken in one window.
PART = 4096

_KEY = ["depth", "p1", "p2"]
_PARENT = ["depth", "q1", "q2"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, _span, rank`` (from 0), ``turn_key``, ``words`` of each row, by ``turn`` (null first), role and text.

    Rows are sorted in ranges; a conversation that several ranges hold is ranked in each and moved by those before.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    number = lambda c: F.col(c).cast("long").alias(c)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    rows = conversations.select(number("conv_id"), number("turn"), text("role"), text("text"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(
        dealt.select(
            "conv_id",
            F.spark_partition_id().alias("_span"),
            F.monotonically_increasing_id().alias("_at"),
            F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("turn_key"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        )
    )


def _spans(turns: DataFrame) -> DataFrame:
    """For each conversation and range: where it begins there, and how many of its rows lie before."""
    spans = turns.groupBy("conv_id", "_span").agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")))


def rebuilt_turns(conversations: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """``conv_id, place, turn_key, words, last`` of conversations that begin as the first of their family does, and
    ``conv_id, length`` of all.

    Conversation ``c`` takes the first ``h = crc32(c) % heads`` turns of ``c - c % family``, then its own after its first ``h``.
    """
    turns = ordered_turns(conversations)
    spans = written(_spans(turns))
    sizes = spans.groupBy("conv_id").agg(F.sum("_n").alias("_own"))
    head = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % heads, F.lit(0)).cast("long")
    ids = sizes.select("conv_id", "_own", head.alias("_h"), (F.col("conv_id") - F.col("conv_id") % family).alias("_first"))
    firsts = sizes.select(F.col("conv_id").alias("_first"), F.col("_own").alias("_theirs"))
    taken = F.least("_h", F.coalesce("_theirs", F.lit(0).cast("long")))
    ids = ids.join(firsts, "_first", "left").withColumn("_taken", taken)
    ids = written(ids.withColumn("length", F.col("_taken") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0).cast("long"))))
    told = ids.select(F.col("conv_id").alias("_id"), "_h", "_taken", "length")
    spans = spans.join(told, F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id", "_n")
    spans = spans.withColumnsRenamed({"conv_id": "_id", "_span": "_of"})
    placed = turns.join(spans, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("_span") == F.col("_of")))
    placed = written(
        placed.select("conv_id", "turn_key", "words", (F.col("_at") - F.col("_start") + F.col("_before")).alias("rank"), "_h", "_taken", "length")
    )
    own = placed.where("rank >= _h").withColumn("place", F.col("rank") - F.col("_h") + F.col("_taken"))
    begin = placed.where((F.col("rank") < heads - 1) & (F.col("conv_id") % family == 0))
    begin = begin.select(F.col("conv_id").alias("_first"), "turn_key", "words", F.col("rank").alias("place"))
    begin = ids.where("_taken > 0").select("conv_id", "_first", "_taken", "length").join(begin, "_first").where("place < _taken")
    columns = ["conv_id", "place", "turn_key", "words", (F.col("place") + 1 == F.col("length")).alias("last")]
    return own.select(*columns).unionByName(begin.select(*columns)), ids.select("conv_id", "length")


def _summed(rows: DataFrame, group: str, place: str, values: list[str], down: bool = False) -> DataFrame:
    """``rows`` with running sums ``sum_<value>`` in a group by place, own value included; a long group in parts."""
    part = F.floor(F.col(place) / PART).alias("_part")
    rows = rows.withColumn("_part", part)
    order = (lambda c: F.desc(c)) if down else (lambda c: F.asc(c))
    near = Window.partitionBy(group, "_part").orderBy(order(place)).rowsBetween(Window.unboundedPreceding, 0)
    far = Window.partitionBy(group).orderBy(order("_part")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"sum_{v}": F.sum(v).over(near) for v in values})
    parts = rows.groupBy(group, "_part").agg(*[F.sum(v).alias(v) for v in values])
    moves = parts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), *[F.sum(v).over(far).alias(f"_{v}") for v in values])
    # only groups of more than one part are moved
    moves = moves.where(f"_{values[0]} is not null")
    joined = rows.join(moves, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")), "left")
    zero = F.lit(0).cast("long")
    return joined.withColumns({f"sum_{v}": F.col(f"sum_{v}") + F.coalesce(f"_{v}", zero) for v in values}).drop(
        "_g", "_p", "_part", *[f"_{v}" for v in values]
    )


def prefix_keys(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, p1, p2`` (the prefix of that many turns) ``, q1, q2`` (one turn fewer) ``, words, last``."""
    one, two = F.xxhash64("place", "turn_key"), F.xxhash64("turn_key", "place")
    low = 0xFFFFFFFF
    halves = {
        "a": one.bitwiseAND(F.lit(low)), "b": F.shiftrightunsigned(one, 32),
        "c": two.bitwiseAND(F.lit(low)), "d": F.shiftrightunsigned(two, 32),
    }
    rows = _summed(turns.withColumns(halves), "conv_id", "place", list(halves))

    def joined(high: Column, rest: Column) -> Column:
        return F.shiftleft(high.bitwiseAND(F.lit(low)), 32).bitwiseOR(rest.bitwiseAND(F.lit(low)))

    own = {v: F.col(f"sum_{v}") for v in halves}
    less = {v: F.col(f"sum_{v}") - F.col(v) for v in halves}
    return rows.select(
        "conv_id",
        (F.col("place") + 1).alias("depth"),
        *[joined(of[x], of[y]).alias(n) for of, k in ((own, "p"), (less, "q")) for x, y, n in (("a", "b", f"{k}1"), ("c", "d", f"{k}2"))],
        "words",
        "last",
    )


class CountMin:
    """A count-min sketch of prefixes whose counters stop at two: all that is asked is whether one is certain."""

    def __init__(self, bits: int, seed: int = 42):
        self.bits = bits
        self.mixers = np.random.default_rng(seed).integers(1, 2**63, (SKETCH_ROWS, 3), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def cells(self, depth: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """For each row of the sketch the cell of each prefix."""
        columns = [x.astype(np.int64).view(np.uint64) for x in (depth, one, two)]
        found = []
        for r, mixers in enumerate(self.mixers):
            mixed = sum(((c ^ (c >> np.uint64(31))) * m for c, m in zip(columns, mixers)), np.zeros(len(depth), np.uint64))
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            found.append((mixed >> np.uint64(64 - self.bits)).astype(np.int64) + (r << self.bits))
        return np.stack(found)

    def counted(self, keys: DataFrame) -> np.ndarray:
        """One bit for each cell: whether two or more prefixes fell into it. Tasks send the blocks that they touched."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(SKETCH_ROWS << self.bits, np.uint8)
            for batch in batches:
                cells, n = np.unique(self.cells(*(batch.column(c).to_numpy() for c in _KEY)), return_counts=True)
                held[cells] = np.minimum(held[cells] + np.minimum(n, 2), 2)
            width = min(CELLS, len(held))
            blocks = held.reshape(-1, width)
            touched = np.flatnonzero(blocks.any(1))
            for k in touched.tolist():
                packed = zlib.compress(blocks[k].tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([packed], pa.binary())], ["block", "cells"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, held = None, None
            for batch in batches:
                for k, packed in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist()):
                    own = np.frombuffer(zlib.decompress(packed), np.uint8)
                    if block is not None and k != block:
                        yield marks(block, held)
                        held = None
                    block, held = k, own if held is None else np.minimum(held + own, 2)
            if block is not None:
                yield marks(block, held)

        def marks(block: int, held: np.ndarray) -> pa.RecordBatch:
            packed = np.packbits(held > 1).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed], pa.binary())], ["block", "cells"])

        schema = "block int, cells binary"
        partial = in_batches(keys.select(*_KEY), count, schema).repartition("block").sortWithinPartitions("block")
        width = min(CELLS, SKETCH_ROWS << self.bits) // 8
        out = np.zeros((SKETCH_ROWS << self.bits) // 8, np.uint8)
        for r in in_batches(partial, add, schema).toLocalIterator():
            out[r["block"] * width : (r["block"] + 1) * width] = np.frombuffer(r["cells"], np.uint8)
        return out

    def single(self, marks: np.ndarray, *key: np.ndarray) -> np.ndarray:
        """Whether the estimate is one: any row of the sketch has the prefix alone in its cell."""
        cells = self.cells(*key)
        return ~((marks[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1).astype(bool).all(0)


def _screened(keys: DataFrame, bits: int) -> DataFrame:
    """``keys`` with ``single`` and ``above_single``: whether estimates prove the prefix, and the one above it, unshared."""
    sketch = CountMin(bits)
    marks = keys.sparkSession.sparkContext.broadcast(sketch.counted(keys))

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = {c: batch.column(c).to_numpy() for c in ("depth", "p1", "p2", "q1", "q2")}
            own = sketch.single(marks.value, of["depth"], of["p1"], of["p2"])
            above = sketch.single(marks.value, of["depth"] - 1, of["q1"], of["q2"]) & (of["depth"] > 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(above)], [*batch.schema.names, "single", "above_single"])

    return in_batches(keys, screen, "conv_id long, depth long, p1 long, p2 long, q1 long, q2 long, words long, last boolean, single boolean, above_single boolean")


def _ends(rows: DataFrame) -> DataFrame:
    """``depth, p1, p2, ends_sha256`` of the ids of conversations that end at a node, ascending and comma-joined.

    Ids are joined in ranges first, so a node with many copies of a conversation is put together from few long pieces.
    """
    rows = rows.repartitionByRange(*_KEY, "conv_id").select(*_KEY, "conv_id", F.spark_partition_id().alias("_range"))
    pieces = rows.groupBy(*_KEY, "_range").agg(F.sort_array(F.collect_list("conv_id")).alias("_ids"))
    pieces = pieces.select(F.concat_ws(":", *_KEY).alias("_node"), "_range", F.array_join(F.col("_ids").cast("array<string>"), ",").alias("_told"))
    told = stream_digests(pieces, "_node", ["_range"], "_told", ",")
    parts = F.split("_node", ":")
    return told.select(*[parts[k].cast("long").alias(c) for k, c in enumerate(_KEY)], F.col("sha256").alias("ends_sha256"))


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(x) == F.col(y) for x, y in zip(left, right)))


def prefix_trie(turns: DataFrame, lengths: DataFrame, most_bits: int = SKETCH_BITS[1]) -> DataFrame:
    """Nodes of the trie of ``turns`` (``conv_id, place, turn_key, words, last``) and the root.

    Columns ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``. ``lengths`` names all conversations (``conv_id, length``); those of no turns end at the root. A null
    ``conv_id`` is one conversation, named only where it is alone and left out of digests. No conversations: no rows.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    lengths = written(lengths)
    keys = written(prefix_keys(turns))
    many = keys.count()
    bits = min(max((4 * many).bit_length(), SKETCH_BITS[0]), most_bits)
    rows = written(_screened(keys, bits))
    maybe = rows.where("not single")
    groups = maybe.groupBy(*_KEY).agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min("words").alias("words"),
        F.min("q1").alias("q1"),
        F.min("q2").alias("q2"),
        F.max("last").alias("last"),
        F.max("above_single").alias("above_single"),
    )
    groups = written(groups)
    shared = groups.where("n_convs > 1")
    alone = ["conv_id", *_KEY, "q1", "q2", "last", "above_single"]
    tails = rows.where("single").select(*alone).unionByName(groups.where("n_convs = 1").select(*alone))

    # children of shared nodes; a tail that hangs on one ends in one leaf
    up = lambda df, leaf: df.select((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"), leaf.alias("leaf"))
    below = written(
        up(tails.where("not above_single"), one)
        .unionByName(up(shared, zero))
        .groupBy(*_KEY)
        .agg(F.count("*").alias("n_children"), F.sum("leaf").alias("leaves"))
    )
    nodes = shared.join(below, _KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = written(
        nodes.withColumns(
            {
                "own_leaves": F.coalesce("leaves", zero) + F.when(F.col("n_children") == 0, one).otherwise(zero),
                "own_saved": (F.col("n_convs") - 1) * F.col("words"),
            }
        ).drop("leaves")
    )

    # a node's figures are told by its smallest member, to all prefixes of that conversation
    tellers = nodes.select(*[F.col(c).alias(f"_{c}") for c in (*_KEY, "conv_id")], "own_leaves", "own_saved")
    mine = _same(_KEY, [f"_{c}" for c in _KEY]) & F.col("conv_id").eqNullSafe(F.col("_conv_id"))
    told = maybe.select("conv_id", *_KEY).join(tellers, mine, "left")
    told = told.select("conv_id", *_KEY, *[F.coalesce(c, zero).alias(c) for c in ("own_leaves", "own_saved")])
    passed = _summed(told, "conv_id", "depth", ["own_leaves", "own_saved"], down=True).where("sum_own_leaves > 0 or sum_own_saved > 0")
    sums = passed.groupBy(*_KEY).agg(F.sum("sum_own_leaves").alias("n_leaves"), F.sum("sum_own_saved").alias("saved_tokens"))

    # the root, in figures of one row
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    top = below.where("depth = 0").agg(F.sum("n_children").alias("n_children"), F.sum("leaves").alias("leaves"))
    totals = nodes.agg(F.sum("own_leaves").alias("own_leaves"), F.sum("own_saved").alias("own_saved"))
    least, n, children, leaves, inner, saved = (*root.first(), *top.first(), *totals.first())
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    schema = ", ".join(f"{c} long" for c in names)
    leaves = (leaves or 0) + (inner or 0) + (not children)
    roots = [(least, 0, None, n, children or 0, leaves, saved or 0)] if n else []
    spark = turns.sparkSession
    key = lambda df: df.withColumns({"p1": zero, "p2": zero})
    rooted = key(spark.createDataFrame(roots, schema))

    # names of nodes above: the root's is known, a tail's own conversation names what is in the tail
    above = groups.select(*[F.col(c).alias(f"_{c}") for c in _KEY], F.col("conv_id").alias("parent_conv_id"))
    inner_nodes = nodes.join(sums, _KEY).withColumn("_end", F.lit(True))
    figures = {"n_convs": one, "n_children": F.when(F.col("last"), zero).otherwise(one), "n_leaves": one, "saved_tokens": zero}
    tail_nodes = tails.withColumns(figures)
    columns = [*_KEY, "q1", "q2", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    own_end = F.when(F.col("last"), F.sha2(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), 256)).otherwise(F.lit(_EMPTY))
    local = tail_nodes.where("above_single").select(*columns, F.col("conv_id").alias("parent_conv_id"), own_end.alias("_tail_end"))
    asking = inner_nodes.select(*columns, F.lit(None).cast("string").alias("_tail_end")).unionByName(
        tail_nodes.where("not above_single").select(*columns, own_end.alias("_tail_end"))
    )
    first = asking.where("depth = 1").withColumn("parent_conv_id", F.lit(least).cast("long"))
    deeper = asking.where("depth > 1").join(above, _same(["q1", "q2"], ["_p1", "_p2"]) & (F.col("depth") - 1 == F.col("_depth")))
    deeper = deeper.select(*columns, "_tail_end", "parent_conv_id")
    turnless = key(lengths.where("length = 0").withColumn("depth", zero)).select(*_KEY, "conv_id")
    ends = _ends(maybe.where("last").select(*_KEY, "conv_id").unionByName(turnless))
    found = first.unionByName(deeper).unionByName(local)
    tail_rows = found.where("_tail_end is not null").select(*names, F.col("_tail_end").alias("ends_sha256"))
    node_rows = found.where("_tail_end is null").select(*names, "p1", "p2").unionByName(rooted).join(ends, _KEY, "left")
    return tail_rows.unionByName(node_rows.select(*names, F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """The trie of rebuilt conversations, see ``rebuilt_turns`` and ``prefix_trie``.

    Rows are ordered by turn (null first), then role and text; null roles and texts count as empty; repeated rows are
    turns of their own. An empty table gives an empty result; other columns are unread.
    """
    return prefix_trie(*rebuilt_turns(conversations, family, heads))
