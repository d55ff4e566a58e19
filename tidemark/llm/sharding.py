"""Sharding by best-fit-decreasing bin packing.

Groups that must stay together are sorted by size; each enters the bin that it fills most tightly, found in a
balanced tree of remaining capacities. A group larger than a small share of a bin is an item of its own. The
others are hashed into a fixed number of bundles, each an item of the sum of its sizes, so the packing on the
driver handles a number of items that depends on the number of bins alone, while all rows stay on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.work import text_of, written

#: A group above this share of a mean bin is an item of its own; so many bundles there are for each bin.
SHARE = 1 / 256
BUNDLES_PER_BIN = 256
#: Rows of a shard that are numbered together.
NUMBERED_ROWS = 50_000


class CapacityTree:
    """Bins by remaining capacity in a height-balanced search tree: insert, remove and best fit in log time."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root: list | None = None  # [key, left, right, height]

    @staticmethod
    def _height(node: list | None) -> int:
        return node[3] if node else 0

    def _fixed(self, node: list) -> list:
        height = self._height
        node[3] = 1 + max(height(node[1]), height(node[2]))
        lean = height(node[1]) - height(node[2])
        if abs(lean) < 2:
            return node
        heavy, light = (1, 2) if lean > 0 else (2, 1)
        child = node[heavy]
        if height(child[light]) > height(child[heavy]):
            node[heavy] = self._turned(child, light, heavy)
        return self._turned(node, heavy, light)

    def _turned(self, node: list, up: int, down: int) -> list:
        """The child on side ``up`` takes the node's place."""
        top = node[up]
        node[up], top[down] = top[down], node
        for x in (node, top):
            x[3] = 1 + max(self._height(x[1]), self._height(x[2]))
        return top

    def insert(self, key: tuple[int, int]) -> None:
        def put(node: list | None) -> list:
            if node is None:
                return [key, None, None, 1]
            side = 1 if key < node[0] else 2
            node[side] = put(node[side])
            return self._fixed(node)

        self.root = put(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def take(node: list | None, key: tuple[int, int]) -> list | None:
            if node is None:
                raise KeyError(key)
            if key != node[0]:
                side = 1 if key < node[0] else 2
                node[side] = take(node[side], key)
                return self._fixed(node)
            if node[1] is None or node[2] is None:
                return node[1] or node[2]
            least = node[2]
            while least[1] is not None:
                least = least[1]
            node[0] = least[0]
            node[2] = take(node[2], least[0])
            return self._fixed(node)

        self.root = take(self.root, key)

    def best_fit(self, size: int) -> tuple[int, int] | None:
        """The bin of least remaining capacity that still holds ``size``; of equal ones the lowest number."""
        node, found = self.root, None
        while node is not None:
            if node[0] >= (size, -1):
                found, node = node[0], node[1]
            else:
                node = node[2]
        return found

    def largest(self) -> tuple[int, int]:
        node = self.root
        while node[2] is not None:
            node = node[2]
        return node[0]


def best_fit_decreasing(sizes: Iterable[tuple[object, int]], capacity: int, bins: int | None = None) -> dict[object, int]:
    """The bin of each item of ``(key, size)``, by decreasing size and then key.

    Without ``bins``, a new bin is opened when an item fits in none; an item above ``capacity`` has one to itself.
    With ``bins``, such an item enters the bin with most room left.
    """
    tree, place, opened = CapacityTree(), {}, 0
    if bins is not None:
        for b in range(bins):
            tree.insert((capacity, b))
    for key, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        found = tree.best_fit(size)
        if found is None and bins is None:
            found = (capacity, opened)
            tree.insert(found)
            opened += 1
        elif found is None:
            found = tree.largest()
        tree.remove(found)
        place[key] = found[1]
        tree.insert((found[0] - size, found[1]))
    return place


def level_capacity(sizes: Iterable[int], bins: int) -> int:
    """The least capacity at which ``bins`` hold all, if items above it have a bin each: the level of the rest."""
    left, most = sum(sizes), sorted(sizes, reverse=True)
    for size in most:
        level = math.ceil(left / bins)
        if size <= level or bins == 1:
            return level
        left, bins = left - size, bins - 1
    return max(1, left)


def _items(rows: DataFrame, group: Column, size: Column, mean: int, bins: int) -> DataFrame:
    """Rows with ``_item``: the group's own name, or that of its bundle."""
    sums = rows.groupBy(group.alias("_group")).agg(F.sum(size).alias("_held"))
    own = F.col("_held") > F.lit(int(mean * SHARE))
    bundle = F.pmod(F.xxhash64("_group"), F.lit(bins * BUNDLES_PER_BIN))
    return sums.withColumn("_item", F.when(own, F.concat(F.lit("g"), F.col("_group"))).otherwise(F.concat(F.lit("b"), bundle.cast("string"))))


def pack_groups(rows: DataFrame, group: str, size: str, bins: int | None = None, capacity: int | None = None) -> DataFrame:
    """``rows`` with an int column ``shard``: rows of one ``group`` (a string) share a shard.

    Give ``bins`` for that many shards of near equal size, or ``capacity`` for as few shards of that capacity as
    best fit finds. The driver gets items only: by the choice of ``SHARE`` fewer than ``1 / SHARE +
    BUNDLES_PER_BIN`` for each bin. A null group is one group; sizes count as 0 where null or negative.
    """
    size_of = F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0))
    named = F.coalesce(F.col(group).cast("string"), F.lit("-"))
    total = rows.agg(F.sum(size_of)).first()[0] or 0
    many = bins or max(1, math.ceil(total / capacity))
    mean = capacity or max(1, math.ceil(total / many))
    groups = written(_items(rows, named, size_of, mean, many))
    items = [(r["_item"], r["n"]) for r in groups.groupBy("_item").agg(F.sum("_held").alias("n")).collect()]
    level = capacity or level_capacity([n for _, n in items], bins)
    place = best_fit_decreasing(items, level, bins)
    spark = rows.sparkSession
    shards = spark.createDataFrame(sorted(place.items()), "_item string, shard int") if place else None
    if shards is None:
        return rows.withColumn("shard", F.lit(None).cast("int"))
    placed = groups.join(F.broadcast(shards), "_item").select("_group", "shard")
    return rows.withColumn("_group", named).join(placed, "_group").drop("_group")


def numbered(rows: DataFrame, shard: str, order: list[str], slot: str = "slot", count: int | None = None) -> DataFrame:
    """``rows`` with a long ``slot``: gapless from 0 within each shard, by hash part of ``order`` and then ``order``.

    A shard is numbered in parts of about ``NUMBERED_ROWS`` rows, each moved by the rows of the parts before it.
    """
    total = count if count is not None else rows.count()
    parts = max(1, math.ceil(total / NUMBERED_ROWS))
    part = F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int")
    rows = rows.withColumn("_part", part)
    first = Window.partitionBy(shard, "_part").orderBy(*order)
    before = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(shard, "_part").agg(F.count("*").alias("_n"))
    starts = sizes.select(shard, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = rows.withColumn("_rank", F.row_number().over(first) - 1)
    return ranked.join(starts, [shard, "_part"]).withColumn(slot, (F.col("_start") + F.col("_rank")).cast("long")).drop("_part", "_start", "_rank")


def shard_documents(documents: DataFrame, shards: int = 40) -> DataFrame:
    """All documents in ``shards`` shards of near equal bytes; equal texts share a shard (law ``bytes``).

    Columns: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. A size is the UTF-8 bytes of the text and
    16; null counts as the empty text. ``grown_shard`` is null under this law. A group of copies above a mean shard
    fills one alone, and the others are levelled among themselves. Repeated rows get a slot each; an empty table
    gives an empty result; other columns are unread.
    """
    text = text_of()
    rows = written(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text).cast("long").alias("text_crc32"),
            F.md5(text).alias("_text"),
        )
    )
    placed = written(pack_groups(rows, "_text", "size", bins=shards).drop("_text"))
    slotted = numbered(placed, "shard", ["doc_id", "size", "text_crc32"])
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
