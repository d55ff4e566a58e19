"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints that differ in at most ``distance`` bits agree on two of ``distance + 2`` blocks of bits, whichever they
are. So the upper nodes of the index are masked bit patterns: a fingerprint belongs to one node for each pair of
blocks. Nodes with too many members are factored again by further bits. Below a node, its members are sorted by Gray
rank, where neighbours share most bits; runs of them form a tree whose nodes hold the bits that all below them share.
A search adds up differences from the root on and leaves whole groups as soon as they exceed the distance.

Removing near-duplicates goes by shared words as well: texts whose sets of word shingles are similar share one of their
rarest shingles, so each of these is a node of the index, and every candidate pair of a group is held to the shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.decontamination import word_hashes
from tidemark.llm.work import columns_of, in_batches, text_of, text_slices, texts_by_id, written

BITS = 64
#: Members of a node beyond which it is factored by more bits, and children of a node of the tree.
NODE_ROWS = 20_000
FAN = 8
#: Pairs of a query and a node that are looked at together.
FRONTIER = 2_000_000
#: Classes of shingles by whose frequency they are ordered.
CLASSES = 1 << 16
#: How often a pattern that many texts share is factored by blocks of bits.
FACTORED = 2
#: Text whose shingles are worked out together: their hashes take some 35 bytes for each byte of it.
SHINGLED_BYTES = 2_000_000
#: Texts and shingles of a block; blocks of a large group of candidates are compared two by two.
BLOCK_TEXTS = 1_000
BLOCK_SHINGLES = 2_000_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PLACES = (np.arange(8) * 256)[None, :]
_SET = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles: a bit is 1 if set in over half of the shingles' hashes. No words: zero."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[: -width].tolist()]
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]
    counts = np.zeros(2048, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[k : k + (1 << 16)], np.uint64)
        counts += np.bincount((part.view(np.uint8).reshape(-1, 8) + _PLACES).ravel(), minlength=2048)
    ones = (counts.reshape(8, 256) @ _SET).ravel()
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (its 64 bits as a long) of each row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                made = [fingerprint(t, width) for t in part.column("text").cast(pa.binary()).to_pylist()]
                signed = pa.array(np.array(made, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), signed], ["doc_id", "fingerprint"])

    return in_batches(texts_by_id(documents), make, "doc_id long, fingerprint long")


def _parts(bits: list[int], many: int) -> list[int]:
    """Masks of ``many`` runs of the bits, as equal as may be."""
    edges = [len(bits) * k // many for k in range(many + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def upper_masks(distance: int) -> list[int]:
    blocks = _parts(list(range(BITS)), distance + 2)
    return [a | b for a, b in combinations(blocks, 2)]


def lower_masks(mask: int, distance: int) -> list[int]:
    """Masks that fix more bits, of which two members of a node within ``distance`` share at least one pattern."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | part for part in _parts(free, distance + 1)] if len(free) > distance + 1 else []


def gray_rank(value: Column) -> Column:
    """The place of a bit pattern in Gray order, as a long whose signed order is that of the ranks."""
    for k in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, k))
    return value.bitwiseXOR(F.lit(-(1 << 63)))


def index_nodes(patterns: DataFrame, distance: int, node_rows: int = NODE_ROWS) -> DataFrame:
    """``mask, pattern, fingerprint``: each distinct fingerprint in its nodes, none of them over ``node_rows`` unless
    its bits are used up. Nodes of one member are left out. No pair within the distance is missed."""
    masks, done, at = upper_masks(distance), [], patterns.select("fingerprint")
    rows = at.select(F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("mask"), "fingerprint")
    while True:
        rows = rows.withColumn("pattern", F.col("fingerprint").bitwiseAND(F.col("mask")))
        sizes = written(rows.groupBy("mask", "pattern").agg(F.count("*").alias("n")).where("n > 1"))
        children = {m: lower_masks(m, distance) for m in masks}
        large = [m for m in masks if children[m]]
        hot = sizes.where((F.col("n") > node_rows) & F.col("mask").isin([_signed(m) for m in large])) if large else None
        if hot is None or hot.isEmpty():
            done.append(rows.join(sizes.select("mask", "pattern"), ["mask", "pattern"], "left_semi"))
            break
        cool = sizes.join(hot.select("mask", "pattern"), ["mask", "pattern"], "left_anti")
        done.append(rows.join(cool.select("mask", "pattern"), ["mask", "pattern"], "left_semi"))
        of = F.create_map(*[x for m in large for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in children[m]]))])
        inside = rows.join(hot.select("mask", "pattern"), ["mask", "pattern"], "left_semi")
        rows = inside.select(F.explode(F.element_at(of, F.col("mask"))).alias("mask"), "fingerprint").distinct()
        masks = sorted({c for m in large for c in children[m]})
    nodes = done[0]
    for more in done[1:]:
        nodes = nodes.unionByName(more)
    return nodes.select("mask", "pattern", "fingerprint")


class GrayTree:
    """A tree over fingerprints sorted by node and Gray rank: each level's nodes cover runs of the level below."""

    def __init__(self, prints: np.ndarray, node: np.ndarray):
        self.prints = prints
        self.levels: list[dict[str, np.ndarray]] = []
        low, high = prints, prints
        first, last = np.arange(len(prints)), np.arange(1, len(prints) + 1)
        while True:
            begins = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            place = np.arange(len(node)) - np.repeat(begins, np.diff(np.r_[begins, len(node)]))
            runs = np.flatnonzero(place % FAN == 0)
            ends = np.r_[runs[1:], len(node)]
            low, high = np.bitwise_and.reduceat(low, runs), np.bitwise_or.reduceat(high, runs)
            first, last, node = first[runs], last[ends - 1], node[runs]
            self.levels.append({"begin": runs, "end": ends, "low": low, "shared": ~(low ^ high), "first": first, "last": last})
            if len(np.unique(node)) == len(node):
                break
        # each node keeps only what its parent does not have
        for upper, lower in zip(self.levels[:0:-1], self.levels[-2::-1]):
            parent = np.repeat(np.arange(len(upper["begin"])), upper["end"] - upper["begin"])
            lower["own"] = lower["shared"] & ~upper["shared"][parent]
        self.levels[-1]["own"] = self.levels[-1]["shared"]

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places of the same root, the smaller place first, whose fingerprints are within the distance."""
        root = self.levels[-1]
        sizes = root["last"] - root["first"]
        query = np.arange(len(self.prints))
        node = np.repeat(np.arange(len(sizes)), sizes)
        wide = np.repeat(sizes, sizes) > 1
        query, node = query[wide], node[wide]
        weight = np.cumsum(np.minimum(np.repeat(sizes, sizes)[wide], FRONTIER))
        cuts = np.searchsorted(weight, np.arange(FRONTIER, int(weight[-1]) + FRONTIER, FRONTIER), "right") if len(weight) else []
        start = 0
        for cut in cuts:
            cut = max(int(cut), start + 1)
            if start >= len(query):
                break
            yield from self._descend(query[start:cut], node[start:cut], distance)
            start = cut
        if start < len(query):
            yield from self._descend(query[start:], node[start:], distance)

    def _descend(self, query: np.ndarray, node: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        added = np.zeros(len(query), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            added = added + np.bitwise_count((self.prints[query] ^ level["low"][node]) & level["own"][node])
            keep = (added <= distance) & (level["last"][node] > query + 1)
            query, node, added = query[keep], node[keep], added[keep]
            counts = level["end"][node] - level["begin"][node]
            skipped = np.repeat(np.cumsum(counts) - counts, counts)
            query, added = np.repeat(query, counts), np.repeat(added, counts)
            node = np.repeat(level["begin"][node], counts) + np.arange(len(query)) - skipped
        near = (node > query) & (np.bitwise_count(self.prints[query] ^ self.prints[node]) <= distance)
        if near.any():
            yield query[near], node[near]


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the sets of all pairs: each place gets the smallest place of its set."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, up := label[label]):
            label = up


def _nearest_forest(n: int, a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Indexes of the pairs of a minimum spanning forest: in rounds, each set takes its nearest pair to another."""
    label, taken = np.arange(n), []
    order = np.lexsort((b, a, apart))
    while len(order):
        x, y = label[a[order]], label[b[order]]
        order = order[x != y]
        x, y = label[a[order]], label[b[order]]
        best = np.full(n, len(order))
        rank = np.arange(len(order))
        np.minimum.at(best, x, rank)
        np.minimum.at(best, y, rank)
        chosen = np.unique(best[best < len(order)])
        taken.append(order[chosen])
        label = _joined(label, a[order[chosen]], b[order[chosen]])
    return np.concatenate(taken) if taken else np.zeros(0, np.int64)


def _search(distance: int):
    """Over rows sorted by node and Gray rank: the links of a nearest forest of what is within the distance."""

    def found(node: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        kept = np.zeros((3, 0), np.int64)
        shared = np.bincount(node)[node] > 1
        node, prints = node[shared], prints[shared]
        for a, b in GrayTree(prints, node).links(distance) if len(node) else ():
            apart = np.bitwise_count(prints[a] ^ prints[b]).astype(np.int64)
            pairs = np.concatenate([kept, np.stack([a, b, apart])], axis=1)
            kept = pairs[:, _nearest_forest(len(prints), *pairs)]
        ends = np.sort(np.stack([prints[kept[0]], prints[kept[1]]]).view(np.int64), axis=0)
        names = ["high", "low", "apart"]
        return pa.RecordBatch.from_arrays([pa.array(ends[1]), pa.array(ends[0]), pa.array(kept[2])], names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in ("mask", "pattern", "fingerprint")])
            rows = np.concatenate([*held, rows], axis=1)
            changes = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(0)) + 1
            cut = int(changes[-1]) if len(changes) else 0  # the last node may go on in the next batch
            if cut:
                node = np.cumsum(np.r_[False, (rows[:2, 1:cut] != rows[:2, : cut - 1]).any(0)])
                yield found(node, rows[2, :cut].copy().view(np.uint64))
            held = [rows[:, cut:]]
        if held and held[0].shape[1]:
            yield found(np.zeros(held[0].shape[1], np.int64), held[0][2].copy().view(np.uint64))

    return search


def _links_of(nodes: DataFrame, distance: int) -> DataFrame:
    ordered = nodes.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", gray_rank(F.col("fingerprint")))
    return in_batches(ordered, _search(distance), "high long, low long, apart long").distinct()


def near_links(patterns: DataFrame, distance: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links ``high, low, apart`` between distinct fingerprints (column ``fingerprint``), each ``apart`` bits apart.

    They join, directly or by further links, exactly those within ``distance`` bits. In each node, the nearest links
    make up a spanning forest.
    """
    return _links_of(index_nodes(patterns, distance, node_rows), distance)


def components(links: DataFrame) -> DataFrame:
    """``member, root`` for every end of a link: the smallest value that can be reached.

    Large-star and small-star rounds: each end passes its least neighbour on, until all links lead to roots. Each
    round is written, and its minima are aggregated ahead of the shuffle.
    """
    links = written(links.select("high", "low").where("high <> low"))
    while True:
        least = links.groupBy("high").agg(F.min("low").alias("least"))
        both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
        lowest = both.groupBy("high").agg(F.least(F.min("low"), F.first("high")).alias("least"))
        large = (
            both.join(lowest, "high").where(F.col("low") > F.col("high")).select(F.col("low").alias("high"), F.col("least").alias("low")).distinct()
        )
        large = written(large)
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(least, "high").select(F.col("low").alias("high"), F.col("least").alias("low")).where("high <> low")
        links = written(small.unionByName(least.select("high", F.col("least").alias("low"))).distinct())
        on = links.select(F.col("low").alias("high")).join(links.select("high"), "high", "left_semi")
        if on.isEmpty() and links.groupBy("high").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return links.select(F.col("high").alias("member"), F.col("low").alias("root")).unionByName(
                links.select(F.col("low").alias("member"), F.col("low").alias("root")).distinct()
            )


def _grouped(prints: DataFrame, patterns: DataFrame, links: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of all rows of ``prints``."""
    member = written(components(links))
    rooted = patterns.join(member, F.col("fingerprint") == F.col("member"), "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = rooted.join(named, "root").select("fingerprint", "component_id")
    return prints.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _patterns(prints: DataFrame) -> DataFrame:
    return written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))


def simhash_groups(documents: DataFrame, width: int = 3, distance: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) ``, component_id`` for each row of ``documents``.

    Fingerprints within ``distance`` bits are linked, exactly; ``component_id`` is the smallest ``doc_id`` that can be
    reached, null if all ids there are null. Texts without words, null among them, have fingerprint zero, linked like
    any other. Repeated rows are in one group; an empty table gives an empty result; other columns are unread.
    Copies are one node of the search, however many there are.
    """
    prints = written(fingerprints(documents, width))
    patterns = _patterns(prints)
    rows = _grouped(prints, patterns, near_links(patterns, distance, node_rows))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def shingle_hashes(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Hashes of the distinct word shingles of each text, sorted; a shorter text with words is one shingle."""
    words, bounds = word_hashes(texts)
    lengths = np.diff(bounds)
    counts = np.where(lengths > 0, np.maximum(lengths - width + 1, 1), 0)
    edges = np.r_[0, np.cumsum(counts)]
    start = np.repeat(bounds[:-1], counts) + np.arange(edges[-1]) - np.repeat(edges[:-1], counts)
    end = np.repeat(bounds[1:], counts)
    words = np.r_[words, np.zeros(width, np.uint64)]
    mixers = np.random.default_rng(width).integers(1, 2**63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sums = np.zeros(len(start), np.uint64)
    for k in range(width):
        word = np.where(start + k < end, words[start + k], np.uint64(0))
        sums += (word ^ (word >> np.uint64(31))) * mixers[k]
    sums = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    sums ^= sums >> np.uint64(32)
    return [np.unique(sums[a:z]) for a, z in zip(edges, edges[1:])]


def _class_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(CLASSES)).astype(np.int64)


def _class_counts(texts: DataFrame, width: int) -> np.ndarray:
    """How many shingles of all texts are in each class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for part in text_slices(batch, most=SHINGLED_BYTES):
                for own in shingle_hashes(part.column("text"), width):
                    np.add.at(held, _class_of(own), 1)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["class", "n"])

    found = np.zeros(CLASSES, np.int64)
    for r in in_batches(texts.select("text"), count, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        found[r["class"]] = r["n"]
    return found


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    offsets = np.r_[0, np.cumsum([len(x) for x in arrays])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def shingle_prefix(shingles: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """Those of the rarest classes, so many that two sets of that Jaccard similarity have one of theirs in common."""
    n = len(shingles)
    order = np.lexsort((shingles, counts[_class_of(shingles)]))
    return shingles[order[: n + n * round(-1000 * similarity) // 1000 + 1]] if n else shingles


def _profiles(counts, width: int, similarity: float):
    """The fingerprint of each text and its rarest shingles."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, most=SHINGLED_BYTES):
                prints = np.array([fingerprint(t) for t in part.column("text").cast(pa.binary()).to_pylist()], np.uint64)
                rare = [shingle_prefix(x, counts.value, similarity) for x in shingle_hashes(part.column("text"), width)]
                columns = [part.column("doc_id"), part.column("text_key"), pa.array(prints.view(np.int64)), _lists(rare)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fingerprint", "prefix"])

    return make


def shingle_links(nodes: DataFrame, distance: int, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links ``high, low, apart`` that join the fingerprints within ``distance`` bits that share a ``pattern``.

    Patterns of more than about ``node_rows`` fingerprints, by a sample of these, are factored by blocks of bits, of
    which two fingerprints within the distance share one, and what is still large once more (each time a fingerprint
    enters as many nodes as there are blocks). No pair is missed; what a family of near copies leaves in one node is
    searched by the tree.
    """
    step = max(1, node_rows // 300)
    masks, done = [0], []
    rows = nodes.select(F.lit(0).cast("long").alias("mask"), "pattern", "fingerprint")
    for left in reversed(range(FACTORED + 1)):
        sampled = rows.where(F.pmod(F.xxhash64("fingerprint"), F.lit(step)) == 0)
        children = {m: lower_masks(m, distance) for m in masks}
        large = [m for m in masks if children[m]]
        hot = sampled.groupBy("mask", "pattern").agg(F.count("*").alias("n")).where(F.col("n") * step > node_rows)
        hot = written(hot.select("mask", "pattern")) if left else None
        if hot is None or hot.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(hot, ["mask", "pattern"], "left_anti"))
        of = F.create_map(*[x for m in large for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in children[m]]))])
        inside = rows.join(hot, ["mask", "pattern"], "left_semi").withColumn("mask", F.explode(F.element_at(of, F.col("mask"))))
        # a smaller node is named by the one it comes from and its bits
        rows = written(inside.withColumn("pattern", F.xxhash64("pattern", F.col("fingerprint").bitwiseAND(F.col("mask")))).distinct())
        masks = sorted({c for m in large for c in children[m]})
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return _links_of(whole.select("mask", "pattern", "fingerprint"), distance)


def similar_pairs(
    prints: np.ndarray, side: np.ndarray, flat: np.ndarray, bounds: np.ndarray, distance: int, similarity: float
) -> list[tuple[int, int]]:
    """Pairs that join the texts of equal fingerprints, or within the distance and of that Jaccard similarity.

    If there are two sides, only pairs of both are looked at; pairs that are joined already are left out.
    """
    label = np.unique(prints, return_inverse=True)[1]
    codes = np.unique(flat, return_inverse=True)[1]
    sizes, least, both = np.diff(bounds), round(1000 * similarity), bool(side.any() and not side.all())
    flags = np.zeros(len(flat), bool)
    pairs = []
    for i in range(len(prints) - 1):
        others = slice(i + 1, len(prints))
        near = (np.bitwise_count(prints[others] ^ prints[i]) <= distance) & (label[others] != label[i])
        near &= 1000 * np.minimum(sizes[others], sizes[i]) >= least * np.maximum(sizes[others], sizes[i])
        near &= sizes[others] > 0
        if both:
            near &= side[others] != side[i]
        near = np.flatnonzero(near) + i + 1
        if not len(near):
            continue
        own = codes[bounds[i] : bounds[i + 1]]
        flags[own] = True
        skipped = np.cumsum(sizes[near]) - sizes[near]
        places = np.repeat(bounds[near] - skipped, sizes[near]) + np.arange(sizes[near].sum())
        common = np.add.reduceat(flags[codes[places]].astype(np.int64), skipped)
        flags[own] = False
        for j in near[1000 * common >= least * (sizes[near] + sizes[i] - common)].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                pairs.append((i, j))
    return pairs


def _compared(distance: int, similarity: float):
    """Over rows sorted by group and blocks: links of the fingerprints of similar texts."""

    def of(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        prints = table.column("fingerprint").to_numpy()
        lists = table.column("shingles").combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        bounds = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy()[bounds[0] : bounds[-1]]
        side = table.column("side").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        found = similar_pairs(prints.view(np.uint64), side, flat, bounds - bounds[0], distance, similarity)
        ends = np.sort(prints[np.array(found, np.int64).reshape(-1, 2)], axis=1)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 1]), pa.array(ends[:, 0])], ["high", "low"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("root", "one", "other")])
            cuts = np.r_[0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, batch.num_rows]
            for a, z in zip(cuts.tolist(), cuts[1:].tolist()):
                if a == z:
                    continue
                key = tuple(keys[:, a].tolist())
                if held and key != last:
                    yield of(held)
                    held = []
                last = key
                held.append(batch.slice(a, z - a))
        if held:
            yield of(held)

    return compare


def _sets(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, most=SHINGLED_BYTES):
                columns = [part.column(c) for c in ("root", "fingerprint", "text_key")]
                columns.append(_lists(shingle_hashes(part.column("text"), width)))
                yield pa.RecordBatch.from_arrays(columns, ["root", "fingerprint", "text_key", "shingles"])

    return make


def similar_links(
    texts: DataFrame, profiles: DataFrame, member: DataFrame, distance: int, width: int = 5, similarity: float = 0.8
) -> DataFrame:
    """Links ``high, low`` that join, in each group of candidates, the fingerprints of similar texts.

    All texts of a group are compared in one place, each pair that is not joined yet; a group of many texts is dealt
    into blocks, and each two blocks meet in a place of their own. Only links that join are written.
    """
    own = profiles.groupBy("fingerprint", "text_key").agg(F.min("doc_id").alias("_id"))
    own = own.join(member.select(F.col("member").alias("fingerprint"), "root"), "fingerprint")
    own = own.select("root", "fingerprint", F.col("text_key").alias("_key"), "_id")
    found = texts.join(own, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    found = found.select("root", "fingerprint", "text_key", "text").dropDuplicates(["text_key"])
    sets = written(in_batches(found, _sets(width), "root long, fingerprint long, text_key long, shingles array<long>"))
    sizes = sets.groupBy("root").agg((F.count("*") / BLOCK_TEXTS).alias("a"), (F.sum(F.size("shingles")) / BLOCK_SHINGLES).alias("b"))
    large = sizes.select("root", F.ceil(F.greatest("a", "b")).alias("_blocks")).where("_blocks > 1")
    dealt = sets.join(large, "root", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1).cast("long")))
    dealt = dealt.withColumn("_own", F.pmod("text_key", "_blocks"))
    dealt = dealt.withColumn("_with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    dealt = dealt.withColumns({"one": F.least("_own", "_with"), "other": F.greatest("_own", "_with")})
    dealt = dealt.select("root", "one", "other", (F.col("_own") == F.col("one")).alias("side"), "fingerprint", "shingles")
    placed = dealt.repartition("root", "one", "other").sortWithinPartitions("root", "one", "other")
    return in_batches(placed, _compared(distance, similarity), "high long, low long").distinct()


def simhash_dedup(
    documents: DataFrame, distance: int = 11, width: int = 5, similarity: float = 0.8, node_rows: int = NODE_ROWS
) -> DataFrame:
    """``documents`` with one row of each near-duplicate group: that of the smallest ``doc_id``.

    Two texts are linked if their fingerprints are within ``distance`` bits and their sets of shingles of ``width``
    words at least that similar (Jaccard), or if their fingerprints are equal. No such pair is missed, whatever the
    size of the table: similar sets share one of their rarest shingles. All columns are kept. A group keeps one row,
    also if its ids are all null or repeated in another group; of equal ids, the one with the least hash of its text
    stays. An empty table gives an empty result.
    """
    columns = columns_of(documents)
    key = F.xxhash64(text_of())
    texts = texts_by_id(documents, key.alias("text_key"))
    counts = documents.sparkSession.sparkContext.broadcast(_class_counts(texts, width))
    schema = "doc_id long, text_key long, fingerprint long, prefix array<long>"
    profiles = written(in_batches(texts, _profiles(counts, width, similarity), schema))
    nodes = profiles.dropDuplicates(["fingerprint", "text_key"]).select(F.explode("prefix").alias("pattern"), "fingerprint")
    member = written(components(shingle_links(nodes, distance, node_rows)))
    group = written(components(similar_links(texts, profiles, member, distance, width, similarity)))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    least = profiles.groupBy("fingerprint").agg(F.min(first).alias("first")).join(group, F.col("fingerprint") == F.col("member"), "left")
    kept = least.groupBy(F.coalesce("root", "fingerprint").alias("_root")).agg(F.min("first").alias("first"))
    kept = kept.select("_root", F.col("first.doc_id").alias("_kept"), F.col("first.text_key").alias("_key"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")) & (key == F.col("_key"))
    return documents.join(kept, same).dropDuplicates(["_root"]).select(*columns)
