"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts are sequences of lower-case words. A CGK walk reads a window from its start: at each step the word under it,
with the step, decides by a random function whether the walk moves on by a word or stays, and the word is written
out. Windows that differ by few edits fall into step again, so their embeddings differ in few places. A hash table
of the search samples some places of an embedding; a window of a text meets an item where all of them agree in one
of the tables. Windows begin at every word of every text; an item is indexed from each of its words, so a passage is
found from any of its parts that is little edited. Items shorter than a walk are cut into one piece more than the
edits allowed, so a piece is unedited in every leak, and their pieces are looked up at every word. Each meeting is
verified by the edit distance between the item and the text around it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import filtered, in_batches, text_of, text_slices, texts_by_id

SCHEMA = "doc_id long, item_id long, distance int, first_word long"
_PAD = np.uint64(0x9E3779B97F4A7C15)
#: Text that is hashed at one time.
HASHED_BYTES = 1 << 20
#: Meetings of short items that are looked at together.
MEETINGS = 200_000


@dataclass(frozen=True)
class LeakRules:
    """``most_edits``: word edits allowed, as a share of the item's words. Items of fewer than ``steps`` words are
    searched by their pieces, without a miss. ``block_bytes``: text of the items that are searched at one time."""

    most_edits: float = 0.2
    steps: int = 16
    sampled: int = 8
    tables: int = 5
    walks: int = 2
    seed: int = 42
    block_bytes: int = 2_000_000


def _random_words(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = _random_words(1, 256)
_LONGEST = 1 << 16
_POWER = np.ones(_LONGEST, np.uint64)
np.multiply.accumulate(np.full(_LONGEST - 1, np.uint64(0x5851F42D4C957F2D)), out=_POWER[1:])


def _hashed(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``raw`` and where each begins; a word ends where a text begins."""
    word = ~_BLANK[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[begins] |= word[begins]
    own = _LOWER[raw[word]]
    starts = np.flatnonzero(first[word])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(own)))
    place = np.arange(len(own)) - np.repeat(starts, lengths)
    hashes = np.add.reduceat(_BYTE[own] * _POWER[place & (_LONGEST - 1)], starts) + lengths.astype(np.uint64)
    hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    return hashes, np.flatnonzero(first)


def _parts_of(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about ``HASHED_BYTES`` that end in front of a blank; the hashes of a byte take 35 bytes on the way."""
    start = 0
    while start < len(raw):
        end = start + HASHED_BYTES
        while end < len(raw):
            blank = np.flatnonzero(_BLANK[raw[end : end + 4096]])
            if len(blank):
                end += int(blank[0])
                break
            end += 4096
        yield start, min(end, len(raw))
        start = min(end, len(raw))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts in order, and where each text's words begin and end."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    begins = offsets[:-1][(offsets[:-1] < len(raw)) & (np.diff(offsets) > 0)]
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, z in _parts_of(raw):
        own = begins[np.searchsorted(begins, a) : np.searchsorted(begins, z)] - a
        found, at = _hashed(raw[a:z], own)
        hashes.append(found)
        places.append(at + a)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets)


class Embedding:
    """Random walks and the places that each hash table samples of them."""

    def __init__(self, rules: LeakRules):
        draw = np.random.default_rng(rules.seed)
        self.steps = rules.steps
        self.turns = _random_words(rules.seed + 1, rules.walks * rules.steps).reshape(rules.walks, rules.steps)
        self.places = [
            [np.sort(draw.choice(rules.steps, rules.sampled, replace=False)) for _ in range(rules.tables)] for _ in range(rules.walks)
        ]
        self.mixers = _random_words(rules.seed + 2, rules.steps)

    def keys(self, words: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """For each table, the keys of the windows of ``words`` that begin at ``starts`` (int32).

        ``words`` goes on for ``steps`` entries behind the last window.
        """
        for turns, places in zip(self.turns, self.places):
            at = starts.copy()
            sums = [np.zeros(len(starts), np.uint64) for _ in places]
            for j in range(self.steps):
                seen = words[at]
                for own, k in zip(sums, places):
                    if j in k:
                        own += (seen ^ (seen >> np.uint64(31))) * self.mixers[j]
                at += ((seen * turns[j]) >> np.uint64(63)).astype(np.int32)
            yield from sums

    def pieces(self, words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """The keys of the ``length`` words from each of ``starts`` on."""
        sums = np.zeros(len(starts), np.uint64)
        for j in range(length):
            seen = words[starts + j]
            sums += (seen ^ (seen >> np.uint64(31))) * self.mixers[j]
        return sums


class ItemIndex:
    """The items' windows in hash tables."""

    def __init__(self, items: list[tuple[int, bytes]], rules: LeakRules):
        self.rules, self.embedding = rules, Embedding(rules)
        hashes, bounds = word_hashes(pa.array([t for _, t in items], pa.binary()))
        self.ids = [i for i, _ in items]
        self.words = [hashes[a:b] for a, b in zip(bounds, bounds[1:])]
        self.sets = [set(w.tolist()) for w in self.words]
        #: By the length of a piece, None for walks: what is looked up, a table for each key of a window.
        self.tables: dict[int | None, list[tuple]] = {}
        placed: dict[int | None, list[tuple[int, int]]] = {}
        for k, w in enumerate(self.words):
            n = len(w)
            if n >= rules.steps:
                placed.setdefault(None, []).extend((k, o) for o in range(n - rules.steps // 2 + 1))
            elif n:
                many = min(n, int(rules.most_edits * n) + 1)
                edges = [n * j // many for j in range(many + 1)]
                for a, z in zip(edges, edges[1:]):
                    placed.setdefault(z - a, []).append((k, a))
        first = np.cumsum([0] + [len(w) + rules.steps for w in self.words])
        flat = np.concatenate([x for w in self.words for x in (w, np.full(rules.steps, _PAD))]) if self.words else hashes
        for length, own in placed.items():
            item, offset = np.array(own).T
            tables = []
            for keys in self._keys(flat, (first[item] + offset).astype(np.int32), length):
                order = np.argsort(keys, kind="stable")
                bits = min(26, max(16, int(np.ceil(np.log2(len(keys)))) + 7))
                seen = np.zeros(1 << bits, bool)
                seen[keys >> np.uint64(64 - bits)] = True
                tables.append((keys[order], item[order], offset[order], np.uint64(64 - bits), seen))
            self.tables[length] = tables

    def _keys(self, words: np.ndarray, starts: np.ndarray, length: int | None) -> Iterator[np.ndarray]:
        if length is None:
            yield from self.embedding.keys(words, starts)
        else:
            # the top bits choose the place in a table
            yield self.embedding.pieces(words, starts, length) * np.uint64(0xBF58476D1CE4E5B9)

    def meetings(self, words: np.ndarray) -> np.ndarray:
        """Rows (item, word at which the item would begin), each once; ``words`` ends with ``steps`` of padding."""
        starts = np.arange(len(words) - self.rules.steps, dtype=np.int32)
        found = []
        for length, tables in self.tables.items():
            for keys, (own, item, offset, shift, seen) in zip(self._keys(words, starts, length), tables):
                near = np.flatnonzero(seen[keys >> shift])
                low = np.searchsorted(own, keys[near], "left")
                count = np.searchsorted(own, keys[near], "right") - low
                # common pieces meet often: in parts, of which only what may be a leak stays
                cuts = np.flatnonzero(np.diff(np.cumsum(count) // MEETINGS)) + 1
                for near, low, count in zip(*(np.split(x, cuts) for x in (near, low, count))):
                    if total := int(count.sum()):
                        skipped = np.repeat(np.cumsum(count) - count, count)
                        entry = np.repeat(low, count) + np.arange(total) - skipped
                        begin = np.repeat(near, count) - offset[entry]
                        rows = np.stack([item[entry], begin], 1)
                        rows = rows if length is None else self._likely(rows, words)
                        found.append(np.unique(rows, axis=0))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def _likely(self, rows: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Those rows of short items around which enough of the item's words are found, in whatever order."""
        item, begin = rows.T
        lengths = np.array([len(w) for w in self.words])
        most = (self.rules.most_edits * lengths).astype(np.int64)
        short = np.full((len(lengths), self.rules.steps), _PAD)
        for k in np.unique(item).tolist():
            short[k, : lengths[k]] = self.words[k]
        common = np.zeros(len(rows), np.int64)
        around, own = begin - most[item], short[item]
        for j in range(int((lengths + 2 * most)[item].max())):
            at = around + j
            inside = (j < (lengths + 2 * most)[item]) & (at >= 0) & (at < len(words) - self.rules.steps)
            seen = words[np.clip(at, 0, len(words) - 1)]
            common += inside & (own == seen[:, None]).any(1)
        return rows[common >= (lengths - most)[item]]

    def verified(self, words: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
        """By text and item the least edit distance within bounds, and the word at which the search for it began."""
        padded = np.concatenate([words, np.full(self.rules.steps, _PAD)])
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for k, begin in self.meetings(padded).tolist():
            item = self.words[k]
            n = len(item)
            most = int(self.rules.most_edits * n)
            middle = min(max(begin + n // 2, 0), len(words) - 1)
            for text in {int(np.searchsorted(bounds, x, "right")) - 1 for x in (max(begin, 0), middle, min(begin + n - 1, len(words) - 1))}:
                low, high = int(bounds[text]), int(bounds[text + 1])
                a, b = max(low, begin - most), min(high, begin + n + most)
                known = best.get((text, k))
                if b - a < n - most or known and known[0] == 0:
                    continue
                if low <= begin and begin + n <= high and np.array_equal(words[begin : begin + n], item):
                    best[text, k] = (0, begin - low)
                    continue
                near = words[a:b]
                if sum(map(self.sets[k].__contains__, near.tolist())) < n - most:
                    continue
                distance = edit_distance_within(item, near)
                if distance <= most and (known is None or (distance, begin - low) < known):
                    best[text, k] = (distance, max(begin - low, 0))
        return best


def edit_distance_within(item: np.ndarray, text: np.ndarray) -> int:
    """Least edit distance between the item and any part of the text."""
    column = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, word in enumerate(item, 1):
        step = np.empty_like(row)
        step[0] = k
        step[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(step - column) + column
    return int(row.min())


def _blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple[int, bytes]]]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")).where("item_id is not null and text <> ''")
    held, block = 0, []
    for r in items.distinct().toLocalIterator():
        text = r["text"].encode("utf-8", "surrogatepass")
        if block and held + len(text) > most:
            yield block
            held, block = 0, []
        block.append((r["item_id"], text))
        held += len(text)
    if block:
        yield block


def benchmark_leaks(documents: DataFrame, benchmark: DataFrame, rules: LeakRules = LeakRules()) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains: ``doc_id, item_id, distance, first_word``.

    ``distance`` counts word edits (lower-cased words between ASCII blanks), at most ``most_edits`` of the item's
    words; ``first_word`` is where in the text the item begins. A text is searched in full at every word. The
    benchmark is taken in blocks of bounded size, each broadcast to one pass over the documents. Null texts count as
    empty and match nothing, as do items without words or without an id. Repeated rows of documents give a pair
    each, repeated items none more. Empty tables give an empty result; other columns are unread.
    """
    spark = documents.sparkSession
    rows = texts_by_id(documents)
    found = spark.createDataFrame([], SCHEMA)
    for block in _blocks(benchmark, rules.block_bytes):
        items = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(items.value, rules)
            for batch in batches:
                for part in text_slices(batch, most=2_000_000):
                    words, bounds = word_hashes(part.column("text"))
                    if not len(words):
                        continue
                    ids = part.column("doc_id").to_pylist()
                    pairs = [(ids[t], index.ids[k], d, at) for (t, k), (d, at) in sorted(index.verified(words, bounds).items())]
                    if pairs:
                        names = ["doc_id", "item_id", "distance", "first_word"]
                        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*pairs), kinds)], names)

        found = found.unionByName(in_batches(rows, search, SCHEMA))
    return found


def without_leaks(documents: DataFrame, benchmark: DataFrame, rules: LeakRules = LeakRules()) -> DataFrame:
    """The rows of ``documents`` that contain no item of the benchmark, with all columns.

    Each row is searched by its own text, whatever its id, so null and repeated ids are kept apart; null texts stay.
    Empty tables: an empty result, or all documents.
    """
    spark = documents.sparkSession
    for block in _blocks(benchmark, rules.block_bytes):
        items, held = spark.sparkContext.broadcast(block), []

        def keep(part: pa.RecordBatch, items=items, held=held) -> list[bool]:
            if not held:
                held.append(ItemIndex(items.value, rules))
            words, bounds = word_hashes(part.column("text"))
            leaked = {text for text, _ in held[0].verified(words, bounds)} if len(words) else set()
            return [k not in leaked for k in range(part.num_rows)]

        documents = filtered(documents, {"text": text_of()}, keep, most=2_000_000)
    return documents
