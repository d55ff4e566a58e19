"""Packing documents into training sequences by a grouping genetic algorithm.

Documents are cut into pieces of at most a sequence's tokens, and pieces shorter than a sequence are packed. They are dealt
into blocks of bounded size; each block is bred on several islands. An individual is a whole packing, its genes are
sequences: a child takes well-filled sequences of one parent whole, keeps those of the other that share no piece with
them, and the pieces displaced enter by best fit. After each epoch the best packing of an island migrates to the next.
A block that reaches a lower bound is done. The loosest sequences of all blocks are pooled and packed again in fewer
blocks, until one block holds the pool, so that dealing into blocks costs next to nothing.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.token_counts import LETTER_WORDS, _byte_letters
from tidemark.llm.work import in_batches, text_slices, texts_by_id, written

# The pieces into which byte-level vocabularies of this kind cut a text, with the blanks of the rank encoder.
PIECES = rf"{LETTER_WORDS}| ?[^\s\p{{L}}\p{{N}}]+|\s+(?!\S)|\s+"
#: Longer texts are tokenised in parts of about so many characters.
PART_CHARS = 1 << 20
#: A place where no piece of a text crosses: a space between two characters that are not blank.
_BREAK = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class PackRules:
    """``block_items``: pieces bred together. ``islands, population, generations, epochs``: size of the search in a block.
    ``loose``: share of a block's sequences that are packed again with those of other blocks."""

    capacity: int = 1024
    end_id: int = 2
    block_items: int = 20_000
    islands: int = 3
    population: int = 5
    generations: int = 8
    epochs: int = 3
    loose: float = 0.01
    seed: int = 42


class TokenIds:
    """Token ids of texts under a vocabulary file of byte-level merges, as its library gives them without added tokens.

    Special strings inside texts are their ids. Where ids are in the order of merges, ranks are ids and texts are
    encoded by ranks, which is several times faster; else by the file's own library.
    """

    def __init__(self, vocabulary: str):
        told = json.loads(vocabulary)
        model, letters = told["model"], _byte_letters()
        self.special = {x["content"]: x["id"] for x in told["added_tokens"]}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        vocab = model.get("vocab", {})
        places = [vocab.get(a + b) for a, b in merges]
        plain = (told["pre_tokenizer"] or {}) == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        ranked = plain and not told["normalizer"] and model["type"] == "BPE" and places == sorted(set(places)) and None not in places
        if ranked and all(set(w) <= set(letters) for w in vocab if w not in self.special):
            import tiktoken

            ranks = {bytes(letters[c] for c in w): i for w, i in vocab.items() if w not in self.special}
            self.encoding = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=self.special)
            self.encode = self._by_ranks
        else:
            self.encode = self._by_library
        self.vocabulary, self.tokenizer = vocabulary, None
        self.whole = not ranked or any(re.search(r"\s", s) for s in self.special)

    def _by_library(self, text: str) -> list[int]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.vocabulary)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _by_ranks(self, text: str) -> list[int]:
        try:
            return self.encoding.encode(text, allowed_special="all")
        except ValueError:  # a run of over a million blanks is too deep for its patterns
            return self._by_library(text)

    def ids(self, text: str) -> np.ndarray:
        if len(text) <= PART_CHARS or self.whole:
            return np.array(self.encode(text), "<u4")
        parts, start = [], 0
        while start < len(text):
            cut = _BREAK.search(text, start + PART_CHARS) if len(text) - start > PART_CHARS else None
            end = cut.start() if cut else len(text)
            parts.append(np.array(self.encode(text[start:end]), "<u4"))
            start = end
        return np.concatenate(parts)


_IDS: dict[int, TokenIds] = {}


def token_pieces(documents: DataFrame, vocabulary: str, rules: PackRules = PackRules(), with_ids: bool = False) -> DataFrame:
    """``key, doc_id, piece, start, length, ids_crc32`` (and ``ids``) of all pieces of each document.

    A document's tokens end in ``end_id``; if they exceed the capacity, every piece but the first has as many tokens as
    fit. ``key`` is a number of the piece in this result, so the result is to be written before it is used twice.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = documents.sparkSession.sparkContext.broadcast(file.read())
    names = ["key", "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.list_(pa.int32())] if with_ids else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, key = content.value, TaskContext.get().partitionId() << 40
        tokens = _IDS.get(hash(told))
        if tokens is None:
            _IDS.clear()
            tokens = _IDS[hash(told)] = TokenIds(told)
        for batch in batches:
            for part in text_slices(batch, most=4_000_000):
                out: list[list] = [[] for _ in names]
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.append(tokens.ids(text), np.uint32(rules.end_id)).astype("<u4")
                    first = (len(ids) - 1) % rules.capacity + 1
                    for piece, end in enumerate(range(first, len(ids) + 1, rules.capacity)):
                        start = max(0, end - rules.capacity) if piece else 0
                        own = ids[start:end]
                        row = (key, doc, piece, start, len(own), zlib.crc32(own.tobytes()), own.astype(np.int32))
                        key += 1
                        for held, value in zip(out, row):
                            held.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    schema = "key long, doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return in_batches(texts_by_id(documents), cut, schema)


# -- the search in a block ------------------------------------------------


def fewest(sizes: np.ndarray, capacity: int) -> int:
    """A lower bound of the sequences that pieces of these sizes need: large pieces cannot share one, small ones fill up."""
    counts = np.bincount(sizes, minlength=capacity + 1)[: capacity + 1]
    many, held = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(counts * np.arange(capacity + 1))]
    half = capacity // 2
    best = 0
    for least in range(half + 1):  # pieces of less than this are left out
        alone = many[-1] - many[capacity - least + 1]
        large = many[capacity - least + 1] - many[half + 1]
        room = large * capacity - (held[capacity - least + 1] - held[half + 1])
        small = held[half + 1] - held[least]
        best = max(best, int(alone + large + max(0, -(-(small - room) // capacity))))
    return best


class Packing:
    """Pieces by sequence, the tokens of each sequence, and the sequence of each piece. An empty sequence is a free number."""

    __slots__ = ("bins", "fills", "place")

    def __init__(self, bins: list[list[int]], fills: list[int], place: list[int]):
        self.bins, self.fills, self.place = bins, fills, place

    def copy(self) -> Packing:
        # sequences are replaced and never changed, so copies share them
        return Packing(self.bins[:], self.fills[:], self.place[:])

    def score(self) -> tuple[int, int]:
        """Fewer sequences are better, then fuller ones beside emptier ones."""
        return len(self.fills) - self.fills.count(0), -sum([f * f for f in self.fills])


class Island:
    """A population of packings of the same pieces, of which number 0 is the largest."""

    def __init__(self, sizes: np.ndarray, rules: PackRules, draw: np.random.Generator):
        self.rules, self.draw = rules, draw
        self.array, self.sizes = sizes, sizes.tolist()
        self.bound = fewest(sizes, rules.capacity)
        self.people: list[tuple[tuple[int, int], Packing]] = []

    def add(self, packing: Packing) -> None:
        self.people.append((packing.score(), packing))
        self.people.sort(key=lambda x: x[0])

    def done(self) -> bool:
        return bool(self.people) and self.people[0][0][0] <= self.bound

    def best_fit(self, pieces: list[int], into: Packing) -> Packing:
        """``into`` with the pieces added in their order, each where it leaves the least room."""
        capacity, size = self.rules.capacity, self.sizes
        bins, fills, place = into.bins, into.fills, into.place
        by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        for k, fill in enumerate(fills):
            if fill < capacity:
                by_room[capacity - fill].append(k)
        rooms = sum(1 << r for r, own in enumerate(by_room) if own)  # one bit for each room that some sequence has
        added: dict[int, list[int]] = {}
        for i in pieces:
            n = size[i]
            fitting = rooms >> n
            if fitting:
                room = n + (fitting & -fitting).bit_length() - 1
                k = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
            else:
                room, k = capacity, len(bins)
                bins.append([])
                fills.append(0)
            added.setdefault(k, []).append(i)
            fills[k] += n
            place[i] = k
            if room > n:
                by_room[room - n].append(k)
                rooms |= 1 << (room - n)
        for k, more in added.items():
            bins[k] = bins[k] + more
        return into

    def settle(self) -> None:
        """The first population: best fit by decreasing size, and by sizes blurred at random."""
        empty = lambda: Packing([], [], [-1] * len(self.sizes))
        if len(self.people) < self.rules.population:
            self.add(self.best_fit(list(range(len(self.sizes))), empty()))
        while len(self.people) < self.rules.population and not self.done():
            blurred = self.array * self.draw.uniform(0.9, 1.1, len(self.array))
            self.add(self.best_fit(np.argsort(-blurred, kind="stable").tolist(), empty()))

    def cross(self, keeper: Packing, giver: Packing) -> Packing:
        """A child: well-filled sequences of the giver whole, what they leave of the keeper's, the rest by best fit."""
        draw, child = self.draw, keeper.copy()
        full = np.array(giver.fills)
        fullest = np.argsort(-full, kind="stable")[: max(1, int((full > 0).sum()) // 2)]
        many = int(min(len(fullest), draw.integers(1, 2 + len(fullest) // 3), 200))
        start = int(draw.integers(0, len(fullest) - many + 1))
        injected = [giver.bins[k] for k in fullest[start : start + many].tolist()]
        taken = {i for b in injected for i in b}
        hit = {child.place[i] for i in taken}
        # some of the keeper's emptiest go as well, so that their pieces find other places
        fills = np.array(child.fills)
        fills[list(hit)] = 0
        used = np.flatnonzero(fills)
        few = int(min(len(used), draw.integers(2, 30)))
        hit.update(used[np.argpartition(fills[used], few - 1)[:few]].tolist() if few else ())
        loose = [i for k in hit for i in child.bins[k] if i not in taken]
        for k in hit:
            child.bins[k], child.fills[k] = [], 0
        for b, k in zip(injected, hit):
            child.bins[k], child.fills[k] = b, sum([self.sizes[i] for i in b])
            for i in b:
                child.place[i] = k
        free = [k for k in hit if not child.fills[k]]
        return self.best_fit(self.exchanged(sorted(loose), child), self.without(child, free, len(injected) - len(hit), injected))

    def without(self, child: Packing, free: list[int], more: int, injected: list[list[int]]) -> Packing:
        """The child with sequences for the injected ones that found no free number, and no empty ones."""
        for b in injected[len(injected) - more :] if more > 0 else ():
            for i in b:
                child.place[i] = len(child.bins)
            child.bins.append(b)
            child.fills.append(sum([self.sizes[i] for i in b]))
        for k in sorted(free, reverse=True):
            last = len(child.bins) - 1
            if k != last:
                child.bins[k], child.fills[k] = child.bins[last], child.fills[last]
                for i in child.bins[k]:
                    child.place[i] = k
            child.bins.pop()
            child.fills.pop()
        return child

    def exchanged(self, loose: list[int], child: Packing) -> list[int]:
        """Loose pieces after exchanges that fill a sequence better: one of its pieces for a larger one, or for two."""
        capacity, size = self.rules.capacity, self.sizes
        order = sorted((size[i], i) for i in loose)
        open_bins = [k for k, f in enumerate(child.fills) if 0 < f < capacity]
        if not order or not open_bins:
            return loose
        for k in self.draw.permutation(open_bins)[:300].tolist():
            if len(order) < 2:
                break
            best = None
            for i in child.bins[k]:
                most = size[i] + capacity - child.fills[k]
                at = bisect_right(order, (most, len(size))) - 1
                if at >= 0 and order[at][0] > size[i] and (best is None or order[at][0] - size[i] > best[0]):
                    best = (order[at][0] - size[i], i, (at,))
                low = int(self.draw.integers(0, len(order)))
                rest = most - order[low][0]
                other = bisect_right(order, (rest, len(size))) - 1
                other -= other == low
                if other >= 0 and other != low:
                    gain = order[low][0] + order[other][0] - size[i]
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, i, (low, other))
            if best is None:
                continue
            gain, out, places = best
            moved = [order[x][1] for x in places]
            for x in sorted(places, reverse=True):
                del order[x]
            insort(order, (size[out], out))
            child.bins[k] = [i for i in child.bins[k] if i != out] + moved
            child.fills[k] += gain
            for i in moved:
                child.place[i] = k
        return [i for _, i in reversed(order)]

    def breed(self) -> None:
        for _ in range(self.rules.generations):
            for _ in range(self.rules.population - 1):
                if self.done():
                    return
                a, b = self.draw.choice(len(self.people), 2, replace=len(self.people) < 2)
                self.add(self.cross(self.people[a][1], self.people[b][1]))
                del self.people[self.rules.population :]

    def written(self, packing: Packing) -> bytes:
        return np.unique(np.array(packing.place, np.int32), return_inverse=True)[1].astype(np.int32).tobytes()

    def read(self, genome: bytes) -> None:
        place = np.frombuffer(genome, np.int32)
        order = np.argsort(place, kind="stable")
        edges = np.flatnonzero(np.diff(place[order])) + 1
        bins = [b.tolist() for b in np.split(order, edges)] if len(place) else []
        self.add(Packing(bins, np.bincount(place, self.array).astype(int).tolist(), place.tolist()))


_STATE = "block long, island int, sizes binary, genomes array<binary>, best int, score long, bound int"


def _evolved(state: DataFrame, rules: PackRules, epoch: int, rows: int) -> DataFrame:
    """Each island of ``state`` (``block, island, sizes, genomes``) after an epoch."""
    spark = state.sparkSession
    tasks = max(1, min(rows, 20 * spark.sparkContext.defaultParallelism))

    def evolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("block", "island", "sizes", "genomes")]
            for block, number, sizes, genomes in zip(*columns):
                draw = np.random.default_rng([rules.seed, epoch, number, block & 0xFFFFFFFF])
                island = Island(np.frombuffer(sizes, np.int32), rules, draw)
                for genome in genomes or ():
                    island.read(genome)
                island.settle()
                island.breed()
                (best, score), _ = island.people[0]
                made = [[block], [number], [sizes], [[island.written(b) for _, b in island.people]], [best], [score], [island.bound]]
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.int32(), pa.int64(), pa.int32()]
                names = ["block", "island", "sizes", "genomes", "best", "score", "bound"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(made, kinds)], names)

    dealt = state.select("block", "island", "sizes", "genomes").repartition(tasks, "block", "island")
    return written(in_batches(dealt, evolve, _STATE))


def _bred(blocks: DataFrame, many: int, rules: PackRules) -> DataFrame:
    """``block`` and the ``genome`` of its best packing. Blocks go on until their bound is reached or the epochs are over."""
    islands = F.explode(F.sequence(F.lit(0), F.lit(rules.islands - 1))).alias("island")
    start = F.when(F.col("seed").isNotNull(), F.array("seed")).otherwise(F.array().cast("array<binary>"))
    state = _evolved(blocks.select("block", islands, "sizes", start.alias("genomes")), rules, 0, many * rules.islands)
    done = []
    for epoch in range(1, rules.epochs + 1):
        told = state.groupBy("block").agg(F.min("best").alias("_best"), F.max("bound").alias("_bound"))
        open_blocks = written(told.where("_best > _bound").select("block"))
        left = open_blocks.count()
        if not left or epoch == rules.epochs:
            break
        done.append(state.join(open_blocks, "block", "left_anti"))
        migrants = state.select("block", ((F.col("island") + 1) % rules.islands).cast("int").alias("island"), F.col("genomes")[0].alias("_elite"))
        going = state.join(open_blocks, "block", "left_semi").join(migrants, ["block", "island"])
        going = going.withColumn("genomes", F.concat(F.array("_elite"), "genomes"))
        state = _evolved(going, rules, epoch, left * rules.islands)
    for rows in done:
        state = state.unionByName(rows)
    order = F.struct("best", "score", "island")
    return written(state.groupBy("block").agg(F.min_by(F.col("genomes")[0], order).alias("genome")))


def _level(pieces: DataFrame, many: int, level: int, rules: PackRules) -> tuple[DataFrame, int]:
    """``key, length, sequence, loose`` of pieces ``key, length, sequence`` (null at first), and the number of blocks."""
    blocks = max(1, -(-many // rules.block_items))
    dealt = F.pmod(F.xxhash64(F.coalesce("sequence", "key"), F.lit(level)), F.lit(blocks))
    items = F.sort_array(F.collect_list(F.struct((-F.col("length")).alias("n"), "key", "sequence")))
    rows = pieces.groupBy(dealt.alias("block")).agg(items.alias("items"))
    rows = rows.select("block", F.col("items.key").alias("keys"), F.transform("items.n", lambda n: -n).alias("lengths"), F.col("items.sequence").alias("was"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lengths, was = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("lengths", "was"))
                seed = None if batch.column("was")[k].values.null_count else np.unique(was, return_inverse=True)[1].astype(np.int32).tobytes()
                made = [[batch.column("block")[k].as_py()], [lengths.astype(np.int32).tobytes()], [seed], [batch.column("keys")[k].as_py()]]
                kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, kinds)], ["block", "sizes", "seed", "keys"])

    known = written(in_batches(rows, read, "block long, sizes binary, seed binary, keys array<long>"))
    best = _bred(known, blocks, rules)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                sizes = np.frombuffer(batch.column("sizes")[k].as_py(), np.int32)
                place = np.frombuffer(batch.column("genome")[k].as_py(), np.int32)
                fills = np.bincount(place, sizes)
                pooled = np.zeros(len(fills), bool)
                if blocks > 1:
                    # at most a quarter, so that the pool shrinks whatever the size of a block
                    most = min(max(8, int(len(fills) * rules.loose)), len(fills) // 4)
                    pooled[np.argsort(fills, kind="stable")[:most]] = True
                    pooled &= fills < rules.capacity
                sequence = (level << 56) + (batch.column("block")[k].as_py() << 24) + place.astype(np.int64)
                columns = [batch.column("keys")[k].values, pa.array(sizes.astype(np.int64)), pa.array(sequence), pa.array(pooled[place])]
                yield pa.RecordBatch.from_arrays(columns, ["key", "length", "sequence", "loose"])

    joined = known.select("block", "sizes", "keys").join(best, "block")
    return written(in_batches(joined, tell, "key long, length long, sequence long, loose boolean")), blocks


def pack_pieces(pieces: DataFrame, rules: PackRules = PackRules()) -> DataFrame:
    """``key`` and ``sequence`` of pieces ``key, length``, none longer than the capacity: pieces of a sequence fit in it.

    Pieces of the capacity have a sequence each and take no part in the search.
    """
    full = pieces.where(F.col("length") >= rules.capacity).select("key", (-1 - F.col("key")).alias("sequence"))
    rest = pieces.where(F.col("length") < rules.capacity).select("key", "length", F.lit(None).cast("long").alias("sequence"))
    placed, level = [full], 0
    many = rest.count()
    while many:
        packed, blocks = _level(rest, many, level, rules)
        placed.append(packed.where("not loose").select("key", "sequence"))
        rest, level = packed.where("loose").drop("loose"), level + 1
        many = rest.count() if blocks > 1 else 0
    found = placed[0]
    for more in placed[1:]:
        found = found.unionByName(more)
    return found


def pack_documents(documents: DataFrame, vocabulary: str, rules: PackRules = PackRules(), with_ids: bool = False) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``rules.capacity`` tokens.

    Columns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``). A null text counts as empty and
    is its end token alone. Repeated rows are packed each for itself, null ids are kept; an empty table gives an empty
    result; other columns are unread.
    """
    pieces = written(token_pieces(documents, vocabulary, rules, with_ids))
    placed = pieces.join(pack_pieces(pieces.select("key", "length"), rules), "key")
    # a sequence is no longer than its tokens, so no window is large; full ones need none
    before = Window.partitionBy("sequence").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")).alias("offset")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", F.col("sequence").alias("sequence_id"), offset, *(["ids"] if with_ids else [])]
    return placed.select(*columns)


def packed_sequences(documents: DataFrame, vocabulary: str, rules: PackRules = PackRules()) -> DataFrame:
    """The sequences themselves: ``sequence_id, ids`` and ``pieces`` (``offset, doc_id, start, length``), in order."""
    rows = pack_documents(documents, vocabulary, rules, with_ids=True)
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    told = rows.groupBy("sequence_id").agg(parts.alias("_parts"))
    pieces = F.transform("_parts", lambda p: F.struct(p["offset"].alias("offset"), p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["length"].alias("length")))
    return told.select("sequence_id", F.flatten("_parts.ids").alias("ids"), pieces.alias("pieces"))
