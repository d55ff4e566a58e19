"""Token counts by byte-pair merging.

Each text is split as the vocabulary's pre-tokenizer does; in each piece, the adjacent pair of lowest rank is
merged again and again, by a heap of pairs over a linked list of symbols. The count is the number of initial
symbols less the merges; identifiers are never made. Counts of short pieces are remembered by each Python worker.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.work import in_batches, text_slices, texts_by_id

# The pieces into which byte-level vocabularies of this kind cut a text.
LETTER_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
SPACE = r"\t-\r\x20\x85\xa0  -     　"
PIECES = rf"{LETTER_WORDS}| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

#: Pieces up to this length are remembered, and so many of them at most by each worker.
REMEMBERED_CHARS = 48
REMEMBERED = 1_000_000
#: Longer texts are cut into pieces one at a time instead of into a list.
LISTED_CHARS = 4_000_000

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _byte_letters() -> dict[str, int]:
    """The printable letter for each byte in such vocabularies: itself, or the next letter from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters = {chr(b): b for b in plain}
    letters.update({chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)})
    return letters


class TokenCounter:
    """Counts tokens of texts under a vocabulary file of byte-level merges.

    A text in which a special string occurs is cut there, and the string counts as one token, as the library
    does by default. Nothing is added at either end.
    """

    def __init__(self, vocabulary: str):
        told = json.loads(vocabulary)
        pre, model = told["pre_tokenizer"] or {}, told["model"]
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or told["normalizer"]:
            raise ValueError("a byte-level BPE vocabulary without normalizer and prefix space is needed")
        symbols: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        letters = _byte_letters()
        self.rank: dict[int, int] = {}
        self.result: list[int] = []
        for merge in model["merges"]:
            left, right = (bytes(letters[c] for c in x) for x in (merge if isinstance(merge, list) else merge.split(" ")))
            made = symbols.setdefault(left + right, len(symbols))
            self.rank[symbols[left] << 32 | symbols[right]] = len(self.result)
            self.result.append(made)
        special = sorted((x["content"] for x in told["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pieces = regex.compile(PIECES)
        self.known = _Known(self)

    def count_piece(self, piece: bytes) -> int:
        """Tokens of one piece: initial symbols less merges."""
        n = len(piece)
        if n < 2:
            return n
        symbols, rank_of, result = list(piece), self.rank.get, self.result
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        bits = n.bit_length()  # an entry of the heap: rank, then place
        heap = []
        for i in range(n - 1):
            if (r := rank_of(symbols[i] << 32 | symbols[i + 1])) is not None:
                heap.append(r << bits | i)
        heapify(heap)
        mask, tokens = (1 << bits) - 1, n
        while heap:
            entry = heappop(heap)
            i, r = entry & mask, entry >> bits
            j, left = following[i], symbols[i]
            if left < 0 or j >= n or rank_of(left << 32 | symbols[j]) != r:
                continue  # one of its symbols has been merged meanwhile
            symbols[i] = made = result[r]
            symbols[j] = -1
            following[i] = after = following[j]
            before = previous[i]
            tokens -= 1
            if after < n:
                previous[after] = i
                if (r := rank_of(made << 32 | symbols[after])) is not None:
                    heappush(heap, r << bits | i)
            if before >= 0 and (r := rank_of(symbols[before] << 32 | made)) is not None:
                heappush(heap, r << bits | before)
        return tokens

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        total = len(parts) - 1
        for part in parts:
            if len(part) <= LISTED_CHARS:
                total += sum(map(self.known.__getitem__, self.pieces.findall(part)))
            else:
                total += sum(self.known[m[0]] for m in self.pieces.finditer(part))
        return total


class _Known(dict):
    """Counts of pieces seen; a full memory is begun anew."""

    def __init__(self, counter: TokenCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        n = self.counter.count_piece(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n


_COUNTERS: dict[int, TokenCounter] = {}


def token_counts(documents: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """Tokens of each whole text: ``doc_id, n_bytes, n_tokens, over_limit`` (more tokens than ``limit``).

    ``vocabulary`` is the path of a vocabulary file on the driver; its content, whose size does not depend on
    the data, goes to the tasks. A null text counts as empty: no bytes, no tokens. Repeated rows are counted
    each for itself, a null ``doc_id`` is kept, an empty table gives an empty result; other columns are unread.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = documents.sparkSession.sparkContext.broadcast(file.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = content.value
        key = hash(told)
        counter = _COUNTERS.get(key)
        if counter is None:
            _COUNTERS.clear()
            counter = _COUNTERS[key] = TokenCounter(told)
        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text")
                n_tokens = [counter.count(t) for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.compute.cast(pa.compute.binary_length(texts), pa.int64()),
                        pa.array(n_tokens, pa.int64()),
                        pa.array([n > limit for n in n_tokens], pa.bool_()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return in_batches(texts_by_id(documents), count, SCHEMA)
