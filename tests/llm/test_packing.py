"""Packing: ids as the library gives them, whole packings, bounds, and few more sequences than the bound."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import packing

SCHEMA = "doc_id long, text string"
LETTERS = [*"aZ09 '’.,!\n\t\r\x0b\x0c\x1c\x85\xa0é中😀#$", "<|endoftext|>", "'s", "'ll", "  ", " \n", "̀", " ", "٣"]


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def test_ids_equal_the_library(vocabulary, library, monkeypatch):
    with open(vocabulary, encoding="utf-8") as file:
        tokens = packing.TokenIds(file.read())
    draw = np.random.default_rng(1)
    texts = ["".join(draw.choice([*LETTERS, *["word", " "] * 9], draw.integers(0, 60))) for _ in range(1500)]
    for most in (1 << 20, 7):
        monkeypatch.setattr(packing, "PART_CHARS", most)
        for text in texts:
            assert tokens.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(packing, "PART_CHARS", 1 << 20)
    blank = "\n" * 1_200_000
    assert tokens.ids(blank).tolist() == library.encode(blank, add_special_tokens=False).ids


@pytest.mark.parametrize("block", [20_000, 15])
def test_packing_of_odd_rows(spark, vocabulary, library, block):
    draw = np.random.default_rng(2)
    texts = [None, "", " ", "a<|endoftext|>b", "word " * 1023, "word " * 1022, "word " * 5000, "x y z", "x y z"]
    texts += ["word " * int(n) for n in draw.integers(1, 1300, 60)]
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts)] + [(3, "same id")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "'x' as length", "2 as sequence", "3 as block")
    got = packing.pack_documents(df, vocabulary, packing.PackRules(block_items=block), with_ids=True).collect()
    held, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        held[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["ids"]))
    for own in held.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own[:-1]]).tolist() and sum(n for _, n in own) <= 1024
    whole = defaultdict(list)
    for doc, text in rows:
        whole[doc].append(library.encode(text or "", add_special_tokens=False).ids + [2])
    for doc, ids in whole.items():
        if len(ids) == 1:
            own = sorted(pieces[doc])
            assert sum((p[2] for p in own), []) == ids[0] and [p[0] for p in own] == list(range(len(own)))
            assert [p[1] for p in own] == np.cumsum([0] + [len(p[2]) for p in own[:-1]]).tolist()
            assert all(len(p[2]) == 1024 for p in own[1:])
    assert sum(r["length"] for r in got) == sum(len(x) for d in whole.values() for x in d)
    total = sum(r["length"] for r in got)
    assert -(-total // 1024) <= len(held) <= -(-total // 1024) + (2 if block > 100 else 8)  # small blocks waste some


def test_packing_of_an_empty_table(spark, vocabulary):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), vocabulary).count() == 0


def test_packed_sequences_hold_all_ids(spark, vocabulary, library):
    rows = [(k, "a few words " * (k * 7 % 90)) for k in range(80)]
    got = packing.packed_sequences(spark.createDataFrame(rows, SCHEMA), vocabulary).collect()
    told = {}
    for r in got:
        for p in r["pieces"]:
            told[p["doc_id"], p["start"]] = r["ids"][p["offset"] : p["offset"] + p["length"]]
    for k, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        assert sum((told[x] for x in sorted(told) if x[0] == k), []) == ids


def _fewest(sizes, capacity):
    """By search over all assignments."""
    best = [len(sizes)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for room in sorted({r for r in rooms if r >= sizes[k]}):
            left = list(rooms)
            left.remove(room)
            place(k + 1, [*left, room - sizes[k]])
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best[0]


def test_small_packings_are_the_best():
    draw = np.random.default_rng(3)
    for _ in range(60):
        capacity = int(draw.integers(10, 40))
        sizes = np.sort(draw.integers(1, capacity, draw.integers(1, 10)).astype(np.int32))[::-1].copy()
        island = packing.Island(sizes, packing.PackRules(capacity=capacity), np.random.default_rng(4))
        island.settle()
        island.breed()
        want = _fewest(sizes.tolist(), capacity)
        assert packing.fewest(sizes, capacity) <= want == island.people[0][0][0]


def test_children_are_whole_packings_and_better_ones_stay():
    draw = np.random.default_rng(5)
    sizes = np.sort(draw.integers(250, 420, 600).astype(np.int32))[::-1].copy()
    island = packing.Island(sizes, packing.PackRules(generations=12), np.random.default_rng(6))
    island.settle()
    first = island.people[0][0][0]
    island.breed()
    for score, own in island.people:
        assert sorted(i for b in own.bins for i in b) == list(range(600)) and score == own.score()
        assert own.fills == [int(sizes[b].sum()) for b in own.bins] and max(own.fills) <= 1024
        assert all(own.place[i] == k for k, b in enumerate(own.bins) for i in b)
    assert island.people[0][0][0] < 0.95 * first
    other = packing.Island(sizes, packing.PackRules(), np.random.default_rng(7))
    other.read(island.written(island.people[0][1]))
    assert other.people[0][0] == island.people[0][0]


def test_elites_migrate(spark):
    """The epochs never lose the best packing, and blocks at their bound stop."""
    draw = np.random.default_rng(8)
    rows = [(k, int(n)) for k, n in enumerate(draw.integers(250, 420, 900))]
    df = spark.createDataFrame(rows, "key long, length long")
    few = packing.pack_pieces(df, packing.PackRules(epochs=1, generations=2)).select("sequence").distinct().count()
    more = packing.pack_pieces(df, packing.PackRules(epochs=4, generations=4)).select("sequence").distinct().count()
    assert more <= few and more <= 1.03 * packing.fewest(np.array([n for _, n in rows]), 1024)
