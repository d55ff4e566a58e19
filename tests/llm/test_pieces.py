"""The operators' parts against plain versions of them, without Spark."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import decontamination as leaks
from tidemark.llm import divergence, pii, sharding, simhash, token_counts, toxicity
from tidemark.llm.work import text_slices

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_token_counts_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        counter = token_counts.TokenCounter(file.read())
    library = Tokenizer.from_file(path)
    draw = random.Random(1)
    letters = "ab'sStlvd  \n\t\r\x85\xa0 　\x1c\x1f\x00é世界①Ⅷ½١२🙂́‍.,-"
    texts = ["", " ", "a" * 5000, "ab" * 3000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", " \n" * 400]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    assert [counter.count(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_memory_of_pieces_is_bounded(monkeypatch):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        counter = token_counts.TokenCounter(file.read())
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    texts = [f"word{k} thing{k * 7}" for k in range(300)]
    first = [counter.count(t) for t in texts]
    assert len(counter.known) <= 50 and first == [counter.count(t) for t in texts]


def plain_spans(text: str) -> dict:
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    found = {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]}
    found["ip"] = [
        m.span()
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(x) <= 255 for x in m[0].split("."))
    ]
    found["card"] = [
        m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))
    ]
    found["phone"] = [
        m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15
    ]
    return found


def test_base_spans_equal_the_patterns():
    draw = random.Random(2)
    parts = ["1.2.3.4", "4111 1111 1111 1111", "+1 (375) 555-4393", "a.b@c.d", "@", ".", "+", " ", "-", "12", "256", "é", "9" * 30]
    for k in range(20_000):
        some = "a@.+-0123459 ()%é" if k % 2 else parts
        text = "".join(draw.choice(some) for _ in range(draw.randint(0, 40 if k % 2 else 9)))
        spans, want = pii.find_spans(text), plain_spans(text)
        assert {kind: spans[kind] for kind in want} == want, text


def test_further_spans_and_redaction():
    text = "IBAN: DE89 3704 0044 0532 0130 00, account no. 12345678; see https://u:p@a.example.org/x?y=1. Accountant 5"
    spans = pii.find_spans(text)
    assert [text[a:b] for a, b in spans["account"]] == ["DE89 3704 0044 0532 0130 00", "12345678"]
    assert [text[a:b] for a, b in spans["url"]] == ["https://u:p@a.example.org/x?y=1"]
    assert pii.redacted("mail a@b.c now", pii.find_spans("mail a@b.c now")) == "mail <email> now"
    assert not any(pii.find_spans("an account of 12 days, iban unknown").values())


def test_repeated_words_and_lines():
    plain = lambda w: len(
        {i + j for i in range(len(w) - 4) if Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))[tuple(w[i : i + 5])] > 1 for j in range(5)}
    )
    draw = random.Random(3)
    for _ in range(300):
        words = [draw.choice([b"a", b"b"]) for _ in range(draw.randint(0, 40))]
        assert divergence.repeated_words(words) == plain(words)
    assert divergence.duplicate_lines(b"a\nb\na\n\n \na") == 2


def test_divergence_distance():
    p, q = np.array([1.0, 0.0]), np.array([0.0, 3.0])
    assert divergence.js_distance(p, q) == pytest.approx(1.0)
    assert divergence.js_distance(p, p * 7) == pytest.approx(0.0)
    assert divergence.js_distance(p, np.zeros(2)) == 0
    assert divergence.class_histogram("Aé 1#".encode()).tolist() == [0, 1, 1, 1, 0, 1, 0, 1]


def test_capacity_tree_is_a_sorted_set():
    tree, held, draw = sharding.CapacityTree(), [], random.Random(4)
    for _ in range(3000):
        key = (draw.randint(0, 50), draw.randint(0, 9999))
        if held and draw.random() < 0.45:
            key = held.pop(draw.randrange(len(held)))
            tree.remove(key)
        elif key not in held:
            held.append(key)
            tree.insert(key)
        size = draw.randint(0, 55)
        assert tree.best_fit(size) == min((k for k in held if k[0] >= size), default=None)
    assert tree.root[3] <= 1.45 * np.log2(len(held) + 2)


def test_best_fit_decreasing_equals_a_scan():
    draw = random.Random(5)
    for _ in range(50):
        items = [(k, draw.randint(1, 60)) for k in range(draw.randint(0, 60))]
        room, want = [], {}
        for key, size in sorted(items, key=lambda x: (-x[1], x[0])):
            fits = [(r, b) for b, r in enumerate(room) if r >= size]
            b = min(fits)[1] if fits else len(room)
            if not fits:
                room.append(50)
            room[b] -= size
            want[key] = b
        assert sharding.best_fit_decreasing(items, 50) == want
    assert set(sharding.best_fit_decreasing([(k, 5) for k in range(8)], 10, bins=4).values()) == {0, 1, 2, 3}
    assert sharding.level_capacity([100, 5, 5, 5, 5], 3) == 10


def test_fingerprint_equals_the_definition():
    def plain(text: str) -> int:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text).encode())
        if not words:
            return 0
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    draw = random.Random(6)
    texts = ["", " \n", "a", "a B", "É a b c", "x y z w\x85v"] + [" ".join(draw.choice("abÄcD") for _ in range(n)) for n in range(60)]
    assert [simhash.fingerprint(t.encode()) for t in texts] == [plain(t) for t in texts]


@pytest.mark.parametrize("distance", [0, 2, 9])
def test_gray_tree_finds_exactly_the_near_pairs(distance):
    draw = np.random.default_rng(7)
    base = draw.integers(0, 2**63, 40, dtype=np.uint64)
    flips = [np.uint64(1) << draw.integers(0, 64, 1500).astype(np.uint64) for _ in range(3)]
    prints = np.unique(base[draw.integers(0, 40, 1500)] ^ flips[0] ^ flips[1] ^ flips[2])
    node = np.sort(draw.integers(0, 5, len(prints)))
    gray = prints.copy()
    for k in (1, 2, 4, 8, 16, 32):
        gray ^= gray >> np.uint64(k)
    prints = prints[np.lexsort((gray, node))]
    got = {p for a, b in simhash.GrayTree(prints, node).links(distance) for p in zip(a.tolist(), b.tolist())}
    near = (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= distance) & (node[:, None] == node[None, :])
    assert got == {(a, b) for a, b in zip(*(x.tolist() for x in np.nonzero(near))) if a < b}


def test_masks_miss_no_pair_within_the_distance():
    draw = random.Random(8)
    top = simhash.upper_masks(2)
    for _ in range(500):
        apart = sum(1 << b for b in draw.sample(range(64), 2))
        agreeing = [m for m in top if not m & apart]
        assert agreeing
        for mask in agreeing:
            assert any(not m & apart for m in simhash.lower_masks(mask, 2))


def test_nearest_forest_joins_what_the_pairs_join():
    draw = np.random.default_rng(9)
    a, b = draw.integers(0, 60, (2, 80))
    a, b = a[a != b], b[a != b]
    apart = draw.integers(0, 9, len(a))
    kept = simhash._nearest_forest(60, a, b, apart)
    label = simhash._joined(np.arange(60), a, b)
    assert (simhash._joined(np.arange(60), a[kept], b[kept]) == label).all()
    assert len(kept) == 60 - len(np.unique(label))


def test_edit_distance_within_a_text():
    def plain(item, text):
        row = [0] * (len(text) + 1)
        for k, w in enumerate(item, 1):
            new = [k]
            for j, x in enumerate(text, 1):
                new.append(min(row[j - 1] + (x != w), row[j] + 1, new[-1] + 1))
            row = new
        return min(row)

    draw = random.Random(10)
    for _ in range(200):
        item, text = ([draw.randint(0, 3) for _ in range(draw.randint(1, 12))] for _ in range(2))
        assert leaks.edit_distance_within(np.array(item), np.array(text)) == plain(item, text)


def test_word_hashes_are_those_of_the_words():
    texts = ["A b\tC", None, "", "  ", "x", "a b c", "é a", "b"]
    hashes, bounds = leaks.word_hashes(pa.array(texts, pa.string()))
    words = [[] if t is None else t.lower().split() for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in words]
    by_word = {}
    for w, h in zip((w for own in words for w in own), hashes.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


@pytest.mark.parametrize("edits", [0.0, 0.1, 0.2])
def test_leaks_are_found_up_to_the_edits_allowed(edits):
    draw = random.Random(11)
    vocabulary = [b"w%d" % k for k in range(3000)]
    items = [[draw.choice(vocabulary) for _ in range(draw.randint(4, 60))] for _ in range(150)]
    index = leaks.ItemIndex([(k, b" ".join(w)) for k, w in enumerate(items)], leaks.LeakRules())
    found = 0
    for k, item in enumerate(items):
        own = list(item)
        for _ in range(int(edits * len(own))):
            place = draw.randrange(len(own))
            if draw.random() < 0.5:
                own[place] = b"z%d" % draw.randrange(10**6)
            elif draw.random() < 0.5:
                own.insert(place, b"y")
            else:
                own.pop(place)
        text = [draw.choice(vocabulary) for _ in range(50)]
        words, bounds = leaks.word_hashes(pa.array([b" ".join(text), b" ".join(text[:20] + own + text[20:])], pa.binary()))
        got = index.verified(words, bounds)
        assert not any(t == 0 for t, _ in got)
        found += (1, k) in got
    assert found >= (150 if not edits else 0.9 * 150)


def test_label_model_finds_the_poor_voter():
    draw = np.random.default_rng(12)
    truth = draw.random(4000) < 0.3
    votes = []
    for accuracy, cover in ((0.95, 0.9), (0.9, 0.7), (0.85, 0.8), (0.5, 0.9)):
        right = draw.random(4000) < accuracy
        said = np.where(right == truth, 1, -1)
        votes.append(np.where(draw.random(4000) < cover, said, 0))
    votes.append(votes[-1])  # a copy of the poor voter adds nothing
    model = toxicity.LabelModel(np.stack(votes, 1))
    assert ((model.posterior > 0.5) == truth).mean() > 0.95
    assert model.weight[-1] < 0.7 < model.weight[0]


def test_text_slices_cover_a_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 50, "", "c"])], ["text"])
    parts = list(text_slices(batch, most=12))
    assert [p.num_rows for p in parts] == [2, 1, 2] and sum(p.num_rows for p in parts) == 5


@pytest.mark.parametrize("length", range(1, 25))
def test_leaks_are_found_at_every_length(length):
    draw = np.random.default_rng(length)
    edits, trials = int(0.2 * length), 120
    items = [[f"w{x}".encode() for x in draw.integers(0, 10**6, length)] for _ in range(trials)]
    index = leaks.ItemIndex([(k, b" ".join(w)) for k, w in enumerate(items)], leaks.LeakRules())
    found = 0
    for k, item in enumerate(items):
        own = list(item)
        for n in range(edits):
            at, kind = int(draw.integers(len(own))), int(draw.integers(3))
            own[at : at + (kind < 2)] = [f"n{n}".encode()] if kind else []
        text = [f"t{x}".encode() for x in draw.integers(0, 10**6, 40)]
        words, bounds = leaks.word_hashes(pa.array([b" ".join(text[:20] + own + text[20:])], pa.binary()))
        found += (0, k) in index.verified(words, bounds)
    assert found >= (trials if length < 16 else 0.9 * trials)
