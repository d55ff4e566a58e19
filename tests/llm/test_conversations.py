"""Conversation repair and the prefix trie: brute force, odd rows, long conversations, any size of sketch."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import prefixes, repair

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()
AUDITS = {"K": "K", "D": "D", "U": "R", "A": "R", "u": "I", "a": "I"}


def _cheapest(symbols):
    """The least (cost, audit, roles) over all edits, with up to two inserted turns at each place."""
    gaps = ["", "u", "a", "uu", "ua", "au", "aa"]
    best = None
    for codes in itertools.product("DKUA", repeat=len(symbols)):
        if any(s == "x" and c != "D" or c == "K" and s.lower() not in "sua" for s, c in zip(symbols, codes)):
            continue
        for turns in itertools.product(gaps, repeat=len(symbols) + 1):
            told = turns[0] + "".join(c + t for c, t in zip(codes, turns[1:]))
            at, roles, cost = 0, "", 0
            for c in told:
                if c in "KDUA":
                    s = symbols[at]
                    at += 1
                    cost += {"K": 0, "D": 4, "U": 3, "A": 3}[c] + (3 if s.isupper() and c != "D" else 0)
                    roles += "" if c == "D" else s.lower() if c == "K" else c.lower()
                else:
                    cost += 3
                    roles += c
            if re.fullmatch("(s?(ua)+)?", roles):
                best = min(filter(None, (best, (cost, "".join(AUDITS[c] for c in told), roles))))
    return best


@pytest.mark.parametrize("symbols", ["".join(p) for n in range(3) for p in itertools.product("sSuaAox", repeat=n)] + ["xua", "saU", "auS", "ssA", "uuu", "Aax"])
def test_parser_equals_all_edits(symbols):
    cost, codes = repair.Parser().repair(symbols)
    told = "".join(codes)
    roles, at = "", 0
    for c in told:
        roles += {"K": symbols[at].lower() if at < len(symbols) else "", "D": ""}.get(c, c.lower())
        at += c in "KDUA"
    assert (cost, told.translate(repair.AUDIT), roles) == _cheapest(symbols)


def test_parser_reads_long_conversations_in_linear_steps():
    parser = repair.Parser()
    symbols = "".join(np.random.default_rng(1).choice(list("suaUAox"), 200_000))
    cost, codes = parser.repair(symbols)
    assert len(codes) == len(symbols) and len(parser.steps) < 5_000
    halves = parser.repair(symbols[:100_000])[0] + parser.repair(symbols[100_000:])[0]
    assert cost <= halves + repair.SLACK and halves <= cost + repair.SLACK


ROWS = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (1, 4, "assistant", "Hello."),
    (2, None, None, "x."), (2, 0, "user", None), (2, 3, "user", "cut off"), (2, 3, "user", "cut off"), (None, 5, "assistant", "a?"),
    (3, 7, "tool", "t. \n"), (4, 0, "user", "\t"), (5, 1, "user", "q?"), (5, 1, "assistant", "r!"), (6, 0, "", "e."),
]


def _reports(rows):
    """The plain version over lists, by the parser's own codes."""
    by_conv = defaultdict(list)
    for c, t, r, x in rows:
        by_conv[c].append((t if t is not None else -1, " " if r is None else r, " " if x is None else x))
    out = {}
    for conv, own in by_conv.items():
        own.sort()
        seen, symbols, kinds = set(), "", Counter()
        for _, r, x in own:
            body = x.strip(" \t\n\x0b\x0c\r")
            kind = "blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((r, x))
            kinds[kind] += 1
            symbol = r[:1] if r[:1] in ("s", "u", "a") else "o"
            symbols += "x" if kind in ("blank", "duplicate") else symbol.upper() if kind else symbol
        cost, codes = repair.Parser().repair(symbols)
        turns = []
        for (_, r, x), code in zip(own, codes):
            for c in code:
                if c != "D":
                    turns.append({"K": f"{r}:{x}", "U": f"user:{x}", "A": f"assistant:{x}", "u": "user:", "a": "assistant:"}[c])
        times = [t for t, *_ in own if t != -1]
        gaps = max(times) - min(times) + 1 - len(set(times)) if times else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        told = hashlib.sha256("\n".join(turns).encode()).hexdigest()
        out[conv] = (gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, "".join(codes).translate(repair.AUDIT), told)
    return out


@pytest.mark.parametrize("segment", [4096, 2])
def test_repair_of_odd_rows(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment)
    draw = np.random.default_rng(2)
    more = [(9, int(k), str(draw.choice(["user", "assistant"])), str(draw.choice(["a.", "b", " ", "c!"]))) for k in draw.integers(0, 90, 60)]
    df = spark.createDataFrame(ROWS + more, SCHEMA).selectExpr("*", "'x' as cost", "'y' as audit", "1 as segment")
    ids = spark.createDataFrame([(c,) for c in {r[0] for r in ROWS + more} | {77}], "conv_id long")
    got = {r[0]: tuple(r)[1:] for r in repair.repair_digests(repair.repair_conversations(df, ids)).collect()}
    assert got == _reports(ROWS + more) | {77: (0, 0, 0, 0, 0, 0, "", EMPTY)}
    turns = repair.repair_conversations(df).turns.where("conv_id = 9").orderBy("position").collect()
    assert [r["position"] for r in turns] == list(range(len(turns)))
    assert re.fullmatch("(ua)*", "".join(r["role"][0] for r in turns))


def test_repair_of_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_digests(repair.repair_conversations(repair.damaged(none), none)).count() == 0


def test_damage_of_nulls(spark):
    rows = [(None, k, None, None) for k in range(60)] + [(k, None, "user", "a. b!") for k in range(60)]
    got = Counter(tuple(r) for r in repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect())
    want = Counter()
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        if kind:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            want[c, t, "user" if kind == 4 else r, x] += 2 if kind == 3 else 1
    assert got == want


def _trie(rows, family=20, heads=4):
    by_conv = defaultdict(list)
    for c, t, r, x in rows:
        by_conv[c].append((-1 if t is None else t, r or "", x or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in by_conv.items()}
    nodes = defaultdict(list)
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads if c is not None else 0
        built[c] = (own.get(c - c % family, [])[:h] if c is not None else []) + turns[h:]
        for d in range(len(built[c]) + 1):
            nodes[tuple(built[c][:d])].append(c)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        childless = lambda p: not any(len(q) == len(p) + 1 and q[:-1] == p for q in nodes)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode().split()) for p in under if p)
        ends = sorted(c for c in members if c is not None and len(built[c]) == len(path))
        least = lambda m: min((c for c in m if c is not None), default=None)
        out.append(
            (least(members), len(path), least(nodes[path[:-1]]) if path else None, len(members), sum(len(p) == len(path) + 1 for p in under),
             sum(map(childless, under)), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
        )
    return Counter(out)


@pytest.mark.parametrize("bits, part", [(24, 4096), (2, 3)])
def test_trie_equals_a_plain_version(spark, monkeypatch, bits, part):
    """Also with a sketch too small to prove anything, and with conversations in parts of three turns."""
    monkeypatch.setattr(prefixes, "PART", part)
    if bits == 2:
        monkeypatch.setattr(prefixes, "SKETCH_BITS", (2, 2))
    draw, rows = np.random.default_rng(3), []
    for c in range(70):
        for k in range(int(draw.integers(0, 9))):
            rows.append((c, k, str(draw.choice(["user", "assistant"])), str(draw.choice(["a b", "c", "d e f"], p=[0.7, 0.2, 0.1]))))
    rows += [(100, k, "user", f"w {k}") for k in range(30)] + [(101, k, "user", f"w {k}") for k in range(31)]
    rows += [(None, 0, "user", "a b"), (None, None, None, None), (41, 2, "user", "c"), (41, 2, "user", "c"), (200, 0, None, "x")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as depth", "1 as p1", "2 as n_convs")
    turns, lengths = prefixes.rebuilt_turns(df)
    got = Counter(tuple(r) for r in prefixes.prefix_trie(turns, lengths, most_bits=bits).collect())
    want = _trie(rows)
    assert got == want


def test_trie_of_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefixes.conversation_trie(none).count() == 0
    one = prefixes.conversation_trie(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)).collect()
    assert Counter(tuple(r) for r in one) == _trie([(1, 0, "user", "a")])


def test_estimates_of_one_are_proofs(spark):
    draw = np.random.default_rng(4)
    keys = draw.integers(-(2**62), 2**62, (400, 2))
    rows = [(int(k % 7) + 1, *map(int, keys[k])) for k in [*range(400), *range(100)]]
    df = spark.createDataFrame(rows, "depth long, p1 long, p2 long")
    for bits in (4, 12):
        sketch = prefixes.CountMin(bits)
        single = sketch.single(sketch.counted(df), *(np.array(c, np.int64) for c in zip(*rows)))
        often = Counter(rows)
        assert not any(s and often[r] > 1 for s, r in zip(single, rows))
        assert bits == 4 or single.sum() > 250
