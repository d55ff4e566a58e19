"""Whole results of operators that SQL cannot express, against plain versions over all rows and pairs."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import chat, decontamination, divergence, pii, sharding
from tidemark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _classes(text):
    def of(c):
        if ord(c) > 127:
            return "beyond_ascii"
        if c in "#*$%&|<>":
            return "symbol"
        if c in ".,;:!?'\"()-":
            return "stop"
        return "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "blank" if c in " \t\n\r\x0b\x0c" else "other_ascii"

    return Counter(map(of, text))


def _distance(p, q):
    """Jensen-Shannon distance in bits of two dicts of shares."""
    total = 0.0
    for k in set(p) | set(q):
        a, b = p.get(k, 0.0), q.get(k, 0.0)
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(0.0, total / 2))


def _repeated(words):
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    return len({k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)})


def _judged(rows, rules):
    """(class distance, word distance, kept) of each (text, lang) by the definition, over dicts."""
    words, classes, texts = defaultdict(Counter), defaultdict(Counter), Counter()
    passed = []
    for text, lang in rows:
        own = WORD.findall(text)
        passed.append(len(own) >= rules.least_words and 100 * _repeated(own) <= rules.most_repeat_percent * len(own))
        if passed[-1]:
            for g in {lang or "", ""}:
                words[g].update(own)
                classes[g].update(_classes(text))
                texts[g] += 1
    top = lambda g: [w for w, _ in sorted(words[g].items(), key=lambda x: (-x[1], x[0].encode()))[: rules.common_words]]
    share = lambda c: {k: n / sum(c.values()) for k, n in c.items()}
    references = {}
    for g in texts:
        weight = texts[g] / (texts[g] + rules.prior_documents) if g else 0.0
        blend = lambda own, every, keys: {k: weight * own.get(k, 0) + (1 - weight) * every.get(k, 0) for k in keys}  # noqa: E731, B023
        listed = set(top("")) | (set(top(g)) if g else set())
        by_word = blend(share(words[g]), share(words[""]), listed)
        references[g] = blend(share(classes[g]), share(classes[""]), set(classes[""])), by_word | {None: 1 - sum(by_word.values())}
    out = []
    for (text, lang), fine in zip(rows, passed):
        own = WORD.findall(text)
        ref = references.get(lang or "", references.get(""))
        a = _distance(share(_classes(text)), ref[0]) if ref and own and len(text.encode()) >= rules.class_chars else None
        by_word = Counter(w if w in ref[1] else None for w in own) if ref else None
        b = _distance(share(by_word), ref[1]) if ref and len(own) >= rules.word_words else None
        out.append((a, b, fine and (a or 0) <= rules.class_distance and (b or 0) <= rules.word_distance))
    return out


def test_divergence_equals_the_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rules = divergence.DivergenceRules()
    rows = docs.collect()
    want = dict(zip([r["doc_id"] for r in rows], _judged([(r["text"], r["lang"]) for r in rows], rules)))
    for blocks in (500_000, 1):  # all languages at once, and one at a time
        split = divergence.DivergenceRules(block_rows=blocks)
        got = {r["doc_id"]: r for r in divergence.divergence_quality(docs, split).collect()}
        assert set(got) == set(want)
        for i, (a, b, kept) in want.items():
            assert got[i]["kept"] == kept
            for mine, told in ((got[i]["class_distance"], a), (got[i]["word_distance"], b)):
                assert (mine is None) == (told is None) and (mine is None or mine == pytest.approx(told, abs=1e-9))
        assert {r["doc_id"] for r in divergence.kept_documents(docs, split).collect()} == {i for i, w in want.items() if w[2]}


def test_a_verdict_moves_little_as_a_language_grows(spark):
    """No step where a language gets a reference of its own: one document more or less changes the distance a little."""
    draw = np.random.default_rng(1)
    text = lambda letter: " ".join(f"{letter}{n}" for n in draw.integers(0, 40, 80))
    base = [(k, text("w"), "xx") for k in range(51)]
    other = [(1000 + k, text("v"), "yy") for k in range(200)]
    seen = []
    for many in (49, 50, 51):
        df = spark.createDataFrame(base[:many] + other, "doc_id long, text string, lang string")
        seen.append(divergence.divergence_quality(df).where("doc_id = 0").first()["word_distance"])
    assert abs(seen[0] - seen[1]) < 0.01 and abs(seen[1] - seen[2]) < 0.01, seen


def test_rows_with_null_and_repeated_ids_are_judged_by_themselves(spark):
    good = "a plain text of more than ten words that says nothing twice at all"
    bad = "again and again and again " * 10
    rows = [(None, good, "en"), (None, bad, "en"), (7, good + " indeed", "en"), (7, bad, "en"), (8, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "doc_id as _text", "'x' as `a.b`")
    kept = divergence.kept_documents(df)
    assert kept.columns == df.columns and {(r["doc_id"], r["text"]) for r in kept.collect()} == {(None, good), (7, good + " indeed")}
    items = spark.createDataFrame([(1, "again and again and again and again"), (2, None)], "item_id long, text string")
    for most in (2_000_000, 1):
        clean = decontamination.without_leaks(df, items, decontamination.LeakRules(block_bytes=most))
        assert clean.columns == df.columns
        assert Counter((r["doc_id"], r["text"]) for r in clean.collect()) == Counter([(None, good), (7, good + " indeed"), (8, None)])


def test_simhash_query_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op10_simhash"](spark, sf).collect()}
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    prints = {}
    for i, text in rows.items():
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        ones = Counter(b for s in shingles for h in [xxhash.xxh64_intdigest(s.encode(), 42)] for b in range(64) if h >> b & 1)
        prints[i] = sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    ids = sorted(prints)
    array = np.array([prints[i] for i in ids], np.uint64)
    label = {i: i for i in ids}
    find = lambda i: i if label[i] == i else find(label[i])
    for a, b in zip(*np.nonzero(np.bitwise_count(array[:, None] ^ array[None, :]) <= 2)):
        x, y = find(ids[a]), find(ids[b])
        label[max(x, y)] = min(x, y)
    assert {i: r["component_id"] for i, r in got.items()} == {i: find(i) for i in ids}


def _least_edits(item, text):
    """Least word edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for k, word in enumerate(item, 1):
        new = [k]
        for j, other in enumerate(text, 1):
            new.append(min(row[j - 1] + (word != other), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_leaks_equal_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    draw = np.random.default_rng(1)
    words = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: words(r["text"])[:400] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(25).collect()}
    for k, (i, own) in enumerate(items.items()):  # passages with edits, each in a text of its own
        edited = list(own)
        for _ in range(int(draw.integers(0, max(1, len(own) // 5) + 1))):
            at = int(draw.integers(0, len(edited)))
            edited[at : at + 1] = [[], ["new"], [edited[at], "more"]][int(draw.integers(0, 3))]
        docs[10_000 + k] = [f"x{j}" for j in range(20)] + edited + [f"y{j}" for j in range(20)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontamination.benchmark_leaks(df, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    want = {}
    for d, text in docs.items():
        for i, own in items.items():
            if len(set(own) & set(text)) >= 0.5 * len(set(own)):  # fewer shared words are more edits than allowed
                n = _least_edits(own, text)
                if n <= int(0.2 * len(own)):
                    want[d, i] = n
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(got) >= 0.95 * len(want) and len(want) >= len(items)


def test_sharding_equals_a_scan_of_all_bins(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select(F.md5("text").alias("g"), (F.octet_length("text") + 16).alias("n"))
    total = rows.agg(F.sum("n")).first()[0]
    items = sharding._items(rows, F.col("g"), F.col("n"), -(-total // 7), 7).select("_group", "_item", "_held").collect()
    sizes = Counter()
    for r in items:
        sizes[r["_item"]] += r["_held"]
    room, place = [sharding.level_capacity(sizes.values(), 7)] * 7, {}
    for name, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        fitting = [(room[b], b) for b in range(7) if room[b] >= n]
        b = min(fitting)[1] if fitting else max((room[b], b) for b in range(7))[1]
        room[b] -= n
        place[name] = b
    of = {r["_group"]: place[r["_item"]] for r in items}
    assert {(r["g"], r["shard"]) for r in sharding.pack_groups(rows, "g", "n", bins=7).collect()} == set(of.items())


@pytest.mark.parametrize(
    "text, found",
    [
        ('x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y', "04dbebab91ab85687d33eeaaf9ac699e1188f962"),
        ('!! TOKEN = "04DBEBAB91AB85687D33EEAAF9AC699E1188F962"!!', "04DBEBAB91AB85687D33EEAAF9AC699E1188F962"),
        ("api_key: sk-abc123DEF456ghi789 x", "sk-abc123DEF456ghi789"), ("apiKey=abcd1234efgh5678", "abcd1234efgh5678"),
        ("password='hunter2hunter'", "hunter2hunter"), ("Authorization: Bearer eyJhbGciOi.J9abc.d1 x", "eyJhbGciOi.J9abc.d1"),
        ("my_secret=>abcdef1234567890", "abcdef1234567890"), ("the key = value of all things", None), ("Bearer of tokens and news", None),
        ("token = aaaaaaaaaaaaaaaaaaaaaaaa", None), ("token = 12345678901234567890", None), ("monkey = 1234567890abcdefg", None), ("token=", None),
        ('token = "short1"', None),
    ],
)
def test_credentials_behind_cues(text, found):
    spans = pii.find_spans(text)
    assert [text[a:b] for a, b in spans["secret"]] == ([found] if found else [])
    assert not spans["email"] and not spans["ip"]


def test_planted_credentials_are_all_found(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r["n_secret"] for r in QUERIES["op4_personal_data"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        assert got[r["doc_id"]] == len(re.findall(r'(?i)token = "[0-9a-f]{40}"', r["text"] or ""))


def test_a_long_conversation_is_formatted_and_read_back(spark):
    turns = spark.range(6000).selectExpr(
        "1 as conv_id", "id as turn", "if(id % 3 = 0, 'user', 'assistant') as role", "concat('é<|x|> ', repeat('word ', cast(id % 400 as int)), id) as text"
    )
    told = chat.chat_digests(chat.format_chats(turns)).first()
    rows = turns.orderBy("turn").collect()
    loss = "".join(r["text"] for r in rows if r["role"] == "assistant")
    import hashlib

    assert told["n_turns"] == 6000 and told["loss_chars"] == len(loss)
    assert told["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert told["turns_sha256"] == hashlib.sha256("".join(f"{r['role']}\n{r['text']}\n" for r in rows).encode()).hexdigest()
