"""The operators on Spark: odd rows, empty tables, clashing names, and plain versions of whole results."""

import hashlib
import importlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, decontamination, divergence, line_dedup, mixing, pii, sharding, simhash, toxicity
from tidemark.llm.queries import QUERIES
from tidemark.llm.token_counts import token_counts

corpus_pipeline = importlib.import_module("corpus_pipeline")

LONG = "the quick brown fox jumps over a lazy dog and then some more words follow it. " * 3000
ODD = [
    (1, "one two three four five six\nseven eight nine ten eleven\n\none two three four five six", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \n\t ", "de", "b"),
    (5, LONG, "en", "b"),
    (6, "Write to me at a.b@example.org or +1 (375) 555-4393, card 4111 1111 1111 1111, host 10.0.0.1", "en", "a"),
    (6, "Write to me at a.b@example.org or +1 (375) 555-4393, card 4111 1111 1111 1111, host 10.0.0.1", "en", "a"),
    (7, "one two three four five six\nseven eight nine ten eleven\n\none two three four five six", "fr", "a"),
    (None, "a row without an id", "en", "a"),
    (None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = ("size", "shard", "fingerprint", "n_words", "kept", "spans", "block", "text_crc32", "words", "line", "n", "root", "item_id", "a.b")


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (5, 1), (None, 1), (6, None), (7, 3)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "seven eight nine ten eleven"), (2, None), (3, ""), (None, "one two"), (4, "lazy dog and then some more words"), (1, "seven eight nine ten eleven")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_token_counts_of_odd_rows(odd, none, vocabulary):
    rows = token_counts(odd, vocabulary).collect()
    assert len(rows) == len(ODD)
    assert Counter((r["doc_id"], r["n_bytes"]) for r in rows) == Counter((i, len((t or "").encode())) for i, t, *_ in ODD)
    assert all((r["n_tokens"] == 0) == (r["n_bytes"] == 0) and r["over_limit"] == (r["n_tokens"] > 512) for r in rows)
    assert token_counts(none, vocabulary).count() == 0


def test_divergence_of_odd_rows(odd, none):
    rows = divergence.divergence_quality(odd).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        texts = {(t or "") for i, t, *_ in ODD if i == r["doc_id"]}
        assert r["n_words"] in {len(t.encode().split()) for t in texts}
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert divergence.divergence_quality(none).count() == 0


def test_divergence_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r for r in divergence.divergence_quality(docs).collect()}
    for r in docs.collect():
        words, mine = r["text"].encode().split(), got[r["doc_id"]]
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        often = Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
        lines = [x for x in r["text"].split("\n") if x.strip(" \t\n\r\x0b\x0c")]
        assert mine["n_words"] == len(words) and mine["n_repeat_words"] == len(covered)
        assert mine["word_chars"] == sum(len(w.decode()) for w in words)
        assert mine["n_symbols"] == sum(r["text"].count(c) for c in "#*$%&|<>")
        assert mine["n_dup_lines"] == len(lines) - len(set(lines))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [got[i]["kept"] for i, q in labels.items() if q == 1 and not got[i]["base_failed"]]
    assert sum(clean) >= 0.97 * len(clean)


def test_personal_data_of_odd_rows(odd, none):
    rows = pii.personal_data(odd).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        if r["doc_id"] == 6:
            text = ODD[5][1]
            want = f"email:15:30,ip:{text.index('10.0')}:{len(text)},card:{text.index('4111')}:{text.index(', host')},phone:34:51"
            assert r["spans"] == want and r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        else:
            assert r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data(none).count() == 0


def test_toxicity_of_odd_rows(odd, none, labels):
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert toxicity.toxicity(none, labels).count() == 0
    assert toxicity.toxicity(odd, labels.limit(0)).where("predicted = 1").count() == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op5_toxicity"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(got[r["doc_id"]]["predicted"], r["toxic"]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert sum(p == t for p, t in held) >= 0.95 * len(held)
    assert not any(p and not t for p, t in held)


def test_line_dedup_of_odd_rows(odd, none):
    rows = line_dedup.similar_lines(odd).collect()
    assert len(rows) == sum((t or "").count("\n") + 1 for _, t, *_ in ODD)
    by_place = defaultdict(set)
    for r in rows:
        by_place[r["doc_id"], r["line_no"]].add((r["class_doc"], r["class_line"], r["n_links"], r["removed"]))
    assert by_place[1, 0] == {(1, 0, 0, False)} and by_place[1, 3] == {(1, 0, 0, True)}
    assert by_place[7, 1] == {(1, 1, 0, True)} and by_place[7, 2] == {(7, 2, 0, False)}
    assert line_dedup.similar_lines(none).count() == 0
    texts = {r["doc_id"]: r for r in line_dedup.without_repeated_lines(odd.where("doc_id in (1, 7)")).collect()}
    assert texts[7]["text"] == "" and texts[1]["n_removed"] == 1


def test_unlike_long_lines_are_no_candidates(spark):
    """Lines of 150 words out of 600 meet on their rarest words; only those that are similar are sent on to be verified."""
    rng = random.Random(5)
    lines = [rng.sample(range(600), 150) for _ in range(40)]
    lines += [x[:-3] + [600 + k, 700 + k, 800 + k] for k, x in enumerate(lines[:8])]
    docs = [(k, " ".join(f"w{w}" for w in x)) for k, x in enumerate(lines)]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    sets = line_dedup.line_sets(documents, 80).withColumn("id", F.col("doc_id"))
    pairs = {tuple(sorted(r)) for r in line_dedup._meetings(sets, 80).collect()}
    assert pairs == {(k, 40 + k) for k in range(8)}
    found = {r["doc_id"]: (r["n_links"], r["removed"]) for r in line_dedup.similar_lines(documents).collect()}
    assert found == {k: (int(k < 8 or k >= 40), k >= 40) for k in range(48)}


def test_lines_of_a_large_group_are_verified_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "GROUP_LINES", 4)
    common = " ".join(f"w{k}" for k in range(20))
    documents = spark.createDataFrame([(k, f"{common} own{k}") for k in range(30)], "doc_id long, text string")
    rows = line_dedup.similar_lines(documents).collect()
    assert {(r["doc_id"], r["n_links"], r["removed"]) for r in rows} == {(k, 29, k > 0) for k in range(30)}


def test_line_dedup_links(spark):
    base = [f"w{k}" for k in range(10)]
    docs = [(1, " ".join(base)), (2, " ".join([*base[:9], "new"])), (3, " ".join([*base, "x", "y"])), (4, " ".join(base[:7])), (5, "w1 w0"), (6, "w0  w1 w1")]
    rows = {r["doc_id"]: r for r in line_dedup.similar_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {i: r["n_links"] for i, r in rows.items()} == {1: 2, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0}
    assert {i for i, r in rows.items() if r["removed"]} == {2, 3, 6}


def test_sharding_of_odd_rows(odd, none):
    rows = sharding.shard_documents(odd, 4).collect()
    assert len(rows) == len(ODD)
    slots, shards = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        shards[r["size"], r["text_crc32"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values()) and set(slots) <= set(range(4))
    assert sharding.shard_documents(none).count() == 0


def test_sharding_levels_the_table(spark, sf):
    rows = sharding.shard_documents(spark.read.parquet(f"{sf}/documents.parquet"), 10).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 10 and max(sizes.values()) < 1.05 * min(sizes.values())


def test_numbering_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "NUMBERED_ROWS", 20)
    rows = sharding.numbered(spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("shard")), "shard", ["doc_id"]).collect()
    for shard in range(3):
        own = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert own == list(range(len(own)))


def test_capacity_packing_keeps_groups(spark):
    df = spark.createDataFrame([(k, f"g{k % 7}", k % 5) for k in range(70)], "id long, group string, size int")
    rows = sharding.pack_groups(df, "group", "size", capacity=60).collect()
    held, of = Counter(), defaultdict(set)
    for r in rows:
        held[r["shard"]] += r["size"]
        of[r["group"]].add(r["shard"])
    assert len(rows) == 70 and max(held.values()) <= 60 and all(len(s) == 1 for s in of.values())


def test_leaks_of_odd_rows(odd, none, benchmark):
    rows = decontamination.benchmark_leaks(odd, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in rows) == [(1, 1, 0), (5, 4, 0), (7, 1, 0)]
    blocks = decontamination.benchmark_leaks(odd, benchmark, decontamination.LeakRules(block_bytes=1)).collect()
    assert sorted(rows) == sorted(blocks)
    assert decontamination.benchmark_leaks(none, benchmark).count() == 0
    assert decontamination.benchmark_leaks(odd, benchmark.limit(0)).count() == 0


def test_leaks_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    plain = lambda t: " " + " ".join(t.encode().lower().split and [w.decode() for w in t.encode().lower().split()]) + " "
    docs = [(r["doc_id"], plain(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], plain(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = QUERIES["op8_benchmark_leaks"](spark, sf).collect()
    assert {(d, i) for d, t in docs for i, x in items if x in t} == {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0}


def test_chats_of_odd_rows(spark):
    rows = [
        (1, 0, "user", "a<|turn|>\\"), (1, 1, "user", "</s>[INST]"), (1, 2, "assistant", "é\\<|"), (1, 3, "assistant", None),
        (2, None, None, "x"), (None, 0, "assistant", ""), (1, 2, "assistant", "é\\<|"), (3, 1, "a<|end|>", "\n"), (3, 0, "assistant", "<<|"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    formatted = chat.format_chats(df)
    told = {r["conv_id"]: r for r in chat.chat_digests(formatted).collect()}
    outputs = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    assert outputs[1].count(chat.TURN) == 2  # adjacent turns of a role are merged
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        mine = told[conv]
        assert mine["n_turns"] == len(turns) and mine["loss_chars"] == len(loss)
        assert mine["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert mine["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert mine["formatted_chars"] == len(outputs[conv])
    assert chat.format_chats(df.limit(0)).count() == 0


def test_simhash_of_odd_rows(odd, none):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == len(ODD)
    assert {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16} == {2}
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 7)} == {1}
    assert simhash.simhash_groups(none).count() == 0
    kept = simhash.simhash_dedup(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == [-1, 1, 2, 5, 6]
    assert simhash.simhash_dedup(none).count() == 0


@pytest.mark.parametrize("node_rows", [20_000, 3])
def test_simhash_groups_equal_all_pairs(spark, node_rows):
    draw = np.random.default_rng(1)
    base = draw.integers(0, 2**63, 30, dtype=np.uint64)
    flips = [np.uint64(1) << draw.integers(0, 64, 400).astype(np.uint64) for _ in range(2)]
    prints = np.unique(base[draw.integers(0, 30, 400)] ^ flips[0] ^ flips[1])
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fingerprint long")
    root = {r["member"]: r["root"] for r in simhash.components(simhash.near_links(frame, 2, node_rows)).collect()}
    a, b = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)
    label = simhash._joined(np.arange(len(prints)), a, b)
    mine = [root.get(int(x), int(x)) for x in prints.view(np.int64)]
    assert len(set(zip(mine, label.tolist()))) == len(set(mine)) == len(set(label.tolist()))


def _kept_by_all_pairs(rows):
    """Ids that stay by the definition, over all pairs of (id, text)."""
    prints = np.array([simhash.fingerprint(t.encode()) for _, t in rows], np.uint64)
    words = [t.encode().lower().split() for _, t in rows]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in words]
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    pairs = [(a, b) for a, b in zip(*(x.tolist() for x in np.nonzero(apart <= 11))) if a < b]
    same = [(a, b) for a, b in pairs if not apart[a, b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    label = simhash._joined(np.arange(len(rows)), *(np.array([p[k] for p in same], np.int64) for k in (0, 1)))
    return {i for k, (i, _) in enumerate(rows) if label[k] == k}, apart, sets, same


def _varied(draw, base, edits):
    out = list(base)
    for k in draw.integers(0, len(base), edits):
        out[k] = f"x{draw.integers(10**9)}"
    return out


def test_simhash_dedup_misses_no_pair_up_to_its_distance(spark):
    draw, rows = np.random.default_rng(3), []
    for _ in range(1500):
        base = [f"w{k}" for k in draw.integers(0, 10**6, 60)]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(_varied(draw, base, 1)))]
    want, apart, _, same = _kept_by_all_pairs(rows)
    assert sum(apart[a, b] >= 9 for a, b in same) > 100
    got = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id").collect()
    assert {r["doc_id"] for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("node_rows, block", [(20_000, 1_000), (300, 40)])
def test_simhash_dedup_checks_every_pair_of_a_family(spark, monkeypatch, node_rows, block):
    monkeypatch.setattr(simhash, "BLOCK_TEXTS", block)
    draw, rows = np.random.default_rng(4), []
    for size, many in ((400, 1), (5, 40)):  # a dense family, and small ones with texts between two copies
        for _ in range(many):
            base = [f"w{k}" for k in draw.integers(0, 10**6, 60)]
            rows += [(len(rows) + k, " ".join(_varied(draw, base, int(draw.integers(1, 4))))) for k in range(size)]
    want, apart, _, same = _kept_by_all_pairs(rows)
    linked = np.zeros(apart.shape, bool)
    linked[tuple(zip(*same))] = True
    linked |= linked.T
    # a text nearer to both than they are to each other, and linked to neither
    assert any(((np.maximum(apart[a], apart[b]) < apart[a, b]) & ~linked[a] & ~linked[b]).any() for a, b in same)
    got = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"), node_rows=node_rows).select("doc_id").collect()
    assert {r["doc_id"] for r in got} == want and len(got) == len(want)


def test_simhash_dedup_keeps_a_row_of_each_group(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcd")
    rows = [(None, a), (None, b), (None, a), (7, c), (7, d), (7, c), (8, d)]
    got = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter([(None, a), (None, b), (7, c), (7, d)])


def test_components_of_a_long_path(spark):
    links = spark.range(200).select((F.col("id") + 1).alias("high"), F.col("id").alias("low"))
    assert {r["root"] for r in simhash.components(links).collect()} == {0}


def test_mixing_of_odd_rows(odd, none):
    for rules in (mixing.MixRules(), mixing.MixRules(budget=None), mixing.MixRules(entropy=None, most_repeats=None, budget=3.0)):
        rows = mixing.mix_sources(odd, rules).collect()
        places = Counter((r["source"], r["block"], r["position"]) for r in rows)
        assert max(places.values()) == 1 and {r["source"] for r in rows} <= {"a", "b"}
    assert mixing.mix_sources(none).count() == 0
    kept = mixing.mix_documents(odd.where("source is not null"), mixing.MixRules(budget=None))
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 4, 5, 6, 7, None}


def test_mix_reaches_the_target(spark):
    rows = [(k, "w " * 10, "big" if k % 10 else "small") for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    share = lambda rules: {
        r["source"]: r["n"] for r in mixing.mix_sources(df, rules).groupBy("source").agg((F.sum("n_tokens") / 20000).alias("n")).collect()
    }
    flat = share(mixing.MixRules(entropy=0.9, most_repeats=None))
    entropy = -sum(p * np.log(p) for p in flat.values()) / np.log(2)
    assert entropy == pytest.approx(0.9, abs=0.01)
    assert share(mixing.MixRules(entropy=1.0, most_repeats=2.0))["small"] == pytest.approx(0.2, abs=0.01)
    assert mixing.mix_documents(df, mixing.MixRules(budget=None)).select("doc_id").distinct().count() == 2000


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    """Quality by the operator's own verdicts; groups, leaks and weights by plain Python over all pairs."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect())
    kept = {r["doc_id"] for r in divergence.divergence_quality(docs).where("kept").collect()}
    rows = {r["doc_id"]: r for r in docs.collect() if r["doc_id"] in kept}
    ids = sorted(rows)
    prints = np.array([simhash.fingerprint(rows[i]["text"].encode()) for i in ids], np.uint64)
    words = {i: rows[i]["text"].encode().lower().split() for i in ids}
    sets = [{tuple(words[i][k : k + 5]) for k in range(max(1, len(words[i]) - 4))} for i in ids]
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 11
    pairs = [(a, b) for a, b in zip(*(x.tolist() for x in np.nonzero(near))) if a < b]
    same = [(a, b) for a, b in pairs if prints[a] == prints[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    label = simhash._joined(np.arange(len(ids)), *(np.array([p[k] for p in same], np.int64) for k in (0, 1)))
    first = [i for k, i in enumerate(ids) if label[k] == k]
    items = [b" " + b" ".join(r["text"].encode().lower().split()) + b" " for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = [i for i in first if not any(x in b" " + b" ".join(words[i]) + b" " for x in items)]
    assert set(got) == set(clean)
    tokens = Counter()
    for i in clean:
        tokens[rows[i]["source"]] += len(words[i])
    taken = Counter()
    for i, n in got.items():
        taken[rows[i]["source"]] += n * len(words[i])
    assert all(taken[s] >= tokens[s] for s in tokens) and max(taken[s] / tokens[s] for s in tokens) <= 4


def test_stages_keep_the_columns(odd, none, spark, sf):
    for docs in (odd.withColumn("n_chars", F.lit(1)), none.withColumn("n_chars", F.lit(1))):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf).columns == docs.columns
            stage(spark, docs, sf).count()
        corpus_pipeline.STAGES[-1][1](spark, docs, sf).count()


def test_native_plans_hold_no_python(spark, sf):
    for name in ("op6_line_dedup", "op9_chat_format"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan
