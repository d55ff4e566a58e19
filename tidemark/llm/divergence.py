"""Quality rules by distribution divergence.

References are learned from all documents: for each language the histogram of character classes and the shares
of its most common words, blended with those of all documents by count. A document is compared with its language's reference by Jensen-Shannon distance
(square root of the divergence in bits, 0 to 1), each comparison guarded by a minimum length, after base rules on
length and on repetition.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.work import filtered, in_batches, text_of, text_slices, written

CLASSES = ("lower", "upper", "digit", "blank", "stop", "symbol", "other_ascii", "beyond_ascii")
SYMBOLS = b"#*$%&|<>"
STOPS = b".,;:!?'\"()-"
#: Name of the reference over all documents, for rows without a language.
ANY = ""
#: Parts in which the words of a language are ranked first.
RANK_PARTS = 8


def _class_table() -> np.ndarray:
    """The class of each byte of UTF-8: a character beyond ASCII counts once, by its first byte."""
    table = np.full(256, CLASSES.index("other_ascii"), np.int64)
    for b in range(256):
        c = bytes([b])
        if b >= 0x80:
            table[b] = CLASSES.index("beyond_ascii") if b >= 0xC0 else len(CLASSES)
        elif c.islower():
            table[b] = CLASSES.index("lower")
        elif c.isupper():
            table[b] = CLASSES.index("upper")
        elif c.isdigit():
            table[b] = CLASSES.index("digit")
        elif c.isspace():
            table[b] = CLASSES.index("blank")
        elif c in STOPS:
            table[b] = CLASSES.index("stop")
        elif c in SYMBOLS:
            table[b] = CLASSES.index("symbol")
    return table


_CLASS = _class_table()
NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))

SCHEMA = """doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,
base_failed boolean, kept boolean, class_distance double, word_distance double"""


@dataclass(frozen=True)
class DivergenceRules:
    """Limits. A distance is judged only in texts of the given least length. ``prior_documents``: how many documents of
    the mixed kind a language's reference is blended with; a null language is held against all documents.
    ``block_rows``: shares that are sent to the tasks at one time."""

    least_words: int = 10
    most_repeat_percent: int = 20
    common_words: int = 50
    prior_documents: int = 10
    block_rows: int = 500_000
    class_chars: int = 240
    class_distance: float = 0.28
    word_words: int = 60
    word_distance: float = 0.45


@dataclass
class References:
    """Shares by language: of the classes, and of the common words with all others as the last share."""

    classes: dict[str, np.ndarray] = field(default_factory=dict)
    words: dict[str, tuple[dict[bytes, int], np.ndarray]] = field(default_factory=dict)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms of counts or shares, in bits; 0 if either is empty."""
    a, b = float(p.sum()), float(q.sum())
    if not a or not b:
        return 0.0
    p, q = p / a, q / b
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(p > 0, p * np.log2(p / m), 0.0) + np.where(q > 0, q * np.log2(q / m), 0.0)
    return math.sqrt(max(0.0, float(gain.sum()) / 2))


def class_histogram(text: bytes) -> np.ndarray:
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return np.bincount(_CLASS, weights=by_byte, minlength=len(CLASSES) + 1)[: len(CLASSES)]


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words that lie in a window of ``size`` words found twice or more in the text."""
    windows = list(zip(*(words[k:] for k in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    total, covered = 0, 0  # covered: words before this place are counted
    for i, window in enumerate(windows):
        if found[window] > 1:
            total += i + size - max(covered, i)
            covered = i + size
    return total


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def _prepared(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit(ANY)).alias("lang"),
    )


def _corpus_counts(least_words: int, most_repeat_percent: int):
    """Per language: documents, classes and words of the texts that pass the base rules."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}
        texts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = [(g, "text", b"", n) for g, n in texts.items()]
            out += [(g, "class", name.encode(), int(n)) for g, h in classes.items() for name, n in zip(CLASSES, h)]
            out += [(g, "word", w, n) for g, c in words.items() for w, n in c.items()]
            lang, kind, item, n = zip(*out) if out else ((), (), (), ())
            made = pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(kind, pa.string()), pa.array(item, pa.binary()), pa.array(n, pa.int64())],
                ["lang", "kind", "item", "n"],
            )
            words.clear(), classes.clear(), texts.clear()
            return made

        held = 0
        for batch in batches:
            for part in text_slices(batch):
                for text, lang in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("lang").to_pylist()):
                    own = text.split()
                    if len(own) < least_words or 100 * repeated_words(own) > most_repeat_percent * len(own):
                        continue
                    texts[lang] += 1
                    counts = words.setdefault(lang, Counter())
                    before = len(counts)
                    counts.update(own)
                    held += len(counts) - before + len(CLASSES)
                    histogram = class_histogram(text)
                    classes[lang] = classes[lang] + histogram if lang in classes else histogram
                    if held > 400_000:
                        yield rows()
                        held = 0
        yield rows()

    return gather


def _counted(documents: DataFrame, rules: DivergenceRules) -> DataFrame:
    """``lang, kind, item, n``: documents, classes and words of the texts that pass the base rules, over all documents."""
    gather = _corpus_counts(rules.least_words, rules.most_repeat_percent)
    found = in_batches(_prepared(documents), gather, "lang string, kind string, item binary, n long")
    return written(found.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))


def _top_words(words: DataFrame, most: int) -> DataFrame:
    """The most frequent words of each language with their ``place``: ranked in parts by hash first, so that a large
    language is not one task's."""
    parted = words.withColumn("_part", F.pmod(F.xxhash64("item"), F.lit(RANK_PARTS)))
    order = [F.desc("n"), F.col("item").asc()]
    near = Window.partitionBy("lang", "_part").orderBy(*order)
    parted = parted.withColumn("place", F.row_number().over(near)).where(F.col("place") <= most)
    first = Window.partitionBy("lang").orderBy(*order)
    return parted.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most).select("lang", "item", "n", "place")


def reference_table(documents: DataFrame, rules: DivergenceRules = DivergenceRules()) -> DataFrame:
    """``lang, kind, item, place, share`` for every language and for all documents together (``lang`` empty).

    A language's shares are blended with those of all documents as if it had ``prior_documents`` more of the mixed kind,
    so a rare language leans on all and a frequent one on itself, without a step between. The words are its own most
    common ones and those of all documents; ``share`` of kind ``word`` is of all words.
    """
    counted = _counted(documents, rules)
    whole = counted.groupBy("kind", "item").agg(F.sum("n").alias("n_all"))
    whole = written(whole)
    words = counted.where("kind = 'word'")
    common = _top_words(whole.where("kind = 'word'").select(F.lit(ANY).alias("lang"), "item", F.col("n_all").alias("n")), rules.common_words)
    common = [bytes(r["item"]) for r in common.collect()]  # ``common_words`` rows
    own = _top_words(words.where(F.col("lang") != ANY), rules.common_words)
    langs = counted.where("kind = 'text'").where(F.col("lang") != ANY).select("lang", F.col("n").alias("texts"))
    each = lambda items: F.explode(F.array(*[F.lit(bytearray(i)) for i in items]) if items else F.array().cast("array<binary>"))
    listed = own.select("lang", "item").union(langs.select("lang", each(common).alias("item"))).distinct()
    sums = counted.where("kind <> 'text'").groupBy("lang", "kind").agg(F.sum("n").alias("total"))
    all_sums = whole.where("kind <> 'text'").groupBy("kind").agg(F.sum("n_all").alias("total_all"))
    classes = langs.select("lang", F.lit("class").alias("kind"), each([c.encode() for c in CLASSES]).alias("item"))
    asked = listed.select("lang", F.lit("word").alias("kind"), "item").union(classes)
    found = (
        asked.join(counted.where("kind <> 'text'"), ["lang", "kind", "item"], "left")
        .join(whole.where("kind <> 'text'"), ["kind", "item"])
        .join(sums, ["lang", "kind"])
        .join(F.broadcast(all_sums), "kind")
        .join(langs, "lang")
    )
    weight = F.col("texts") / (F.col("texts") + F.lit(rules.prior_documents))
    own_share, all_share = F.coalesce("n", F.lit(0)) / F.col("total"), F.col("n_all") / F.col("total_all")
    blended = found.select("lang", "kind", "item", (weight * own_share + (1 - weight) * all_share).alias("share"))
    every = whole.where((F.col("kind") == "class") | ((F.col("kind") == "word") & F.col("item").isin([bytearray(i) for i in common])))
    every = every.join(F.broadcast(all_sums), "kind")
    return written(blended.unionByName(every.select(F.lit(ANY).alias("lang"), "kind", "item", (F.col("n_all") / F.col("total_all")).alias("share"))))


def _blocks_of(table: DataFrame, most: int) -> Iterator[tuple[References, str, str | None]]:
    """References in blocks of about ``most`` rows, each with the reference over all documents, for the languages from
    the first name on and below the second."""
    base = References()
    _add(base, table.where(F.col("lang") == ANY).toLocalIterator())
    held: list = []
    last = begin = ANY
    for r in table.where(F.col("lang") != ANY).orderBy("lang").toLocalIterator():
        if r["lang"] != last and len(held) >= most:
            yield _with(base, held), begin, r["lang"]
            held, begin = [], r["lang"]
        held.append(r)
        last = r["lang"]
    yield _with(base, held), begin, None


def _add(found: References, rows: Iterator) -> None:
    words: dict[str, dict[bytes, float]] = {}
    for r in rows:
        item = bytes(r["item"])
        if r["kind"] == "class":
            found.classes.setdefault(r["lang"], np.zeros(len(CLASSES)))[CLASSES.index(item.decode())] = r["share"]
        else:
            words.setdefault(r["lang"], {})[item] = r["share"]
    for lang, own in words.items():
        names = sorted(own)
        shares = [own[w] for w in names]
        found.words[lang] = ({w: k for k, w in enumerate(names)}, np.array([*shares, max(0.0, 1 - math.fsum(shares))]))


def _with(base: References, rows: list) -> References:
    found = References(dict(base.classes), dict(base.words))
    _add(found, iter(rows))
    return found


def learn_references(documents: DataFrame, rules: DivergenceRules = DivergenceRules()) -> list[tuple[References, str, str | None]]:
    """References from all documents that pass the base rules, in blocks of bounded size by the name of the language.

    Counts are summed on the executors. The driver holds a block at a time and sends it to the tasks: about ``common_words``
    rows twice over for a language. Few languages are one block.
    """
    return list(_blocks_of(reference_table(documents, rules), rules.block_rows))


def judge(text: bytes, lang: str, references: References, rules: DivergenceRules) -> tuple:
    """The result's columns after ``doc_id`` for one text."""
    words = text.split()
    n = len(words)
    repeated = repeated_words(words)
    base_failed = n < rules.least_words or 100 * repeated > rules.most_repeat_percent * n
    word_chars = sum(map(len, words))
    if not text.isascii():
        word_chars -= len(text) - len(text.decode("utf-8", "surrogatepass"))  # blanks are ASCII: the rest lies in words
    by_class = by_word = None
    if n:
        lang = lang if lang in references.words else ANY
        if len(text) >= rules.class_chars and lang in references.classes:
            by_class = js_distance(class_histogram(text), references.classes[lang])
        if n >= rules.word_words and lang in references.words:
            places, shares = references.words[lang]
            own = np.zeros(len(shares))
            for w, k in Counter(words).items():
                own[places.get(w, -1)] += k
            by_word = js_distance(own, shares)
    far = (by_class or 0) > rules.class_distance or (by_word or 0) > rules.word_distance
    symbols = len(text.translate(None, NOT_SYMBOLS))
    return n, word_chars, symbols, duplicate_lines(text), repeated, base_failed, not (base_failed or far), by_class, by_word


Blocks = list[tuple[References, str, str | None]]


def _in_block(begin: str, end: str | None) -> Column:
    inside = F.col("lang") >= begin
    return inside if end is None else inside & (F.col("lang") < end)


def divergence_quality(documents: DataFrame, rules: DivergenceRules = DivergenceRules(), references: Blocks | None = None) -> DataFrame:
    """Base counts, distances and verdict for each whole text of ``documents`` (``doc_id``, ``text``, ``lang``).

    Columns: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept`` and the
    distances, null where the text is too short to be judged by them. A null text has no words and fails. A null
    language, and one without a text that passes the base rules, is held against all documents. Repeated rows are judged
    each for itself; an empty table gives an empty result; other columns are unread. Documents are read once for each
    block of languages, and judged in the block of their own.
    """
    spark, found = documents.sparkSession, None
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
    for block, begin, end in references or learn_references(documents, rules):
        known = spark.sparkContext.broadcast(block)

        def apply(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text_slices(batch):
                    texts, langs = part.column("text").cast(pa.binary()).to_pylist(), part.column("lang").to_pylist()
                    rows = [judge(t, g, known.value, rules) for t, g in zip(texts, langs)]
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *names])

        judged = in_batches(_prepared(documents).where(_in_block(begin, end)), apply, SCHEMA)
        found = judged if found is None else found.unionByName(judged)
    return found


def kept_documents(documents: DataFrame, rules: DivergenceRules = DivergenceRules(), references: Blocks | None = None) -> DataFrame:
    """The rows of ``documents`` that ``divergence_quality`` keeps, without a join and with all columns.

    Each row is judged by its own text and language, whatever its id; null texts go; an empty table gives an empty result.
    """
    for block, begin, end in references or learn_references(documents, rules):
        known = documents.sparkSession.sparkContext.broadcast(block)

        def keep(part: pa.RecordBatch, known=known, begin=begin, end=end) -> list[bool]:
            texts, langs = part.column("text").cast(pa.binary()).to_pylist(), part.column("lang").to_pylist()
            # other languages are judged in a block of their own
            return [not (begin <= g and (end is None or g < end)) or judge(t, g, known.value, rules)[6] for t, g in zip(texts, langs)]

        documents = filtered(documents, {"text": text_of(), "lang": F.coalesce(F.col("lang").cast("string"), F.lit(ANY))}, keep)
    return documents
