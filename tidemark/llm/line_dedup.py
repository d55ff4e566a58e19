"""Near-duplicate lines by an exact set-similarity join, with Spark expressions only.

A line is the set of its words. Words are put in order of rarity; of two sets of the asked-for Jaccard similarity the
first words in that order, the prefixes, have one in common. Sets meet on a word of their prefixes if their lengths and
its places allow the similarity (length and positional filters), and if a parity bitmap of their words does not rule
it out. What is left is verified on all words of both, as 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import discard, text_of, written

#: Up to this many lines to be verified are named by broadcast (a few numbers each); beyond, they are joined by shuffle.
NAMED_LINES = 1_000_000
#: Lines that are checked against each other in one place.
GROUP_LINES = 2_000
#: Words are counted in so many classes by the upper bits of their hash; the order of rarity is that of the classes.
CLASS_BITS = 16
_CLASSES = 1 << CLASS_BITS
_REST = 64 - CLASS_BITS


def _spaced(text: str) -> str:
    """The text with a space for each blank but the line's end, so that it is split by a plain character."""
    for blank in ("\\t", "\\u000b", "\\u000c", "\\r"):
        text = f"replace({text}, '{blank}', ' ')"
    return text


#: Hashes of a line's words, repeats included; what is split off between two blanks is no word.
_HASHES = f"array_remove(transform(split({_spaced('line')}, ' '), w -> xxhash64(w)), xxhash64(''))"
#: A word's hash with its class replaced by the class's rank, so that the order of numbers is that of rarity.
#: (``coalesce`` only says that none is null, so that the numbers are sorted as such)
_BY_RARITY = f"sort_array(array_distinct(transform({_HASHES}, h -> h ^ coalesce(ranks[cast(shiftrightunsigned(h, {_REST}) as int)], 0L))))"
#: One bit for each of 64 classes of words by the lower bits of the hash: whether the set has an odd number of them.
_PARITY = "aggregate({words}, 0L, (x, h) -> x ^ shiftleft(1L, cast(h & 63 as int)))"
#: The same of the words whose next bit is set, so that both tell of 128 classes: 64 say nothing of sets of 100 words.
_UPPER = "aggregate({words}, 0L, (x, h) -> if(h & 64 = 0, x, x ^ shiftleft(1L, cast(h & 63 as int))))"


def _lines(documents: DataFrame) -> DataFrame:
    """``doc_id, line_no`` (from 0) ``, line``."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(text_of(), "\n", -1)).alias("line_no", "line"))


def word_ranks(documents: DataFrame) -> DataFrame:
    """One row ``ranks``: for each class of words, what turns its bits of a hash into the rank of its count, rarest first."""
    text = documents.select(F.replace(text_of(), F.lit("\n"), F.lit(" ")).alias("line"))
    words = text.select(F.expr(f"explode(split({_spaced('line')}, ' '))").alias("w")).where("w <> ''")
    counts = words.groupBy(F.expr(f"cast(shiftrightunsigned(xxhash64(w), {_REST}) as int)").alias("class")).agg(F.count("*").alias("n"))
    listed = counts.agg(F.expr("transform(array_sort(collect_list(struct(n, class))), c -> c.class)").alias("classes"))
    # classes without words come behind; the place of each class in the list is its rank
    full = listed.select(F.expr(f"concat(classes, array_except(sequence(0, {_CLASSES - 1}), classes))").alias("classes"))
    rank = f"shiftleft(cast(k - {_CLASSES // 2} as bigint), {_REST}) ^ shiftleft(cast(c as bigint), {_REST})"
    placed = f"transform(array_sort(transform(classes, (c, k) -> struct(c, {rank} as turn))), x -> x.turn)"
    return full.select(F.expr(placed).alias("ranks"))


def _needed(percent: int, size: str) -> str:
    return f"(({percent} * {size} + 99) div 100)"


def _overlap(percent: int, sizes: str) -> str:
    """Least number of common words of two sets of these sizes together."""
    return f"(({percent} * ({sizes}) + {99 + percent}) div {100 + percent})"


def line_sets(documents: DataFrame, percent: int) -> DataFrame:
    """``doc_id, line_no, size, print, parity, upper, prefix`` of each line; ``print, parity, size`` name its set of words."""
    ordered = _lines(documents).withColumn("ranks", word_ranks(documents).scalar()).select("doc_id", "line_no", F.expr(_BY_RARITY).alias("words"))
    longest = f"if(size(words) >= {_least_size(percent)}, size(words) - {_needed(percent, 'size(words)')} + 1, 0)"
    return ordered.select(
        "doc_id",
        "line_no",
        F.size("words").alias("size"),
        F.xxhash64("words").alias("print"),
        F.expr(_PARITY.format(words="words")).alias("parity"),
        F.expr(_UPPER.format(words="words")).alias("upper"),
        F.expr(f"transform(slice(words, 1, {longest}), w -> cast(w & 2147483647 as int))").alias("prefix"),
    )


def _least_size(percent: int) -> int:
    """Sets smaller than this have only equal ones within the similarity."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 30


def similar_lines(documents: DataFrame, percent: int = 80) -> DataFrame:
    """Lines and their near-duplicates: ``doc_id, line_no, class_doc, class_line, n_links, removed``.

    ``class_doc, class_line`` is the first line (by document, then place) with the same set of words; ``n_links`` is
    the number of other sets with a Jaccard similarity of at least ``percent``; ``removed`` tells whether any earlier
    line has the same set or a similar one. Lines without words are never removed and have no links. Words are what
    stands between ASCII blanks, case and all. Null texts count as one empty line; null ids come first in the order;
    lines equal in document and place, as in repeated rows, stay or go together. An empty table gives an empty result;
    other columns are unread.
    """
    ordered = written(line_sets(documents, percent))
    sets = written(
        ordered.where("size > 0")
        .groupBy("print", "parity", "size")
        .agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.first("upper").alias("upper"), F.first("prefix").alias("prefix"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    lines = written(ordered.drop("upper", "prefix"))
    discard(ordered)
    candidates = written(_meetings(sets, percent))
    links = _verified(documents, sets, candidates, percent)
    return _decided(lines, sets, links)


def _meetings(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of ids of sets that meet on a word of their prefixes and pass the filters."""
    entries = sets.where("size(prefix) > 0").select("id", "parity", "upper", "size", F.posexplode("prefix").alias("pos", "word"))
    a, b = entries.alias("a"), entries.alias("b")
    needed = _overlap(percent, "a.size + b.size")
    meet = (
        "a.word = b.word and (a.size < b.size or (a.size = b.size and a.id < b.id))"
        f" and {percent} * b.size <= 100 * a.size"
        f" and least(a.size - a.pos, b.size - b.pos) >= {needed}"
        f" and bit_count(a.upper ^ b.upper) + bit_count(a.parity ^ a.upper ^ b.parity ^ b.upper) <= a.size + b.size - 2 * {needed}"
    )
    return a.join(b, F.expr(meet)).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def _hashed(documents: DataFrame, named: DataFrame) -> DataFrame:
    """``id, places, first, words`` of the lines named by ``id, size, parity, _doc, _line, places``; ``words`` are hashes."""
    here = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("line_no") == F.col("_line"))
    found = _lines(documents).join(named, here)
    # of rows that share an id and a line number, those with other words are not meant; filtered as a list of one, since
    # the optimizer would put a plain filter before the join's output and hash the words for it and for the output again
    own = f"size(w) = size and {_PARITY.format(words='w')} = parity"
    words = F.explode(F.expr(f"filter(array(array_distinct({_HASHES})), w -> {own})"))
    return found.select("id", "places", F.struct("doc_id", "line_no").alias("first"), words.alias("words"))


def _hubs(candidates: DataFrame) -> DataFrame:
    """``_id, hub``: the least id that an id is a candidate with directly or through one other, itself included."""
    ends = candidates.select(F.col("a").alias("id"), F.col("b").alias("other")).union(candidates.select("b", "a"))
    near = written(ends.groupBy(F.col("id").alias("_id")).agg(F.least("_id", F.min("other")).alias("_hub")))
    return ends.join(near, F.col("other") == F.col("_id")).groupBy(F.col("id").alias("_id")).agg(F.least("id", F.min("_hub")).alias("hub"))


def _verified(documents: DataFrame, sets: DataFrame, candidates: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs that are similar by their words: ``a, b, a_first, b_first``.

    Pairs are checked in groups by the hub of ``a`` (see ``_hubs``), so that most lines of a family go to one group, and
    a line is sent once to a group and not to each of its pairs. The lines of a large group are dealt into blocks, of
    which each two are a group of their own, to which the lines go that are in a pair there.
    """
    grouped = written(candidates.join(_hubs(candidates), F.col("a") == F.col("_id")).select("hub", "a", "b"))
    members = grouped.select("hub", F.explode(F.array("a", "b")).alias("id")).distinct()
    many = members.groupBy(F.col("hub").alias("_hub")).agg(F.ceil(F.count("*") / GROUP_LINES).cast("int").alias("blocks"))
    many = written(many.where("blocks > 1"))
    block = lambda x: F.pmod(F.xxhash64(x), F.coalesce("blocks", F.lit(1))).cast("int")
    key = ["hub", "i", "j"]
    pairs = grouped.join(many, F.col("hub") == F.col("_hub"), "left").select("hub", block("a").alias("i"), block("b").alias("j"), "a", "b")
    placed = pairs.select(*key, F.explode(F.array("a", "b")).alias("id")).distinct()
    placed = placed.groupBy("id").agg(F.collect_list(F.struct(*key)).alias("places"))
    named = written(
        sets.join(placed, "id").select("id", "size", "parity", F.col("first.doc_id").alias("_doc"), F.col("first.line_no").alias("_line"), "places")
    )
    rows = documents.select("doc_id", "text")
    if named.count() <= NAMED_LINES:
        # other documents need not be split into lines
        own = F.broadcast(named.select(F.col("_doc").alias("_own")).distinct())
        rows = rows.join(own, F.col("doc_id").cast("long").eqNullSafe(F.col("_own")), "left_semi")
        named = F.broadcast(named)
    lines = _hashed(rows, named).select("id", "first", "words", F.explode("places").alias("_place"))
    lines = lines.select("_place.*", "id", "first", "words").repartition(*key)
    side = lambda x: lines.select(*key, F.col("id").alias(x), F.col("first").alias(f"{x}_first"), F.col("words").alias(f"{x}_words"))
    spark = documents.sparkSession
    # a group's rows are in one partition, by which both joins can go; the second takes its lines into memory, so that
    # the words that the first has put to each pair need no sorting
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        met = pairs.repartition(*key).join(side("a"), [*key, "a"]).join(side("b").hint("shuffle_hash"), [*key, "b"])
        common = F.size(F.array_intersect("a_words", "b_words"))
        similar = (100 + percent) * common >= percent * (F.size("a_words") + F.size("b_words"))
        return written(met.where(similar).select("a", "b", "a_first", "b_first").distinct())
    finally:
        spark.conf.set(setting, before)


def _decided(lines: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    of = lambda x, y: links.select(F.col(x).alias("id"), (F.col(f"{y}_first") < F.col(f"{x}_first")).alias("later"))
    linked = of("a", "b").union(of("b", "a")).groupBy("id").agg(F.count("*").alias("n_links"), F.max("later").alias("later"))
    key = ["print", "parity", "size"]
    known = sets.select("id", *key, "first").join(linked, "id", "left").drop("id").withColumn("_set", F.lit(True))
    first = (F.col("first.line_no") == F.col("line_no")) & F.col("first.doc_id").eqNullSafe(F.col("doc_id"))
    joined = lines.select("doc_id", "line_no", *key).join(known, key, "left")
    has = F.coalesce("_set", F.lit(False))
    return joined.select(
        "doc_id",
        "line_no",
        F.when(has, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("class_doc"),
        F.when(has, F.col("first.line_no")).otherwise(F.col("line_no")).alias("class_line"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (has & (~first | F.coalesce("later", F.lit(False)))).alias("removed"),
    )


def without_repeated_lines(documents: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, text`` of each document without the lines that ``similar_lines`` removes, and ``n_removed``.

    Rows of one ``doc_id`` are taken as one document whose lines are told apart by their numbers.
    """
    removed = similar_lines(documents, percent).where("removed").groupBy("doc_id").agg(F.collect_set("line_no").alias("_gone"))
    removed = removed.withColumnRenamed("doc_id", "_doc")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    kept = F.filter(F.split("text", "\n", -1), lambda line, k: ~F.array_contains(gone, k))
    return texts.join(removed, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select(
        "doc_id", F.array_join(kept, "\n").alias("text"), F.size(gone).alias("n_removed")
    )
