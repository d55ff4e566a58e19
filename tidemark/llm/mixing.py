"""Mixing sources to target weights by temperature.

The token shares of the sources, raised to an exponent and normalised, are the weights. The exponent is found by
bisection between 0 (equal weights) and 1 (the shares themselves): as low as a target entropy asks for, and no lower
than a limit on repetition allows. A source's weight gives it a budget of tokens, spent in blocks: each full block is
a permutation of all its documents, the last one is cut where the budget ends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.work import WORD, columns_of, text_of, written

#: Documents of a source that are ordered together.
PART_ROWS = 4_096
#: Exponents tried at once in each of the rounds of the bisection.
TRIED, ROUNDS = 16, 8


@dataclass(frozen=True)
class MixRules:
    """``entropy``: target as a share of that of equal weights. ``most_repeats``: how often a source's tokens may
    occur in the mix at most. ``budget``: tokens of the mix as a multiple of the corpus; None: the least at which
    every source is taken in full once."""

    entropy: float | None = 0.9
    most_repeats: float | None = 4.0
    budget: float | None = 1.0
    seed: int = 42


def words_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _exponent(shares: DataFrame, rules: MixRules) -> float:
    """Bisection, ``TRIED`` sections at a time: each round is one aggregate over the sources, however many."""
    many = shares.count()
    if not many:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        tried = [low + (high - low) * k / TRIED for k in range(TRIED + 1)]
        powers = shares.select("share", F.explode(F.array(*map(F.lit, tried))).alias("a"))
        found = powers.groupBy("a").agg(
            F.sum(F.pow("share", "a")).alias("z"),
            F.sum(F.pow("share", "a") * F.log("share")).alias("weighted"),
            F.max(F.pow("share", F.col("a") - 1)).alias("most"),
            F.max(F.pow("share", 1 - F.col("a"))).alias("cover"),
        )
        entropy = F.log("z") - F.col("a") * F.col("weighted") / F.col("z")
        allowed = F.lit(True)
        if rules.most_repeats is not None:
            passes = F.col("cover") if rules.budget is None else F.lit(rules.budget) / F.col("z")
            allowed = allowed & (F.col("most") * passes <= rules.most_repeats)
        if rules.entropy is not None:
            flatter = (entropy > F.log(F.lit(float(many))) * rules.entropy) if many > 1 else F.lit(False)
            allowed = allowed & ~flatter
        good = {r["a"]: r["ok"] for r in found.select("a", allowed.alias("ok")).collect()}
        first = next((k for k, a in enumerate(tried) if good[a]), TRIED)
        if first == 0:
            return tried[0]
        low, high = tried[first - 1], tried[first]
    return high


def source_weights(sizes: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """``source, n_rows, n_tokens, weight, budget`` for each row of ``sizes`` (``source, n_rows, n_tokens``) with tokens.

    A limit on repetition that even the shares themselves exceed leaves the exponent at 1, and so does a target
    entropy below that of the shares.
    """
    sizes = sizes.where("n_tokens > 0")
    total = sizes.agg(F.sum("n_tokens")).first()[0] or 0
    shares = written(sizes.withColumn("share", F.col("n_tokens") / F.lit(float(max(total, 1)))))
    a = _exponent(shares, rules)
    power = F.pow("share", F.lit(a))
    z, cover = shares.agg(F.sum(power), F.max(F.col("share") / power)).first()
    weight = power / F.lit(z or 1.0)
    if rules.budget is None:
        budget = F.greatest(F.col("n_tokens"), F.round(power * F.lit((cover or 1.0) * total)).cast("long"))
    else:
        budget = F.round(weight * F.lit(total * rules.budget)).cast("long")
    return shares.select("source", "n_rows", "n_tokens", weight.alias("weight"), budget.alias("budget"))


def mix_sources(documents: DataFrame, rules: MixRules = MixRules(), tokens: Column | None = None) -> DataFrame:
    """The mix as ``doc_id, source, block, position, n_tokens``: a row for each time that a document is taken.

    ``position`` counts from 0 in the order of the block, a permutation by hash. ``tokens`` is the size of a document
    (words, unless given). A null ``source`` is a source of its own; a source without tokens gets nothing. Null texts
    count as empty: they have no tokens and are taken in full blocks. Repeated rows are documents of their own; an
    empty table gives an empty result; other columns are unread.
    """
    rows = written(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.greatest(F.coalesce(tokens.cast("long"), F.lit(0).cast("long")), F.lit(0)).alias("n_tokens")
            if tokens is not None
            else words_of(text_of()).alias("n_tokens"),
        )
    )
    return _taken(rows, rules)


def _taken(rows: DataFrame, rules: MixRules) -> DataFrame:
    """Of ``rows`` (``doc_id, source, n_tokens`` and what else), those of the mix with ``block`` and ``position``."""
    sizes = rows.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"))
    weights = written(source_weights(sizes, rules)).select(
        F.col("source").alias("_source"),
        F.ceil(F.col("n_rows") / PART_ROWS).cast("long").alias("_parts"),
        F.expr("budget div n_tokens").alias("_full"),
        F.expr("budget % n_tokens").alias("_rest"),
    )
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("block").cast("string"), F.lit(str(rules.seed))))
    part = F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * F.col("_parts") / F.lit(float(1 << 32))).cast("int")
    blocks = (
        rows.join(weights, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_full"))))
        .where((F.col("block") < F.col("_full")) | (F.col("_rest") > 0))
        .withColumn("_key", key)
        .withColumn("_part", part)
        .drop("_source", "_parts")
    )
    by = ["source", "block", "_part"]
    before = Window.partitionBy("source", "block").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.groupBy(*by)
        .agg(F.count("*").alias("_n"), F.sum("n_tokens").alias("_t"))
        .select(
            *[F.col(c).alias(f"_at{k}") for k, c in enumerate(by)],
            F.coalesce(F.sum("_n").over(before.partitionBy("source", "block")), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_t").over(before.partitionBy("source", "block")), F.lit(0)).alias("_tokens_before"),
        )
    )
    own = Window.partitionBy(*by).orderBy("_key", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        blocks.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy("_key", "n_tokens")))
        .withColumn("_sum", F.sum("n_tokens").over(own))
        .join(starts, F.col("source").eqNullSafe(F.col("_at0")) & (F.col("block") == F.col("_at1")) & (F.col("_part") == F.col("_at2")))
    )
    within = (F.col("block") < F.col("_full")) | (F.col("_tokens_before") + F.col("_sum") <= F.col("_rest"))
    dropped = [c for c in placed.columns if c.startswith("_") and c != "_row"]
    return placed.where(within).withColumn("position", (F.col("_rows_before") + F.col("_rank") - 1).cast("long")).drop(*dropped)


def mix_documents(documents: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """``documents`` as often as the mix takes each of them, with the same columns.

    Rows equal in ``doc_id``, ``source`` and text stand for each other: what the mix takes of them is dealt out evenly.
    """
    columns = columns_of(documents)
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    identity = F.md5(F.concat_ws("\n", name("doc_id"), F.md5(text_of()), name("source")))
    rows = written(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            words_of(text_of()).alias("n_tokens"),
            identity.alias("_row"),
        )
    )
    taken = _taken(rows, rules).groupBy("_row").agg(F.count("*").alias("_times"))
    held = rows.groupBy("_row").agg(F.count("*").alias("_rows"))
    counts = taken.join(held, "_row").withColumnRenamed("_row", "_identity")
    some = documents.withColumn("_own", identity).join(counts, F.col("_own") == F.col("_identity"))
    number = F.row_number().over(Window.partitionBy("_own").orderBy("_times"))
    times = F.expr("_times div _rows") + F.when(number <= F.expr("_times % _rows"), 1).otherwise(0)
    return (
        some.withColumn("_copies", times)
        .where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies").cast("long"))))
        .select(*columns)
    )
