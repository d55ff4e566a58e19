"""Toxicity by weak supervision.

Voters (lexicons of words, patterns of word beginnings, style, and the annotators) each label some of a bounded
sample of texts. A generative model estimates how accurate each voter is and which voters err together, without
taking any of them for the truth. A linear classifier is then trained on its posterior labels and scores all texts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import in_batches, text_of, text_slices, texts_by_id, written

PREFIXES = (4, 5)
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_STRIP = b".,;:!?\"'()[]"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class ToxicityRules:
    """Bounds of the fit: labelled texts, features, and voters of each kind."""

    sample: int = 20_000
    features: int = 400
    lexicons: int = 12
    patterns: int = 8
    folds: int = 5
    least_evidence: float = 16.0
    least_lift: float = 3.0


@dataclass
class Classifier:
    weights: dict[bytes, float]
    bias: float

    def score(self, features: set[bytes]) -> float:
        z = self.bias + sum(self.weights[f] for f in features & self.weights.keys())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def features_of(text: bytes) -> set[bytes]:
    """Words in lower case without outer stops, beginnings of longer words (with a leading ^), and marks of style."""
    words = {w.strip(_STRIP) for w in set(text.translate(_LOWER).split())}
    words.discard(b"")
    found = set(words)
    for n in PREFIXES:
        found.update({b"^" + w[:n] for w in words if len(w) > n})
    if text.count(b"!") * 40 > len(text):
        found.add(b"~bang")
    capitals = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    if len(text) > 40 and capitals * 2 > len(text):
        found.add(b"~shout")
    return found


def held_out(doc_id: int | None, folds: int = 5) -> bool:
    return zlib.crc32(str(doc_id).encode()) % folds == 0 if doc_id is not None else False


def _evidence(all_toxic: int, all_clean: int) -> Column:
    """Log-likelihood ratio of a feature in ``t`` toxic and ``c`` clean texts against the label."""
    total = all_toxic + all_clean
    t, c = F.col("t").cast("double"), F.col("c").cast("double")

    def term(observed: Column, row: Column, column: int) -> Column:
        return F.when(observed > 0, observed * F.log(observed * total / (row * column))).otherwise(0.0)

    return 2 * (
        term(t, t + c, all_toxic)
        + term(c, t + c, all_clean)
        + term(all_toxic - t, total - t - c, all_toxic)
        + term(all_clean - c, total - t - c, all_clean)
    )


class LabelModel:
    """Posterior of a binary label under voters that say 1, -1 or 0 (nothing).

    Accuracies come from expectation maximisation. Voters that agree beyond what the label explains share one
    vote: each is weighted by the inverse of one plus its positive conditional correlations.
    """

    def __init__(self, votes: np.ndarray, rounds: int = 25):
        n, m = votes.shape
        states = np.stack([votes == 1, votes == -1, votes == 0]).astype(float)  # by vote, text, voter
        posterior = 1 / (1 + np.exp(-2.0 * votes.sum(1)))
        self.weight = np.ones(m)
        for k in range(rounds):
            self.prior = float(np.clip(posterior.mean(), 1e-3, 1 - 1e-3))
            given = np.stack([(states * side[None, :, None]).sum(1) + 0.1 for side in (posterior, 1 - posterior)])
            self.given = given / given.sum(1, keepdims=True)  # by label, vote, voter
            if k % 5 == 4:
                self.weight = self._weights(votes, posterior)
            gain = np.log(self.given[0]) - np.log(self.given[1])
            z = math.log(self.prior / (1 - self.prior)) + np.einsum("vnm,vm,m->n", states, gain, self.weight)
            posterior = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        self.posterior = posterior

    @staticmethod
    def _weights(votes: np.ndarray, posterior: np.ndarray) -> np.ndarray:
        shared = np.zeros((votes.shape[1],) * 2)
        for side in (posterior, 1 - posterior):
            if (total := side.sum()) < 1:
                continue
            centred = votes - (side @ votes) / total
            covariance = (centred * side[:, None]).T @ centred / total
            spread = np.sqrt(np.clip(np.diag(covariance), 1e-9, None))
            shared += covariance / spread / spread[:, None] * total / len(votes)
        np.fill_diagonal(shared, 0)
        return 1 / (1 + np.clip(shared - 0.1, 0, None).sum(1))


def train_linear(x: np.ndarray, y: np.ndarray, rounds: int = 12, ridge: float = 2e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Newton steps."""
    n, m = x.shape
    x = np.hstack([x, np.ones((n, 1))])
    w = np.zeros(m + 1)
    w[-1] = math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    penalty = np.full(m + 1, ridge * n)
    penalty[-1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x
        curve[np.diag_indices(m + 1)] += penalty
        step = np.linalg.solve(curve, x.T @ (y - p) - penalty * w)
        w += np.clip(step, -4, 4)
    return w[:-1], float(w[-1])


def fit_toxicity(documents: DataFrame, labels: DataFrame, rules: ToxicityRules = ToxicityRules()) -> Classifier:
    """The classifier, from at most ``rules.sample`` labelled texts outside the held-out fold.

    The driver gets identifiers and votes of the sample and at most ``rules.features`` features. Without labels of
    both kinds the classifier gives 0 for all texts.
    """
    spark = documents.sparkSession
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)")
        .where(F.crc32(F.col("doc_id").cast("string")) % rules.folds != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rules.sample)
        .collect()
    )
    if len({r["toxic"] for r in known}) < 2:
        return Classifier({}, -30.0)
    toxic = spark.sparkContext.broadcast({r["doc_id"]: r["toxic"] for r in known})

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = toxic.value
        for batch in batches:
            keep = pa.array([i in of for i in batch.column("doc_id").to_pylist()], pa.bool_())
            for part in text_slices(batch.filter(keep)):
                ids = part.column("doc_id").to_pylist()
                found = [list(features_of(t)) for t in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), part.column("text_key"), pa.array([of[i] for i in ids], pa.int32()), pa.array(found, pa.list_(pa.binary()))],
                    ["doc_id", "text_key", "toxic", "features"],
                )

    rows = in_batches(
        texts_by_id(documents, F.xxhash64(text_of()).alias("text_key")), extract, "doc_id long, text_key long, toxic int, features array<binary>"
    )
    # rows that repeat an id are one text of the sample, so it holds no more than ``rules.sample`` of them
    one = rows.groupBy("doc_id").agg(F.min_by(F.struct("toxic", "features"), "text_key").alias("row"))
    sampled = written(one.select("doc_id", "row.toxic", "row.features"))
    totals = Counter({r["toxic"]: r["n"] for r in sampled.groupBy("toxic").agg(F.count("*").alias("n")).collect()})
    if not totals[0] or not totals[1]:
        return Classifier({}, -30.0)
    counted = (
        sampled.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .where(F.col("t") >= 3)
        .where((F.col("t") + 0.5) / (totals[1] + 1) > rules.least_lift * (F.col("c") + 0.5) / (totals[0] + 1))
        .withColumn("evidence", _evidence(totals[1], totals[0]))
        .where(F.col("evidence") >= rules.least_evidence)
        .orderBy(F.desc("evidence"), "feature")
        .limit(rules.features)
        .collect()
    )
    if not counted:
        return Classifier({}, -30.0)
    place = {bytes(r["feature"]): k for k, r in enumerate(counted)}

    def cues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[place[f] for f in row if f in place] for row in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["toxic", "cues"])

    rows = in_batches(sampled, cues, "toxic int, cues array<int>").collect()
    x = np.zeros((len(rows), len(place)))
    for k, r in enumerate(rows):
        x[k, r["cues"]] = 1
    votes = _votes(x, np.array([r["toxic"] for r in rows]), list(place), rules)
    posterior = LabelModel(votes).posterior
    weights, bias = train_linear(x, posterior)
    return Classifier({f: float(weights[k]) for f, k in place.items()}, bias)


def _votes(x: np.ndarray, toxic: np.ndarray, features: list[bytes], rules: ToxicityRules) -> np.ndarray:
    """Lexicons and patterns say toxic or nothing; the voter for want of any cue says clean; annotators say either."""
    groups: dict[tuple[str, int], list[int]] = {}
    for kind, many, own in (
        ("word", rules.lexicons, [k for k, f in enumerate(features) if f[:1] not in b"^~"]),
        ("beginning", rules.patterns, [k for k, f in enumerate(features) if f[:1] == b"^"]),
        ("style", 2, [k for k, f in enumerate(features) if f[:1] == b"~"]),
    ):
        for n, k in enumerate(own):
            groups.setdefault((kind, n % many), []).append(k)
    said = [x[:, own].any(1).astype(float) for own in groups.values()]
    said.append(-(~x.any(1)).astype(float))
    said.append(np.where(toxic == 1, 1.0, -1.0))
    return np.stack(said, 1)


def toxicity(
    documents: DataFrame, labels: DataFrame, rules: ToxicityRules = ToxicityRules(), classifier: Classifier | None = None
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each whole text of ``documents``.

    Only the text makes the score; labels are learned from rows outside the held-out fold alone. Null texts count as
    empty and get the score of a text without cues. Labels that are null or neither 0 nor 1 are not used; of several
    for one document the highest counts. Repeated rows are scored each for itself, a null ``doc_id`` is not held
    out; an empty table gives an empty result; other columns are unread.
    """
    fitted = documents.sparkSession.sparkContext.broadcast(classifier or fit_toxicity(documents, labels, rules))
    folds = rules.folds

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fitted.value
        for batch in batches:
            for part in text_slices(batch):
                scores = [model.score(features_of(t)) for t in part.column("text").cast(pa.binary()).to_pylist()]
                ids = part.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([held_out(i, folds) for i in ids.to_pylist()], pa.bool_()),
                        pa.array(scores, pa.float64()),
                        pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    ],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    return in_batches(texts_by_id(documents), apply, SCHEMA)
