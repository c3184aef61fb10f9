"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document; a sample of given labels is one
more labeller.  How often which votes occur together is counted over all documents.  From these
counts, expectation-maximisation estimates the share of bad documents and how each labeller
votes on good and on bad ones, and gives every combination of votes a posterior.  Documents
labelled by their posterior train a linear scorer on hashed features of the text, which decides.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import staged, utf8
from staylens.llm.decontaminate import words_of

NONE, GOOD, BAD = 0, 1, 2
#: Bounds of what the classifier is fitted on: labelled rows used as votes, and documents that
#: train the scorer.  Votes are counted over all documents.
LABELLED_ROWS = 20_000
TRAINING_DOCUMENTS = 20_000
#: How much likelier a labeller's bad vote is on a bad document than on a good one, at least,
#: unless this many given labels on its bad votes say how much.
LEAST_RATIO = 30.0
ENOUGH_GIVEN = 20
DIMENSIONS = 1 << 17
#: Slots at the end of the weights that hold the features of the measures.
MEASURE_SLOTS = 256

SYMBOLS = b"#$%&*!<>{}[]~^=\\@+"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = bytes(range(ord("a"), ord("z") + 1))
#: Words of abuse, in English as the labels know them; others are learned by the scorer.
ABUSE = frozenset(
    b"idiot idiots moron morons stupid worthless trash pathetic disgusting clown clowns scum loser losers "
    b"dumb imbecile cretin scumbag filth filthy vermin garbage ugly hate".split()
)


@dataclass(frozen=True)
class Measures:
    words: int
    symbols: float
    capitals: float
    bars: float
    repeats: float
    variety: float
    abuse: int


def measure(text: bytes, words: list[bytes] | None = None) -> Measures:
    """What the labellers look at; rates are per word or per letter."""
    words = words_of(text) if words is None else words
    n = max(len(words), 1)
    upper = len(text) - len(text.translate(None, UPPER))
    lower = len(text) - len(text.translate(None, LOWER))
    distinct = set(words)
    return Measures(
        len(words),
        (len(text) - len(text.translate(None, SYMBOLS))) / n,
        upper / max(upper + lower, 1),
        text.count(b"|") / n,
        sum(map(eq, words, islice(words, 1, None))) / n,
        len(distinct) / n,
        len(ABUSE & distinct),
    )


def _between(value: float, good: float, bad: float) -> int:
    return GOOD if value <= good else BAD if value >= bad else NONE


LABELLERS: dict[str, Callable[[Measures], int]] = {
    "symbols": lambda m: _between(m.symbols, 0.1, 0.4),
    "capitals": lambda m: _between(m.capitals, 0.2, 0.5),
    "bars": lambda m: _between(m.bars, 0.05, 0.25),
    "repeats": lambda m: _between(m.repeats, 0.05, 0.2),
    "variety": lambda m: NONE if m.words < 50 else _between(-m.variety, -0.3, -0.1),
    "abuse": lambda m: BAD if m.abuse else NONE,
}


def votes_of(m: Measures) -> int:
    """All votes as one number, base 3; -1 for a text without words."""
    if not m.words:
        return -1
    total = 0
    for vote in LABELLERS.values():
        total = total * 3 + vote(m)
    return total


def unpack(votes: int) -> list[int]:
    return [votes // 3**i % 3 for i in reversed(range(len(LABELLERS)))]


def votes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, votes)`` per row of ``docs``; see ``votes_of``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [votes_of(measure(t)) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32())], names=["doc_id", "votes"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, votes int")


@dataclass
class Model:
    """Weights of the scorer, and what expectation-maximisation found."""

    weights: np.ndarray
    bad_share: float = 0.5
    #: labeller -> rows good, bad; columns none, good, bad
    tables: dict[str, np.ndarray] = field(default_factory=dict)
    posterior: dict[int, float] = field(default_factory=dict)


def least_ratios(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per labeller the least P(bad vote | bad) / P(bad vote | good), from given labels if they suffice.

    Documents are bad in one way at a time, which the model of independent votes does not know:
    without this it may explain a labeller that is alone with its bad votes as wrong.
    """
    given = patterns[:, -1]
    totals = [counts[given == g].sum() for g in (GOOD, BAD)]
    ratios = []
    for j in range(patterns.shape[1] - 1):
        good, bad = (counts[(patterns[:, j] == BAD) & (given == g)].sum() for g in (GOOD, BAD))
        told = (bad + 0.5) / (totals[1] + 1) / ((good + 0.5) / (totals[0] + 1))
        ratios.append(max(1.0, told) if good + bad >= ENOUGH_GIVEN else LEAST_RATIO)
    return np.array([*ratios, 1.0])


def maximise(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, least: np.ndarray | None = None
) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over vote patterns; the last column is the given labels, whose absence says nothing.

    ``least`` is what ``least_ratios`` returns.  Returns the share of bad documents,
    ``tables[labeller, class, vote]`` and the posterior of bad.
    """
    bad = (patterns == BAD).sum(axis=1)
    good = (patterns == GOOD).sum(axis=1)
    given = patterns[:, -1]
    # A bad vote starts out stronger than a good one: a document is bad in one way at a time.
    posterior = np.where(given == BAD, 0.98, np.where(given == GOOD, 0.02, np.where(bad > 0, 0.9, 0.1 / (1 + good))))
    share, tables = 0.5, np.zeros((patterns.shape[1], 2, 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        share = float((weight[1].sum() + 1) / (counts.sum() + 2))
        for j in range(patterns.shape[1]):
            for vote in range(3):
                tables[j, :, vote] = weight[:, patterns[:, j] == vote].sum(axis=1) + 0.01
        tables[-1, :, NONE] = 0
        if least is not None:
            tables /= tables.sum(axis=2, keepdims=True)
            tables[:, 0, BAD] = np.minimum(tables[:, 0, BAD], tables[:, 1, BAD] / least)
        tables /= tables.sum(axis=2, keepdims=True)
        tables[-1, :, NONE] = 1
        log = np.log([1 - share, share])[:, None] + sum(
            np.log(tables[j][:, patterns[:, j]]) for j in range(patterns.shape[1])
        )
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(new - posterior).max(initial=0) < 1e-6:
            break
        posterior = new
    return share, tables, posterior


def features(text: bytes) -> np.ndarray:
    """Slots of the weights that a text switches on: its hashed words and its binned measures."""
    words = words_of(text)
    m = measure(text, words)
    limit = DIMENSIONS - MEASURE_SLOTS
    slots = np.fromiter((zlib.crc32(w) % limit for w in set(words)), dtype=np.int64)
    binned = [
        (0, min(m.symbols, 2.0) * 10),
        (1, m.capitals * 20),
        (2, min(m.bars, 1.0) * 20),
        (3, m.repeats * 20),
        (4, m.variety * 20 if m.words >= 50 else 21),
        (5, min(m.abuse, 3)),
    ]
    return np.unique(np.concatenate([slots, [limit + 24 * k + int(v) for k, v in binned]]))


def score_of(text: bytes, weights: np.ndarray) -> float:
    """Probability that a text is good; a text without words has none."""
    if not words_of(text):
        return 0.0
    return float(1 / (1 + np.exp(np.clip(weights[features(text)].sum() + weights[-1], -500, 500))))


def train(slots: list[np.ndarray], bad: np.ndarray, epochs: int = 4, steps: int = 1200) -> np.ndarray:
    """Logistic regression by adaptive gradient steps; words move slower than measures.

    ``epochs`` at least, and more where the documents make fewer than ``steps``.
    """
    epochs = max(epochs, -(-steps * 64 // len(slots)))
    weights = np.zeros(DIMENSIONS, dtype=np.float64)
    squares = np.full(DIMENSIONS, 1e-8)
    speed = np.full(DIMENSIONS, 0.03)
    speed[-MEASURE_SLOTS:] = 0.2
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for at in np.array_split(order.permutation(len(slots)), max(1, len(slots) // 64)):
            rows = np.concatenate([np.append(slots[i], DIMENSIONS - 1) for i in at])
            sizes = np.array([len(slots[i]) + 1 for i in at])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            error = 1 / (1 + np.exp(-np.clip(np.add.reduceat(weights[rows], starts), -30, 30))) - bad[at]
            touched, index = np.unique(rows, return_inverse=True)
            step = np.bincount(index, weights=np.repeat(error, sizes)) / len(at) + 1e-4 * weights[touched]
            squares[touched] += step**2
            weights[touched] -= speed[touched] * step / np.sqrt(squares[touched])
    return weights.astype(np.float32)


def sampled(rows: DataFrame, total: int, bound: int, *by: str) -> DataFrame:
    """About ``bound`` of ``total`` rows, chosen by a hash."""
    share = min(1.0, bound / max(total, 1))
    return rows.filter(F.pmod(F.xxhash64(*by), F.lit(1_000_000_000)) < share * 1_000_000_000)


def fit(
    docs: DataFrame,
    labels: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    labelled_rows: int = LABELLED_ROWS,
    training_documents: int = TRAINING_DOCUMENTS,
) -> Model:
    """Fit the weak-label model and the scorer.

    ``labels`` has ``doc_id``, ``quality`` (1 good) and ``toxic`` (1 bad); a document is bad if
    either says so, nulls say nothing, and of several labels of a document the worst counts.
    """
    rows = staged(votes(docs, id_col, text_col), "quality_votes")
    given = _given(labels, labelled_rows) if labels is not None else None
    joined = rows.withColumn("given", F.lit(NONE)) if given is None else rows.join(F.broadcast(given), "doc_id", "left")
    counted = (
        joined.filter("votes >= 0").groupBy("votes", F.coalesce("given", F.lit(NONE)).alias("given")).count().collect()
    )  # at most 3 ** (labellers + 1) rows
    if not counted:
        return Model(np.zeros(DIMENSIONS, dtype=np.float32))
    patterns = np.array([[*unpack(r.votes), r.given] for r in counted])
    times = np.array([r["count"] for r in counted], dtype=float)
    share, tables, posterior = maximise(patterns, times, least=least_ratios(patterns, times))
    found = {(r.votes, r.given): float(p) for r, p in zip(counted, posterior, strict=True)}
    model = Model(np.zeros(DIMENSIONS, dtype=np.float32), share, dict(zip([*LABELLERS, "given"], tables, strict=True)))
    model.posterior = {v: p for (v, g), p in found.items() if g == NONE}

    total = int(sum(r["count"] for r in counted))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = sampled(texts, total, training_documents, "doc_id", "text")
    if given is not None:
        texts = texts.join(F.broadcast(given), "doc_id", "left")
    else:
        texts = texts.withColumn("given", F.lit(NONE))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, bad = [], []
            for text, vote in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                pattern = votes_of(measure(text))
                if pattern >= 0:
                    slots.append(features(text).astype(np.int32))
                    bad.append(found.get((pattern, vote or NONE), found.get((pattern, NONE), share)))
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.list_(pa.int32())), pa.array(bad, pa.float64())], names=["slots", "bad"])

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, bad = [], []
        for batch in batches:
            slots += [np.array(s, dtype=np.int64) for s in batch.column(0).to_pylist()]
            bad += batch.column(1).to_pylist()
        order = sorted(range(len(slots)), key=lambda i: (len(slots[i]), slots[i].tobytes()))
        if order:
            weights = train([slots[i] for i in order], np.array([bad[i] for i in order]))
            yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], names=["weights"])

    sample = texts.mapInArrow(featured, "slots array<int>, bad double").repartition(1)
    result = sample.mapInArrow(trained, "weights binary").collect()
    if result:
        model.weights = np.frombuffer(result[0].weights, dtype=np.float32)
    return model


def _given(labels: DataFrame, bound: int) -> DataFrame:
    says = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), BAD).when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(), GOOD
    )
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), says.alias("given")).filter(
        "doc_id IS NOT NULL AND given IS NOT NULL"
    )
    per_document = rows.groupBy("doc_id").agg(F.max("given").alias("given"))
    return staged(sampled(per_document, rows.count(), bound, "doc_id"), "quality_given")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, quality, keep, votes, weak_quality)`` per row of ``docs``.

    ``quality`` is the scorer's probability of good, ``keep`` says it is at least a half.  Null
    texts and texts without words have quality 0.  ``weak_quality`` is the posterior of the
    votes alone, null if no document of the fit had these votes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            texts = utf8(batch.column(1))
            quality = np.array([score_of(t, fitted.weights) for t in texts])
            patterns = [votes_of(measure(t)) for t in texts]
            weak = [1 - fitted.posterior[p] if p in fitted.posterior else None for p in patterns]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(quality), pa.array(quality >= 0.5), pa.array(patterns, pa.int32()), pa.array(weak, pa.float64())],
                names=["doc_id", "quality", "keep", "votes", "weak_quality"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, quality double, keep boolean, votes int, weak_quality double")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            yield batch.filter(pa.array([score_of(t, weights) >= 0.5 for t in utf8(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
