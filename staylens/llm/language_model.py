"""Scores of texts under a hashed maximum-entropy model with class-factored softmax.

Every word is hashed to a bucket; a bucket is a class and a slot in it.  The probability of the
next word is P(class | context) * P(slot | class, context) * P(word | bucket).  The first two
are log-linear in hashed features of the context: none, the word before, the word two before
(a skip), and both.  They are trained by distributed gradient updates: in a round every task
starts from the shared weights, takes adaptive gradient steps over its share of the training
documents, and sends its change; the changes are averaged over the training tokens.  The last
factor is the add-one share of a word among the training tokens of its bucket, where all unseen
words of a bucket count as one, so the model sums to one over known words and one unknown word
per bucket.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import staged, utf8

CLASSES = 32
SLOTS = 32
#: Rows of hashed weights per factor; a row has a weight per class or per slot.
ROWS = 1 << 14
ROUNDS = 2
STEP = 0.25
#: Tokens per gradient step.
BATCH = 4096
#: The end of a text, a token that no word can be.
END = b"\n"
#: Distinct words a counting task holds before it sends what it has.
HELD_WORDS = 400_000
#: Bytes of text that are scored together with the counts of their words.
BLOCK_BYTES = 20_000_000
FOLDS, HELD_OUT = 7, 2


def tokens_of(text: bytes) -> list[bytes]:
    """Lower-cased words and the end."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    words.append(END)
    return words


def buckets_of(words: list[bytes]) -> np.ndarray:
    hashed = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    return (hashed * np.uint32(2654435761) >> np.uint32(16)).astype(np.int64) % (CLASSES * SLOTS)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64)


def contexts(buckets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashed features ``[token, 4]`` of every position of texts laid end to end."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    before = np.empty_like(buckets)
    before[1:] = buckets[:-1]
    before[starts] = CLASSES * SLOTS
    skip = np.empty_like(buckets)
    skip[2:] = buckets[:-2]
    skip[starts] = CLASSES * SLOTS
    second = starts + 1
    skip[second[lengths > 1]] = CLASSES * SLOTS
    both = before * (CLASSES * SLOTS + 1) + skip
    return np.stack([np.zeros_like(before), _mix(before, 1), _mix(skip, 2), _mix(both, 3)], axis=1)


@dataclass
class Weights:
    """``classes[row, class]`` and ``slots[row, slot]``."""

    classes: np.ndarray
    slots: np.ndarray

    @classmethod
    def zeros(cls) -> Weights:
        return cls(np.zeros((ROWS, CLASSES), np.float32), np.zeros((ROWS, SLOTS), np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.classes.ravel(), self.slots.ravel()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Weights:
        cut = ROWS * CLASSES
        return cls(flat[:cut].reshape(ROWS, CLASSES).copy(), flat[cut:].reshape(ROWS, SLOTS).copy())


def _rows(features: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight rows of both factors; those of the slots depend on the class as well."""
    return features % ROWS, _mix(features * CLASSES + classes[:, None], 4) % ROWS


def _logits(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    logits = weights.take(rows[:, 0], axis=0)
    for i in range(1, rows.shape[1]):
        logits += weights.take(rows[:, i], axis=0)
    return np.clip(logits, -40, 40, out=logits)


def _log_softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    logits = _logits(weights, rows)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def log_probabilities(weights: Weights, features: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Natural log of P(bucket | context) for every position."""
    classes, slots = buckets // SLOTS, buckets % SLOTS
    result = np.empty(len(buckets))
    for at in range(0, len(buckets), 8 * BATCH):
        part = slice(at, at + 8 * BATCH)
        a, b = _rows(features[part], classes[part])
        line = np.arange(len(a))
        result[part] = _log_softmax(weights.classes, a)[line, classes[part]]
        result[part] += _log_softmax(weights.slots, b)[line, slots[part]]
    return result


def _step(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
    """One adaptive gradient step on the rows that a batch touches."""
    error = np.exp(_logits(weights, rows))
    error /= error.sum(axis=1, keepdims=True)
    error[np.arange(len(target)), target] -= 1
    touched, change = _sums(error, rows)
    squares[touched] += np.einsum("ij,ij->i", change, change) / change.shape[1]
    weights[touched] -= change * (STEP / np.sqrt(squares[touched]))[:, None]


def _sums(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``rows`` and, for each, the sum of the values of the positions that have it.

    The n-th occurrences of all rows are added at once, most frequent rows first; what is left
    of the few most frequent is summed row by row.
    """
    flat = rows.ravel().astype(np.uint16)
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    sizes = np.diff(np.append(starts, len(flat)))
    by_size = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by_size], sizes[by_size]
    sorted_values = values.take(order // rows.shape[1], axis=0)
    total = sorted_values.take(starts, axis=0)
    nth = 1
    while (more := int(np.searchsorted(-sizes, -nth, side="left"))) > 48:
        total[:more] += sorted_values.take(starts[:more] + nth, axis=0)
        nth += 1
    for i in range(more):
        total[i] += sorted_values[starts[i] + nth : starts[i] + sizes[i]].sum(axis=0)
    return ordered[starts].astype(np.int64), total


def train_on(weights: Weights, squares: Weights, buckets: np.ndarray, features: np.ndarray) -> None:
    for at in range(0, len(buckets), BATCH):
        part = slice(at, at + BATCH)
        classes = buckets[part] // SLOTS
        a, b = _rows(features[part], classes)
        _step(weights.classes, squares.classes, a, classes)
        _step(weights.slots, squares.slots, b, buckets[part] % SLOTS)


class _Squares:
    """Sums of squared gradients per row."""

    def __init__(self) -> None:
        self.classes = np.full(ROWS, 1e-3, np.float32)
        self.slots = np.full(ROWS, 1e-3, np.float32)


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text, held_out)``; a missing id is in the fold of the empty text."""
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        (fold == HELD_OUT).alias("held_out"),
    )


def train(rows: DataFrame, rounds: int = ROUNDS) -> Weights:
    """Weights from the rows of ``prepared`` that are not held out, each seen once.

    The tasks of a round are at most twice the cores, however large the input: what they send
    is that many times the size of the weights, summed in Spark slice by slice.
    """
    spark = rows.sparkSession
    weights = Weights.zeros()
    slices = 64
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(weights.flat())
        own = rows.filter(~F.col("held_out") & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == number)).select("text")

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            current, squares, seen = Weights.of(shared.value), _Squares(), 0
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    words = [tokens_of(t) for t in utf8(whole.column(0).slice(at, 512))]
                    lengths = np.array([len(w) for w in words])
                    buckets = buckets_of([w for ws in words for w in ws])
                    train_on(current, squares, buckets, contexts(buckets, lengths))
                    seen += len(buckets)
            if seen:
                change = (current.flat() - shared.value) * np.float32(seen)
                parts = np.array_split(change, slices)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(slices), pa.int32()), pa.array([seen] * slices, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
                    names=["slice", "seen", "change"],
                )

        def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, seen = None, 0
            for batch in batches:
                for n, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    change = np.frombuffer(raw, np.float32).astype(np.float64)
                    total = change if total is None else total + change
                    seen += n
            mean = (total / seen).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([mean.tobytes()], pa.binary())], names=["slice", "change"])

        changes = own.coalesce(2 * spark.sparkContext.defaultParallelism).mapInArrow(run, "slice int, seen long, change binary")
        summed = changes.groupBy("slice").applyInArrow(add, "slice int, change binary").orderBy("slice").collect()
        if summed:
            change = np.concatenate([np.frombuffer(r.change, np.float32) for r in summed])
            weights = Weights.of(weights.flat() + change)
    return weights


def block_counts(rows: DataFrame) -> DataFrame:
    """``(block, word, own, n)``: words per block, with their training occurrences in it.

    Counted in the task that reads the texts, which sends its words once per block, or when it
    holds too many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {}
        size = 0

        def send() -> Iterator[pa.RecordBatch]:
            for block, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(counts), pa.int32()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                    names=["block", "word", "n"],
                )

        for batch in batches:
            for block, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                counts = held.setdefault(block, Counter())
                size -= len(counts)
                words = tokens_of(text)
                counts.update(dict.fromkeys(words, 0) if out else words)
                size += len(counts)
                if size > HELD_WORDS:
                    yield from send()
                    held, size = {}, 0
        yield from send()

    return rows.repartition("block").select("block", "held_out", "text").mapInArrow(run, "block int, word binary, n long")


def scored(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, rounds: int = ROUNDS
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    Null texts are empty and have the end only.  ``base_score`` is the add-one unigram score,
    ``score`` the model's, both log10.  Without any training text every count is zero and the
    model is uniform over its buckets.

    Texts are dealt to blocks of bounded size by a hash.  The words of a block, once each, meet
    those of all others in one shuffle by word, where they are counted, and return to the block
    with their counts in another, together with its texts; no vocabulary is ever in one place.
    """
    spark = docs.sparkSession
    rows = prepared(docs, id_col, text_col)
    size = rows.agg(F.sum(F.length("text"))).head()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    vocabulary = staged(
        block_counts(rows)
        .groupBy("word")
        .agg(F.sum("n").alias("c"), F.collect_list("block").alias("blocks"))
        .filter("c > 0"),
        "language_model_vocabulary",
    )
    total = vocabulary.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).head()
    tokens, types = int(total.n or 0), int(total.v)
    per_bucket = _bucket_totals(vocabulary)
    weights = spark.sparkContext.broadcast((train(rows, rounds).flat(), per_bucket))
    known = vocabulary.select(F.explode("blocks").alias("block"), "word", "c")

    def score(key: tuple, texts: pa.Table, words: pa.Table) -> pa.Table:
        flat, in_bucket = weights.value
        model = Weights.of(flat)
        count_of = dict(zip(words["word"].to_pylist(), words["c"].to_pylist(), strict=True)).get
        per_doc: list[tuple] = []
        for at in range(0, texts.num_rows, 256):
            part = texts.slice(at, 256)
            split = [tokens_of(t) for t in part["text"].cast(pa.binary()).to_pylist()]
            lengths = np.array([len(w) for w in split])
            every = [w for ws in split for w in ws]
            c = np.fromiter((count_of(w, 0) for w in every), dtype=np.int64, count=len(every))
            buckets = buckets_of(every)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            base = np.log10((c + 1) / (tokens + types + 1))
            own = np.log10((c + 1) / in_bucket[buckets]) + log_probabilities(model, contexts(buckets, lengths), buckets) / np.log(10)
            per_doc += zip(
                part["doc_id"].to_pylist(), part["held_out"].to_pylist(), lengths.tolist(),
                np.add.reduceat((c > 0).astype(np.int64), starts).tolist(), [tokens] * len(split),
                np.add.reduceat(base, starts).tolist(), np.add.reduceat(own, starts).tolist(), strict=True,
            )
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        columns = list(zip(*per_doc, strict=True)) or [()] * len(kinds)
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    texts = rows.select("block", "doc_id", "held_out", "text").groupBy("block")
    return texts.cogroup(known.groupBy("block")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def _bucket_totals(vocabulary: DataFrame) -> np.ndarray:
    """Per bucket the training tokens, the training words and one: a row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * SLOTS, dtype=np.int64)
        for batch in batches:
            buckets = buckets_of(batch.column(0).to_pylist())
            np.add.at(total, buckets, batch.column(1).to_numpy() + 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    result = np.ones(CLASSES * SLOTS, dtype=np.float64)
    rows = vocabulary.select("word", "c").mapInArrow(run, "bucket long, n long")
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        result[bucket] += n
    return result
