"""Best-fit packing of token pieces into sequences, in bulk-synchronous steps.

Documents are range-sorted by length and numbered within their length; gaps (the free ends of
open sequences) are kept sorted by size.  Both are held as runs: a run of documents is a length
with a range of ranks, a run of gaps is a size with a range of sequences, so there are never
more than a few runs per possible length, however many documents there are.  In one step, all
documents of the largest remaining length look for their successor, the smallest gap that
holds them.  Documents that want the same gaps are told apart by rank: the first go to the
first gap.  Then gaps are updated, documents that found none open new sequences, and the next
step begins.  The last sweep is distributed: each task looks up the run of its own ranks.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StructField, StructType

from staylens.llm.common import staged, texts
from staylens.llm.tokens import encoder, public_path

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces: full ones, the first takes the rest."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pieces(
    docs: DataFrame,
    path: str | None = None,
    end: int = END,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``; ``ids`` are little-endian unsigned 32-bit integers.

    A null text is an empty one and has the end id only.  Repeated rows are pieces of their own.
    """
    path = path or public_path(TOKENIZER)
    last = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows: list[tuple] = []
                for doc, ids in zip(batch.column(0).to_pylist(), encode.ids(texts(batch.column(1))), strict=True):
                    raw = ids + last
                    rows += [
                        (doc, n, start, size, raw[4 * start : 4 * (start + size)])
                        for n, (start, size) in enumerate(cut(len(raw) // 4, capacity))
                    ]
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


@dataclass(frozen=True)
class Placement:
    """Ranks ``[rank, rank + count)`` of a length: ``each`` per sequence, from ``sequence`` on."""

    length: int
    rank: int
    count: int
    sequence: int
    each: int
    offset: int


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Placement], int]:
    """Placements for ``counts`` documents of each length, and the number of sequences.

    ``gaps`` holds runs ``(size, first sequence, sequences)`` in order of size.
    """
    gaps: list[tuple[int, int, int]] = []
    placed: list[Placement] = []
    opened = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, (length, -1, -1))
            if at < len(gaps):
                size, first, many = gaps.pop(at)
            else:
                size, first, many = capacity, opened, -(-left // (capacity // length))
                opened += many
            each = size // length
            full = min(many, left // each)
            if full:
                placed.append(Placement(length, rank, full * each, first, each, capacity - size))
                if size - each * length:
                    insort(gaps, (size - each * length, first, full))
                rank, left = rank + full * each, left - full * each
            if full < many:
                rest = left if left < each else 0
                if rest:
                    placed.append(Placement(length, rank, rest, first + full, rest, capacity - size))
                    rank, left = rank + rest, 0
                    if size - rest * length:
                        insort(gaps, (size - rest * length, first + full, 1))
                    full += 1
                if full < many:
                    insort(gaps, (size, first + full, many - full))
    return placed, opened


def _with(rows: DataFrame, **columns: DataType) -> StructType:
    return StructType([*rows.schema, *(StructField(n, k) for n, k in columns.items())])


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``part`` and ``nth``: range-sorted by length, numbered per length and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
            nth = np.empty(len(lengths), dtype=np.int64)
            starts = np.flatnonzero(np.append(True, lengths[1:] != lengths[:-1])) if len(lengths) else []
            for a, b in zip(starts, np.append(starts[1:], len(lengths)), strict=True):
                length = int(lengths[a])
                nth[a:b] = np.arange(b - a) + seen.get(length, 0)
                seen[length] = seen.get(length, 0) + int(b - a)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(lengths), part, dtype=np.int32)), pa.array(nth)],
                names=[*batch.schema.names, "part", "nth"],
            )

    dealt = rows.repartitionByRange("length", *order).sortWithinPartitions("length", *order)
    return dealt.mapInArrow(run, _with(rows, part=IntegerType(), nth=LongType()))


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` of pieces with ``sequence_id`` and ``offset``.

    Needs ``doc_id``, ``piece`` and ``length`` from 1 to ``capacity``.  Sequences are gapless
    from offset 0.  What reaches the driver is the number of documents per length and range
    partition, at most one row per partition and length boundary.
    """
    columns = rows.columns
    order = [c for c in ("doc_id", "piece", "ids_crc32") if c in columns]
    sorted_rows = staged(ranked(rows, *order), "packing_ranked")
    counted = sorted_rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).orderBy("length", "part").collect()
    counts: dict[int, int] = {}
    before: dict[tuple[int, int], int] = {}
    for length, part, n in counted:
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        before[length, part] = counts.get(length, 0)
        counts[length] = counts.get(length, 0) + n
    placed, _ = best_fit(counts, capacity)
    placed.sort(key=lambda p: (p.length, p.rank))
    plan = rows.sparkSession.sparkContext.broadcast(
        (before, np.array([(p.length, p.rank, p.sequence, p.each, p.offset) for p in placed], dtype=np.int64).reshape(-1, 5))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets, runs = plan.value
        first = np.searchsorted(runs[:, 0], np.arange(capacity + 2))
        for batch in batches:
            at = batch.schema.get_field_index
            length, part, rank = (batch.column(at(c)).to_numpy() for c in ("length", "part", "nth"))
            rank = rank + np.array([offsets[key] for key in zip(length.tolist(), part.tolist(), strict=True)], dtype=np.int64)
            row = np.empty(len(rank), dtype=np.int64)
            for size in np.unique(length):
                own = length == size
                low, high = first[size], first[size + 1]
                row[own] = low + np.searchsorted(runs[low:high, 1], rank[own], side="right") - 1
            nth = rank - runs[row, 1]
            kept = [batch.column(at(c)) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(runs[row, 2] + nth // runs[row, 3]), pa.array(runs[row, 4] + nth % runs[row, 3] * length)],
                names=[*columns, "sequence_id", "offset"],
            )

    return sorted_rows.mapInArrow(run, _with(rows, sequence_id=LongType(), offset=LongType()))


def packed(docs: DataFrame, path: str | None = None, end: int = END, capacity: int = CAPACITY, **columns: str) -> DataFrame:
    """Where every piece of ``docs`` goes: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    found = pieces(docs, path, end, capacity, **columns)
    digests = found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    # Written first: a range sort reads its input twice, and texts should be encoded once.
    return pack(staged(digests, "packing_pieces"), capacity)


def sequences(docs: DataFrame, path: str | None = None, end: int = END, capacity: int = CAPACITY, **columns: str) -> DataFrame:
    """``(sequence_id, length, ids)``: the packed sequences themselves.

    A sequence holds at most ``capacity`` tokens, which bounds what is gathered per group.
    """
    found = staged(pieces(docs, path, end, capacity, **columns), "packing_pieces")
    parts = pack(found.withColumn("ids_crc32", F.crc32("ids")), capacity)
    return (
        parts.groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", "length", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"))
    )
