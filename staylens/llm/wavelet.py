"""Token ids as wavelet matrices: one succinct structure per shard, kept in Parquet files.

A shard holds the ids of consecutive documents.  For every bit of the ids, from the highest, a
plane keeps that bit of all tokens in their current order; the tokens are then reordered, those
with a 0 first, before the next plane.  With the number of ones before every block of a plane
(rank), any token can be read, any id counted in any range, and any occurrence located, without
decoding the rest.  A row of the file is a whole shard: directory, planes and rank blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylens.llm.common import staged, texts
from staylens.llm.tokens import encoder, public_path

TOKENIZER = "word_bpe_49k.json"
END = 1
#: Tokens after which a shard is closed, at the end of a document.
SHARD_TOKENS = 1 << 18
#: Bits per rank block.
BLOCK = 512
SCHEMA = (
    "part int, nth int, n_tokens long, width int, doc_ids array<long>, lengths array<long>, "
    "zeros array<long>, planes array<binary>, ranks array<binary>"
)


@dataclass
class WaveletMatrix:
    n: int
    width: int
    zeros: list[int]
    planes: list[np.ndarray]
    ranks: list[np.ndarray]

    @classmethod
    def build(cls, ids: np.ndarray, width: int | None = None) -> WaveletMatrix:
        width = width or max(1, int(ids.max(initial=0)).bit_length())
        kind = np.uint16 if width <= 16 else np.uint32
        ids = ids.astype(kind)
        zeros, planes, ranks = [], [], []
        for shift in reversed(range(width)):
            ones = (ids & kind(1 << shift)) != 0
            packed = np.packbits(ones, bitorder="little")
            padded = np.zeros(-(-len(ids) // BLOCK) * (BLOCK // 8), dtype=np.uint8)
            padded[: len(packed)] = packed
            per_block = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1)
            ranks.append(np.concatenate([[0], np.cumsum(per_block)]).astype("<u4"))
            planes.append(padded)
            low = np.flatnonzero(~ones)
            zeros.append(len(low))
            ids = np.concatenate([ids.take(low), ids.take(np.flatnonzero(ones))])
        return cls(len(ids), width, zeros, planes, ranks)

    def _ones(self, level: int, at: int) -> int:
        """Ones of a plane before a position."""
        block, rest = divmod(at, BLOCK)
        total = int(self.ranks[level][block])
        if rest:
            raw = self.planes[level][block * BLOCK // 8 : block * BLOCK // 8 + -(-rest // 8)]
            total += int(np.unpackbits(raw, bitorder="little")[:rest].sum())
        return total

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3]) >> (at & 7) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(self.width):
            bit, ones = self._bit(level, at), self._ones(level, at)
            value = value << 1 | bit
            at = self.zeros[level] + ones if bit else at - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token before ``end`` lie after the last plane."""
        start = 0
        for level in range(self.width):
            ones = self._ones(level, start), self._ones(level, end)
            if token >> self.width - 1 - level & 1:
                start, end = self.zeros[level] + ones[0], self.zeros[level] + ones[1]
            else:
                start, end = start - ones[0], end - ones[1]
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token in ``[start, end)`` (rank)."""
        if token >> self.width or token < 0:
            return 0
        inside = [self._range(token, at) for at in (start, self.n if end is None else end)]
        return (inside[1][1] - inside[1][0]) - (inside[0][1] - inside[0][0])

    def locate(self, token: int, nth: int) -> int:
        """The position of the ``nth`` occurrence of a token, from 0 (select)."""
        if not 0 <= nth < self.count(token):
            raise IndexError(nth)
        at = self._range(token, self.n)[0] + nth
        for level in reversed(range(self.width)):
            one = token >> self.width - 1 - level & 1
            at = self._find(level, one, at - self.zeros[level] if one else at)
        return at

    def _find(self, level: int, bit: int, nth: int) -> int:
        """The position of the ``nth`` 0 or 1 of a plane."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, nth, side="right")) - 1
        raw = self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8]
        places = np.flatnonzero(np.unpackbits(raw, bitorder="little") == bit)
        return block * BLOCK + int(places[nth - int(before[block])])

    def decode(self) -> np.ndarray:
        """All ids, by undoing the reorderings from the last plane up."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        ids = np.zeros(self.n, dtype=kind)
        for level in reversed(range(self.width)):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            before = np.empty_like(ids)
            before[np.flatnonzero(~ones)] = ids[: self.zeros[level]]
            before[np.flatnonzero(ones)] = ids[self.zeros[level] :] | kind(1 << self.width - 1 - level)
            ids = before
        return ids


def matrix_of(row) -> WaveletMatrix:
    """The matrix in a row of a shard file."""
    return WaveletMatrix(
        row["n_tokens"],
        row["width"],
        list(row["zeros"]),
        [np.frombuffer(p, dtype=np.uint8) for p in row["planes"]],
        [np.frombuffer(r, dtype="<u4") for r in row["ranks"]],
    )


def write_shards(
    docs: DataFrame,
    folder: str,
    path: str | None = None,
    end: int = END,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode documents in ascending order of id, each followed by ``end``, into shard files.

    Rows without an id come last; equal ids are in the order of a hash of their texts.  A null
    text is an empty one.  Documents are range-partitioned, and a partition becomes one file of shards.
    """
    path = path or public_path(TOKENIZER)
    last = np.array([end], dtype="<u4").tobytes()

    def shard(part: int, nth: int, doc_ids: list, raw: list[bytes]) -> pa.RecordBatch:
        matrix = WaveletMatrix.build(np.frombuffer(b"".join(raw), dtype="<u4"))
        row = {
            "part": part,
            "nth": nth,
            "n_tokens": matrix.n,
            "width": matrix.width,
            "doc_ids": doc_ids,
            "lengths": [len(r) // 4 for r in raw],
            "zeros": matrix.zeros,
            "planes": [p.tobytes() for p in matrix.planes],
            "ranks": [r.tobytes() for r in matrix.ranks],
        }
        kinds = {
            "part": pa.int32(), "nth": pa.int32(), "n_tokens": pa.int64(), "width": pa.int32(),
            "doc_ids": pa.list_(pa.int64()), "lengths": pa.list_(pa.int64()), "zeros": pa.list_(pa.int64()),
            "planes": pa.list_(pa.binary()), "ranks": pa.list_(pa.binary()),
        }
        return pa.RecordBatch.from_arrays([pa.array([row[c]], k) for c, k in kinds.items()], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, nth = encoder(path), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        raw: list[bytes] = []
        size = 0
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                for doc, ids in zip(batch.column(0).to_pylist(), encode.ids(texts(batch.column(1))), strict=True):
                    doc_ids.append(doc)
                    raw.append(ids + last)
                    size += len(raw[-1]) // 4
                    if size >= shard_tokens:
                        yield shard(part, nth, doc_ids, raw)
                        doc_ids, raw, size, nth = [], [], 0, nth + 1
        if doc_ids:
            yield shard(part, nth, doc_ids, raw)

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_hash")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("doc_id", "text").mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)


def directory(shards: DataFrame) -> DataFrame:
    """``(part, nth, before)``: tokens of all earlier shards; a row per shard, so it is small."""
    order = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("part", "nth", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("before"))


def read_documents(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` decoded from the files; ``ids`` as unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                raw = matrix_of(row).decode().astype("<u4").tobytes()
                lengths = np.array(row["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["before"]),
                        pa.array(lengths),
                        pa.array([raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    # A table of its own, so that its size is known and the shards need not be shuffled.
    located = shards.join(staged(directory(shards), "wavelet_directory"), ["part", "nth"])
    return located.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_counts(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """``(token, n)``: occurrences of the given tokens, counted on the planes."""
    tokens = sorted(set(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = matrix_of(batch.slice(i, 1).to_pylist()[0])
                counts = [matrix.count(t) for t in tokens]
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(counts, pa.int64())], names=["token", "n"])

    return shards.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
