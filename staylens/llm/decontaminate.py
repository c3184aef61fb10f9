"""Benchmark decontamination: a hash set of normalised test n-grams, scanned over token windows."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import staged, utf8

WINDOW = 10
#: Most bytes of benchmark text that are sent to every task.  Larger benchmarks are split into
#: parts of this size, each sent in turn, and the hits of the parts are united.
BROADCAST_BYTES = 32_000_000
#: Fixed value: what a word is, on UTF-8 bytes (every byte of a non-ASCII character counts).
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Multiplier of the polynomial window hash, odd.
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Column in which ``clean`` carries the hits of the parts before.
HITS = "_decontaminate_hits"


def words_of(text: bytes) -> list[bytes]:
    """The normalised words: A-Z lower-cased, split at everything that is no letter or digit."""
    return WORD.findall(text.lower())


@dataclass
class Windows:
    """The windows of benchmark items as sorted hashes per length, with what verifies a hit."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    #: length -> sorted hashes, and per hash the ids of its words and the items that have it
    hashes: dict[int, np.ndarray] = field(default_factory=dict)
    grams: dict[int, dict[tuple[int, ...], list[str]]] = field(default_factory=dict)

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], size: int = WINDOW) -> Windows:
        self = cls()
        grams: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text))
            length = min(size, len(ids))
            for at in range(len(ids) - length + 1 if length else 0):
                grams[length][ids[at : at + length]].add(item)
        for length, found in grams.items():
            self.grams[length] = {g: sorted(i) for g, i in found.items()}
            rows = np.array(list(found), dtype=np.uint64).reshape(-1, length)
            self.hashes[length] = np.unique(rolling(rows.ravel(), length)[::length])
        return self

    def hits(self, text: bytes) -> tuple[int, np.ndarray, set[str]]:
        """Number of words, which words are hit, and the items with a window in the text."""
        words = words_of(text)
        known = self.vocabulary.get
        ids = np.fromiter((known(w, 0) for w in words), dtype=np.uint64, count=len(words))
        hit = np.zeros(len(words), dtype=bool)
        items: set[str] = set()
        for length, hashes in self.hashes.items():
            if len(ids) < length:
                continue
            # A window with an unknown word is no hit: only runs of known words are hashed.
            unknown = np.concatenate([[0], np.cumsum(ids == 0)])
            maybe = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(maybe):
                continue
            window = rolling(ids, length)[maybe]
            at = np.searchsorted(hashes, window)
            at[at == len(hashes)] = 0
            for start in maybe[hashes[at] == window].tolist():
                found = self.grams[length].get(tuple(ids[start : start + length].tolist()))
                if found:
                    hit[start : start + length] = True
                    items.update(found)
        return len(words), hit, items


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` ids, modulo 2**64."""
    count = len(ids) - length + 1
    total = np.zeros(max(count, 0), dtype=np.uint64)
    for i in range(length if count > 0 else 0):
        total = total * BASE + ids[i : i + count]
    return total


def parts(benchmark: DataFrame, item_col: str, text_col: str, limit: int = BROADCAST_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in parts whose size is proven: at most ``limit`` bytes of text and one item."""
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).filter(
        F.col(item_col).isNotNull() & F.col(text_col).isNotNull()
    )
    part: list[tuple[str, bytes]] = []
    size = 0
    for item, text in rows.toLocalIterator():
        raw = text.encode()
        if part and size + len(raw) > limit:
            yield part
            part, size = [], 0
        part.append((item, raw))
        size += len(raw)
    yield part


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(doc_id, n_words, hits, items)``, one row per row of ``docs``.

    ``hits`` are the positions of words inside an occurrence of a benchmark window, ``items``
    the items, as strings, that have such a window.  A window is ``window`` consecutive words
    of an item, or all of a shorter item that has words.  Null texts have no words; items
    without id or text match nothing; repeated items and rows count as they come.

    One scan without a shuffle as long as the benchmark fits one part; otherwise one scan per
    part, whose hits are united per row.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = [_mark_part(rows, part, window) for part in parts(benchmark, item_col, "text", limit)]
    if len(found) == 1:
        return found[0]
    # Rows are told apart by id and text; repeated rows have equal hits and stay repeated.
    every = staged(
        _union([f.withColumn("part", F.lit(i)) for i, f in enumerate(found)]), "decontaminate_parts"
    )
    united = (
        every.filter("size(hits) > 0 OR part = 0")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    first = every.filter("part = 0").select("doc_id", "text_hash", "n_words")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash"))
    return first.alias("a").join(united.alias("b"), same).select("a.doc_id", "a.text_hash", "n_words", "hits", "items")


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _mark_part(rows: DataFrame, part: list[tuple[str, bytes]], window: int) -> DataFrame:
    windows = rows.sparkSession.sparkContext.broadcast(Windows.of(part, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = windows.value
        for batch in batches:
            counts, hits, items = [], [], []
            for text in utf8(batch.column(2)):
                n, hit, found = known.hits(text)
                counts.append(n)
                hits.append(np.flatnonzero(hit).astype(np.int32))
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(hits, pa.list_(pa.int32())),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["doc_id", "text_hash", "n_words", "hits", "items"],
            )

    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, n_words long, hits array<int>, items array<string>"
    )


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document the digest of ``mark``: words, hit words, items and their SHA-256."""
    return mark(docs, benchmark, **options).select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def remove_hits(text: bytes, hit: np.ndarray) -> str:
    """The text without its hit words and what separates two hit words."""
    spans = [m.span() for m in WORD.finditer(text.lower())]
    kept, end = [], 0
    for start, stop in _runs(hit):
        kept.append(text[end : spans[start][0]])
        end = spans[stop - 1][1]
    kept.append(text[end:])
    return b"".join(kept).decode("utf-8", "replace")


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    drop_share: float = 0.5,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` without benchmark passages, all columns kept.

    A document with more than ``drop_share`` of its words hit goes; from the others the hit
    spans are cut.  Documents without a hit are returned as they are, null texts included.
    The hits of all parts of a large benchmark are found in the whole text and united, as in
    ``mark``; the share and the cuts are settled once, after the last part.
    """
    at = docs.columns.index(text_col)
    *others, last = parts(benchmark, item_col, "text", limit)
    rows = docs.withColumn(HITS, F.lit(None).cast("array<int>")) if others else docs
    for part in others:
        rows = _add_hits(rows, part, window, at)
    return _cut_hits(rows, docs, last, drop_share, window, at)


def _united(known: Windows, raw: bytes, before: list[int] | None) -> tuple[int, np.ndarray]:
    """Number of words, and which are hit by these windows or were ``before``."""
    n, hit, _ = known.hits(raw)
    if before:
        hit[before] = True
    return n, hit


def _add_hits(rows: DataFrame, part: list[tuple[str, bytes]], window: int, at: int) -> DataFrame:
    windows = rows.sparkSession.sparkContext.broadcast(Windows.of(part, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = windows.value
        for batch in batches:
            found = []
            for raw, before in zip(utf8(batch.column(at)), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                found.append(np.flatnonzero(_united(known, raw, before)[1]).astype(np.int32))
            arrays = [*batch.columns[:-1], pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def _cut_hits(
    rows: DataFrame, docs: DataFrame, part: list[tuple[str, bytes]], drop_share: float, window: int, at: int
) -> DataFrame:
    windows = rows.sparkSession.sparkContext.broadcast(Windows.of(part, window))
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = windows.value
        for batch in batches:
            column, keep = batch.column(at).to_pylist(), np.ones(batch.num_rows, dtype=bool)
            marked = batch.column(width).to_pylist() if batch.num_columns > width else [None] * batch.num_rows
            for i, (raw, before) in enumerate(zip(utf8(batch.column(at)), marked, strict=True)):
                n, hit = _united(known, raw, before)
                if hit.any():
                    keep[i] = hit.sum() <= drop_share * n
                    column[i] = remove_hits(raw, hit)
            arrays = list(batch.columns[:width])
            arrays[at] = pa.array(column, batch.schema.field(at).type)
            schema = pa.schema([batch.schema.field(i) for i in range(width)])
            yield pa.RecordBatch.from_arrays(arrays, schema=schema).filter(pa.array(keep))

    return rows.mapInArrow(run, docs.schema)
