"""Substring dedup over sliding spans of sentences.

A text is cut into sentences, and every run of several consecutive sentences is hashed.  A run
that occurs again, in another text or later in the same one, is a repeat of its first
occurrence, and the sentences it covers are removed there; the first occurrence stays.

Runs are as short as they may be: at least ``least_sentences`` sentences and ``least_words``
words.  From every sentence one run is taken forwards and one backwards, so that a repeated
passage is covered to its last sentence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import texts

LEAST_SENTENCES = 3
LEAST_WORDS = 20
#: A sentence of over ``LONGEST`` words is cut after the word with the least hash of every ``NEAR``
#: consecutive words, so a cut depends on a few words on either side of it, not on the cut before.
#: Of a passage all copies are cut alike but for ``2 * NEAR - 1`` words at its start and ``2 * NEAR - 2``
#: at its end; the 30 words left of 51 hold a run, which has at most ``LEAST_SENTENCES * LONGEST``.
NEAR, LONGEST = 6, 10
#: Bits of the hash of a run beside its 64, and bits for the number of its sentences (31 are for the first).
EXTRA, UNITS = 23, 9
#: An odd number that spreads rows.
SPREAD = np.int64(0x5851F42D4C957F2D)
#: A sentence ends after its full stop and white space, at a line break, or when it is too long.
STOPS = ".!?…。"
#: White space by code point; there is none beyond the ideographic blank.
IS_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])
STOP_CODES = np.array([ord(c) for c in STOPS], dtype=np.uint32)


def cuts(text: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words of a text in lower case, the last word of every sentence, and where every word's piece ends.

    A piece is a word with the white space after it, so the ends cut the whole text (what comes before
    the first word belongs to the first piece).
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    space = IS_SPACE[np.minimum(points, len(IS_SPACE) - 1)]
    starts = np.flatnonzero(~space & np.append(True, space[:-1])) if len(points) else np.empty(0, dtype=np.int64)
    if not len(starts):
        return [], starts, starts
    stop = np.isin(points[~space & np.append(space[1:], True)], STOP_CODES)
    of_break = np.searchsorted(starts, np.flatnonzero(points == ord("\n")), side="right") - 1
    stop[of_break[of_break >= 0]] = True
    stop[-1] = True
    low = text.lower()
    if (space & (points > ord("\r")) & (points != ord(" "))).any():  # bytes are not cut there
        words = [w.encode("utf-8", "replace") for w in low.split()]
    else:
        words = low.encode("utf-8", "replace").split()
    last = np.flatnonzero(stop | least_words_of(words, stop))
    return words, last, np.append(starts[1:], len(text))


def sentences(text: str) -> tuple[list[str], list[int], list[int]]:
    """Normalised sentences, where each ends in the text, and their words."""
    words, last, ends = cuts(text)
    joined, at = coded_sentences(words, last)
    found = [bytes(joined[a : b - 1]).decode() for a, b in zip(at[:-1], at[1:], strict=True)]
    return found, ends[last].tolist(), np.diff(last, prepend=-1).tolist()


def coded_sentences(words: list[bytes], last: np.ndarray) -> tuple[bytearray, list[int]]:
    """Normalised sentences, a line each, and where every line starts (and would start after the last)."""
    joined = bytearray(b" ".join(words))
    at = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)[last]
    if len(at):
        np.frombuffer(joined, dtype=np.uint8)[at[:-1] - 1] = ord("\n")
    return joined, [0, *at.tolist()]


def least_words_of(words: list[bytes], stop: np.ndarray) -> np.ndarray:
    """Which words have the least hash, the last of equal ones, of ``NEAR`` words of one long sentence."""
    least = np.zeros(len(words), dtype=bool)
    sizes = np.diff(np.flatnonzero(stop), prepend=-1)
    long = np.repeat(sizes > LONGEST, sizes)
    if not long.any():
        return least
    hashes = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    stops = np.concatenate([[0], np.cumsum(stop)])
    whole = np.flatnonzero((stops[NEAR - 1 : -1] == stops[:-NEAR]) & long[: 1 - NEAR])
    window = np.lib.stride_tricks.sliding_window_view(hashes, NEAR)[whole, ::-1]
    least[whole + NEAR - 1 - window.argmin(axis=1)] = True
    return least


def runs(sizes: np.ndarray, least_sentences: int, least_words: int) -> np.ndarray:
    """``(first, end)`` of the shortest runs forwards from and backwards to every sentence, each once."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    n = len(sizes)
    first = np.arange(n)
    end = np.maximum(np.searchsorted(total, total[:-1] + least_words), first + least_sentences)
    last = np.arange(1, n + 1)
    start = np.minimum(np.searchsorted(total, total[1:] - least_words, side="right") - 1, last - least_sentences)
    other = (start >= 0) & (end[np.maximum(start, 0)] != last)
    return np.concatenate([np.stack([first, end], axis=1)[end <= n], np.stack([start, last], axis=1)[other]])


def occurrences(docs: DataFrame, least_sentences: int, least_words: int, id_col: str, text_col: str) -> DataFrame:
    """``(run, doc_id, text_hash, at)``: what a task knows of its runs, in four longs a row.

    A run is identified by 87 bits of its hash: ``run``, and ``EXTRA`` bits in ``at``.  Below them ``at`` has
    the run's first sentence and how many it has.  For each run a task sends its first occurrence,
    which competes with those of other tasks.  Its other occurrences are repeats whatever the others
    hold: their ``at`` is negative, and ``run`` is a number of their own, which spreads them in the shuffle,
    so a run that is everywhere sends a row per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        owners: list[tuple[bool, int, int]] = []
        for batch in batches:
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), strict=True):
                words, last, _ = cuts(text)
                places = runs(np.diff(last, prepend=-1), least_sentences, least_words)
                if not len(places):
                    continue
                joined, at = coded_sentences(words, last)
                view, digest = memoryview(joined), xxhash.xxh3_128_digest
                hashes = np.frombuffer(b"".join([digest(view[at[a] : at[b] - 1]) for a, b in places.tolist()]), dtype=np.int64)
                rows = np.empty((len(places), 3), dtype=np.int64)
                extra = hashes[1::2] & ((1 << EXTRA) - 1)
                rows[:, 0], rows[:, 1] = hashes[::2], len(owners)
                rows[:, 2] = extra << (63 - EXTRA) | places[:, 0] << UNITS | (places[:, 1] - places[:, 0])
                found.append(rows)
                owners.append((doc is None, doc or 0, key))
        if not found:
            return
        every = np.concatenate(found)
        # Owners in the order in which first occurrences are chosen; equal owners are one.
        ranked = {o: i for i, o in enumerate(sorted(set(owners)))}
        rank = np.array([ranked[o] for o in owners], dtype=np.int64)[every[:, 1]]
        extra = every[:, 2] >> (63 - EXTRA)
        order = np.lexsort((every[:, 2], rank, extra, every[:, 0]))
        every, rank, extra = every[order], rank[order], extra[order]
        alike = (every[1:, 0] == every[:-1, 0]) & (extra[1:] == extra[:-1])
        keep = np.append(True, ~(alike & (rank[1:] == rank[:-1]) & (every[1:, 2] == every[:-1, 2])))
        # Of equal rows the first one stays, so what follows a row is alike if it was before.
        every, rank, again = every[keep], rank[keep], np.append(False, alike)[keep]
        every[again, 0] ^= (rank[again] * SPREAD + every[again, 2]) * SPREAD
        every[again, 2] |= np.int64(-1 << 63)
        # In document order: rows of one document lie together and compress well.
        order = np.argsort(rank, kind="stable")
        every, rank, again = every[order], rank[order], again[order]
        names = np.array(sorted(set(owners)), dtype=object)
        no_id, ids, keys = (np.array([o[i] for o in names], dtype=k) for i, k in ((0, bool), (1, np.int64), (2, np.int64)))
        for at in range(0, len(every), 1 << 16):
            part = slice(at, at + (1 << 16))
            own = rank[part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(every[part, 0]), pa.array(ids[own], mask=no_id[own]), pa.array(keys[own]), pa.array(every[part, 2])],
                names=["run", "doc_id", "text_hash", "at"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_hash"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.mapInArrow(run, "run long, doc_id long, text_hash long, at long")


def repeats(
    docs: DataFrame, least_sentences: int, least_words: int, id_col: str, text_col: str
) -> DataFrame:
    """``(no_id, doc_id, text_hash, spans)``: runs of sentences to remove, per document that has any."""
    if least_words >= 1 << UNITS or least_sentences >= 1 << UNITS:
        raise ValueError(f"a run has fewer than {1 << UNITS} sentences and words at least")
    found = occurrences(docs, least_sentences, least_words, id_col, text_col).repartition("run")
    first = F.shiftrightunsigned(F.shiftleft("at", EXTRA + 1), EXTRA + 1 + UNITS)
    placed = found.select(
        "run", "doc_id", "text_hash", F.shiftrightunsigned("at", 63 - EXTRA).alias("extra"), first.alias("first"),
        (first + F.col("at").bitwiseAND((1 << UNITS) - 1)).alias("end"),
    )
    order = Window.partitionBy("run", "extra").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash", "first")
    # Equal places are one document whose copies were read by several tasks.
    again = F.col("extra") >= 1 << EXTRA
    later = placed.withColumn("nth", F.rank().over(order)).filter(again | (F.col("nth") > 1))
    keys = {"no_id": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0))}
    spans = F.collect_list(F.struct("first", "end")).alias("spans")
    return later.withColumns(keys).groupBy("no_id", "doc_id", "text_hash").agg(spans)


def dedup(
    docs: DataFrame,
    least_sentences: int = LEAST_SENTENCES,
    least_words: int = LEAST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, text, n_sentences, n_removed, removed_words)``, one row per row of ``docs``.

    The first occurrence of a run is that with the smallest id, then the smallest hash of the
    text, then the earliest; rows without an id come last.  Rows repeated in id and text are one
    document: they are no repeats of each other and all lose the same sentences.  A null text
    stays null and has no sentences; a text whose sentences are all repeats becomes empty.
    """
    spans = repeats(docs, least_sentences, least_words, id_col, text_col)
    keys = ["no_id", "doc_id", "text_hash"]
    rows = docs.select(
        F.col(id_col).isNull().alias("no_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_hash"),
        F.col(text_col).cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                for column, value in zip(columns, cut(text, cuts or []), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True))],
                names=["doc_id", "text", "n_sentences", "n_removed", "removed_words"],
            )

    joined = rows.join(spans, keys, "left").select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "text", "spans")
    return joined.mapInArrow(run, "doc_id long, text string, n_sentences long, n_removed long, removed_words long")


def cut(text: str | None, spans: list[dict]) -> tuple[str | None, int, int, int]:
    """The text without the sentences of ``spans``, its sentences, those removed and their words."""
    if text is None:
        return None, 0, 0, 0
    _, last, places = cuts(text)
    if not spans:
        return text, len(last), 0, 0
    ends, sizes = places[last].tolist(), np.diff(last, prepend=-1)
    gone = np.zeros(len(ends), dtype=bool)
    for s in spans:
        gone[s["first"] : s["end"]] = True
    starts = [0, *ends[:-1]]
    kept = "".join(text[a:b] for a, b, g in zip(starts, ends, gone, strict=True) if not g)
    return kept.rstrip() if gone[-1] else kept, len(ends), int(gone.sum()), int(sizes[gone].sum())
