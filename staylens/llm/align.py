"""Alignment of the tokens of two tokenizers over the bytes of a text.

Each side's tokens get their cumulative ends in bytes, kept as a dictionary from end to index.  The
hash-set intersection of the ends, sorted, cuts both id lists into groups: the shortest stretches that
both tokenizers cover with whole tokens.  Within a group every token of one side is linked to every
token of the other.

A text is cut into words: before white space that follows a word, and before the punctuation behind
it, both tokenizers cut, so those places are common ends and the groups of a text are those of its
words, one after the other.  A worker remembers the groups of words it has seen; unseen words of
many texts are aligned together, as if they were one text.

How often a pair of ids is linked is counted in documents over all of them.  Documents go through in
blocks.  A block sends each of its pairs once, with the number of its documents that hold it; the
totals come back to the block, whose documents know their pairs by place.  So no pair, however
frequent, is more than one row per block, and neither totals nor pairs are collected or broadcast.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate, chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import staged, texts
from staylens.llm.pieces import BLANK, MODEL, pieces
from staylens.llm.tokens import SPACE, TAIL, Encoder, public_path

TOKENIZER = "byte_bpe_50k.json"
#: Words remembered per worker (some 250 MB), and the longest one remembered.
MEMORY = 600_000
LONGEST = 64
#: A word with the white space before it.  Tabs and the like may be one piece with what they follow.
WORD = f"[{SPACE}]*[^{SPACE}]+(?:(?![ \n])[{SPACE}][{SPACE}]*[^{SPACE}]*)*|[{SPACE}]+"
#: Punctuation up to the end of a word.
LAST = f"[{re.escape(TAIL)}]+(?=[ \n]|\\Z)"
#: Texts handled together, and the links after which a block of documents ends.
TOGETHER = 64
BLOCK_LINKS = 2_000_000

Slice = tuple[list[int], list[int]]
#: Tokens of either side, groups as text, and links as ``a << 32 | b``; groups are None where a side's bytes are not the word's.
Known = tuple[int, int, str | None, bytes]


def slices(a: list[int], b: list[int], size_a: list[int], size_b: list[int]) -> Iterator[Slice]:
    """The groups of two id lists, given how many bytes every id stands for."""
    at_a = dict(zip(accumulate(map(size_a.__getitem__, a)), count(1)))
    at_b = dict(zip(accumulate(map(size_b.__getitem__, b)), count(1)))
    i = j = 0
    for end in sorted(at_a.keys() & at_b.keys()):
        x, y = at_a[end], at_b[end]
        yield a[i:x], b[j:y]
        i, j = x, y


def byte_level() -> dict[str, int]:
    """The byte behind every character of a byte-level vocabulary.

    Bytes that Latin-1 prints stand for themselves; the others, in order, are the characters from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class PlainEncoder(Encoder):
    """Token ids where strings of special tokens are ordinary text."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True

    def _whole(self, text: str) -> bytes:
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def token_bytes(self) -> list[bytes]:
        known = byte_level()
        found = [b""] * self.plain.get_vocab_size()
        for token, i in self.plain.get_vocab().items():
            found[i] = bytes(known[c] for c in token) if all(c in known for c in token) else token.encode()
        return found


class Aligner:
    """Groups and links of texts, by a tokenizers file and a sentencepiece model."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a = PlainEncoder(path_a)
        self.b = pieces(path_b, checked=False)
        if self.a.drops_space or not self.b.by_word:
            raise ValueError(f"{path_a} or {path_b} changes white space or joins words")
        self.bytes_a, self.bytes_b = self.a.token_bytes(), self.b.token_bytes()
        self.size_a, self.size_b = ([len(x) for x in of] for of in (self.bytes_a, self.bytes_b))
        # Letters and digits that are never one piece with punctuation.
        joined = "".join({x for x, y in self.b.joined if y in TAIL and x.isalnum()})
        letter = f"[^\\W_{re.escape(joined)}]"
        plain = f"[{SPACE}]*{letter}+(?=[ \n]|\\Z|{LAST})"
        self.split = re.compile(f"{plain}|(?<={letter}){LAST}|[{SPACE}]*[^{SPACE}]*{letter}(?={LAST})|{WORD}")
        self.marked = re.compile("|".join(map(re.escape, self.a.special)))
        self.words: dict[str, Known] = {}

    def _ids(self, new: list[str]) -> list[bytes]:
        """The first side's ids, many in one call but where a special token's string is in the way."""
        self.a.memory = {x: self.a._whole(x) for x in new if self.marked.search(x)}
        self.a._encode([x for x in new if x not in self.a.memory])
        return [self.a.memory[x] for x in new]

    def _learn(self, new: list[str]) -> None:
        """Align unseen words, all of them as one text: where they meet, both sides end."""
        flat_a: list[int] = []
        flat_b: list[int] = []
        sizes = []
        bytes_a, bytes_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for word, raw in zip(new, self._ids(new), strict=True):
            a, b = array("I", raw).tolist(), array("I", self.b._chunk(word.replace(" ", BLANK))).tolist()
            said = word.encode()
            if b"".join(map(bytes_a, a)) == said == b"".join(map(bytes_b, b)):
                flat_a += a
                flat_b += b
                sizes.append((word, len(a), len(b)))
            else:
                self.words[word] = (0, 0, None, b"")
        found = slices(flat_a, flat_b, self.size_a, self.size_b)
        for word, n_a, n_b in sizes:
            groups, links, left = [], array("q"), n_a
            while left:
                a, b = next(found)
                left -= len(a)
                if len(a) == len(b) == 1:
                    groups.append(f"{a[0]}|{b[0]}")
                    links.append(a[0] << 32 | b[0])
                else:
                    groups.append(f"{','.join(map(str, a))}|{','.join(map(str, b))}")
                    links.extend([i << 32 | j for i in a for j in b])
            self.words[word] = (n_a, n_b, ";".join(groups), links.tobytes())

    def align(self, some: list[str]) -> list[tuple[int, int, str, bytes]]:
        """Per text the tokens of either side, the groups as text and the links.

        Without tokens (zeros and an empty text) are texts that are empty, and those where the joined tokens
        of a side are not a blank and the text.
        """
        if len(self.words) > MEMORY:
            self.words = dict(islice(self.words.items(), MEMORY // 2))
        normal = self.b.library.normalize
        # The model may change a text; then its tokens are not the text's bytes.
        whole = [t if t and BLANK not in t and normal(t) == BLANK + t.replace(" ", BLANK) else "" for t in some]
        split = [self.split.findall(" " + t) if t else [] for t in whole]
        unseen = list(set(chain.from_iterable(split)).difference(self.words))
        if unseen:
            self._learn(unseen)
        known = self.words.__getitem__
        result = []
        for words in split:
            n_a, n_b, said, links = zip(*map(known, words), strict=True) if words else ((), (), (None,), ())
            result.append((0, 0, "", b"") if None in said else (sum(n_a), sum(n_b), ";".join(said), b"".join(links)))
        for word in unseen:
            if len(word) > LONGEST:
                del self.words[word]
        return result


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner of two files, kept between tasks."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or public_path(TOKENIZER), path_b or public_path(MODEL)


def aligned(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, groups)``: the groups of every text, as an array of ``(a, b)`` id lists.

    The first side reads a blank and the text, the second one puts its own blank in front.  Null and empty
    texts, and those that a side does not keep byte by byte, have no groups.  One row per row of ``docs``.
    """
    paths = _paths(path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = aligner(*paths)
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(at, TOGETHER)
                found = [x[2] for x in side.align(texts(batch.column(1)))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "groups"])

    # Groups leave a worker as text; the lists are made of it here.
    said = _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, groups string")
    split = F.transform(
        F.filter(F.split("groups", ";"), lambda g: g != ""),
        lambda g: F.struct(
            *(F.split(F.split_part(g, F.lit("|"), F.lit(n)), ",").cast("array<int>").alias(c) for n, c in ((1, "a"), (2, "b")))
        ),
    )
    return said.select("doc_id", split.alias("groups"))


_BLOCKS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "place array<int>, times array<int>, pairs array<long>, docs array<int>"
)
_STATISTICS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _block(number: int, docs: list[tuple], links: list[bytes]) -> pa.RecordBatch:
    """The documents of a block with the places of their pairs, then a row with the block's pairs."""
    sizes = np.array([len(x) // 8 for x in links])
    pairs, place = np.unique(np.frombuffer(b"".join(links), "<i8"), return_inverse=True)
    width = max(len(pairs), 1)
    # Each document's own pairs, in the order of documents.
    own, times = np.unique(np.repeat(np.arange(len(docs)), sizes) * width + place, return_counts=True)
    of, place = own // width, own % width
    ends = np.append(np.searchsorted(of, np.arange(len(docs) + 1)), len(own))
    columns = [[*c, None] for c in zip(*docs, strict=True)]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    none = np.zeros(len(docs) + 1, dtype=np.int64)
    held = np.bincount(place, minlength=len(pairs)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(docs) + 1, number)), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
            _lists(place.astype(np.int32), ends), _lists(times.astype(np.int32), ends),
            _lists(pairs, np.append(none, len(pairs))), _lists(held, np.append(none, len(pairs))),
        ],
        names=["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "place", "times", "pairs", "docs"],
    )


def blocks(docs: DataFrame, paths: tuple[str, str], block_links: int) -> DataFrame:
    """The aligned documents block by block; a row without ``n_a`` has the block's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side, first = aligner(*paths), TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        links: list[bytes] = []
        size = 0
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(at, TOGETHER)
                for doc, (n_a, n_b, said, found) in zip(
                    batch.column(0).to_pylist(), side.align(texts(batch.column(1))), strict=True
                ):
                    n_groups = said.count(";") + 1 if said else 0
                    digest = sha256(said.encode()).hexdigest() if said else ""
                    rows.append((doc, n_a, n_b, n_groups, len(found) // 8, digest))
                    links.append(found)
                    size += len(found) // 8
                    if size >= block_links:
                        yield _block(first, rows, links)
                        first, rows, links, size = first + 1, [], [], 0
        if rows:
            yield _block(first, rows, links)

    return docs.mapInArrow(run, _BLOCKS)


def statistics(
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per row of ``docs``.

    The count of a pair is the number of rows of ``docs`` that hold it linked; ``n_best`` are the links whose
    count is the highest of their first id, ties included, ``count_sum`` the counts of all links.
    ``groups_sha256`` is the digest of the groups written as ``a1,a2|b1;a3|b2,b3``.  Null and empty texts and
    those that a side does not keep byte by byte have zeros and an empty digest.  Repeated rows are
    documents of their own, ids may be null, columns are taken by name; others do not matter.
    """
    found = staged(blocks(_rows(docs, id_col, text_col), _paths(path_a, path_b), block_links), "aligned_blocks")
    held = (
        found.filter(F.col("n_a").isNull())
        .select(F.col("block").alias("owner"), F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "held"))
        .select("owner", "place", F.col("held.pairs").alias("pair"), F.col("held.docs").alias("docs"))
    )
    totals = held.groupBy("pair").agg(F.sum("docs").alias("total"))
    # A first id has no more pairs than the second vocabulary has ids.
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    totals = totals.withColumn("best", F.col("total") == F.max("total").over(of_a))
    back = held.select("owner", "place", "pair").join(totals, "pair").select("owner", "place", "total", "best")

    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        total, best = np.zeros(pairs.num_rows, dtype=np.int64), np.zeros(pairs.num_rows, dtype=np.int64)
        if pairs.num_rows:
            at = pairs["place"].to_numpy()
            total[at], best[at] = pairs["total"].to_numpy(), pairs["best"].to_numpy().astype(np.int64)
        place, times = docs["place"].combine_chunks(), docs["times"].combine_chunks()
        ends = np.cumsum([0, *place.value_lengths().to_pylist()])
        of, n = place.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)

        def per_doc(values: np.ndarray) -> pa.Array:
            sums = np.append(0, np.cumsum(values * n))
            return pa.array(np.diff(sums[ends]))

        kept = [docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table(
            [*kept, per_doc(best[of]), per_doc(total[of]), docs["groups_sha256"]],
            names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
        )

    rows = found.filter(F.col("n_a").isNotNull()).drop("pairs", "docs")
    return rows.groupBy("block").cogroup(back.groupBy("owner")).applyInArrow(run, _STATISTICS)
