"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text's symbols are its characters; an agenda holds every pair of adjacent symbols that together
are a piece, best score first, the leftmost of equal ones.  The best pair is merged, the pairs of
the new symbol with its neighbours go on the agenda, and those of symbols that are gone leave it.  What is no piece at the end is spelt in byte pieces.

No merge joins two characters that no piece has side by side, so the agenda of a text falls apart
into those of its chunks.  Words are cut off at blanks, which stay in front of them, and at line
breaks, and their punctuation is cut off where no piece joins it to them; a worker remembers
the ids of words and chunks it has seen.

Every chunk that a worker has not seen is also encoded by the sentencepiece library, many of an Arrow
batch at a time, and a difference is an error.  Models that trim white space, or join more than a
word, have no chunks; there the agenda runs over whole texts, and whole texts are compared.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, islice, repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import texts
from staylens.llm.tokens import TAIL, public_path

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
#: Words, and chunks, remembered per worker and model (some 200 MB), and the longest one remembered.
#: When they are too many, the half seen first stays: frequent ones come early.
MEMORY = 600_000
LONGEST = 64
#: Symbols of a chunk whose agenda is a list; and what no piece's score is there.
SHORT = 40
NONE = 1 << 30
WORDS = re.compile(f"\n+|{BLANK}*[^{BLANK}\n]+|{BLANK}+")
#: Texts handled together: unseen words of all of them are one call of the library.
TOGETHER = 256


class MismatchError(RuntimeError):
    """The agenda and the library disagree on a text."""


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, checked: bool = True) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.checked = checked
        lib, size = self.library, self.library.vocab_size()
        apart = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(size)]
        if any(lib.is_unused(i) for i in range(size)):
            raise ValueError(f"{path} has unused pieces, which are split again after merging")
        self.piece_id = {lib.id_to_piece(i): i for i in range(size) if not apart[i]}
        self.byte_id = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(size) if lib.is_byte(i)}
        scores = {p: lib.get_score(i) for p, i in self.piece_id.items()}
        # Equal scores are equal ranks: then the place decides.
        rank = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {p: rank[s] for p, s in scores.items() if len(p) > 1}
        self.joined = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}
        #: Whether white space comes through as it is, one mark in front, so that words stand alone.
        self.keeps_space = lib.normalize(" a  b ") == f"{BLANK}{BLANK}a{BLANK}{BLANK}b{BLANK}"
        self.by_word = self.keeps_space and not any("\n" in p or BLANK in p.lstrip(BLANK) for p in self.rank)
        #: A line break in front keeps the library's own mark away from a chunk without one.
        self.front = np.array(lib.encode("\n"), dtype="<u4").tobytes()
        #: Ids as little-endian unsigned 32-bit integers.
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The symbols of ``text`` when its agenda is empty."""
        return self._short(text) if len(text) <= SHORT else self._long(text)

    def _short(self, text: str) -> list[str]:
        # The agenda of a few symbols is a list: the score of every symbol with its right neighbour.
        score = self.rank.get
        symbols = list(text)
        agenda = [score(pair, NONE) for pair in map(add, symbols, symbols[1:])]
        while agenda and (best := min(agenda)) != NONE:
            i = agenda.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score(symbols[i] + symbols[i + 1], NONE)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + symbols[i], NONE)
        return symbols

    def _long(self, text: str) -> list[str]:
        # That of many is a heap of (score, start, length).
        n, score = len(text), self.rank.get
        bits = n.bit_length()
        mask = (1 << bits) - 1
        ends = list(range(1, n + 1))  # of the symbol that starts there; 0: none does
        before = list(range(-1, n - 1))  # start of the symbol to the left
        agenda = [(r << 2 * bits) | (i << bits) | 2 for i in range(n - 1) if (r := score(text[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = entry >> bits & mask
            right = ends[left]
            if not right or right == n or ends[right] - left != entry & mask:
                continue
            end = ends[left] = ends[right]
            ends[right] = 0
            if end < n:
                before[end] = left
                after = ends[end]
                if (r := score(text[left:after])) is not None:
                    heappush(agenda, (r << 2 * bits) | (left << bits) | (after - left))
            start = before[left]
            if start >= 0 and (r := score(text[start:end])) is not None:
                heappush(agenda, (r << 2 * bits) | (start << bits) | (end - start))
        return [text[i:e] for i, e in enumerate(ends) if e]

    def _spelt(self, symbol: str) -> list[int]:
        """A symbol that is no piece: its bytes, or the unknown id."""
        if not self.byte_id:
            return [self.library.unk_id()]
        return [self.byte_id[b] for b in symbol.encode()]

    def _chunk(self, text: str) -> bytes:
        symbols = self.merged(text)
        ids = list(map(self.piece_id.get, symbols))
        if None in ids:
            spelt = [self._spelt(x) if i is None else [i] for x, i in zip(symbols, ids, strict=True)]
            ids = list(chain.from_iterable(spelt))
        return array("I", ids).tobytes()

    def _cut(self, word: str) -> list[str]:
        """``word`` and the punctuation after it, where no piece joins them."""
        core = word.rstrip(TAIL)
        n = len(core)
        if not 0 < n < len(word) or word[n - 1 : n + 1] in self.joined:
            return [word]
        return [core, word[n:]]

    def _learn(self, unseen: set[str]) -> None:
        cut = [(word, self._cut(word) if self.by_word else [word]) for word in unseen]
        new = set(chain.from_iterable(c for _, c in cut)).difference(self.chunks)
        found = {chunk: self._chunk(chunk) for chunk in new}
        if self.checked and self.by_word:
            self._compare(found)
        self.chunks.update(found)
        known = self.chunks.__getitem__
        for word, chunks in cut:
            self.words[word] = b"".join(map(known, chunks))
        for chunk in new:
            if len(chunk) > LONGEST or not self.by_word:
                del self.chunks[chunk]

    def _compare(self, found: dict[str, bytes]) -> None:
        # The library puts a mark in front, which is a chunk's own first one.
        marked = [c for c in found if c[0] == BLANK and len(c) > 1]
        plain = [c for c in found if c[0] != BLANK]
        shown = [c[1:] for c in marked] + ["\n" + c for c in plain]
        fronts = chain(repeat(b"", len(marked)), repeat(self.front))
        for chunk, front, ids in zip(chain(marked, plain), fronts, self.library.encode(shown, num_threads=1)):
            if array("I", ids).tobytes() != front + found[chunk]:
                raise MismatchError(f"{chunk[:100]!r}: the library has {ids[:50]}")

    def encode(self, some: list[str]) -> list[bytes]:
        """The ids of every text as little-endian unsigned 32-bit integers, without start and end ids."""
        for memory in (self.words, self.chunks):
            if len(memory) > MEMORY:
                kept = dict(islice(memory.items(), MEMORY // 2))
                memory.clear()
                memory.update(kept)
        normal = self.library.normalize
        split = [WORDS.findall(normal(t)) if self.by_word else [normal(t)] for t in some]
        unseen = set(chain.from_iterable(split)).difference(self.words)
        if unseen:
            self._learn(unseen)
        known = self.words.__getitem__
        result = [b"".join(map(known, words)) for words in split]
        for word in unseen:
            if len(word) > LONGEST or not self.by_word:
                del self.words[word]
        if self.checked and not self.by_word:
            for text, ids, theirs in zip(some, result, self.library.encode(some, num_threads=1), strict=True):
                if np.array(theirs, dtype="<u4").tobytes() != ids:
                    raise MismatchError(f"{text[:100]!r}: the library has {theirs[:50]}")
        return result

    def decode(self, some: list[bytes]) -> list[str]:
        """The library's texts of ids, which may hold start and end ids."""
        return self.library.decode([np.frombuffer(i, "<u4").tolist() for i in some], num_threads=1)

    def token_bytes(self) -> list[bytes]:
        """What every piece stands for: its characters with marks as blanks, or its byte; nothing for control ids."""
        lib = self.library
        spelt = {i: bytes([b]) for b, i in self.byte_id.items()}
        names = {i: p.replace(BLANK, " ").encode() for p, i in self.piece_id.items()}
        return [spelt.get(i, names.get(i, b"")) for i in range(lib.vocab_size())]


_PIECES: dict[tuple[str, bool], Pieces] = {}


def pieces(path: str, checked: bool = True) -> Pieces:
    """The worker's encoder of a model, kept between tasks."""
    if (path, checked) not in _PIECES:
        _PIECES[path, checked] = Pieces(path, checked)
    return _PIECES[path, checked]


def encoded(
    docs: DataFrame,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    checked: bool = True,
) -> DataFrame:
    """``(doc_id, ids, decoded)``, one row per row of ``docs``: token ids with the end id, and their text.

    A null text is an empty one and has the end id only.  Repeated rows are rows of their own, ids may
    be null.  Columns are taken by name; others do not matter.  With ``checked``, a text that the library
    encodes otherwise stops the job (``MismatchError``).
    """
    path = path or public_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, checked)
        end = np.array([model.library.eos_id()], dtype="<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(at, TOGETHER)
                ids = [i + end for i in model.encode(texts(batch.column(1)))]
                ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), lists, pa.array(model.decode(ids), pa.string())], names=["doc_id", "ids", "decoded"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decoded(rows: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, text)`` of rows of token ids; null ids are none, and start and end ids say nothing."""
    path = path or public_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            ids = [[x for x in i or [] if x is not None] for i in batch.column(1).to_pylist()]
            found = model.library.decode(ids, num_threads=1) if ids else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "text"])

    named = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return named.mapInArrow(run, "doc_id long, text string")
