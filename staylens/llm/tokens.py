"""Token ids of whole texts, by a tokenizers file, with repeated words encoded once.

The pre-tokenizers of the files used here never join characters across the start of a run of
non-space characters, so a text's ids are the ids of its chunks, one after the other.  A worker
remembers the ids of chunks it has seen; unseen ones go to the library many at a time.  A text
that holds the string of a special token goes to the library as a whole.
"""

from __future__ import annotations

import os
import re
from itertools import islice
from unicodedata import is_normalized

import numpy as np

# What the library's patterns take as white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Control characters that Python's split() takes as space and the library does not.
NO_SPACE = re.compile("[\x1c-\x1f]")
WORDS = re.compile(f"[^{SPACE}]+")
SPACED_WORDS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
UNEVEN = "\u03a3\u0130"
DOUBLE = ("  ", "\n ", " \n", "\n\n")
#: Punctuation that is always a token run of its own after a letter or digit.
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Chunks remembered per worker and file (about 250 MB), and the longest one remembered.  When
#: they are too many, the half seen first stays: frequent words come early.
MEMORY = 1_000_000
LONGEST = 64
#: Unseen chunks per call of the library.
TOGETHER = 256


class Encoder:
    """``ids(text)`` as little-endian unsigned 32-bit integers, without special tokens."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence

        self.tokenizer = Tokenizer.from_file(path)
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = tuple(special.values())
        #: A special token separates chunks that are encoded in one call.
        self.mark, self.separator = next(iter(special.items()))
        #: With a normalizer, the file drops white space; without, it is part of the ids.
        self.drops_space = isinstance(self.tokenizer.normalizer, Sequence)
        self.memory: dict[str, bytes] = {"": b""}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _chunks(self, text: str) -> list[str]:
        if not self.drops_space:
            # Single blanks and line breaks only, as in most texts: cut before and after them.
            if text.replace("\n", "").isprintable() and not any(d in text for d in DOUBLE):
                return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
            return SPACED_WORDS.findall(text)
        return WORDS.findall(text) if NO_SPACE.search(text) else text.split()

    def _encode(self, chunks: list[str]) -> None:
        for at in range(0, len(chunks), TOGETHER):
            some = chunks[at : at + TOGETHER]
            ids = np.array(
                self.tokenizer.encode(self.separator.join(some), add_special_tokens=False).ids, dtype="<u4"
            )
            raw, start = ids.tobytes(), 0
            ends = [*(np.flatnonzero(ids == self.mark) * 4).tolist(), len(raw)]
            for chunk, end in zip(some, ends, strict=True):
                self.memory[chunk] = raw[start:end]
                start = end + 4

    def _learn(self, chunks: set[str]) -> None:
        """Remember the ids of chunks; trailing punctuation is encoded apart, once."""
        split = []
        plain = set()
        for chunk in chunks:
            core = chunk.rstrip(TAIL)
            tail = chunk[len(core) :]
            if core and tail and core[-1].isalnum():
                split.append((chunk, core, tail))
                plain.add(core)
                plain.add(tail)
            else:
                plain.add(chunk)
        self._encode([c for c in plain if c not in self.memory])
        for chunk, core, tail in split:
            self.memory[chunk] = self.memory[core] + self.memory[tail]

    def _folded(self, text: str) -> str:
        """The text in lower case where the file does nothing else to it before it does that.

        A text that is composed, and still is in lower case, is not changed by composing it.
        The two letters whose lower case depends on the letters around them are left alone.
        """
        if not self.drops_space or any(c in text for c in UNEVEN):
            return text
        folded = text.lower()
        return folded if is_normalized("NFC", text) and is_normalized("NFC", folded) else text

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of every text; unseen chunks of all of them are encoded together."""
        if len(self.memory) > MEMORY:
            self.memory = dict(islice(self.memory.items(), MEMORY // 2))
        split: list[list[str] | None] = []
        for text in texts:
            folded = self._folded(text)
            if any(s in folded or s in text for s in self.special):
                split.append(None)
                continue
            split.append(self._chunks(folded))
        unseen = set().union(*(s for s in split if s)).difference(self.memory)
        if unseen:
            self._learn(unseen)
        known = self.memory.__getitem__
        result = [self._whole(t) if s is None else b"".join(map(known, s)) for t, s in zip(texts, split, strict=True)]
        for chunk in unseen:
            if len(chunk) > LONGEST:
                self.memory.pop(chunk, None)
        return result


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def public_path(name: str) -> str:
    """The place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
