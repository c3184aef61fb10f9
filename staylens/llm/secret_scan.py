"""Secrets in texts: three fixed patterns, and strings of high entropy.

The entropy method looks at candidate strings, maximal runs of the characters of a class.  A
window slides over the candidate; the counts of its characters, and with them the Shannon
entropy, are updated by the character that enters and the one that leaves.  Windows over the
threshold of their class are united into spans, unless the candidate is on the allow-list.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import texts

# The base patterns, their kinds in order, and the lengths a match must have.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")


@dataclass(frozen=True)
class CharClass:
    """Characters that candidates are made of, the window, and its least entropy in bits."""

    kind: str
    candidate: re.Pattern[str]
    window: int
    least: float


#: A random window of 24 hex digits has 3.5 bits or so, one of 20 base-64 characters 4.0.
CLASSES = (
    CharClass("entropy_hex", re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{24,}"), 24, 3.0),
    CharClass("entropy_base64", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"), 20, 3.75),
)
#: Candidates that are no secrets, matched as a whole: words and their compounds, numbers, dates,
#: identifiers with a public form, paths, and file digests announced as such.
ALLOW = tuple(
    re.compile(p)
    for p in (
        r"[A-Za-z]+(?:[-_/=+][A-Za-z]+)*[-_/=+]*",
        r"[-_/=+]*[0-9]+(?:[-_/=+]+[0-9]+)*[-_/=+]*",
        r"[-_=+/]+",
        r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
        r"(?:[a-z]+[-_/])+[a-z]*[0-9]{1,4}",
        r"[A-Z]?[a-z]+(?:[A-Z][a-z]+)+[0-9]{0,4}",
    )
)


def entropies(candidate: str, window: int) -> np.ndarray:
    """Shannon entropy in bits of every window, by incremental counts.

    With counts c that sum to w, the entropy is log2(w) - sum(c log2 c) / w; a step changes two
    of the counts.
    """
    part = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, result = 0.0, []
    for i, char in enumerate(candidate):
        c = counts.get(char, 0)
        total += part[c + 1] - part[c]
        counts[char] = c + 1
        if i >= window:
            old = candidate[i - window]
            c = counts[old]
            total += part[c - 1] - part[c]
            counts[old] = c - 1
        if i >= window - 1:
            result.append(math.log2(window) - total / window)
    return np.array(result)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns, in code points."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return spans + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def entropy_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` where windows of a class exceed its threshold."""
    spans = []
    for kind in CLASSES:
        for m in kind.candidate.finditer(text):
            if any(a.fullmatch(m[0]) for a in ALLOW):
                continue
            high = np.flatnonzero(entropies(m[0], kind.window) >= kind.least)
            if not len(high):
                continue
            cuts = np.flatnonzero(np.diff(high) > kind.window)
            for first, last in zip(high[np.append(0, cuts + 1)], high[np.append(cuts, len(high) - 1)], strict=True):
                spans.append((m.start() + int(first), m.start() + int(last) + kind.window, kind.kind))
    return spans


def all_spans(text: str) -> list[tuple[int, int, str]]:
    """Every span by start, then by kind in the order of ``KINDS``."""
    return sorted(base_spans(text) + entropy_spans(text), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: counts of the base kinds, their digest, and all spans.

    ``spans`` is ``kind:start:end`` by start, comma-joined; positions count code points, the end
    is exclusive.  A null text is an empty one.  One pass without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in KINDS[:3]}
            digests, spans = [], []
            for text in texts(batch.column(1)):
                found = all_spans(text)
                base = [s for s in found if s[2] in KINDS[:3]]
                for kind in counts:
                    counts[kind].append(sum(s[2] == kind for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts.values()), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redacted(text: str, mask: str) -> str:
    """The text with every united span replaced by ``mask``."""
    kept, end = [], 0
    for start, stop, _ in sorted(all_spans(text)):
        if start >= end:
            kept += [text[end:start], mask]
        end = max(end, stop)
    return "".join([*kept, text[end:]])


def redact(docs: DataFrame, mask: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """``docs`` with secrets masked, all columns and rows kept; null texts stay null."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = [None if t is None else redacted(t, mask) for t in batch.column(at).to_pylist()]
            arrays = list(batch.columns)
            arrays[at] = pa.array(column, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
