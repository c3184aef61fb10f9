"""Near-duplicate classes by SimHash and an inverted index on positional bytes.

A fingerprint of 64 bits has 8 positional bytes.  Two fingerprints that differ in at most
``bits`` bits share at least ``8 - bits`` of them: that is the guaranteed minimum of the count
filter.  The index is keyed by groups of positions rather than by single bytes, chosen so that
any two fingerprints with the guaranteed minimum meet under at least one key; under a key, the
shared positional bytes of a pair are tallied, pairs below the minimum go, and the rest are
verified by their differing bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import map_rows, staged, utf8, whole_partition
from staylens.llm.graph import components

BITS = 4
WORDS = 4
SEED = 42
#: Distinct fingerprints up to which keys of two bytes are used; beyond, keys of three bytes
#: keep posting lists short.  Either finds the same links.
TWO_BYTE_LIMIT = 50_000_000
#: Most members of a posting list that one task compares; longer lists are cut into blocks
#: and every pair of blocks is a cell of its own.
CELL = 20_000
#: Lists up to this length are compared offset by offset, across all lists of a task at once.
SHORT = 64


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The SimHash of a text given as UTF-8: a bit is set if it is in over half the hashes."""
    found = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        hashes = [digest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        hashes = [
            digest(joined[a:b], SEED)
            for a, b in zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)
        ]
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fp)`` per row; a null text is an empty one and gives zero."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t) for t in utf8(batch.column(2))], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(fps)], names=["doc_id", "text_hash", "fp"]
        )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
        F.col(text_col).cast("string").alias("text"),
    )
    return map_rows(rows, run, "doc_id long, text_hash long, fp long")


def key_positions(width: int) -> list[tuple[int, ...]]:
    """Groups of ``width`` positions such that any 4 of the 8 positions hold one group.

    Width 2: positions fall into 3 classes, so two of any four share a class.  Width 3: by the
    same argument on two classes of four, triples with two or three positions in one class,
    taken cyclically; checked by brute force in the tests.
    """
    classes = [(0, 1, 2), (3, 4, 5), (6, 7)]
    if width == 2:
        return [p for c in classes for p in combinations(c, 2)]
    chosen: list[tuple[int, ...]] = []
    for four in combinations(range(8), 4):
        if not any(set(t) <= set(four) for t in chosen):
            chosen.append(four[:3])
    return chosen


def keyed(nodes: DataFrame, width: int) -> DataFrame:
    """``(key, fp)``: the postings.  A key holds which positions they are and their bytes."""
    keys = []
    for number, positions in enumerate(key_positions(width)):
        key = F.lit(number).cast("long")
        for p in positions:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)))
        keys.append(key)
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "fp")


def cells(postings: DataFrame, cell: int = CELL, member: str = "fp") -> DataFrame:
    """Postings with a ``cell``: lists over ``cell`` members are cut into blocks, and block pairs are cells."""
    long_lists = staged(
        postings.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > cell)
        .select("key", F.ceil(F.col("n") / cell).cast("int").alias("blocks")),
        "simhash_long_lists",
    )
    block = F.pmod(F.xxhash64(member), F.col("blocks")).cast("int")
    others = [c for c in postings.columns if c != "key"]
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        postings.join(long_lists, "key", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", block)
        .withColumn("other", other)
        .select("key", (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).alias("cell"), *others)
    )


Linked = Callable[[np.ndarray, int], np.ndarray]


def _linked(x: np.ndarray, bits: int) -> np.ndarray:
    """Which differences are links: count filter on shared positional bytes, then verification."""
    shared = (x[..., None].view(np.uint8) == 0).sum(axis=-1) >= 8 - bits
    shared[shared] = np.bitwise_count(x[shared]) <= bits
    return shared


def _spanning(fps: np.ndarray, bits: int, linked: Linked = _linked) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect one posting list as all its links would: a search that visits each once."""
    left = np.arange(len(fps))
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            some, front = front[:32], front[32:]
            hits = linked(fps[some][:, None] ^ fps[left][None, :], bits)
            reached = hits.any(axis=0)
            if reached.any():
                b.append(left[reached])
                a.append(some[hits[:, reached].argmax(axis=0)])
                front = np.concatenate([front, left[reached]])
                left = left[~reached]
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([*a, empty]), np.concatenate([*b, empty])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each index's component."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        if np.array_equal(la, lb):
            return label
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(label, label[label]):
            label = label[label]


def listed_links(
    key: np.ndarray, cell: np.ndarray, fp: np.ndarray, bits: int, linked: Linked = _linked
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked members of the same list and cell, all three sorted by these."""
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(key)))
    a: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]
    b: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]
    for start, size in zip(starts[sizes > SHORT].tolist(), sizes[sizes > SHORT].tolist(), strict=True):
        x, y = _spanning(fp[start : start + size], bits, linked)
        a.append(x + start)
        b.append(y + start)
    short = np.flatnonzero((sizes > 1)[group] & (sizes <= SHORT)[group])
    for offset in range(1, SHORT):
        short = short[short + offset < len(group)]
        short = short[group[short] == group[short + offset]]
        if not len(short):
            break
        for at in range(0, len(short), 1 << 18):
            some = short[at : at + (1 << 18)]
            some = some[linked(fp[some] ^ fp[some + offset], bits)]
            a.append(some)
            b.append(some + offset)
    return np.concatenate(a), np.concatenate(b)


def forest(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """``(a, b)`` with the same components as the links between ``x`` and ``y``, a row per member."""
    different = x != y  # a list cut into blocks holds a member in several cells, never twice in one
    x, y = x[different], y[different]
    known = np.unique(np.concatenate([x, y]))
    roots = _roots(len(known), np.searchsorted(known, x), np.searchsorted(known, y))
    member = np.flatnonzero(roots != np.arange(len(known)))
    return pa.RecordBatch.from_arrays([pa.array(known[member]), pa.array(known[roots[member]])], names=["a", "b"])


def _links(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = whole_partition(batches)
        if table is None:
            return
        key, cell, fp = (table.column(i).to_numpy() for i in range(3))
        order = np.lexsort((fp, cell, key))
        key, cell, fp = key[order], cell[order], fp[order].view(np.uint64)
        a, b = listed_links(key, cell, fp, bits)
        signed = fp.view(np.int64)
        yield forest(signed[a], signed[b])

    return run


def links(nodes: DataFrame, bits: int = BITS, width: int = 2, cell: int = CELL) -> DataFrame:
    """``(a, b)`` with the same components as all links between the distinct ``fp`` of ``nodes``.

    Each task returns a spanning forest of the links it found, so a group of thousands of
    near copies costs as many rows as it has members, not their pairs.
    """
    if not 0 <= bits <= 4:
        raise ValueError("the index guarantees a meeting for up to 4 differing bits")
    dealt = cells(keyed(nodes, width), cell).repartition("key", "cell")
    return dealt.mapInArrow(_links(bits), "a long, b long")


def classes(fps: DataFrame, bits: int = BITS, cell: int = CELL) -> DataFrame:
    """``(fp, root, component_id)`` per distinct fingerprint: the smallest ``doc_id`` reachable."""
    nodes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash_nodes")
    width = 2 if nodes.count() <= TWO_BYTE_LIMIT else 3
    member = components(links(nodes, bits, width, cell)).withColumnRenamed("node", "fp")
    member = member.unionByName(member.select(F.col("root").alias("fp"), "root").distinct())
    member = staged(member.join(nodes, "fp"), "simhash_members")
    smallest = staged(member.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash_smallest")
    of_member = member.join(smallest, "root").select("fp", "root", "component_id")
    return staged(
        nodes.join(of_member, "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first_id").alias("component_id")
        ),
        "simhash_classes",
    )


def near_duplicates(
    docs: DataFrame, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``.

    A null text is an empty one; texts without words have fingerprint zero and are linked like
    any other.  ``component_id`` is the smallest ``doc_id`` reachable over links of at most
    ``bits`` differing bits, null if no reachable row has one.  Repeated rows stay repeated.
    An empty table gives an empty result.
    """
    fps = staged(fingerprints(docs, id_col, text_col), "simhash_fingerprints")
    return fps.join(classes(fps, bits, cell), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_dedup(docs: DataFrame, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one row per component.

    That with the smallest id stays; rows without an id come last, equal ids go by the hash of
    the text, and of rows repeated in both any one stays.
    """
    fps = staged(fingerprints(docs, id_col, text_col), "simhash_fingerprints")
    labels = classes(fps, bits)
    keys = {
        "_simhash_no_id": F.col("doc_id").isNull(),
        "_simhash_id": F.coalesce("doc_id", F.lit(0)),
        "_simhash_text": F.col("text_hash"),
    }
    rows = fps.join(labels, "fp").select("root", F.struct(*[c.alias(k) for k, c in keys.items()]).alias("row"))
    first = rows.groupBy("root").agg(F.min("row").alias("row")).select("row.*")
    found = docs.withColumns(
        {
            "_simhash_no_id": F.col(id_col).isNull(),
            "_simhash_id": F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
            "_simhash_text": F.xxhash64(F.col(text_col).cast("string")),
        }
    ).join(first, [*keys], "left_semi")
    # Rows repeated in id and text are all found; the join has brought them together.
    copies = Window.partitionBy(*keys).orderBy(F.lit(0))
    return found.withColumn("_simhash_n", F.row_number().over(copies)).filter("_simhash_n = 1").select(*docs.columns)
