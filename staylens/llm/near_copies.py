"""Near copies by SimHash, verified on the word shingles, for the dedup stage of the pipeline.

A text is the set of its runs of ``words`` words, and its SimHash the majority of their hashes, bit
by bit.  A bit of two texts with similarity 0.8 differs with probability acos(0.889) / pi = 0.15, so
the 4 bits of 64 that the inverted index of ``simhash`` guarantees find copies only that are much
nearer.  The fingerprint here is long, ``PAIRS`` pairs of positional bytes and ``CHECKED`` bits
more.  The index is keyed by the pairs: two texts meet under those in which both bytes agree, and
are candidates if at most ``BITS`` of the other bits differ.  A pair with similarity 0.8 agrees in none of
128 pairs with probability (1 - 0.85**16)**128 = 7e-5, and differs in more than 38 of 128 bits with 1e-5;
unrelated texts differ in 64, and in 38 or fewer with 3e-6.

Candidates are joined to groups.  Within a group the similarity of the pairs is counted on the
shingles themselves, until they are connected or known not to be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm import simhash
from staylens.llm.common import map_rows, staged, utf8, whole_partition
from staylens.llm.graph import components

SIMILARITY = 0.8
WORDS = 5
SEED = 42
#: Pairs of positional bytes, and the bits beside them that are compared; the most that may differ.
PAIRS, CHECKED, BITS = 128, 128, 38
#: Most members and most bytes of text of a block; groups beyond are cut into blocks.
CELL = 200
CELL_BYTES = 16_000_000
#: Shingles whose bits are counted together: as many as a byte can count.
CHUNK = 255

_WORDS = (16 * PAIRS + CHECKED) // 64
_random = np.random.default_rng(SEED)
MULTIPLY = _random.integers(1 << 63, size=(2, _WORDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FLIP = _random.integers(1 << 63, size=_WORDS, dtype=np.uint64)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the runs of ``words`` words; a shorter text is one run."""
    found = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([digest(joined, SEED)], dtype=np.uint64)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    spans = zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64))


def _mixed(found: np.ndarray) -> np.ndarray:
    """The bits of each hash, as many as the fingerprint has: a row per hash, a byte per bit."""
    x = (found[:, None] ^ FLIP) * MULTIPLY[0]
    x = (x ^ (x >> np.uint64(32))) * MULTIPLY[1]
    return np.unpackbits((x ^ (x >> np.uint64(29))).view(np.uint8), axis=1)


def fingerprint(found: np.ndarray) -> bytes | None:
    """The SimHash of sorted hashes: bits set in more than half, in half of them as in the smallest.

    A text without words has none.
    """
    if not len(found):
        return None
    counts = np.zeros(64 * _WORDS, dtype=np.int64)
    for at in range(0, len(found), CHUNK):
        counts += _mixed(found[at : at + CHUNK]).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts + _mixed(found[:1])[0] > len(found)).tobytes()


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(no_id, doc_id, text_hash, node, size, fp)`` per row; equal shingle sets are one node."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes, sizes, fps = [], [], []
        for text in utf8(batch.column(3)):
            found = shingles(text, words)
            nodes.append(xxhash.xxh64_intdigest(found.tobytes()))
            sizes.append(len(text))
            fps.append(fingerprint(found))
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3], pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)),
                pa.array(sizes, pa.int64()), pa.array(fps, pa.binary()),
            ],
            names=["no_id", "doc_id", "text_hash", "node", "size", "fp"],
        )

    rows = docs.select(*_row_keys(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, run, "no_id boolean, doc_id long, text_hash long, node long, size long, fp binary")


def _row_keys(id_col: str, text_col: str) -> list:
    return [
        F.col(id_col).isNull().alias("no_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc_id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
    ]


def keyed(nodes: DataFrame) -> DataFrame:
    """``(key, node, low, high)``: the postings.  A key holds which pair it is and its bytes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
        pairs = np.ascontiguousarray(fps[:, : 2 * PAIRS]).view("<u2").astype(np.int64)
        checked = np.ascontiguousarray(fps[:, 2 * PAIRS :]).view(np.int64)
        keys = (pairs + (np.arange(PAIRS) << 16)).ravel()
        rows = [np.repeat(x, PAIRS) for x in (batch.column(0).to_numpy(), checked[:, 0], checked[:, 1])]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, *rows)], names=["key", "node", "low", "high"])

    rows = nodes.filter(F.col("fp").isNotNull()).select("node", "fp")
    return map_rows(rows, run, "key long, node long, low long, high long")


def _close(x: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1) <= bits


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect the members of posting lists as all pairs of close fingerprints would."""
    table = whole_partition(batches)
    if table is None:
        return
    key, cell, node, low, high = (table[c].to_numpy() for c in ("key", "cell", "node", "low", "high"))
    order = np.lexsort((node, cell, key))
    checked = np.stack([low[order], high[order]], axis=1).view(np.uint64)
    a, b = simhash.listed_links(key[order], cell[order], checked, BITS, _close)
    yield simhash.forest(node[order][a], node[order][b])


def candidates(nodes: DataFrame) -> DataFrame:
    """``(node, root)``: groups connected by close fingerprints, of two nodes and more, roots included."""
    dealt = simhash.cells(keyed(nodes), member="node").repartition("key", "cell")
    member = components(dealt.mapInArrow(_met, "a long, b long"))
    return staged(member.unionByName(member.select(F.col("root").alias("node"), "root").distinct()), "near_copies_groups")


def _linked(similarity: float, words: int):
    """Links that connect the members of a cell as all its links would."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = whole_partition(batches)
        if table is None:
            return
        table = table.sort_by([("root", "ascending"), ("cell", "ascending"), ("node", "ascending")])
        root, cell, node = (table[c].to_numpy() for c in ("root", "cell", "node"))
        new = np.flatnonzero(np.append(True, (root[1:] != root[:-1]) | (cell[1:] != cell[:-1])))
        for start, end in zip(new.tolist(), [*new[1:].tolist(), len(node)], strict=True):
            if end - start < 2:
                continue
            texts = table["text"].slice(start, end - start).combine_chunks()
            a, b = spanning([shingles(t, words) for t in utf8(texts)], similarity)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[start:end][a]), pa.array(node[start:end][b])], names=["a", "b"]
                )

    return run


def spanning(sets: list[np.ndarray], similarity: float) -> tuple[list[int], list[int]]:
    """Links of at least ``similarity`` that connect the sets, none of them empty, as all would."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    known, ids = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(known), dtype=np.int64)
    left = np.ones(len(sets), dtype=bool)
    a: list[int] = []
    b: list[int] = []
    for first in range(len(sets)):
        if not left[first]:
            continue
        left[first] = False
        front = [first]
        while front and left.any():
            x = front.pop()
            own = ids[starts[x] : starts[x] + sizes[x]]
            mark[own] = 1
            both = np.add.reduceat(mark[ids], starts)
            mark[own] = 0
            # In whole numbers of shingles, so that exactly 0.8 is not lost to rounding.
            hits = np.flatnonzero(left & (both + 1e-9 >= similarity * (sizes + sizes[x] - both))).tolist()
            left[hits] = False
            a += [x] * len(hits)
            b += hits
            front += hits
    return a, b


def links(docs: DataFrame, nodes: DataFrame, similarity: float, words: int, id_col: str, text_col: str, cell: int) -> DataFrame:
    """``(a, b)``: verified links between nodes, with the same components as all candidates' links.

    Small groups are compared whole.  The others are cut into blocks, first each with the root of
    the group, which settles groups of copies of one text in linear work; then, in groups that
    are not connected by that, every block with every other.
    """
    groups = candidates(nodes)
    member = staged(groups.join(nodes.drop("fp"), "node"), "near_copies_members")
    size = member.groupBy("root").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / cell), F.ceil(F.sum("size") / CELL_BYTES)).cast("int").alias("blocks")
    )
    member = member.join(staged(size, "near_copies_blocks"), "root").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    rows = docs.select(*_row_keys(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    keys = ["no_id", "doc_id", "text_hash"]
    schema = "a long, b long"

    def compared(dealt: DataFrame) -> DataFrame:
        of_text = dealt.join(rows, keys).select("root", "node", "cell", "text")
        return of_text.repartition("root", "cell").mapInArrow(_linked(similarity, words), schema)

    everywhere = F.when(F.col("node") == F.col("root"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = staged(compared(member.withColumn("cell", F.explode(everywhere))), "near_copies_links")
    large = member.filter("blocks > 1")
    if large.isEmpty():
        return first
    label = components(first).withColumnRenamed("root", "label")
    parts = large.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_groups = parts.groupBy("root").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("root")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = (
        large.join(staged(open_groups, "near_copies_open"), "root")
        .withColumn("other", other)
        .withColumn("cell", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
    )
    return first.unionByName(staged(compared(pairs), "near_copies_links"))


def near_dedup(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    words: int = WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    cell: int = CELL,
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one row per component of near copies.

    Two texts are linked if the Jaccard similarity of their shingles is at least ``similarity``;
    texts without words are copies of each other.  That with the smallest id stays; rows without
    an id come last, equal ids go by the hash of the text, and of rows repeated in both any one
    stays.
    """
    keys = ["no_id", "doc_id", "text_hash"]
    found = staged(signatures(docs, id_col, text_col, words), "near_copies_signatures")
    own = F.struct(*keys)
    nodes = staged(
        found.groupBy("node").agg(F.min(own).alias("row"), F.max("size").alias("size"), F.max_by("fp", own).alias("fp")).select(
            "node", "row.*", "size", "fp"
        ),
        "near_copies_nodes",
    )
    member = components(links(docs, nodes, similarity, words, id_col, text_col, cell))
    root = F.coalesce("root", "node")
    first = nodes.join(member, "node", "left").groupBy(root.alias("root")).agg(F.min(own).alias("row"))
    names = [f"_near_copies_{k}" for k in keys]
    first = staged(first.select(*[F.col(f"row.{k}").alias(n) for k, n in zip(keys, names, strict=True)]), "near_copies_first")
    kept = docs.withColumns(dict(zip(names, _row_keys(id_col, text_col), strict=True))).join(first, names, "left_semi")
    # Rows repeated in id and text are all found; the join has brought them together.
    copies = Window.partitionBy(*names).orderBy(F.lit(0))
    return kept.withColumn("_near_copies_n", F.row_number().over(copies)).filter("_near_copies_n = 1").select(*docs.columns)
