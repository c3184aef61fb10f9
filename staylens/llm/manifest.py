"""A Merkle manifest of a dataset: leaves, one subtree a source, one tree over the sources.

Every row is a leaf, every source a tree whose leaves ascend by id, and the roots of the sources
are the leaves of one last tree.  While a level has several nodes, every three consecutive ones
become their hash; the last run of a level may have fewer, even one.

The exchange works on superblocks: ``3 ** HEIGHT`` consecutive nodes of a tree, so a source of
any size is many groups and no task holds more than one superblock at a time.  Going up, a
superblock is reduced to the one node that stands for it; those nodes are the leaves of the next
round, until every tree has one.  Going down, the nodes of a superblock are cogrouped with the one
row of outer nodes they need, the siblings on the way from their superblock to the root.  One call
then finishes the local reduction, joins the local proof to the outer one and folds the claimed leaf
up to a root.

Only one row per range partition and the final root come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import staged

ARITY = 3
#: Levels a superblock has: 2,187 nodes.
HEIGHT = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "tree long, pos long, hash string"
_PATH = "tree long, pos long, proof array<string>, place array<int>"
_RESULT = (
    "doc_id long, source string, leaf string, subroot string, root string, "
    "proof array<string>, place array<int>, folded_root string, verified boolean"
)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(values: Sequence[Column]) -> Column:
    """The hash of a row: every value with its length in bytes before it, ``-`` for null."""
    said = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*said).cast("binary"), 256)


def leaves(docs: DataFrame, columns: Sequence[str], id_col: str, source_col: str, claim: Mapping[str, Column]) -> DataFrame:
    """``(doc_id, source, leaf, claimed, salt)``; ``claimed`` is null where the claim is the row itself."""
    own = [F.col(c).cast("string") for c in columns]
    said = [claim.get(c, F.col(c)).cast("string") for c in columns]
    same = F.lit(True)
    for c in columns:
        if c in claim:
            same &= F.col(c).cast("string").eqNullSafe(claim[c].cast("string"))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        leaf(own).alias("leaf"),
        F.when(~same, leaf(said)).alias("claimed"),
        # Tells repeated rows apart, so that any number of them can be sorted in parts.
        F.monotonically_increasing_id().alias("salt"),
    )


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``tree`` (the rank of the source) and ``pos`` in it, and the size of the largest tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, local, seen, last = TaskContext.get().partitionId(), -1, 0, None
        for batch in batches:
            sources = batch.column(1).to_pylist()
            trees, places = np.empty(len(sources), dtype=np.int64), np.empty(len(sources), dtype=np.int64)
            for i, source in enumerate(sources):
                if local < 0 or source != last:
                    local, seen, last = local + 1, 0, source
                trees[i], places[i] = local, seen
                seen += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(np.full(len(sources), part, dtype=np.int32)), pa.array(trees), pa.array(places)],
                names=["doc_id", "source", "leaf", "claimed", "part", "local", "nth"],
            )

    order = ("source", "doc_id", "leaf", "salt")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "doc_id long, source string, leaf string, claimed string, part int, local long, nth long"
    found = staged(dealt.mapInArrow(run, schema), "manifest_numbered")
    # A row per partition: only a source at its border goes on from the partition before.
    sizes = found.groupBy("part", "local").agg(F.count(F.lit(1)).alias("n"), F.first("source").alias("source"))
    borders = (
        sizes.groupBy("part")
        .agg(
            F.max("local").alias("local"), F.max("n").alias("most"),
            F.min_by(F.struct("source", "n"), "local").alias("first"), F.max_by(F.struct("source", "n"), "local").alias("last"),
        )
        .orderBy("part")
        .collect()
    )
    starts, tree, size, largest, before = [], -1, 0, 0, None
    for row in borders:
        goes_on = before is not None and before.source == row.first.source
        first = tree if goes_on else tree + 1
        starts.append((row.part, first, size if goes_on else 0))
        tree = first + row.local
        size = row.last.n + (size if goes_on and not row.local else 0)
        largest, before = max(largest, row.most, size, row.first.n + starts[-1][2]), row.last
    offsets = found.sparkSession.createDataFrame(starts, "part int, first_tree long, first_pos long")
    placed = found.join(F.broadcast(offsets), "part").select(
        "doc_id", "source", "leaf", "claimed", (F.col("first_tree") + F.col("local")).alias("tree"),
        (F.col("nth") + F.when(F.col("local") == 0, F.col("first_pos")).otherwise(0)).alias("pos"),
    )
    return placed, largest


def levels(nodes: list[str], alone: bool, height: int) -> list[list[str]]:
    """The levels of a superblock from its nodes up; ``alone`` if it is its whole tree."""
    found = [nodes]
    while len(found[-1]) > 1 if alone else len(found) <= height:
        below = found[-1]
        found.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return found


def paths(
    found: list[list[str]], proof: list[str], place: list[int]
) -> list[tuple[list[str], list[int]]]:
    """For every node of the lowest level its siblings, level by level, and its places among them, up to the root."""
    above = [(proof, place)]
    for level in reversed(found[:-1]):
        own = []
        for i in range(len(level)):
            run, at = level[i - i % ARITY : i - i % ARITY + ARITY], i % ARITY
            further = above[i // ARITY]
            own.append((["".join(run[:at] + run[at + 1 :]), *further[0]], [at, *further[1]]))
        above = own
    return above


def fold(node: str, proof: Sequence[str], place: Sequence[int]) -> str:
    """The root that a node and the siblings on its way give."""
    for siblings, at in zip(proof, place, strict=True):
        at *= 64
        node = sha256((siblings[:at] + node + siblings[at:]).encode()).hexdigest()
    return node


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {ARITY**height}"))


def reduced(nodes: DataFrame, height: int) -> DataFrame:
    """One node per superblock of ``nodes`` (``tree, pos, hash``)."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree, block = (int(k) for k in key)
        hashes = group.sort_values("pos")["hash"].tolist()
        top = levels(hashes, block == 0 and len(hashes) < ARITY**height, height)[-1][0]
        return pd.DataFrame({"tree": [tree], "pos": [block], "hash": [top]})

    return _blocks(nodes, height).groupBy("tree", "block").applyInPandas(run, _NODE)


def rounds(nodes: DataFrame, size: int, height: int, name: str) -> list[DataFrame]:
    """``nodes`` and the superblock nodes of each round above, to one node per tree; ``size``: of the largest tree."""
    found = [nodes]
    while len(found) == 1 or size > 1:
        found.append(staged(reduced(found[-1], height), name))
        size = -(-size // ARITY**height)
    return found


def _cogrouped(nodes: DataFrame, outer: DataFrame, height: int):  # noqa: ANN202 - PySpark's cogroup has no public type
    above = outer.withColumnRenamed("pos", "block")
    return _blocks(nodes, height).groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))


def _local(nodes: pd.DataFrame, outer: pd.DataFrame, height: int) -> tuple[list[list[str]], list[tuple[list[str], list[int]]]]:
    hashes = nodes["hash"].tolist()
    alone = int(nodes["block"].iloc[0]) == 0 and len(hashes) < ARITY**height
    found = levels(hashes, alone, height)
    return found, paths(found, list(outer["proof"].iloc[0]), list(outer["place"].iloc[0]))


def descended(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """The paths of ``nodes`` to the root, given those of their superblocks (``tree, pos, proof, place``)."""

    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        proof, place = zip(*_local(nodes, outer, height)[1], strict=True)
        return pd.DataFrame({"tree": nodes["tree"].array, "pos": nodes["pos"].array, "proof": proof, "place": place})

    return _cogrouped(nodes, outer, height).applyInPandas(run, _PATH)


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    id_col: str = "doc_id",
    source_col: str = "source",
    claim: Mapping[str, Column] | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """``(doc_id, source, leaf, subroot, root, proof, place, folded_root, verified)``, one row per row of ``docs``.

    ``proof`` has the siblings of every level from the leaf up, joined left to right, ``place`` the
    node's own index among them; a level whose run is the node alone has an empty string.
    ``claim`` gives columns as they are presented for verification: the leaf of the row with them is
    folded with the siblings of the dataset, and ``verified`` tells if the dataset's root comes out.

    Null columns are hashed as ``-``, which no value is.  Rows without an id come first in their source,
    rows without a source are the first source.  Equal ids are in the order of their leaves; repeated
    rows are leaves of their own, and which of them has which place does not matter.  An empty table
    has no rows and no root.  Columns are taken by name; others do not matter.
    """
    rows = staged(leaves(docs, columns, id_col, source_col, claim or {}), "manifest_leaves")
    spark = docs.sparkSession
    if rows.isEmpty():
        return spark.createDataFrame([], _RESULT)
    placed, largest = numbered(rows)
    within = rounds(placed.select("tree", "pos", F.col("leaf").alias("hash")), largest, height, "manifest_nodes")
    subroots = within[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash")
    n_trees = subroots.agg(F.max("pos")).first()[0] + 1
    over = rounds(subroots, n_trees, height, "manifest_top")
    root = over[-1].first()["hash"]

    outer = spark.createDataFrame([(0, 0, [], [])], _PATH)
    for nodes in reversed(over[:-1]):
        outer = descended(nodes, outer, height)
    outer = outer.join(subroots.select("pos", F.col("hash").alias("subroot")), "pos")
    outer = outer.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "proof", "place", "subroot")
    trees = outer.select("tree", "subroot")
    outer = outer.drop("subroot")
    for nodes in reversed(within[1:-1]):
        outer = descended(nodes, outer, height)
    outer = outer.join(trees, "tree")

    def run(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        _, found = _local(nodes, outer, height)
        folded = [fold(node, *path) for node, path in zip(nodes["claimed"], found, strict=True)]
        proof, place = zip(*found, strict=True)
        return pd.DataFrame(
            {
                "doc_id": nodes["doc_id"].array, "source": nodes["source"].array, "leaf": nodes["hash"].array,
                "subroot": outer["subroot"].iloc[0], "root": root, "proof": proof, "place": place,
                "folded_root": folded, "verified": [f == root for f in folded],
            }
        )

    # Ids go as text: pandas has no null among integers.
    lowest = placed.select(
        F.col("doc_id").cast("string").alias("doc_id"), "source", "tree", "pos", F.col("leaf").alias("hash"),
        F.coalesce("claimed", "leaf").alias("claimed"),
    )
    found = _cogrouped(lowest, outer, height).applyInPandas(run, _RESULT.replace("doc_id long", "doc_id string"))
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
