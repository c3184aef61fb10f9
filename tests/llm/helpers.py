"""Small tables and brute-force helpers for the operator tests."""

from __future__ import annotations

from collections.abc import Iterable

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def documents(spark, rows: Iterable[tuple], extra: str = ""):
    """``(doc_id, text)`` rows as a documents table; ``extra`` adds a clashing column."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.selectExpr("*", *([extra] if extra else []))


def smallest_reachable(ids: list, linked) -> list:
    """Component ids over a predicate on positions, by exhaustive search."""
    found = [None] * len(ids)
    todo = set(range(len(ids)))
    while todo:
        group, front = set(), [todo.pop()]
        while front:
            x = front.pop()
            group.add(x)
            near = {y for y in todo if linked(x, y)}
            todo -= near
            front += near
        known = [ids[x] for x in group if ids[x] is not None]
        for x in group:
            found[x] = min(known) if known else None
    return found
