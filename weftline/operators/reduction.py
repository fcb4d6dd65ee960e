"""Semi-join reduction: key filters passed through a tree of joins before any large join runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from weftline.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, fits
from weftline.session import materialise


@dataclass(frozen=True)
class Edge:
    """``parent`` joins ``child`` on pairs of (parent column, child column)."""

    parent: str
    child: str
    on: Sequence[tuple[str, str]]

    def flipped(self) -> Edge:
        return Edge(self.child, self.parent, [(c, p) for p, c in self.on])


def _kept(tables: dict[str, DataFrame], edge: Edge, max_rows: int, max_bytes: int) -> DataFrame | None:
    """The parent's rows whose keys the child has, or None where the distinct keys are too many to broadcast."""
    named = [F.col(c).alias(f"_k{i}") for i, (_, c) in enumerate(edge.on)]
    keys = materialise(tables[edge.child].select(*named).distinct().na.drop(), "join-keys")
    if not fits(keys, max_rows, max_bytes):
        return None
    same = [F.col(p) == F.col(f"_k{i}") for i, (p, _) in enumerate(edge.on)]
    return tables[edge.parent].join(F.broadcast(keys), same, "left_semi")


def reduce_tables(
    tables: Mapping[str, DataFrame],
    edges: Sequence[Edge],
    down: Sequence[str] = (),
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> dict[str, DataFrame]:
    """The tables of inner joins along a tree, without the rows that the filters on other tables rule out.

    ``edges`` go from the root outwards. First each parent keeps the rows whose keys its children have, leaves first, so
    that filters on far tables reach the root before it is shuffled. Then the children named in ``down`` keep the rows whose keys
    their reduced parent has, root first. Keys are written, measured and broadcast; where they are too many, that step
    is left out, and the join that follows does its work. Rows with a null key have no partner and go.
    """
    reduced = dict(tables)
    steps = [*reversed(edges), *[e.flipped() for e in edges if e.child in down]]
    for edge in steps:
        kept = _kept(reduced, edge, max_rows, max_bytes)
        reduced[edge.parent] = reduced[edge.parent] if kept is None else kept
    return reduced


def reduced_join(tables: Mapping[str, DataFrame], edges: Sequence[Edge], root: str, down: Sequence[str] = ()) -> DataFrame:
    """Inner join of a tree after ``reduce_tables``. Column names must differ between tables."""
    reduced = reduce_tables(tables, edges, down)
    joined = reduced[root]
    for edge in edges:
        joined = joined.join(reduced[edge.child], [F.col(p) == F.col(c) for p, c in edge.on])
    return joined
