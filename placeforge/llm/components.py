"""Connected components of a link table, without leaving the cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.runtime import cut
from placeforge.llm.textkit import batch_of

PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
LABEL = pa.schema([("id", pa.int64()), ("component", pa.int64())])
CHUNK = 1 << 19  # links that one task joins at a time


def smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For vertices 0..n-1 the smallest one reachable over the links a, b."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The fewest links that join what a, b join: each id with the smallest of its component."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = smallest(len(ids), at[: len(a)], at[len(a) :])
    far = root != np.arange(len(ids))
    return ids[far], ids[root[far]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition become stars, CHUNK links at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= CHUNK:
            yield batch_of(PAIR, *stars(*(np.concatenate(c) for c in zip(*held, strict=True))))
            held, size = [], 0
    if size:
        yield batch_of(PAIR, *stars(*(np.concatenate(c) for c in zip(*held, strict=True))))


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links of a partition at once: each id with the smallest of its component, that one too."""
    held = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches if x.num_rows]
    if held:
        a, b = stars(*(np.concatenate(c) for c in zip(*held, strict=True)))
        root = np.unique(b)
        yield batch_of(LABEL, np.concatenate([a, root]), np.concatenate([b, root]))


def components(links: DataFrame, rounds: int = 40, chunk: int = CHUNK) -> DataFrame:
    """(id, component): the smallest id reachable over `links` (a, b), for ids that stand in a link.

    Links are read in tasks of about `chunk`, each of which turns its own into
    stars (one task is enough for up to `chunk` of them). What the tasks leave
    apart is joined by alternating large and small stars: each round hangs every
    vertex and its larger (then smaller) neighbours on the smallest neighbour,
    until only stars are left. Null ends and self links are left out; an empty
    table gives an empty one.
    """
    links = cut(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a is not null and b is not null and a <> b"))
    parts = max(1, -(-links.count() // chunk))
    if parts == 1:
        return cut(links.coalesce(1).mapInArrow(_labelled, "id long, component long"))
    edges = cut(links.coalesce(parts).mapInArrow(_contract, "a long, b long").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    for _ in range(rounds):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(low.select("u", F.col("m").alias("v")))
        edges = cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    else:
        raise RuntimeError("components did not settle")
    leaves = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return cut(leaves.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))


def _settled(edges: DataFrame) -> bool:
    """Whether all edges (u, v) with v < u make stars: each u has one edge, and no v is a u."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or (up > 0 and down > 0)").isEmpty()
