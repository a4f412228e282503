"""Merkle manifest of a dataset: a tree for each language by superblock reduction, proofs for all rows, and their check."""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeforge.llm.runtime import beside, cut, width

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
LEVELS = 12  # that one bucket collapses: fanout ** LEVELS nodes at most


def leaf(**replaced: Column) -> Column:
    """Digest of a row's FIELDS (columns, or those that replace them): length in bytes and value of each, or a sign for null."""

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*(field(replaced.get(c, F.col(c))) for c in FIELDS)), 256)


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds `at`, the place in the node's tree by `order` (from 0, nulls first, ties in any order), and `n`, the tree's nodes.

    Rows are sorted in ranges of tree and order; only the ranges' counts are
    added up, so that a tree may be as large as it likes.
    """
    spark = nodes.sparkSession
    keys = ["tree", *order, "tie"]
    ranged = nodes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(width(spark), *keys).sortWithinPartitions(*keys).drop("tie")
    ranged = cut(ranged.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}))  # places run on within a range
    held = ranged.groupBy("part", "tree").agg(F.min("place").alias("first"), F.count("*").alias("m"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("m").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = cut(held.select("part", "tree", (before - F.col("first")).alias("shift"), F.sum("m").over(tree).alias("n")))
    return ranged.join(beside(starts, starts.count()), ["part", "tree"]).withColumn("at", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def _grid(nodes: list[str], fanout: int, levels: int) -> list[list[str]]:
    """The nodes of each level, from the given one to the one that `levels` reductions make."""
    grid = [nodes]
    for _ in range(levels):
        grid.append([sha256("".join(grid[-1][i : i + fanout]).encode()).hexdigest() for i in range(0, len(grid[-1]), fanout)])
    return grid


def reduced(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> list[DataFrame]:
    """tree, at, node, height of `nodes` and of each superblock reduction of them, to one node a tree; n is needed in `nodes`.

    height: how many levels still lie above. Buckets of fanout ** levels
    neighbours collapse by that many levels, or by what is left.
    """
    powers = [fanout**k for k in range(63) if fanout**k < 1 << 62]
    height = F.size(F.filter(F.array(*map(F.lit, powers)), lambda p: p < F.col("n")))
    rounds = [cut(nodes.withColumn("height", height.cast("long")).drop("n"))]
    span = fanout**levels

    def collapse(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        up = min(levels, int(rows["height"].iloc[0]))
        top = _grid(rows.sort_values("at")["node"].tolist(), fanout, up)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "at": [key[1]], "node": [top], "height": [int(rows["height"].iloc[0]) - up]})

    while (rounds[-1].agg(F.max("height")).first()[0] or 0) > 0:
        below = rounds[-1].select("tree", F.expr(f"at div {span}").alias("bucket"), "at", "node", "height")
        rounds.append(cut(below.groupBy("tree", "bucket").applyInPandas(collapse, "tree string, at long, node string, height long")))
    return rounds


def proven(rounds: list[DataFrame], above: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The rows of rounds[0] with subroot and root as `above` has them, and lefts and rights: the siblings of each level to the root.

    above: tree, lefts, rights, subroot, root for each tree. Each bucket's own
    levels stand before what is above it. Columns of rounds[0] besides are kept.
    """
    span = fanout**levels

    def descend(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at", ignore_index=True)
        height = int(rows["height"].iloc[0])
        grid = _grid(rows["node"].tolist(), fanout, min(levels, height))
        sides = []
        for nodes in grid[:-1]:
            heads = [i - i % fanout for i in range(len(nodes))]
            sides.append([("".join(nodes[h:i]), "".join(nodes[i + 1 : h + fanout])) for i, h in enumerate(heads)])
        own = [[sides[k][i // fanout**k] for k in range(len(sides))] for i in range(len(rows))]
        more = above.iloc[0]
        lefts, rights = list(more["lefts"]), list(more["rights"])
        return rows.drop(columns=["bucket", "height"]).assign(
            lefts=[[x[0] for x in path] + lefts for path in own], rights=[[x[1] for x in path] + rights for path in own], subroot=more["subroot"], root=more["root"]
        )

    above = above.select("tree", F.lit(0).cast("long").alias("bucket"), "lefts", "rights", "subroot", "root")
    for k in range(len(rounds) - 1, -1, -1):
        below = rounds[k].withColumn("bucket", F.expr(f"at div {span}"))
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rounds[k].schema if f.name != "height")
        paths = below.groupBy("tree", "bucket").cogroup(above.groupBy("tree", "bucket")).applyInPandas(descend, f"{kept}, lefts array<string>, rights array<string>, subroot string, root string")
        if k:
            above = cut(paths.select("tree", F.col("at").alias("bucket"), "lefts", "rights", "subroot", "root"))
    return paths


def folded(start: Column, lefts: Column, rights: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(F.arrays_zip(lefts.alias("l"), rights.alias("r")), start, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def manifest(docs: DataFrame, also: dict[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """doc_id, lang, leaf, at, lefts, rights, subroot, root, and the text columns of `also`, one row for each row of `docs`.

    Leaves of a language ascend by doc_id (nulls first; rows of one id by their
    leaves) and are reduced `fanout` at a time, the last run as it is, until one
    node is left: the subroot. The subroots, ordered by language (null first,
    then by bytes), give the root alike. lefts and rights are the siblings on
    each side, joined, of each level from the leaf to the root; a level where
    a node is alone has empty ones. `also` is worked out on the rows of `docs`.
    Nulls are a field of their own kind; empty and very long texts are digested
    whole; repeated rows are leaves of their own; an empty table gives an empty
    one; only FIELDS (and what `also` names) are read.
    """
    also = also or {}
    taken = [f"also{k}" for k in range(len(also))]
    tree = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))
    number = F.col("doc_id").cast("long")
    leaves = cut(docs.select(tree.alias("tree"), number.alias("number"), leaf().alias("node"), *(c.cast("string").alias(k) for k, c in zip(taken, also.values(), strict=True))))
    # ids travel as text: a missing one would make the others floating-point numbers
    leaves = numbered(leaves, ["number", "node"]).withColumn("number", F.col("number").cast("string"))
    rounds = reduced(leaves, fanout, levels)
    tops = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("lang_tree"), "node")
    top_rounds = reduced(numbered(tops, ["lang_tree"]), fanout, levels)
    nothing = F.expr("cast(array() as array<string>)")
    root = top_rounds[-1].select("tree", nothing.alias("lefts"), nothing.alias("rights"), F.col("node").alias("subroot"), F.col("node").alias("root"))
    subroots = cut(proven(top_rounds, root, fanout, levels).select(F.col("lang_tree").alias("tree"), "lefts", "rights", F.col("node").alias("subroot"), "root"))
    lang = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30))
    return proven(rounds, subroots, fanout, levels).select(F.col("number").cast("long").alias("doc_id"), lang.alias("lang"), F.col("node").alias("leaf"), "at", "lefts", "rights", "subroot", "root", *(F.col(k).alias(c) for k, c in zip(taken, also, strict=True)))
