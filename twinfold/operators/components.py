"""Connected components of an edge table: forests of chunks of edges, then alternating stars."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.sources.shared import drop_written, written

#: Forests of at most so many edges (16 bytes each) are searched by one task, in a second; larger ones by rounds.
SMALL = 200_000
#: Edges whose forest is made at once.
CHUNK = 1 << 20
#: Rows of one key that a join deals out whole, and the most keys that are split, 20 bytes each.
HOT_ROWS = 100_000
HOT_KEYS = 200_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """node, root (the smallest node of its component) of all nodes of some edges: roots are hooked to smaller ones
    beside them until no edge joins two roots."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while len(u):
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(up := root[root], root):
            root = up
        u, v = root[u], root[v]
        two = u != v
        u, v = u[two], v[two]
    return nodes, nodes[root]


def _edges(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held, size = [], 0
    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        size += batch.num_rows
        if size >= most:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (root, node) that join what the edges of a chunk join: at most one a node."""
    for a, b in _edges(batches, CHUNK):
        node, root = forest(a, b)
        leaf = node != root
        yield pa.RecordBatch.from_arrays([pa.array(root[leaf]), pa.array(node[leaf])], names=["a", "b"])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for a, b in _edges(batches, 1 << 62):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in forest(a, b)], names=["node", "component"])


def split_join(rows: DataFrame, known: DataFrame, key: str, n: str, by: str, most: int | None = None) -> DataFrame:
    """rows joined with known on key, where known's column n says how many rows have the key (it is dropped).

    A key of more than `most` rows is split: its rows go by a hash of the column `by` to as many parts, and its entry
    in known is repeated for each. Which keys these are is broadcast: no more than HOT_KEYS, else `most` grows.
    """
    most = most or HOT_ROWS
    while (n_hot := (hot := known.where(F.col(n) > most).select(key, F.ceil(F.col(n) / most).cast("int").alias("_parts")).distinct()).count()) > HOT_KEYS:
        most *= 4
    if not n_hot:
        return rows.join(known.drop(n), key)
    rows = rows.join(F.broadcast(hot), key, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    known = known.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col(n) / most).cast("int"), F.lit(1)) - 1)))
    return rows.join(known.drop(n), [key, "_part"]).drop("_part")


def _settled(stars: DataFrame) -> bool:
    """No node is both a root and a leaf, and no leaf has two roots. stars: distinct edges (a, b)."""
    sides = stars.select(F.col("a").alias("node"), F.lit(1).alias("root"), F.lit(0).alias("leaf")).unionByName(stars.select(F.col("b").alias("node"), F.lit(0).alias("root"), F.lit(1).alias("leaf")))
    return sides.groupBy("node").agg(F.max("root").alias("root"), F.sum("leaf").alias("leaf")).where("leaf > 1 or leaf + root > 1").isEmpty()


def connected_components(edges: DataFrame, cut: Callable[[DataFrame], DataFrame] = written, most_rounds: int = 50, small: int = SMALL) -> DataFrame:
    """node, component (its smallest node) of every node of the undirected edges (i, j); nodes without an edge and
    self-loops do not appear.

    Each task first replaces the edges that it reads by their forests, so that what is shuffled has at most one edge for
    each node and chunk, and not all of a node's. Forests of at most `small` edges are then one task's. Else each round
    links every node's larger neighbours, then its smaller ones, to the smallest node around it (large-star and
    small-star, Kiveris et al. 2014), until all are stars. Rounds grow with the logarithm of the longest path. A node's
    neighbours are never collected: the minimum is an aggregate, joined back to the edges, in parts for nodes of very
    many edges. cut: writes a table and reads it again.
    """
    pairs = edges.where("i <> j").select(F.least("i", "j").cast("long").alias("a"), F.greatest("i", "j").cast("long").alias("b"))
    now = cut(pairs.mapInArrow(_forests, "a long, b long").distinct())
    if now.count() <= small:
        return now.repartition(1).mapInArrow(_search, "node long, component long")
    for _ in range(most_rounds):
        if _settled(now):
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count(F.lit(1)).alias("n")))
        large = cut(split_join(both.where("b > a"), least, "a", "n", "b").select(F.col("m").alias("a"), "b").where("a <> b").distinct())
        least_below = cut(large.groupBy("b").agg(F.min("a").alias("m"), F.count(F.lit(1)).alias("n")))
        below = split_join(large, least_below, "b", "n", "a").select(F.col("a").alias("x"), "b", "m")
        stars = cut(below.select(F.col("m").alias("a"), "b").unionByName(below.select(F.col("m").alias("a"), F.col("x").alias("b"))).where("a <> b").distinct())
        if cut is written:
            drop_written(now, least, large, least_below)
        now = stars
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
