"""Exact nearest neighbours by cosine similarity, cut at a threshold.

The base threshold is applied before the top k: both keep a prefix of the same order, so the result is the same and the
sort is small. What depends on the pair is applied after the top k. Ties go to the smaller id; a vector is not its own
neighbour; zero vectors have similarity 0.

Beyond one broadcast, vectors are partitioned by metric cells. Pivots are drawn, each vector belongs to the nearest one,
and each cell keeps the least and greatest distance of its members. As |x - y|^2 <= 2 - 2 sim for vectors of length 1 and
less, a vector whose neighbours must have a similarity of b looks no further than r = sqrt(2 - 2 b). Where its distance
to a cell's pivot is D and to its own pivot D0, the triangle inequality excludes the cell if D - r is more than the
cell's greatest distance, D + r less than its least one, or D - D0 more than 2 r. b is the threshold or, if that is more,
the k-th best similarity in the vector's own block. Cells are cut into blocks of at most BLOCK_BYTES, and blocks are dealt
out to PARTS parts of about equal size. A part's task holds the part's vectors and lets those of every cell that some of
them cannot exclude pass by, in tiles; b grows with what was found. So a vector is sent once to a part, however many blocks
and cells there are, and of unlike vectors the products alone grow with the square. Equal vectors are compared as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.functions.vectors import unit
from twinfold.sources.shared import written
from twinfold.operators.idf import effective_threshold

#: Largest matrix that is broadcast, in bytes of float64; beyond it, vectors are partitioned by cells.
BROADCAST_BYTES = 16 << 20
#: Most bytes of a block, as float64.
BLOCK_BYTES = 16 << 20
#: Parts that vectors are dealt out to. A vector is sent once to each part that cannot exclude it, so at most PARTS times
#: whatever the blocks; only where a part would have more than PART_BYTES of float64 are there more of them.
PARTS = 32
PART_BYTES = 64 << 20
#: Most pivots: a broadcast matrix of so many vectors.
PIVOTS = 1024
#: Of a similarity, what ranks; the last bits of a product depend on the shape of its matrices.
DIGITS = 12
#: Added to squared distances, so that no rounding excludes a cell.
SLACK = 1e-9
#: Vectors whose distances to all pivots are held at once.
ROWS = 2048
#: Rows and columns of the products that are held at once beyond one broadcast.
TILE = (512, 512)
#: Pairs whose products are made again at once.
MANY = 1 << 13
#: What a product may lack to a bound before it is rounded.
EDGE = 1e-11
NEAR = pa.schema([("i", pa.int64()), ("j", pa.int64()), ("sim", pa.float64()), ("rank", pa.int32())])
FOUND = pa.schema([("i", pa.int64()), ("j", pa.int64()), ("sim", pa.float64())])


def top_k(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("i").orderBy(F.desc("sim"), "j")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _matrix(vectors: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    flat = vectors.flatten() if isinstance(vectors, pa.Array) else vectors.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), d)


def _unit_rows(vectors: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Rows of length 1 from lists of d numbers."""
    m = _matrix(vectors, d)
    return m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-10)


def _near(ids: np.ndarray, left: np.ndarray, others: np.ndarray, right: np.ndarray, k: int | None, least: float | np.ndarray) -> Iterator[pa.RecordBatch]:
    """i, j, sim, rank of each left vector's k nearest (all if k is None) of the right ones, at least as similar as its
    entry of `least`; products are rounded, so that ties do not depend on the blocks."""
    step, least = max(1, min(512, (32 << 20) // (8 * max(1, len(others))))), np.broadcast_to(least, len(ids))
    for s in range(0, len(ids), step):
        sim = np.round(left[s : s + step] @ right.T, DIGITS)
        sim[ids[s : s + step, None] == others[None, :]] = -np.inf
        cut = least[s : s + step]
        if k is not None and sim.shape[1] > k:
            cut = np.maximum(np.partition(sim, sim.shape[1] - k, axis=1)[:, -k], cut)  # the k-th best
        r, c = np.nonzero(sim >= cut[:, None])
        order = np.lexsort((others[c], -sim[r, c], r))
        r, c = r[order], c[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r) + 1
        kept = rank <= (len(others) if k is None else k)  # of ties with the k-th, the smaller ids
        r, c = r[kept], c[kept]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[s + r], others[c], sim[r, c], rank[kept].astype(np.int32))], schema=NEAR)


def _plain(vectors: DataFrame) -> tuple[DataFrame, int, int]:
    """id, vector as the operators take them; how many, and of how many numbers. Floats stay floats while they are moved."""
    kind = vectors.schema["vector"].dataType.simpleString()
    vectors = vectors.select(F.col("id").cast("long").alias("id"), F.col("vector").cast(kind if kind == "array<float>" else "array<double>").alias("vector"))
    return vectors, *vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()


def neighbours(vectors: DataFrame, k: int = 20, least: float = 0.99, broadcast_bytes: int | None = None, block_bytes: int | None = None) -> DataFrame:
    """i, j, sim, rank of each vector's k nearest others with sim >= least. vectors: id, vector (all of one length).

    Products run in blocks of numpy matrices. Only rows above `least` and in a block's top k leave Python; where all
    other vectors are one block, that is the result.
    """
    spark = vectors.sparkSession
    vectors, n, d = _plain(vectors)
    if n * d * 8 > (BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        return _of_copies(vectors, k, least, d, block_bytes or BLOCK_BYTES)
    held = vectors.toArrow().sort_by("id")
    sent = spark.sparkContext.broadcast((held["id"].to_numpy(), _unit_rows(held["vector"], d)))

    def run(batches: Iterator[pa.RecordBatch]):
        others, right = sent.value
        for b in batches:
            yield from _near(b.column("id").to_numpy(), _unit_rows(b.column("vector"), d), others, right, k, least)

    return vectors.mapInArrow(run, "i long, j long, sim double, rank int")


def similar_pairs(vectors: DataFrame, least: float, block_bytes: int | None = None) -> DataFrame:
    """i, j, sim of all pairs i < j with sim >= least."""
    vectors, n, d = _plain(vectors)
    near = Cells(vectors, n, d, least, None, block_bytes or BLOCK_BYTES).near()
    return near.where("i <> j").select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "sim")


def _of_copies(vectors: DataFrame, k: int, least: float, d: int, block_bytes: int) -> DataFrame:
    """neighbours() where equal vectors are compared as one. A vector's k nearest are among the k + 1 smallest ids of
    each group of equal ones; how many copies there are does not matter, and no group is gathered."""
    keyed = vectors.withColumn("key", F.sha2(F.col("vector").cast("string"), 256))
    few = keyed.withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("copy") <= k + 1)
    groups = few.groupBy("key").agg(F.min("id").alias("id"), F.min_by("vector", "id").alias("vector"), F.array_sort(F.collect_list("id")).alias("ids"))
    groups = written(groups)
    near = Cells(groups.select("id", "vector"), groups.count(), d, least, k, block_bytes).near()
    near = near.join(groups.select(F.col("id").alias("j"), "ids"), "j").select("i", "sim", F.explode("ids").alias("j"))
    best = top_k(near, k + 1).groupBy("i").agg(F.array_sort(F.collect_list(F.struct("rank", "j", "sim"))).alias("best"))
    of = keyed.select("id", "key").join(groups.select("key", F.col("id").alias("i")), "key").join(best, "i")
    found = F.slice(F.filter("best", lambda b: b["j"] != F.col("id")), 1, k)
    return of.select(F.col("id").alias("i"), F.posexplode(found).alias("at", "b")).select("i", "b.j", "b.sim", (F.col("at") + 1).cast("int").alias("rank"))


def _distances(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (units * units).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (units @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def _reach(bound: np.ndarray) -> np.ndarray:
    """How far a neighbour at least as similar as `bound` can be."""
    return np.sqrt(np.maximum(2 - 2 * bound, 0) + SLACK)


class _Asking:
    """A part's vectors, and what they found: of each the k best so far, or all that is not taken yet if k is None."""

    def __init__(self, ids: np.ndarray, units: np.ndarray, far: np.ndarray, bound: np.ndarray, k: int | None):
        self.ids, self.units, self.far, self.bound, self.k = ids, units, far, bound.copy(), k
        self.single, self.squares, self.lack = units.astype(np.float32), (units * units).sum(1), (units.shape[1] + 8) * 2.0**-23
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = self.most = 0
        itself = np.round(self.squares, DIGITS)  # what copies of one vector have
        self.copies = pa.RecordBatch.from_arrays([pa.array(x[itself >= bound]) for x in (ids, ids, itself)], schema=FOUND)

    def meet(self, others: np.ndarray, right: np.ndarray, pivot: np.ndarray, low: float, high: float, once: bool) -> Iterator[pa.RecordBatch]:
        """Compare with vectors of one cell those that cannot exclude it. once: of (i, j) and (j, i) the first alone.

        Products are of single precision first, which lacks at most `lack` for vectors of length 1 and less; those that
        may reach the bound are made again in double precision, and these decide."""
        far, r = np.sqrt(np.maximum(self.squares + pivot @ pivot - 2 * (self.units @ pivot), 0)), _reach(self.bound)
        asks, rough = np.flatnonzero((far - r <= high) & (far + r >= low) & (far - self.far <= 2 * r)), right.astype(np.float32)
        for rows in (asks[s : s + TILE[0]] for s in range(0, len(asks), TILE[0])):
            left, least = self.single[rows], (self.bound[rows] - EDGE - self.lack).astype(np.float32)
            for s in range(0, len(others), TILE[1]):
                sim = left @ rough[s : s + TILE[1]].T
                hit = np.flatnonzero(sim.max(1) >= least)
                row, c = np.divmod(np.flatnonzero(sim[hit] >= least[hit, None]), sim.shape[1])
                i, c = rows[hit[row]], s + c
                sim = np.concatenate([np.einsum("ij,ij->i", self.units[i[x : x + MANY]], right[c[x : x + MANY]]) for x in range(0, max(1, len(i)), MANY)])
                j, sim = others[c], np.round(sim, DIGITS)
                kept = (sim >= self.bound[i]) & ((self.ids[i] < j) if once else (self.ids[i] != j))
                self.found.append((i[kept], j[kept], sim[kept]))
                self.n += int(kept.sum())
                if self.k is None and self.n >= 1 << 17:
                    yield self.taken()
                elif self.k is not None and self.n >= 2 * self.most + (1 << 20):
                    self._best()

    def _best(self) -> None:
        i, j, sim = map(np.concatenate, zip(*self.found, strict=True))
        order = np.lexsort((j, -sim, i))
        i, j, sim = i[order], j[order], sim[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i) + 1
        full, kept = rank == self.k, rank <= self.k
        self.bound[i[full]] = np.maximum(self.bound[i[full]], sim[full])
        self.found, self.n = [(i[kept], j[kept], sim[kept])], int(kept.sum())
        self.most = self.n

    def taken(self) -> pa.RecordBatch:
        if self.k is not None and self.found:
            self._best()
        i, j, sim = map(np.concatenate, zip(*self.found, strict=True)) if self.found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self.found, self.n = [], 0
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.ids[i], j, sim)], schema=FOUND)


class Cells:
    """Vectors by cells, blocks and parts. blocks: one row a vector with its cell, the distance to its pivot, its block,
    its part and its bound; asks: how many vectors of a part cannot exclude a cell. Pivots are the vectors with the
    smallest hashes of ids, at most PIVOTS; the driver holds them and some numbers a cell and block."""

    def __init__(self, vectors: DataFrame, n: int, d: int, least: float, k: int | None, block_bytes: int):
        spark, parts = vectors.sparkSession, max(PARTS, -(-n * d * 8 // PART_BYTES))
        rows = max(1, min(block_bytes // max(1, 8 * d), -(-n // parts)))
        drawn = vectors.orderBy(F.xxhash64("id"), "id").limit(min(PIVOTS, max(1, int(n**0.5)))).toArrow()
        pivots = _unit_rows(drawn["vector"], d) if len(drawn) else np.zeros((1, max(1, d)))
        sent = spark.sparkContext.broadcast(pivots)
        kind = vectors.schema["vector"].dataType.simpleString()

        def assign(batches: Iterator[pa.RecordBatch]):
            for b in (b.slice(s, ROWS) for b in batches for s in range(0, b.num_rows, ROWS)):
                far = _distances(_unit_rows(b.column("vector"), d), sent.value)
                cell = far.argmin(1)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vector"), pa.array(cell, pa.int32()), pa.array(far[np.arange(len(far)), cell])], names=["id", "vector", "cell", "far"])

        held = written(vectors.mapInArrow(assign, f"id long, vector {kind}, cell int, far double"))
        size, low, high = np.zeros(len(pivots), np.int64), np.full(len(pivots), np.inf), np.zeros(len(pivots))
        for r in held.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("low"), F.max("far").alias("high")).collect():
            size[r["cell"]], low[r["cell"]], high[r["cell"]] = r["n"], r["low"], r["high"]
        count = -(-size // rows)  # blocks of a cell; none of an empty one
        first, before = np.cumsum(count) - count, np.cumsum(size) - size
        homes = [[int((before[c] + x * size[c] // count[c]) * parts // n) for x in range(count[c])] for c in range(len(count))]
        of_cell = spark.createDataFrame([(c, int(first[c]), h) for c, h in enumerate(homes) if h], "cell int, first int, homes array<int>")
        at = F.pmod(F.xxhash64("id"), F.size("homes")).cast("int")
        dealt = held.join(F.broadcast(of_cell), "cell").select("id", "vector", "cell", "far", (F.col("first") + at).alias("block"), F.get("homes", at).alias("part"))

        def own(t: pa.Table) -> pa.Table:
            """The bound of a block's vectors: the k-th best similarity among themselves, if it is more than the threshold."""
            t = t.sort_by("id")
            ids, units, bound = t["id"].to_numpy(), _unit_rows(t["vector"], d), np.full(len(t), float(least))
            for b in _near(ids, units, ids, units, k, least):
                full = b.column("rank").to_numpy() == k
                bound[np.searchsorted(ids, b.column("i").to_numpy()[full])] = b.column("sim").to_numpy()[full]
            return t.append_column("bound", pa.array(bound))

        def ask(batches: Iterator[pa.RecordBatch]):
            for b in (b.slice(s, ROWS) for b in batches for s in range(0, b.num_rows, ROWS)):
                part, own_far, r = b.column("part").to_numpy(), b.column("far").to_numpy()[:, None], _reach(b.column("bound").to_numpy())[:, None]
                far = _distances(_unit_rows(b.column("vector"), d), sent.value)
                asks = (far - r <= high) & (far + r >= low) & (far - own_far <= 2 * r) & (size > 0)
                for p in np.unique(part):
                    by_cell = asks[part == p].sum(0)
                    cell = np.flatnonzero(by_cell)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), p, np.int32)), pa.array(cell, pa.int32()), pa.array(by_cell[cell], pa.int64())], names=["part", "cell", "n"])

        bounded = dealt.withColumn("bound", F.lit(float(least))) if k is None else dealt.groupBy("block").applyInArrow(own, f"id long, vector {kind}, cell int, far double, block int, part int, bound double")
        self.d, self.k, self.parts, self.cells = d, k, parts, spark.sparkContext.broadcast((pivots, low, high))
        self.blocks = written(bounded)
        self.asks = written(self.blocks.mapInArrow(ask, "part int, cell int, n long").groupBy("part", "cell").agg(F.sum("n").alias("n")))

    def _once(self, part: str, home: str) -> Column:
        """Whether a part meets those of another: always, but if k is None one of both meets the other."""
        if self.k is not None:
            return F.lit(True)
        ahead = 2 * F.pmod(F.col(home) - F.col(part), F.lit(self.parts))
        return (ahead < self.parts) | ((ahead == self.parts) & (F.col(part) < F.col(home)))

    def pairs(self) -> DataFrame:
        """part, other, n: which blocks a part meets, and how many of its vectors ask them, the block's own ones aside."""
        blocks = self.blocks.groupBy("cell", F.col("block").alias("other"), F.col("part").alias("home")).agg(F.count(F.lit(1)).alias("own"))
        n = F.col("n") - F.when(F.col("part") == F.col("home"), F.col("own")).otherwise(0)
        return self.asks.join(blocks, "cell").where(self._once("part", "home")).select("part", "other", n.alias("n")).where("n > 0")

    def sent(self) -> DataFrame:
        """What parts get: their own vectors, which ask (bound is not null), and once those of every cell that they ask."""
        to = self.asks.groupBy("cell").agg(F.collect_list("part").alias("to"))
        asking = self.blocks.select(F.col("part").alias("to"), F.lit(False).alias("own"), "cell", "far", "bound", "id", "vector")
        asked = self.blocks.join(F.broadcast(to), "cell").select(F.explode("to").alias("to"), "part", "cell", "id", "vector").where(self._once("to", "part"))
        asked = asked.select("to", (F.col("to") == F.col("part")).alias("own"), "cell", F.lit(None).cast("double").alias("far"), F.lit(None).cast("double").alias("bound"), "id", "vector")
        return asking.unionByName(asked)

    def near(self) -> DataFrame:
        """i, j, sim: of each vector its k nearest of all, and itself."""
        d, k, cells = self.d, self.k, self.cells

        def meet(batches: Iterator[pa.RecordBatch]):
            pivots, low, high = cells.value
            part, waiting, asking = None, [], None
            for b in batches:
                to, own, cell = (b.column(c).to_numpy(zero_copy_only=False) for c in ("to", "own", "cell"))
                asks = b.column("bound").is_valid().to_numpy(zero_copy_only=False)
                new = np.flatnonzero((np.diff(to) != 0) | (np.diff(asks.astype(np.int8)) != 0) | (~asks[1:] & ((np.diff(cell) != 0) | (np.diff(own.astype(np.int8)) != 0)))) + 1
                for s, e in zip([0, *new], [*new, len(to)], strict=True):
                    run = b.slice(s, e - s)
                    if to[s] != part:
                        if asking:
                            yield asking.taken()
                        part, waiting, asking = to[s], [], None
                    ids, units = run.column("id").to_numpy(), _unit_rows(run.column("vector"), d)
                    if asks[s]:
                        waiting.append((ids, units, run.column("far").to_numpy(), run.column("bound").to_numpy()))
                        continue
                    if asking is None:
                        asking = _Asking(*map(np.concatenate, zip(*waiting, strict=True)), k)
                        waiting = []
                        yield asking.copies
                    yield from asking.meet(ids, units, pivots[cell[s]], low[cell[s]], high[cell[s]], k is None and bool(own[s]))
            if asking:
                yield asking.taken()

        by = self.sent().repartition("to").sortWithinPartitions("to", F.col("bound").isNull(), "own", "cell")
        return by.mapInArrow(meet, "i long, j long, sim double")


def neighbours_by_hashing(vectors: DataFrame, k: int = 20, least: float = 0.99, tables: int = 8, width: float = 0.5) -> DataFrame:
    """As neighbours(), but approximate: pairs that no random projection puts in one bucket are missed. Recall grows with
    the number of tables and the width; a test measures it against neighbours()."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    u = vectors.select("id", array_to_vector(unit(F.col("vector"))).alias("u"))
    model = BucketedRandomProjectionLSH(inputCol="u", outputCol="h", bucketLength=width, numHashTables=tables, seed=1).fit(u)
    pairs = model.approxSimilarityJoin(u, u, float(np.sqrt(2 - 2 * least)) + 1e-9, "dist").select(F.col("datasetA.id").alias("i"), F.col("datasetB.id").alias("j"), (1 - F.col("dist") * F.col("dist") / 2).alias("sim"))
    return top_k(pairs.where((F.col("i") != F.col("j")) & (F.col("sim") >= least)), k)


def edges(vectors: DataFrame, k: int = 20, threshold: float = 0.99, penalty: float = 0.0) -> DataFrame:
    """i, j, sim of neighbours at or above the threshold; with a penalty, vectors also carries idf."""
    near = neighbours(vectors, k, threshold + min(0.0, penalty))
    if not penalty:
        return near.select("i", "j", "sim")
    idf = vectors.select("id", "idf")
    near = near.join(idf.toDF("i", "idf_i"), "i").join(idf.toDF("j", "idf_j"), "j")
    return near.where(F.col("sim") >= effective_threshold(threshold, penalty, F.col("idf_i"), F.col("idf_j"))).select("i", "j", "sim")
