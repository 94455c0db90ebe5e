"""Neighbours, components and clusters against brute force."""

import tracemalloc

import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from twinfold.operators import clusters, components, knn
from twinfold.operators.components import connected_components
from twinfold.operators.numbering import placed
from twinfold.plans import queries


def frame(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vector array<float>")


def brute(vectors, k, least):
    m = np.array(vectors, np.float64)
    m = m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-10)
    sim = m @ m.T
    out = set()
    for i in range(len(m)):
        order = sorted((j for j in range(len(m)) if j != i and sim[i, j] >= least), key=lambda j: (-round(sim[i, j], 12), j))
        out |= {(i, j) for j in order[:k]}
    return out


@pytest.mark.parametrize("blocked", [False, True])
def test_neighbours_equal_brute_force(spark, monkeypatch, blocked):
    if blocked:
        monkeypatch.setattr(knn, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(knn, "BLOCK_BYTES", 16 * 6 * 8)
    v = np.random.default_rng(5).normal(size=(60, 6)).astype(np.float32)
    got = {(r["i"], r["j"]) for r in knn.neighbours(frame(spark, v), 4, 0.2).collect()}
    assert got == brute(v, 4, 0.2)


def test_plain_pairs_equal_the_blocked_ones(spark):
    v = np.random.default_rng(6).normal(size=(30, 4)).astype(np.float32)
    pairs = {(r["i"], r["j"]) for r in knn.similar_pairs(frame(spark, v), 0.3).collect()}
    assert pairs | {(j, i) for i, j in pairs} == {(r["i"], r["j"]) for r in knn.neighbours(frame(spark, v), 30, 0.3).collect()}


def test_hashing_finds_close_pairs(spark):
    v = np.repeat(np.random.default_rng(7).normal(size=(10, 8)), 2, axis=0).astype(np.float32)
    got = {(r["i"], r["j"]) for r in knn.neighbours_by_hashing(frame(spark, v), 5, 0.99).collect()}
    assert {(i, i ^ 1) for i in range(20)} <= got


def test_recall_of_hashing(spark):
    """Against the exact neighbours of vectors in loose clusters."""
    rng = np.random.default_rng(11)
    v = (np.repeat(rng.normal(size=(60, 16)), 5, axis=0) + 0.05 * rng.normal(size=(300, 16))).astype(np.float32)
    exact = {(r["i"], r["j"]) for r in knn.neighbours(frame(spark, v), 5, 0.95).collect()}
    got = {(r["i"], r["j"]) for r in knn.neighbours_by_hashing(frame(spark, v), 5, 0.95).collect()}
    assert len(exact) > 1000 and len(got & exact) >= 0.95 * len(exact)


@pytest.mark.parametrize("blocked", [False, True])
def test_ties_go_to_the_smaller_id(spark, monkeypatch, blocked):
    if blocked:
        monkeypatch.setattr(knn, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(knn, "BLOCK_BYTES", 7 * 9 * 8)
    v = np.repeat(np.random.default_rng(12).normal(size=(3, 9)), 15, axis=0).astype(np.float32)
    got = {(r["i"], r["j"]) for r in knn.neighbours(frame(spark, v), 4, 0.9).collect()}
    assert got == {(i, j) for i in range(45) for j in [x for x in range(i // 15 * 15, i // 15 * 15 + 15) if x != i][:4]}


def clustered(seed, n, each, d, spread):
    rng = np.random.default_rng(seed)
    return (np.repeat(rng.normal(size=(n, d)), each, axis=0) + spread * rng.normal(size=(n * each, d))).astype(np.float32)


@pytest.mark.parametrize(("k", "least"), [(3, 0.99), (20, 0.5), (5, -2.0)])
def test_cells_equal_brute_force(spark, k, least):
    """Clusters, copies of one vector, multiples of it, zeros and opposite vectors, in blocks of 25 vectors."""
    v = clustered(21, 25, 8, 8, 0.02)
    v = np.concatenate([v, np.repeat(v[:1], 70, axis=0), 3 * v[1:4], np.zeros((5, 8), np.float32), -v[:6]])
    v = v[np.random.default_rng(22).permutation(len(v))]
    got = knn.neighbours(frame(spark, v), k, least, broadcast_bytes=0, block_bytes=25 * 8 * 8).collect()
    assert {(r["i"], r["j"]) for r in got} == brute(v, k, least)
    assert sorted(map(str, got)) == sorted(map(str, knn.neighbours(frame(spark, v), k, least).collect()))


def test_cells_compare_few_pairs(spark):
    v = clustered(23, 60, 20, 16, 0.01)
    cells = knn.Cells(*knn._plain(frame(spark, v)), 0.99, 5, 20 * 16 * 8)
    sizes = {r["block"]: r["count"] for r in cells.blocks.groupBy("block").count().collect()}
    compared = sum(n * n for n in sizes.values()) + sum(r["n"] * sizes[r["other"]] for r in cells.pairs().collect())
    assert max(sizes.values()) <= 60 and len(sizes) >= 34 and compared < len(v) ** 2 / 10


def test_copies_of_one_vector_cost_no_square(spark):
    """A third of all vectors are equal: they are compared as one, and no row gathers them."""
    v = np.concatenate([np.repeat(clustered(24, 1, 1, 8, 0), 1000, axis=0), clustered(25, 100, 20, 8, 0.01)])
    got = knn.neighbours(frame(spark, v), 4, 0.99, broadcast_bytes=0, block_bytes=64 * 8 * 8)
    assert {(r["i"], r["j"]) for r in got.collect()} == brute(v, 4, 0.99)


def test_no_vectors_in_cells(spark):
    assert knn.neighbours(frame(spark, []), 3, 0.5, broadcast_bytes=-1).count() == 0 and knn.similar_pairs(frame(spark, []), 0.5).count() == 0


def test_pairs_of_many_blocks(spark):
    v = clustered(26, 30, 6, 8, 0.05)
    m = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    got = [(r["i"], r["j"]) for r in knn.similar_pairs(frame(spark, v), 0.9, block_bytes=10 * 8 * 8).collect()]
    assert sorted(got) == [(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if (m @ m.T)[i, j] >= 0.9]


def shuffled_mb(spark, job):
    total = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite() / 1e6
    before, rows = total(), job().count()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return total() - before, rows


def unlike(spark, n):
    """Vectors of which no cell can be excluded."""
    return frame(spark, np.random.default_rng(27).normal(size=(n, 32)).astype(np.float32))


def test_nearest_of_unlike_vectors_move_as_many_bytes_as_parts(spark):
    """Not as many as there are blocks: of 16 vectors each here, 250 of them."""
    mb, rows = shuffled_mb(spark, lambda: knn.neighbours(unlike(spark, 4000), 3, -2.0, broadcast_bytes=0, block_bytes=16 * 32 * 8))
    assert rows == 12_000 and mb < 2 * knn.PARTS * 4000 * 32 * 4 / 1e6


def test_near_ones_of_unlike_vectors_move_as_many_bytes_as_parts(spark):
    """With a threshold that excludes no cell, in blocks of 16 vectors."""
    mb, rows = shuffled_mb(spark, lambda: knn.neighbours(unlike(spark, 3000), 20, 0.35, broadcast_bytes=0, block_bytes=16 * 32 * 8))
    assert 0 < rows <= 60_000 and mb < 2 * knn.PARTS * 3000 * 32 * 4 / 1e6


def test_pairs_of_unlike_vectors_move_as_many_bytes_as_parts(spark):
    """In blocks of any size: there are 94 cells, each a block at least, and a vector went to every one that it asks."""
    mb, rows = shuffled_mb(spark, lambda: knn.similar_pairs(unlike(spark, 9000), 0.3))
    assert rows > 1_000_000 and mb < 18 * 9000 * 32 * 4 / 1e6


def test_a_tile_of_products_takes_little_memory():
    """Of single precision, 1 MB; of double precision a tile of 1,024 by 512 took 4 MB at once, a mask of it aside."""
    v = np.random.default_rng(28).normal(size=(4096, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    asking = knn._Asking(np.arange(2048), v[:2048], np.zeros(2048), np.full(2048, 0.45), 20)
    tracemalloc.start()
    list(asking.meet(np.arange(2048, 4096), v[2048:], v[0], 0.0, 2.0, False))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    i, j = np.nonzero(v[:2048] @ v[2048:].T >= 0.45)
    found = [np.concatenate(x) for x in zip(*asking.found, strict=True)]
    assert most < 4 << 20 and sorted(zip(found[0], found[1], strict=True)) == sorted(zip(i, j + 2048, strict=True))


def test_cells_tell_similarities_apart_beyond_single_precision(spark):
    """Angles differ by 1e-8, similarities by 1e-9 and less; copies are told apart by their ids."""
    t = np.repeat(0.1 + 1e-8 * np.random.default_rng(29).permutation(90), 2)
    v = np.concatenate([np.stack([np.cos(t), np.sin(t)], axis=1), [[1.0, 0.0], [1.0, 1e-9]]])
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "id long, vector array<double>")
    got = knn.neighbours(rows, 5, 0.5, broadcast_bytes=0, block_bytes=16 * 2 * 8).collect()
    assert sorted(map(str, got)) == sorted(map(str, knn.neighbours(rows, 5, 0.5).collect()))
    assert {r["j"] for r in got if r["i"] == 180} == {181, *sorted(range(180), key=lambda j: (t[j], j))[:4]}


def test_a_matrix_of_more_than_16_mb_is_not_broadcast(spark, monkeypatch):
    """Each worker would hold it whole: 40,000 vectors of 64 numbers are 20 MB."""
    class Parted(Exception):
        pass

    def parted(*_):
        raise Parted

    monkeypatch.setattr(knn, "_of_copies", parted)
    many = spark.range(40_000).select("id", F.array(*(F.rand(n).cast("float") for n in range(64))).alias("vector"))
    with pytest.raises(Parted):
        knn.edges(many, 3, 0.99)


def test_ranked_groups_broadcast_no_matrix_of_more_than_16_mb(spark, monkeypatch, tmp_path):
    class Parted(Exception):
        pass

    def parted(*_):
        raise Parted

    monkeypatch.setattr(knn, "_of_copies", parted)
    many = spark.range(40_000).select(F.col("id").alias("vec_id"), F.array(*(F.rand(n).cast("float") for n in range(64))).alias("embedding"), F.lit(1).alias("label"))
    many.write.parquet(f"{tmp_path}/embeddings.parquet")
    (tmp_path / "customer.parquet").symlink_to(f"{TESTDATA}/sf0.001/customer.parquet")
    with pytest.raises(Parted):
        queries.QUERIES["groups_ranked"](spark, str(tmp_path))


def test_numbers_are_of_one_person_each(spark):
    people = spark.createDataFrame([(f"urn:{i % 50}x{i}", [1.0]) for i in range(200)], "iri string, vector array<float>").repartition(5)
    got = placed(people, "iri").collect()
    assert sorted(r["place"] for r in got) == list(range(200)) and [r["iri"] for r in sorted(got, key=lambda r: r["place"])] == sorted(r["iri"] for r in got)


def test_few_equal_zero_and_no_vectors(spark):
    assert knn.edges(frame(spark, [[1, 0]]), threshold=0.5).count() == 0
    same = {(r["i"], r["j"]) for r in knn.edges(frame(spark, [[1, 1]] * 3 + [[0, 0]]), threshold=0.9).collect()}
    assert same == {(i, j) for i in range(3) for j in range(3) if i != j}
    assert knn.edges(frame(spark, []), threshold=0.5).count() == 0


def test_a_higher_threshold_or_penalty_never_adds_an_edge(spark):
    v = np.random.default_rng(8).normal(size=(40, 4)).astype(np.float32)
    weighed = frame(spark, v).withColumn("idf", (F.col("id") % 5) / 4.0)
    sets = [{(r["i"], r["j"]) for r in knn.edges(weighed, 5, t, p).collect()} for t, p in ((0.5, 0.0), (0.6, 0.0), (0.5, 0.1), (0.5, 0.3))]
    assert sets[1] <= sets[0] and sets[3] <= sets[2] <= sets[0]


def test_similarity_at_the_threshold_links(spark):
    assert knn.edges(frame(spark, [[1, 0], [1, 0]]), threshold=1 - 1e-9).count() == 2


@pytest.mark.parametrize("small", [0, 200_000])
def test_components_do_not_depend_on_order_or_direction(spark, small):
    rng = np.random.default_rng(9)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(30)]
    label = {x: x for p in pairs for x in p}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    real = {x for a, b in pairs if a != b for x in (a, b)}
    for rows in (pairs, [(b, a) for a, b in reversed(pairs)]):
        got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(rows, "i long, j long"), small=small).collect()}
        assert got == {x: label[x] for x in real}


def shuffled(pairs, seed):
    return [pairs[k] for k in np.random.default_rng(seed).permutation(len(pairs))]


def test_a_long_path_in_many_partitions(spark):
    names = np.random.default_rng(31).permutation(10_000).tolist()
    rows = shuffled(list(zip(names, names[1:], strict=False)), 32) + [(20_000, 20_001)]
    got = connected_components(spark.createDataFrame(rows, "i long, j long").repartition(6), small=0).collect()
    assert {r["node"]: r["component"] for r in got} == dict.fromkeys(range(10_000), 0) | {20_000: 20_000, 20_001: 20_000}
    assert len(got) == 10_002


@pytest.mark.parametrize("middle", [0, 2_000_000])
def test_a_star_of_a_million_edges(spark, monkeypatch, middle):
    """Its middle is the smallest node, or the largest one; its rows are dealt out in parts."""
    monkeypatch.setattr(components, "HOT_ROWS", 50_000)
    edges = spark.range(1, 1_000_001).select(F.lit(middle).alias("i"), F.col("id").alias("j"))
    got = connected_components(edges.repartition(5), small=0).groupBy("component").count().collect()
    assert [tuple(r) for r in got] == [(min(middle, 1), 1_000_001)]


def test_hot_keys_are_joined_in_parts(spark):
    rows = spark.createDataFrame([(i % 3 if i % 7 else 9, i) for i in range(300)], "k long, v long")
    known = rows.groupBy("k").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))
    want = sorted(map(str, rows.join(known.drop("n"), "k").collect()))
    assert sorted(map(str, components.split_join(rows, known, "k", "n", "v", 20).collect())) == want


def test_forests():
    rng = np.random.default_rng(33)
    for n, m in ((5, 3), (50, 40), (50, 20), (1000, 900)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        label = {x: x for p in zip(a, b, strict=True) for x in p}
        for _ in label:
            for x, y in zip(a, b, strict=True):
                label[x] = label[y] = min(label[x], label[y])
        node, root = components.forest(a, b)
        assert dict(zip(node.tolist(), root.tolist(), strict=True)) == label


def test_no_edge_no_cluster(spark):
    assert clusters.clusters(spark.createDataFrame([], "i long, j long")).count() == 0


def test_cap_and_statistics(spark):
    sizes = spark.createDataFrame([(1, 25), (2, 26)], "cluster_id long, size long")
    assert [r[0] for r in sizes.select(clusters.status(F.col("size"))).collect()] == ["to_judge", "skipped_oversized"]
    assert clusters.statistics(sizes, 60).first().asDict() == {"n_clusters": 2, "clustered": 51, "min_size": 25, "max_size": 26, "mean_size": 25.5, "singletons": 9}
    assert clusters.statistics(sizes.limit(0), 3).first()["singletons"] == 3
