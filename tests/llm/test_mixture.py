"""The mix of sources against its contract, a plain walk over words, and draws against their expectation."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import TESTDATA
from fixtures import TEXTS, awkward, empty, words

from twinfold.llm import mixture as module
from twinfold.llm.mixture import Pass, Permutation, hypergeometric, leaves, mixed_blocks, mixed_documents, mixture, split, targets


def plain_targets(sizes):
    """Shares by weight; while any is above its limit, those are set to it and the rest is shared among the others."""
    weights, fixed = [(5, 2, 1)[i % 3] for i in range(len(sizes))], {}
    while True:
        rest = 1.5 * sum(sizes) - sum(fixed.values())
        free = [i for i in range(len(sizes)) if i not in fixed]
        got = {i: rest * weights[i] / sum(weights[j] for j in free) for i in free} | fixed
        above = [i for i in free if got[i] > 2 * sizes[i]]
        if not above:
            return [got[i] for i in range(len(sizes))]
        fixed |= {i: 2.0 * sizes[i] for i in above}


@pytest.mark.parametrize("sizes", [[], [0], [0, 0], [10], [100, 10, 50, 7, 3], [1, 1000, 1], [5, 0, 5, 0], list(range(40))])
def test_targets(sizes):
    assert targets(sizes).tolist() == pytest.approx(plain_targets(sizes))


def test_permutations():
    for n in (1, 2, 3, 5, 64, 1000):
        p = Permutation(n, 1, n)
        out = p(np.arange(n))
        assert sorted(out.tolist()) == list(range(n)) and (p.inverse(out) == np.arange(n)).all()
    assert (Permutation(1000, 1)(np.arange(1000)) != np.arange(1000)).mean() > 0.9


def test_a_pass_takes_its_quota():
    rng = np.random.default_rng(1)
    for size in (1, 6, 7, 8, 100, 4999):
        for taken in {0, 1, size // 2, size - 1, size, *rng.integers(0, size, 20).tolist()} - {-1}:
            p = Pass(0, 1, size, taken, 7, 3)
            blocks, n = p.take(np.arange(p.drawn()))
            assert n.sum() == taken and (n > 0).all() and (n <= np.minimum(7, size - 7 * blocks)).all() and len(set(blocks.tolist())) == len(blocks)


@pytest.mark.parametrize("urn", [10**9, 50])
def test_the_tree_deals_out_all_blocks_once(monkeypatch, urn):
    monkeypatch.setattr(module, "URN", urn)
    quotas = np.array([100, 5, 0, 700, 33])
    found = list(leaves(quotas, 9, 4, 0, 9))
    assert [x[0] for x in found] == list(range(9)) and {int(c.sum()) for _, _, c in found} == {93, 94}
    for k, q in enumerate(quotas.tolist()):
        assert [p for _, places, counts in found for p in range(places[k], places[k] + counts[k])] == list(range(q))
    alone = [x for a in range(9) for x in leaves(quotas, 9, 4, a, a + 1)]
    assert all((x[1] == y[1]).all() and (x[2] == y[2]).all() for x, y in zip(found, alone, strict=True))


def test_draws_without_replacement(monkeypatch):
    rng, good, bad, n = np.random.default_rng(1), 60, 140, 50
    exact = Counter(rng.hypergeometric(good, bad, n, 20_000).tolist())
    monkeypatch.setattr(module, "URN", 10)
    ours = Counter(hypergeometric(rng, good, bad, n) for _ in range(20_000))
    assert sum(abs(exact[k] - ours[k]) for k in exact | ours) < 1500
    for good, bad, n in ((0, 20, 5), (20, 0, 5), (20, 20, 0), (20, 20, 40), (1, 19, 20)):
        assert max(0, n - bad) <= hypergeometric(rng, good, bad, n) <= min(good, n)
    counts = np.array([30, 0, 10, 60])
    draws = np.array([split(rng, counts, 25) for _ in range(4000)])
    assert (draws.sum(1) == 25).all() and np.allclose(draws.mean(0), counts / 4, atol=0.2)
    monkeypatch.undo()
    big = [hypergeometric(rng, 3 * 10**9, 4 * 10**9, 2 * 10**9) for _ in range(40)]
    assert abs(np.mean(big) - 6e9 / 7) < 5 * 18_704 / 40**0.5


def checked(docs, mix, n_rows):
    """The contract's rows, and the pieces against the words of their blocks."""
    rows = mixed_documents(mix).collect()
    assert len(rows) == n_rows
    size, taken, wanted = Counter(), Counter(), {}
    for r in rows:
        assert r["size"] is not None and 0 <= r["taken"] <= 2 * r["size"]
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        wanted[r["source"]] = r["target"], r["source_size"]
    names = sorted(size, key=lambda s: (s is None, s))
    for s, t in zip(names, plain_targets([size[s] for s in names]), strict=True):
        assert wanted[s] == (pytest.approx(t), size[s]) and taken[s] == round(wanted[s][0])
    pieces = mix.pieces.collect()
    assert sum(r["words"] for r in pieces) == sum(taken.values())
    spans = defaultdict(list)
    for r in pieces:
        spans[r["row"], r["pass"]].append((r["start"], r["start"] + r["words"]))
    for s in spans.values():
        s.sort()
        assert all(a[1] <= b[0] for a, b in zip(s, s[1:], strict=False))  # a pass takes no word twice
    return rows, pieces


@pytest.mark.parametrize("block", [5, 512])
def test_mixture(spark, block):
    docs = awkward(spark).drop("start").withColumnsRenamed({"n": "words", "count": "row", "label": "pass", "hash": "block", "component": "target"})
    mix = mixture(docs, block_words=block, shard_blocks=7)
    rows, pieces = checked(docs, mix, docs.count())
    assert sorted((r["doc_id"], r["size"]) for r in rows) == sorted([*((i, len(words(t))) for i, t in enumerate(TEXTS)), (6, len(words(TEXTS[6])))])
    places = {}
    for r in pieces:
        w = words(TEXTS[r["doc_id"]])[r["start"] : r["start"] + r["words"]]
        places.setdefault((r["shard"], r["slot"]), []).append((r["block_start"], w))
    want = {k: " ".join(x for _, w in sorted(v) for x in w) for k, v in places.items()}
    assert {(r["shard"], r["slot"]): r["text"] for r in mixed_blocks(docs, mix).collect()} == want
    slots = defaultdict(set)
    for shard, slot in places:
        slots[shard].add(slot)
    assert all(s == set(range(len(s))) for s in slots.values()) and {len(s) for k, s in slots.items() if k + 1 < len(slots)} <= {6, 7}


def test_mixture_without_words(spark):
    assert mixed_documents(mixture(empty(spark))).count() == 0
    rows = spark.createDataFrame([(1, None, "a"), (2, " ", None), (None, "", "a")], "doc_id long, text string, source string")
    mix = mixture(rows)
    assert sorted(tuple(r) for r in mixed_documents(mix).select("size", "source_size", "target", "taken").collect()) == [(0, 0, 0.0, 0)] * 3 and mix.pieces.count() == 0


def test_reruns_agree_and_rows_lie_anywhere(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    first = mixture(docs, block_words=64, shard_blocks=16)
    rows, _ = checked(docs, first, docs.count())
    again = mixture(docs.repartition(7, "text"), block_words=64, shard_blocks=16)
    assert sorted(map(str, mixed_documents(again).collect())) == sorted(map(str, rows))
    columns = ["shard", "slot", "doc_id", "start", "words"]
    assert sorted(map(str, again.pieces.select(columns).collect())) == sorted(map(str, first.pieces.select(columns).collect()))
