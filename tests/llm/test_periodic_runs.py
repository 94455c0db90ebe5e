"""Periodic runs against a search of all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from fixtures import TEXTS, awkward, by_id, empty, words

from twinfold.llm import periodic_runs as module
from twinfold.llm.digests import run_digests, with_repeats
from twinfold.llm.periodic_runs import find_runs, periodic_runs


def brute(w):
    """start, length, period of all runs, by every period and place."""
    out, n = set(), len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(6, 4 * q) and not any(w[i : j + q - p] == w[i + p : j + q] for p in range(1, q)):
                out.add((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_texts(rng, n):
    """Texts of few words, with repeated stretches one after the other."""
    out = []
    for _ in range(n):
        few, w = rng.choice((1, 2, 2, 3, 6)), []
        while len(w) < rng.randrange(0, 80):
            w += [f"w{rng.randrange(few)}" for _ in range(rng.randrange(1, 8))] * rng.randrange(1, 8)
        out.append(" ".join(w))
    return out


def test_runs_of_many_texts_at_once():
    rng = random.Random(1)
    for _ in range(200):
        texts = [t.split() for t in periodic_texts(rng, rng.randrange(1, 6))]
        ids = np.array([int(x[1:]) for t in texts for x in t], np.int64)
        got = [tuple(r) for r in zip(*(x.tolist() for x in find_runs(ids, np.cumsum([0, *map(len, texts)]))), strict=True)]
        assert got == [(k, *r) for k, t in enumerate(texts) for r in brute(t)]


def test_runs_at_borders():
    for w in ("a a a a a a", "a a a a a", "a b a b a b a b", "a b a b a b a", "x a b a b a b a b a y", "a a a a a a b a a a a a a b a a a a a a b a a a a a a b"):
        w = w.split()
        ids = np.unique(w, return_inverse=True)[1]
        assert [r[1:] for r in zip(*(x.tolist() for x in find_runs(ids, np.array([0, len(w)]))), strict=True)] == brute(w)


@pytest.mark.parametrize("chunk", [7, 100_000])
def test_periodic_runs(spark, monkeypatch, chunk):
    monkeypatch.setattr(module, "CHUNK_WORDS", chunk)
    texts = [*TEXTS, "a  a\ta\na a a", *periodic_texts(random.Random(2), 30)]
    got = by_id(periodic_runs(awkward(spark, texts)))
    assert got.keys() == set(range(len(texts)))
    for i, t in enumerate(texts):
        w = words(t)
        runs = brute(w) if len(w) < 3000 else []  # the long ones are words that differ over their first thousand
        assert (got[i]["n_words"], [tuple(r) for r in got[i]["runs"]], got[i]["collapsed"]) == (len(w), runs, collapsed(w, runs))
    assert periodic_runs(empty(spark)).count() == 0


def test_a_long_text_with_a_long_run(spark):
    w = [f"x{i}" for i in range(30_000)] + [f"y{i}" for i in range(9_000)] * 4 + ["z"] * 30_000
    (row,) = periodic_runs(spark.createDataFrame([(None, " ".join(w))], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row["runs"]] == [(30_000, 36_000, 9_000), (66_000, 30_000, 1)]
    assert row["collapsed"] == " ".join([*w[:39_000], "z"])


def test_digests_of_damaged_texts(spark):
    rng = random.Random(3)
    texts = [*TEXTS[:13], *TEXTS[14:], *(" ".join(f"v{rng.randrange(9)}" for _ in range(rng.randrange(0, 90))) for _ in range(60)), *periodic_texts(rng, 20)]
    got, hit = by_id(run_digests(periodic_runs(with_repeats(awkward(spark, texts))))), 0
    for i, t in enumerate(texts):
        w, h = words(t), zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a, hit = g % n, hit + 1
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (k - a) % p] if k >= a else x for k, x in enumerate(w)]
        if len(w) > 3000:
            continue
        runs = brute(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs).encode()).hexdigest())
        assert tuple(got[i])[1:] == want
    assert hit > 3
