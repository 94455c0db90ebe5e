"""Periodic runs of words: maximal repetitions of at least four periods, by the runs theorem (Bannai et al. 2017).

A run is a stretch of consecutive words with smallest period q and at least max(6, 4 q) words that no word beside it
extends. Every run holds Lyndon roots under one of two orders of words: the one and its reverse. The longest Lyndon word
that starts at a place ends before the next smaller suffix, so it follows from the next smaller (for the reverse order:
larger) value of the inverse suffix array. Such words are extended to the right and left as far as their period goes;
how far two suffixes agree is the least entry of the LCP array between them, found by a sparse table.

All documents of a chunk share one suffix array, in which they come one after the other. A run of at least max(6, 4 q)
words repeats five words, so a text without five repeated words holds none and does not enter the arrays. Memory: about
400 bytes for each word of a chunk (of CHUNK_WORDS, or a single longer text).

Cases: null, empty and short texts have no run and keep all words; repeated rows have equal results; a null doc_id stays;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from twinfold.llm.common import batch, documents, mix, tidy

#: Words of the texts that are searched together (a single longer text is searched alone).
CHUNK_WORDS = 100_000
#: A run has so many words, and so many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: What every run repeats: the words of a shortest run but its last period's.
GRAM = 5


def suffix_ranks(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """By prefix doubling: level l has each suffix's rank by its first 2 ** l words, suffixes of earlier documents first;
    the last one is the inverse suffix array. A suffix that ends comes before those that go on. ends: where each word's
    document ends. Only suffixes that have equals are sorted again."""
    n = len(ids)
    key, rank, left, step, levels = doc * (int(ids.max()) + 1) + ids, np.zeros(n, np.int64), np.arange(n), 1, []
    while True:
        order = np.argsort(key, kind="stable")
        left, key, base = left[order], key[order], rank[left[order]]
        fresh = np.ones(len(left), bool)
        fresh[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(fresh)
        group = np.ones(len(left), bool)
        group[1:] = base[1:] != base[:-1]
        before = np.maximum.accumulate(np.where(group, np.arange(len(left)), 0))
        size = np.diff(np.append(first, len(left)))
        rank[left] = base + np.repeat(first, size) - before
        levels.append(rank.copy())
        left = np.sort(left[np.repeat(size > 1, size)])
        if not len(left):
            return levels
        after = left + step
        key = rank[left] * (n + 1) + np.where(after < ends[left], rank[np.minimum(after, n - 1)] + 1, 0)
        step *= 2


def sparse_table(x: np.ndarray) -> list[np.ndarray]:
    """Level l: the least of 2 ** l consecutive entries."""
    out = [x]
    while len(out[-1]) > 1 << (len(out) - 1):
        half = 1 << (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def next_smaller(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each place, the next one with a smaller entry; its document's end where there is none."""
    table, at = sparse_table(x), np.arange(1, len(x) + 1)
    for level in range(len(table) - 1, -1, -1):
        row, on = table[level], at + (1 << level) <= ends
        on &= row[np.minimum(at, len(row) - 1)] > x
        at = at + (on.astype(np.int64) << level)
    return at


class Extension:
    """How many words two suffixes of one document have in common at their starts."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, ends: np.ndarray):
        levels = suffix_ranks(ids, doc, ends)
        self.rank = levels[-1]
        order = np.empty(len(ids), np.int64)
        order[self.rank] = np.arange(len(ids))
        a, b = order[:-1].copy(), order[1:].copy()
        lcp = np.zeros(len(a), np.int32)
        for level in range(len(levels) - 1, -1, -1):
            x = np.append(levels[level], -1)
            same = (x[a] == x[b]).astype(np.int64) << level
            lcp += same.astype(np.int32)
            a += same
            b += same
        del levels
        self.table = sparse_table(lcp)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """i and j differ in each entry."""
        low, high = np.minimum(self.rank[i], self.rank[j]), np.maximum(self.rank[i], self.rank[j])
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            out[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << k)])
        return out


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """document, start in it, length and period of all runs of texts that lie one after the other (bounds: n + 1 places),
    ordered by document, start and period. ids: equal for equal words of a document."""
    n, sizes = len(ids), np.diff(bounds)
    none = np.zeros(0, np.int64)
    if n < LEAST_WORDS:
        return none, none, none, none
    doc = np.repeat(np.arange(len(sizes)), sizes)
    starts, ends = bounds[:-1][doc], bounds[1:][doc]
    ahead = Extension(ids, doc, ends)
    root, period, place = [], [], np.arange(n)
    for order in (ahead.rank, -ahead.rank):
        after = next_smaller(order, ends)
        at = np.flatnonzero(after < ends)
        root.append(at)
        period.append(after[at] - place[at])
    i, q = np.concatenate(root), np.concatenate(period)
    near = ids[i] == ids[i + q]
    i, q = i[near], q[near]
    on = ahead(i, i + q) if len(i) else none
    least = np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
    far = on >= least - 2 * q + 1  # so far goes a root in the run's first period
    i, q, e = i[far], q[far], (i + q + on)[far]
    if not len(i):
        return none, none, none, none
    order = np.lexsort((i, q, e))
    i, q, e = i[order], q[order], e[order]
    new = np.ones(len(i), bool)
    new[1:] = (e[1:] != e[:-1]) | (q[1:] != q[:-1])
    i, q, e = i[new], q[new], e[new]  # runs of one period that end together are one
    behind = Extension(ids[::-1], doc[::-1].max() - doc[::-1], n - starts[::-1])
    back, inner = np.zeros(len(i), np.int64), np.flatnonzero(i > starts[i])
    if len(inner):
        back[inner] = behind(n - i[inner], n - i[inner] - q[inner])
    start = i - back
    long = e - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
    start, q, e = start[long], q[long], e[long]
    order = np.lexsort((q, start))
    start, q, e = start[order], q[order], e[order]
    return doc[start], start - starts[start], e - start, q


def _repeats(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Numbers of the documents in which GRAM consecutive words may occur twice: never a false no."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if len(ids) < GRAM:
        return doc[:0]
    gram = doc[GRAM - 1 :].astype(np.uint64)
    for k in range(GRAM):
        gram = mix(gram * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - GRAM + 1 + k].astype(np.uint64))
    own = np.flatnonzero(doc[: len(gram)] == doc[GRAM - 1 :])
    order = own[np.argsort(gram[own], kind="stable")]
    return np.unique(doc[order[1:][gram[order[1:]] == gram[order[:-1]]]])


def _collapsed(words: list[bytes], start: list[int], length: list[int], period: list[int]) -> bytes:
    """The words that no run contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for s, n, q in zip(start, length, period, strict=True):
        change[s + q] += 1
        change[s + n] -= 1
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist())


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def _searched(rows: list[tuple[int | None, list[bytes]]], ids: list[np.ndarray]) -> pa.RecordBatch:
    bounds = np.cumsum([0, *map(len, ids)])
    near = _repeats(np.concatenate(ids), bounds)
    doc, *found = [np.zeros(0, np.int64)] * 4
    if len(near):
        doc, *found = find_runs(np.concatenate([ids[k] for k in near.tolist()]), np.cumsum([0, *(len(ids[k]) for k in near.tolist())]))
        doc = near[doc]
    at = np.searchsorted(doc, np.arange(len(rows) + 1))
    texts = []
    for k, (_, words) in enumerate(rows):
        s, e = at[k], at[k + 1]
        texts.append((_collapsed(words, *(x[s:e].tolist() for x in found)) if e > s else b" ".join(words)).decode())
    runs = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays([pa.array(x) for x in found], fields=list(_RUN)))
    return batch(_SCHEMA, [r[0] for r in rows], np.diff(bounds), runs, texts)


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, ids, size = [], [], 0
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
            words = text.as_buffer().to_pybytes().split()
            if rows and size + len(words) > CHUNK_WORDS:
                yield _searched(rows, ids)
                rows, ids, size = [], [], 0
            known: dict[bytes, int] = {}
            rows.append((doc_id, words))
            ids.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
            size += len(words)
        if rows:
            yield _searched(rows, ids)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (an array of start, length and period by start, then period; words are numbered from 0),
    collapsed (the words that no run contains after its first period, joined by a space)."""
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return documents(docs).mapInArrow(tidy(_run_rows), schema)
