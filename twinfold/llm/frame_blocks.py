"""Patched frame-of-reference blocks: a file format for token ids.

A file holds the ids of whole documents in order. Layout, all little-endian:

    magic "PFB1", block length, documents, ids, blocks (4 x uint32)
    doc_ids int64[documents], ids of each document uint32[documents]
    block index: start of each block's packed words uint32[blocks + 1], of its exceptions uint32[blocks + 1],
                 minimum uint32[blocks], width uint8[blocks]
    packed words uint64[...]
    exceptions: places in the block uint16[...], differences uint32[...]

A block has `block length` ids (the last one is padded with its minimum). Its minimum is subtracted; differences are
packed at the width that a percentile of them needs; larger ones are packed by their low bits and kept whole in the
exception list. Block starts are indexed, so one document is read without the rest.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

MAGIC = b"PFB1"
BLOCK = 1024
PERCENTILE = 0.95


def _pack(v: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64 k numbers below 2 ** width as rows of width * k words."""
    rows, n = v.shape
    lanes = np.ascontiguousarray(v.reshape(rows * n // 64, 64).T).astype(np.uint64)
    out = np.zeros((width, lanes.shape[1]), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).reshape(rows, n // 64 * width)


def _unpack(words: np.ndarray, width: int, n: int) -> np.ndarray:
    rows = len(words)
    lanes = np.ascontiguousarray(words.reshape(rows * n // 64, width).T)
    out = np.empty((64, lanes.shape[1]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        x = lanes[word] >> np.uint64(shift)
        if shift + width > 64:
            x |= lanes[word + 1] << np.uint64(64 - shift)
        out[i] = x & mask
    return np.ascontiguousarray(out.T).reshape(rows, n).astype(np.uint32)


def encode(doc_ids: Iterable[int], lengths: Iterable[int], ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """One file. block: a multiple of 64, at most 65536."""
    doc_ids, lengths, ids = np.asarray(doc_ids, "<i8"), np.asarray(lengths, "<u4"), np.asarray(ids, np.uint32)
    blocks = -(-len(ids) // block)
    v = np.full(blocks * block, ids[-1] if len(ids) else 0, np.uint32)
    v[: len(ids)] = ids
    v = v.reshape(blocks, block)
    low = v.min(axis=1) if blocks else np.zeros(0, np.uint32)
    v = v - low[:, None]
    rank = min(block - 1, int(np.ceil(percentile * block)) - 1)
    most = np.partition(v, rank, axis=1)[:, rank] if blocks else np.zeros(0, np.uint32)
    width = np.ceil(np.log2(most.astype(np.float64) + 1)).astype(np.uint8)
    row, place = np.nonzero(v >= (np.uint64(1) << width.astype(np.uint64))[:, None])
    starts = np.zeros(blocks + 1, np.int64)
    starts[1:] = np.cumsum(width.astype(np.int64) * (block // 64))
    words = np.zeros(int(starts[-1]), np.uint64)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        size = int(w) * (block // 64)
        words[(starts[at][:, None] + np.arange(size)).ravel()] = _pack(v[at] & np.uint32((1 << int(w)) - 1), int(w)).ravel()
    odd = np.zeros(blocks + 1, np.int64)
    odd[1:] = np.cumsum(np.bincount(row, minlength=blocks)) if blocks else 0
    head = np.array([block, len(doc_ids), len(ids), blocks], "<u4")
    parts = [head, doc_ids, lengths, starts.astype("<u4"), odd.astype("<u4"), low.astype("<u4"), width, words.astype("<u8"), place.astype("<u2"), v[row, place].astype("<u4")]
    return MAGIC + b"".join(p.tobytes() for p in parts)


class Reader:
    """A file's documents; all(), or any range of ids by the block index."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a file of frame-of-reference blocks")
        self.block, n, self.n_ids, self.blocks = (int(x) for x in np.frombuffer(data, "<u4", 4, 4))
        at = 20

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.doc_ids, self.lengths = take("<i8", n), take("<u4", n)
        self.starts, self.odd = take("<u4", self.blocks + 1).astype(np.int64), take("<u4", self.blocks + 1).astype(np.int64)
        self.low, self.width = take("<u4", self.blocks), take("u1", self.blocks)
        self.words, self.place, self.value = take("<u8", int(self.starts[-1])), take("<u2", int(self.odd[-1])), take("<u4", int(self.odd[-1]))

    def range(self, start: int, end: int) -> np.ndarray:
        """The ids from start to before end; reads only the blocks that hold them."""
        first, last = start // self.block, -(-end // self.block)
        out = np.zeros((max(0, last - first), self.block), np.uint32)
        width = self.width[first:last]
        for w in np.unique(width[width > 0]):
            at = np.flatnonzero(width == w)
            size = int(w) * (self.block // 64)
            out[at] = _unpack(self.words[(self.starts[first + at][:, None] + np.arange(size))], int(w), self.block)
        row = np.repeat(np.arange(len(out)), np.diff(self.odd[first : last + 1]))
        span = slice(int(self.odd[first]), int(self.odd[last])) if len(out) else slice(0)
        out[row, self.place[span]] = self.value[span]
        out += self.low[first:last, None]
        return out.ravel()[start - first * self.block : end - first * self.block]

    def all(self) -> np.ndarray:
        return self.range(0, self.n_ids)
