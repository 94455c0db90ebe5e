"""Packing documents into sequences of bounded length: non-negative least squares over length patterns.

Only the histogram of piece lengths (at most `size` bins) reaches the driver. There, patterns of one, two or three
pieces that fill a sequence exactly are enumerated, their repeat counts are fitted to the histogram by non-negative
least squares (multiplicative updates, which keep every count at 0 or more), rounded with the remainder carried on, and
cut to what is left of each length. What no pattern took is packed best fit, longest first, on counts of equal
sequences, so the work depends on the number of lengths and not on the number of documents. If that needs more sequences
than the sum of lengths does, smaller SHARES of the fitted counts are tried, which leave the residual more of the short
pieces that fill gaps; the fewest sequences win, of these the largest share.

Pieces are then numbered by (length, doc_id, piece) over all tasks; each stretch of equal numbers of a plan takes the
next ones of its length. No group of equal lengths has to be in one task.

Cases: a null or empty text is one piece of the end id; repeated rows are packed each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import batch, documents, tidy, written
from twinfold.llm.tokens import encoder

#: Of the fitted repeat counts, what is tried until no fewer sequences are possible.
SHARES = (1.0, 0.99, 0.95, 0.9, 0.75, 0.5, 0.25, 0.0)

Plan = list[tuple[int, tuple[int, ...]]]  # (number of sequences, lengths of the pieces in each)


def patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """All patterns of one to three of these lengths that fill `size`, longest first, 0 where there is no piece."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    a = lengths[lengths > 0]
    out = [np.array([[size, 0, 0]])] if there[size] else []
    pair = a[(2 * a >= size) & (a < size)]
    pair = pair[there[size - pair]]
    out.append(np.stack([pair, size - pair, np.zeros_like(pair)], 1))
    for x in a[(3 * a >= size) & (a < size - 1)]:
        y = a[(a <= x) & (2 * a >= size - x) & (a < size - x)]
        y = y[there[size - x - y]]
        out.append(np.stack([np.full_like(y, x), y, size - x - y], 1))
    return np.concatenate(out)


def fit(found: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """x >= 0 that makes the patterns' pieces closest to counts (of lengths 0 to size; 0 is no piece)."""
    wanted = counts.astype(float).copy()
    wanted[0] = 0
    n = len(counts)
    x = np.full(len(found), wanted.sum() / max(1, 3 * len(found)))
    real = found > 0
    top = (wanted[found] * real).sum(1)
    for _ in range(rounds):
        made = np.bincount(found.ravel(), np.repeat(x, 3), n)
        made[0] = 0
        x *= top / np.maximum((made[found] * real).sum(1), 1e-12)
    return x


def best_fit(counts: np.ndarray, size: int) -> Plan:
    """Longest first into the fullest sequences that still have room; equal sequences are handled together."""
    room: dict[int, list[list]] = {}
    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            r = min((k for k in room if k >= length), default=None)
            if r is None:
                each = size // length
                full, rest = divmod(left, each)
                for n, k in ((full, each), (1, rest)):
                    if n and k:
                        room.setdefault(size - k * length, []).append([n, (length,) * k])
                left = 0
                break
            group = room[r][-1]
            each = r // length
            n, k = (min(group[0], left // each), each) if left >= each else (1, left)
            room.setdefault(r - k * length, []).append([n, group[1] + (length,) * k])
            left -= n * k
            group[0] -= n
            if not group[0]:
                room[r].remove(group)
                if not room[r]:
                    del room[r]
    return [(n, lengths) for groups in room.values() for n, lengths in groups]


def sequences(made: Plan) -> int:
    return sum(n for n, _ in made)


def rounded(found: np.ndarray, x: np.ndarray, counts: np.ndarray) -> tuple[Plan, np.ndarray]:
    """Whole repeat counts of the patterns, remainders carried on, as far as pieces are left; and what is left."""
    left, out = counts.astype(np.int64).copy(), []
    repeats = np.diff(np.append(0, np.floor(np.cumsum(x) + 0.5))).astype(np.int64)
    for i in np.flatnonzero(repeats):
        lengths, each = np.unique(found[i][found[i] > 0], return_counts=True)
        n = int(min(repeats[i], (left[lengths] // each).min()))
        if n > 0:
            left[lengths] -= n * each
            out.append((n, tuple(int(v) for v in found[i] if v)))
    return out, left


def plan(counts: np.ndarray, size: int) -> Plan:
    """counts: pieces of each length, 0 to size. The fitted patterns come first, the residual's sequences after them."""
    least = -(-int((counts * np.arange(size + 1)).sum()) // size)
    found, best = patterns(np.flatnonzero(counts), size), None
    x = fit(found, counts) if len(found) else np.zeros(0)
    for share in SHARES:
        made, left = rounded(found, x * share, counts)
        made += best_fit(left, size)
        if best is None or sequences(made) < sequences(best):
            best = made
        if sequences(best) == least:
            break
    return best


def _stretches(made: Plan, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """first piece number, first sequence, offset of each stretch of pieces that go to consecutive sequences."""
    base = np.cumsum(counts) - counts
    rows, sequence = [], 0
    for n, lengths in made:
        offset = 0
        for length in lengths:
            rows.append((int(base[length]), sequence, offset))
            base[length] += n
            offset += length
        sequence += n
    out = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def _pieces(path: str, end_id: int, size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]):
        ids_of = encoder(path).encode
        for b in batches:
            out = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = memoryview(ids_of(text.as_py()) + end)
                n = len(ids) // 4
                cuts = [0, *range(n % size or min(size, n), n + 1, size)]
                for piece, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    out.append((doc_id, piece, s, e - s, zlib.crc32(ids[4 * s : 4 * e])))
            if out:
                yield batch(schema, *zip(*out, strict=True))

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of at most `size` ids; only longer documents are cut."""
    return documents(docs).mapInArrow(tidy(_pieces(tokenizer_path, end_id, size)), "doc_id long, piece int, start long, length long, ids_crc32 long")


def _placed(sent):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]):
        parts, before, first, sequence, offset = sent.value
        for b in batches:
            if b.num_rows:
                at = b.column("at").to_numpy(zero_copy_only=False).astype(np.int64)
                n = before[np.searchsorted(parts, at >> 33)] + (at & ((1 << 33) - 1))
                k = np.searchsorted(first, n, "right") - 1
                yield batch(schema, *(b.column(c) for c in schema.names[:5]), sequence[k] + n - first[k], offset[k])

    return run


def pack(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """The pieces with sequence_id and offset: their place in sequences of at most `size` ids, gapless from 0."""
    spark = pieces.sparkSession
    ordered = written(pieces.repartitionByRange("length", "doc_id", "piece").sortWithinPartitions("length", "doc_id", "piece").withColumn("at", F.monotonically_increasing_id()))
    counts = np.zeros(size + 1, np.int64)
    for r in ordered.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    tasks = sorted(ordered.groupBy(F.shiftright("at", 33).alias("part")).count().collect())
    parts, sizes = np.array([r["part"] for r in tasks], np.int64), np.array([r["count"] for r in tasks], np.int64)
    sent = spark.sparkContext.broadcast((parts, np.cumsum(sizes) - sizes, *_stretches(plan(counts, size), counts)))
    return ordered.mapInArrow(tidy(_placed(sent)), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pattern_packing(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    return pack(written(token_pieces(docs, tokenizer_path, size, end_id)), size)
