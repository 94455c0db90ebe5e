"""Substring deduplication by relative Lempel-Ziv parsing against content-anchored reference blocks.

The index. Every window of `width` words owns an anchor: the rightmost smallest hash of `gram` consecutive words inside
it. The windows that share an anchor occurrence are consecutive, and their words form one reference block. Equal windows
have equal anchors at equal places, so only blocks with an anchor that occurs twice can hold a window that does:

* a block whose anchor occurs with one context only recurs whole;
* where an anchor occurs in several contexts, a factor starts or ends inside the block, and each of its windows is
  counted by itself over the whole corpus.

The index holds, for every recurring window of the corpus, its first and its last place (document and word); places
that go on in step are one entry of a block.

The parse. From its first recurring window on, a document is factored greedily: of the window's indexed places (other
than itself), the one is taken that the document follows longest, window by window, each a word further. The next
factor starts at the first recurring window behind. If that one begins inside the factor before, it crosses the factor's
boundary: its words behind the boundary become a factor, with their place in the reference. So factors do not overlap,
each is part of a match of at least `width` words, and together they hold just the words of recurring windows.

Judged on the input, same document included. Windows are equal if their hashes of two lanes are, 128 bits. Cases: null and empty texts
and texts under `width` words have no factor; repeated rows are factors of each other; a row with a null doc_id goes by
a hash of its text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import HashFilter, batch, combine, documents, drop_written, hashed_texts, join_split, span_hashes, tidy, written


def blocks(h: np.ndarray, other: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple:
    """The blocks of all documents of a chunk, from their word hashes of two lanes.

    Returns for each block: anchor hash, the hashes of its whole context, its first window's place among all words, its
    number of windows (at most width - gram + 1); and the hashes of all windows. Of contexts and windows, both lanes'.
    """
    none = np.zeros(0, np.int64)
    if len(h) < width:
        return none.astype(np.uint64), [none.astype(np.uint64)] * 2, none, none, [none.astype(np.uint64)] * 2
    grams, windows, seconds = span_hashes(h, gram), span_hashes(h, width), span_hashes(other, width)
    reach = width - gram + 1
    best, size = np.arange(len(grams)), 1
    while size < reach:  # the rightmost smallest of the next `size` grams, by doubling
        step = min(size, reach - size)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(grams[right] <= grams[left], right, left)
        size += step
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    good = doc[: len(windows)] == doc[width - 1 :]
    owner = np.where(good, best[: len(windows)], -1)
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(owner)))
    kept = owner[first] >= 0
    first, count = first[kept], count[kept]
    anchor = grams[owner[first]]
    place = (owner[first] - first).astype(np.uint64)
    shape = count.astype(np.uint64) * np.uint64(1 << 20) + place
    contexts = [combine([anchor, x[first], x[first + count - 1], shape]) for x in (windows, seconds)]
    return anchor, contexts, first, count, [windows, seconds]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Contexts and windows are told apart by hashes of two lanes, 128 bits: of 1e13 windows, some 70 TB of text, two that
#: differ are equal with a probability of 1e-13.
_KEY = pa.struct([("a", pa.int64()), ("b", pa.int64())])
_KEY_SQL = "struct<a:long,b:long>"


def _keys(lanes: list[np.ndarray], at) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(_signed(x[at])) for x in lanes], fields=list(_KEY))


#: A first and a last place: the document's id and the number of the window there.
PLACES = ("low_id", "low_at", "high_id", "high_at")
_PLACES = "low_id long, low_at int, high_id long, high_at int"
_PLACE_FIELDS = [("low_id", pa.int64()), ("low_at", pa.int32()), ("high_id", pa.int64()), ("high_at", pa.int32())]


def _grouped(keys: np.ndarray, ids: np.ndarray, at: np.ndarray, others: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """An order of the rows by key and place, and where in it a key's rows start and end (its first and last place).
    others: the keys' second lane."""
    others = keys if others is None else others
    order = np.lexsort((at, ids, others, keys))
    new = np.ones(len(keys), bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (others[order][1:] != others[order][:-1])
    first = np.flatnonzero(new)
    return order, first, np.append(first[1:], len(keys)) - 1


def _chunks(b: pa.RecordBatch, width: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each chunk of texts: anchor, context, first window among all words, number of windows, id, first window in the
    document of each block; and the hashes of all windows."""
    ids = b.column("id").to_numpy()
    for (row, h, offsets), (_, other, _) in zip(hashed_texts(b.column("text")), hashed_texts(b.column("text"), lane=1), strict=True):
        anchor, context, first, count, windows = blocks(h, other, offsets, width, gram)
        if len(anchor):
            doc = np.searchsorted(offsets, first, "right") - 1
            yield anchor, context, first, count, ids[doc + row], (first - offsets[doc]).astype(np.int32), windows


def _anchor_rows(width: int, gram: int):
    schema = pa.schema([("anchor", pa.int64()), *((c, pa.int64()) for c in ("low", "high", "low2", "high2", "n")), *_PLACE_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for anchor, context, _, _, ids, at, _ in _chunks(b, width, gram):
                order, s, e = _grouped(anchor, ids, at)
                low, high = order[s], order[e]
                ends = [f.reduceat(_signed(x)[order], s) for x in context for f in (np.minimum, np.maximum)]
                yield batch(schema, _signed(anchor[low]), *ends, e - s + 1, ids[low], at[low], ids[high], at[high])

    return run


def _window_rows(width: int, gram: int, may_hold):
    schema = pa.schema([("context", _KEY), ("windows", pa.list_(_KEY)), ("n", pa.int64()), *_PLACE_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for anchor, context, first, count, ids, at, windows in _chunks(b, width, gram):
                near = np.flatnonzero(may_hold(anchor))
                if len(near):
                    order, s, e = _grouped(context[0][near], ids[near], at[near], context[1][near])
                    low, high = near[order[s]], near[order[e]]
                    sizes = count[low]
                    ends = np.cumsum(sizes)
                    index = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(first[low], sizes)
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), _keys(windows, index))
                    yield batch(schema, _keys(context, low), lists, e - s + 1, ids[low], at[low], ids[high], at[high])

    return run


def _filtered(column: str, may_hold):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(may_hold(b.column(column).field("a").to_numpy().view(np.uint64))))

    return run


def _block_rows(width: int, gram: int, may_hold):
    schema = pa.schema([("context", _KEY), ("id", pa.int64()), ("first", pa.int32()), ("size", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for anchor, context, _, count, ids, at, _ in _chunks(b, width, gram):
                near = np.flatnonzero(may_hold(anchor))
                if len(near):
                    yield batch(schema, _keys(context, near), ids[near], at[near], count[near].astype(np.int32))

    return run


def _ends() -> list[Column]:
    """The first and last place among those of several rows. Rows with one id tell of one text, and each has the first
    and last place there that any has."""
    return [F.min("low_id").alias("low_id"), F.min_by("low_at", "low_id").alias("low_at"), F.max("high_id").alias("high_id"), F.max_by("high_at", "high_id").alias("high_at")]


def reference_index(docs: DataFrame, width: int, gram: int) -> tuple[DataFrame, HashFilter]:
    """context, n (blocks with it), bits (of its recurring windows), low_id, low_at, high_id, high_at (where its window 0
    would be): rows of one context differ in their places. And which anchors recur. docs: id, text."""
    anchors = docs.mapInArrow(tidy(_anchor_rows(width, gram)), f"anchor long, low long, high long, low2 long, high2 long, n long, {_PLACES}")
    anchors = anchors.groupBy("anchor").agg(*(F.min(c).alias(c) for c in ("low", "low2")), *(F.max(c).alias(c) for c in ("high", "high2")), F.sum("n").alias("n"), *_ends())
    context = F.struct(F.col("low").alias("a"), F.col("low2").alias("b")).alias("context")  # if there is but one
    recurring = written(anchors.where("n > 1").select("anchor", context, "n", *PLACES, ((F.col("low") != F.col("high")) | (F.col("low2") != F.col("high2"))).alias("varied")))

    varied = HashFilter(recurring.where("varied"), "anchor")
    windows = docs.mapInArrow(tidy(_window_rows(width, gram, varied.reader())), f"context {_KEY_SQL}, windows array<{_KEY_SQL}>, n long, {_PLACES}")
    windows = windows.groupBy("context").agg(F.first("windows").alias("windows"), F.sum("n").alias("n"), *_ends())
    windows = written(windows.select("context", "n", *PLACES, F.posexplode("windows").alias("place", "window")))
    twice = written(windows.groupBy("window").agg(F.sum("n").alias("n")).where("n > 1").select("window"))
    hit = windows.mapInArrow(tidy(_filtered("window", HashFilter(twice.select("window.a"), "a").reader())), windows.schema)
    place = F.col("place")
    low, high = F.struct("low_id", (F.col("low_at") + place).alias("low_at")), F.struct("high_id", (F.col("high_at") + place).alias("high_at"))
    known = written(hit.groupBy("window").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"), F.min(low).alias("low"), F.max(high).alias("high")).where("total > 1").select("window", "rows", "low.*", "high.*"))
    parts = join_split(hit.select("context", "n", "place", "window"), known, "window", "rows", "context")
    parts = parts.groupBy("context", "n", "low_id", (F.col("low_at") - place).alias("low_at"), "high_id", (F.col("high_at") - place).alias("high_at")).agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))
    whole = recurring.where("not varied").select("context", "n", *PLACES, F.lit(-1).cast("long").alias("bits"))
    index = written(whole.unionByName(parts))
    drop_written(windows, twice, known)
    every = HashFilter(recurring, "anchor")
    drop_written(recurring)
    return index, every


def recurring_blocks(docs: DataFrame, width: int = 35, gram: int = 8) -> DataFrame:
    """id, blocks: of each document with a recurring window, an array of (first window, bits of recurring windows, and
    the first and last place that the index has for its first window). docs: id, text."""
    index, every = reference_index(docs, width, gram)
    found = docs.mapInArrow(tidy(_block_rows(width, gram, every.reader())), f"context {_KEY_SQL}, id long, first int, size int")
    found = join_split(found, index, "context", "n", "id")
    bits = F.col("bits").bitwiseAND(F.expr("shiftleft(1L, size) - 1"))
    return found.groupBy("id").agg(F.collect_set(F.struct("first", bits.alias("bits"), *PLACES)).alias("blocks"))


def _stretches(bits: int) -> Iterator[tuple[int, int]]:
    """Start and end of each run of ones."""
    at = 0
    while bits:
        skip = (bits & -bits).bit_length() - 1
        bits >>= skip
        run = (~bits & (bits + 1)).bit_length() - 1
        yield at + skip, at + skip + run
        bits >>= run
        at += skip + run


def parse(own: int, found: list[tuple[int, int, int, int, int, int]], width: int) -> list[tuple[int, int, int, int]]:
    """The factors (start, length, document and word of the reference) of the document with the id `own`, from its blocks
    (first, bits, low_id, low_at, high_id, high_at). A reference is in step with the document if the difference of their
    places stays; the work grows with the number of blocks."""
    spans = []
    for first, bits, low_id, low_at, high_id, high_at in found:
        steps = sorted({(low_id, low_at - first), (high_id, high_at - first)} - {(own, 0)}) or [(own, 0)]  # itself: another row with its id
        spans += [(first + s, first + e, steps) for s, e in _stretches(bits)]
    spans.sort(key=lambda x: x[0])
    reach: list[dict[tuple[int, int], int]] = []  # of each span, how far each reference is followed; last span first
    before: tuple[int, dict] = (-1, {})
    for s, e, steps in reversed(spans):
        reach.append({x: before[1].get(x, e) if before[0] == e else e for x in steps})
        before = s, reach[-1]
    reach.reverse()
    out, k, covered = [], 0, 0
    while k < len(spans):
        (ref, step), end = min(reach[k].items(), key=lambda r: (-r[1], r[0]))
        start = max(spans[k][0], covered)
        covered = end + width - 1
        out.append((start, covered - start, ref, start + step))
        while k < len(spans) and spans[k][0] < end:
            k += 1
    return out


_FACTOR = ("start", "length", "ref_id", "ref_start")


def _factored(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()), ("factors", pa.list_(pa.struct([(c, pa.int64()) for c in _FACTOR])))])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            out: list[tuple] = []
            size, lists = 0, b.column("blocks")
            flat, lengths = lists.flatten(), pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
            columns, ends = [x.to_pylist() for x in flat.flatten()], np.cumsum(lengths).tolist()
            for row, (doc_id, own, text) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("id").to_pylist(), b.column("text"), strict=True)):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                n, factors = len(words), []
                if lengths[row]:
                    factors = parse(own, list(zip(*(c[ends[row] - lengths[row] : ends[row]] for c in columns), strict=True)), width)
                    kept, at = [], 0
                    for start, length, *_ in factors:
                        kept += words[at:start]
                        at = start + length
                    words = kept + words[at:]
                text = b" ".join(words)
                out.append((doc_id, n, n - len(words), hashlib.sha256(text).hexdigest(), text.decode(), [dict(zip(_FACTOR, f, strict=True)) for f in factors]))
                size += len(text)
                if size > 8_000_000:
                    yield batch(schema, *zip(*out, strict=True))
                    out, size = [], 0
            if out:
                yield batch(schema, *zip(*out, strict=True))

    return run


def substring_dedup(docs: DataFrame, width: int = 35, gram: int = 8) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the words that stay, joined by a space), factors (start, length,
    ref_id and ref_start: the document and word that the factor repeats)."""
    docs = documents(docs).select("doc_id", F.coalesce("doc_id", F.xxhash64("text")).alias("id"), "text")
    found = recurring_blocks(docs.select("id", "text"), width, gram)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, factors array<struct<start:long,length:long,ref_id:long,ref_start:long>>"
    return docs.join(found, "id", "left").select("doc_id", "id", "text", "blocks").mapInArrow(tidy(_factored(width)), schema)
