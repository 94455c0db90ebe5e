"""Near duplicates by word n-gram Jaccard similarity: a prefix-filtered similarity join, exact up to 64-bit hashes.

A document's set holds the hashes of its distinct n-word shingles. Two documents link when their sets' Jaccard
similarity is at least `percent` hundredths. The join finds the components of these links:

1. Equal sets collapse to one representative, so exact copies never meet each other again.
2. Shingles are ordered rare first. Their frequencies are counted over the whole corpus in a table of 2 ** SKETCH
   counters; any order is right, a counter's error only makes a prefix less selective.
3. Sets that link share a shingle within their prefixes. Representatives meet in the bucket of such a shingle and must
   pass the length filter, the positional filter, and a suffix filter: the sets' counts in PARTS parts differ by no
   more than the sets may. Survivors of a bucket are joined to groups by a spanning forest, not by pairs.
4. Groups of more than one block are formed anew in the same way by finer counts, about FINE shingles a part, which
   tell long sets apart as well as short ones.
5. Within a group every pair is verified once at most on whole sets; pairs that other links already join are skipped.

Buckets and groups of more than BUCKET and GROUP members are dealt out (steps 3 to 5 alike, see _linked): a sample of
about SAMPLE members shows which belong together, and PIVOTS of the largest such set go to every block. What a block
joins to a pivot is done; only the members left outside are then compared with all members, block by block. No link is
lost: two members that are both joined to pivots are already in one component. A group of k near copies costs k rows
and not k squared; the price is k times the number outside, k squared at worst, if hardly any two of k candidates link.

Words: A-Z lower-cased if `lower`, then `[^\\x20\\x09-\\x0D]+`. With fewer words than n the whole sequence is the one
shingle. Cases: null and empty texts and those without words have an empty set and link with nothing; repeated rows
fall in one component; a row with a null doc_id has the component of rows with an equal set, or null if none has an id;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import HashFilter, batch, combine, documents, drop_written, hashed_texts, mix, tidy, written
from twinfold.operators.components import connected_components

SKETCH = 20
SLICES = 64
PARTS = 128
BUCKET = 512
GROUP = 64
FINE = 4
#: Members of a large key that are compared first, and how many of the largest set among them go to every block.
SAMPLE = 64
PIVOTS = 8
#: What a row is to a worker: one of a whole key; of a sample; a pivot; another member of a block; one left outside, and
#: what that is compared with.
WHOLE, SAMPLED, PIVOT, MEMBER, LEFT, RIGHT = range(6)
#: Most rows of a table of groups or of large buckets that is broadcast, 12 to 20 bytes each.
BROADCAST_ROWS = 500_000


def shingle_sets(h: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a chunk."""
    if len(h) >= width:
        columns = [h[i : len(h) - width + 1 + i] for i in range(width)]
        grams = combine(columns)
    for s, e in zip(offsets[:-1], offsets[1:], strict=True):
        if e - s >= width:
            yield np.unique(grams[s : e - width + 1])
        elif e > s:
            yield combine([h[i : i + 1] for i in range(s, e)] + [np.array([e - s], np.uint64)])
        else:
            yield np.zeros(0, np.uint64)


def _sets(b: pa.RecordBatch, width: int, lower: bool) -> Iterator[tuple[int, np.ndarray]]:
    for row, h, offsets in hashed_texts(b.column("text"), lower):
        for i, s in enumerate(shingle_sets(h, offsets, width)):
            yield row + i, s


_ROWS = "doc_id long, n long, k1 long, k2 long, slice int, part int, counts binary"


def _signatures(width: int, lower: bool):
    """Each document's size and signature of its set; and, as slices of one table, how many sets hold the shingles."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("slice", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(1 << SKETCH, np.uint32)
        for b in batches:
            n, k1, k2 = (np.zeros(b.num_rows, np.uint64) for _ in range(3))
            held: list[np.ndarray] = []
            size = 0
            for i, s in _sets(b, width, lower):
                n[i], k1[i] = len(s), s.sum(dtype=np.uint64)
                k2[i] = mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)
                held.append(s)
                size += len(s)
                if size > 1_000_000:
                    total += np.bincount((np.concatenate(held) >> np.uint64(64 - SKETCH)).astype(np.int64), minlength=1 << SKETCH).astype(np.uint32)
                    held, size = [], 0
            if held:
                total += np.bincount((np.concatenate(held) >> np.uint64(64 - SKETCH)).astype(np.int64), minlength=1 << SKETCH).astype(np.uint32)
            none = pa.nulls(b.num_rows)
            yield batch(schema, b.column("doc_id"), *(x.view(np.int64) for x in (n, k1, k2)), none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.binary()))
        if total.any():
            yield _slices(schema, total, TaskContext.get().partitionId())

    return run


def _slices(schema: pa.Schema, total: np.ndarray, part: int) -> pa.RecordBatch:
    none = [pa.nulls(SLICES).cast(pa.int64())] * 4
    return batch(schema, *none, np.arange(SLICES, dtype=np.int32), np.full(SLICES, part, np.int32), [zlib.compress(x.tobytes(), 1) for x in total.reshape(SLICES, -1)])


def _added(batches: Iterator[pa.RecordBatch]):
    """Sums of slices with one key; rows come sorted by key."""
    schema = pa.schema([("slice", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
    key, total = None, None
    for b in batches:
        for s, p, counts in zip(*(b.column(c).to_pylist() for c in schema.names), strict=True):
            counts = np.frombuffer(zlib.decompress(counts), np.uint32)
            if key == (s, p):
                total = total + counts
            else:
                if key:
                    yield batch(schema, [key[0]], [key[1]], [zlib.compress(total.tobytes(), 1)])
                key, total = (s, p), counts
    if key:
        yield batch(schema, [key[0]], [key[1]], [zlib.compress(total.tobytes(), 1)])


def _frequencies(rows: DataFrame) -> np.ndarray:
    """The table of counters: summed by slice in two levels; 2 ** SKETCH numbers reach the driver."""
    for level in (256, 1):
        key = F.pmod("part", F.lit(level)).alias("part")
        rows = rows.select("slice", key, "counts").repartition("slice", "part").sortWithinPartitions("slice", "part").mapInArrow(tidy(_added), "slice int, part int, counts binary")
    out = np.zeros((SLICES, (1 << SKETCH) // SLICES), np.uint32)
    for r in rows.collect():
        out[r["slice"]] = np.frombuffer(zlib.decompress(bytes(r["counts"])), np.uint32)
    return out.ravel()


def _prefixes(width: int, lower: bool, percent: int, sent):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("prefix", pa.list_(pa.int64())), ("sums", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]):
        counts = sent.value
        for b in batches:
            rows, n, prefix, sums = [], [], [], []
            for i, s in _sets(b, width, lower):
                if len(s):
                    order = np.lexsort((s, counts[(s >> np.uint64(64 - SKETCH)).astype(np.int64)]))
                    rows.append(i)
                    n.append(len(s))
                    prefix.append(s[order[: len(s) - -(-len(s) * percent // 100) + 1]].view(np.int64))
                    sums.append(np.bincount((s & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS).astype(np.uint8).tobytes())
            if rows:
                ends = np.cumsum([0, *map(len, prefix)])
                yield batch(schema, b.column("doc_id").take(pa.array(rows)), n, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefix))), sums)

    return run


def _entries(may_meet):
    """A row for each shingle of a prefix that other prefixes may hold too."""
    schema = pa.schema([("hash", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("place", pa.int32()), ("sums", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            lists = b.column("prefix")
            flat, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            hits = np.flatnonzero(may_meet(flat.view(np.uint64)))
            row = np.searchsorted(ends, hits, "right")
            for s in range(0, len(hits), 50_000):
                h, r = hits[s : s + 50_000], row[s : s + 50_000]
                at = pa.array(r)
                yield batch(schema, flat[h], b.column("doc_id").take(at), b.column("n").take(at), (h - (ends - lengths)[r]).astype(np.int32), b.column("sums").take(at))

    return run


class Forest:
    """Union-find over 0 to n - 1."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> np.ndarray:
        """Join i with others; returns those of them that were apart, one for each tree."""
        labels, first = np.unique(self.label[others], return_index=True)
        new = labels != self.label[i]
        labels, first = labels[new], first[new]
        if len(labels):
            self.label[np.isin(self.label, labels)] = self.label[i]
        return others[first]


def span(doc: np.ndarray, side: np.ndarray, passes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows (i, j) of a spanning forest of the pairs that passes(i, others) lets through, and the rows to report.

    LEFT rows are compared with RIGHT ones only, others each with each; pairs that are joined already are skipped. To
    report: of SAMPLED rows PIVOTS of the largest tree, of MEMBER rows those that share no tree with a pivot.
    """
    forest, out_i, out_j = Forest(len(doc)), [], []
    rights = np.flatnonzero(side == RIGHT)
    for i in np.flatnonzero(side == LEFT) if len(rights) else range(len(doc) - 1):
        others = rights[doc[rights] != doc[i]] if len(rights) else np.arange(i + 1, len(doc))
        others = others[forest.label[others] != forest.label[i]]
        if len(others):
            ok = passes(i, others)
            if ok.any():
                new = forest.join(i, others[ok])
                out_i.append(np.full(len(new), i))
                out_j.append(new)
    report = np.zeros(0, np.int64)
    if side[0] == SAMPLED:
        labels, sizes = np.unique(forest.label, return_counts=True)
        report = np.flatnonzero(forest.label == labels[sizes.argmax()])[:PIVOTS]
    elif (members := side == MEMBER).any():
        report = np.flatnonzero(members & ~np.isin(forest.label, forest.label[side == PIVOT]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_i]), np.concatenate([none, *out_j]), report


_SPANNED = pa.schema([("i", pa.int64()), ("j", pa.int64()), ("key", pa.int64())])


class _Spanned:
    """Collects links (i, j), and reported members without j but with their key."""

    def __init__(self):
        self.links, self.reported = [], []

    def add(self, key: int, doc: np.ndarray, side: np.ndarray, passes) -> None:
        i, j, report = span(doc, side, passes)
        if len(i):
            self.links.append(np.stack([doc[i], doc[j]]))
        if len(report):
            self.reported.append(np.stack([doc[report], np.full(len(report), key)]))

    def batch(self) -> pa.RecordBatch:
        none = np.zeros((2, 0), np.int64)
        (i, j), (member, key) = (np.concatenate([none, *x], 1) for x in (self.links, self.reported))
        self.links, self.reported = [], []
        nulls = [pa.nulls(len(x)).cast(pa.int64()) for x in (i, key)]
        columns = [pa.array(np.append(i, member)), pa.concat_arrays([pa.array(j), nulls[1]]), pa.concat_arrays([nulls[0], pa.array(key)])]
        return pa.RecordBatch.from_arrays(columns, schema=_SPANNED)


def _pairs_pass(n, place, sums, i, others, percent: int) -> np.ndarray:
    """Which of others may link with i: length, positional and suffix filter."""
    ni, no = n[i], n[others]
    small, large = np.minimum(ni, no), np.maximum(ni, no)
    need = -(-(ni + no) * percent // (100 + percent))  # least size of the intersection
    most = np.minimum(place[i], place[others]) + 1 + np.minimum(ni - place[i], no - place[others]) - 1
    ok = (100 * small >= percent * large) & (most >= need)
    if ok.any():
        apart = sums[others] - sums[i]  # unsigned bytes wrap: counts modulo 256
        ok &= np.minimum(apart, -apart).sum(1, dtype=np.int64) <= ni + no - 2 * need
    return ok


def _bucket_edges(percent: int):
    def run(batches: Iterator[pa.RecordBatch]):
        found = _Spanned()
        for keys, (doc, n, place, side, sums) in grouped(batches, ["key", "a", "b"], ["doc_id", "n", "place", "side"], "sums"):
            cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            starts, ends = np.append(0, cut), np.append(cut, len(keys[0]))
            small = (ends - starts == 2) & (side[starts] == WHOLE)
            two = starts[small]
            if len(two):
                two = two[_pairs_pass(n, place, sums, two, two + 1, percent)]
                found.links.append(np.stack([doc[two], doc[two + 1]]))
            others = ~small & ((ends - starts > 1) | (side[starts] != WHOLE))
            for s, e in zip(starts[others].tolist(), ends[others].tolist(), strict=True):
                found.add(keys[0][s], doc[s:e], side[s:e], lambda i, o, s=s: _pairs_pass(n, place, sums, s + i, s + o, percent))
            yield found.batch()

    return run


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str], numbers: list[str], binary: str):
    """Rows sorted by keys as numpy columns, as many whole groups as have come."""
    rest: pa.Table | None = None

    def columns(t: pa.Table):
        t = t.combine_chunks()
        k = [t.column(c).to_numpy() for c in keys]
        raw = np.frombuffer(b"".join(x.as_buffer() for x in t.column(binary)), np.uint8).reshape(len(t), -1)
        return k, [*(t.column(c).to_numpy().astype(np.int64) for c in numbers), raw]

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        k = [t.column(c).to_numpy() for c in keys]
        last = np.flatnonzero(np.any([x != x[-1] for x in k], axis=0))
        whole = int(last[-1]) + 1 if len(last) else 0
        if whole:
            yield columns(t.slice(0, whole))
        rest = t.slice(whole)
    if rest is not None and len(rest):
        yield columns(rest)


def _group_sets(width: int, lower: bool):
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("blocks", pa.int32()), ("set", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            rows, sets, size = [], [], 0

            def out():
                ends = np.cumsum([0, *map(len, sets)])
                at = pa.array(rows)
                return batch(schema, *(b.column(c).take(at) for c in schema.names[:3]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64))))

            for i, s in _sets(b, width, lower):
                rows.append(i)
                sets.append(s)
                size += len(s)
                if size > 1_000_000:
                    yield out()
                    rows, sets, size = [], [], 0
            if rows:
                yield out()

    return run


def fine_sums(s: np.ndarray) -> np.ndarray:
    """Counts of a set in the power of two of parts that gives a part FINE to 2 * FINE shingles, modulo 256."""
    parts = 1 << max(0, (len(s) // FINE).bit_length() - 1)
    return np.bincount((s & np.uint64(parts - 1)).astype(np.int64), minlength=parts).astype(np.uint8)


def folded(sums: np.ndarray, parts: int) -> np.ndarray:
    """The same counts in fewer parts."""
    return sums.reshape(-1, parts).sum(0, dtype=np.uint8)


def _group_sums(width: int, lower: bool):
    """Of each text, its finer counts and then its number of shingles in 8 bytes."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("blocks", pa.int32()), ("sums", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found = [fine_sums(s).tobytes() + len(s).to_bytes(8, "little") for _, s in _sets(b, width, lower)]
            if found:
                yield batch(schema, *(b.column(c) for c in schema.names[:3]), found)

    return run


def _by_key(passes_of, column: str):
    """A worker that gathers the rows of a key and spans them; passes_of(values of the column) compares them."""

    def run(batches: Iterator[pa.RecordBatch]):
        at, docs, sides, values, found = None, [], [], [], _Spanned()

        def add():
            if len(docs) > 1 or docs and sides[0] != WHOLE:
                found.add(at[0], np.array(docs), np.array(sides), passes_of(values))

        for b in batches:
            for key, doc, side, value in zip(zip(*(b.column(c).to_pylist() for c in ("key", "a", "b")), strict=True), b.column("doc_id").to_pylist(), b.column("side").to_pylist(), b.column(column), strict=True):
                if key != at:
                    add()
                    at, docs, sides, values = key, [], [], []
                docs.append(doc)
                sides.append(side)
                values.append(np.frombuffer(value.as_buffer().to_pybytes(), np.uint8) if column == "sums" else value.values.to_numpy().view(np.uint64).copy())
            yield found.batch()
        add()
        yield found.batch()

    return run


def _alike(percent: int):
    """Whether the finer counts of two sets differ by no more than the sets may."""

    def passes_of(values: list[np.ndarray]):
        n, sums = np.array([int(v[-8:].view(np.int64)[0]) for v in values]), [v[:-8] for v in values]
        parts = np.array([len(x) for x in sums])
        levels = {p: np.stack([folded(x, p) if len(x) >= p else np.zeros(p, np.uint8) for x in sums]) for p in set(parts.tolist())}

        def passes(i: int, others: np.ndarray) -> np.ndarray:
            ok = 100 * np.minimum(n[i], n[others]) >= percent * np.maximum(n[i], n[others])
            both, level = n[i] + n[others], np.minimum(parts[others], parts[i])
            for p in set(level[ok].tolist()):
                these = np.flatnonzero(ok & (level == p))
                apart = levels[p][others[these]] - levels[p][i]
                ok[these] = np.minimum(apart, -apart).sum(1, dtype=np.int64) <= both[these] - 2 * -(-both[these] * percent // (100 + percent))
            return ok

        return passes

    return _by_key(passes_of, "sums")


def _verified(percent: int):
    """Whether two sets link, by their shingles."""

    def passes_of(sets: list[np.ndarray]):
        n = np.array([len(s) for s in sets])

        def passes(i: int, others: np.ndarray) -> np.ndarray:
            ok = 100 * np.minimum(n[i], n[others]) >= percent * np.maximum(n[i], n[others])
            near = others[ok]
            if len(near):
                every = np.concatenate([sets[j] for j in near])
                at = np.searchsorted(sets[i], every)
                hit = sets[i][np.minimum(at, n[i] - 1)] == every
                both = np.add.reduceat(hit, np.cumsum(n[near]) - n[near], dtype=np.int64)
                ok[ok] = 100 * both >= percent * (n[i] + n[near] - both)
            return ok

        return passes

    return _by_key(passes_of, "set")


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _linked(small: DataFrame | None, large: DataFrame | None, size: int, worker) -> DataFrame:
    """i, j: links that span what the worker joins of the members (doc_id and more columns) of each key.

    A key of `small` is one task's. Those of `large` have `blocks` blocks of about `size` members each: pivots are sought
    in a sample, each block is spanned with them, and what stays outside is compared with all members.
    """

    def dealt(df: DataFrame) -> DataFrame:
        return df.drop("blocks").repartition("key", "a", "b").sortWithinPartitions("key", "a", "b").mapInArrow(tidy(worker), "i long, j long, key long")

    def of(found: DataFrame) -> DataFrame:
        return found.where("j is null").select("key", F.col("i").alias("doc_id"))

    zero, links = F.lit(0), []
    if small is not None:
        links.append(dealt(small.withColumns({"a": zero, "b": zero, "side": F.lit(WHOLE)})))
    if large is not None:
        large = written(large)
        own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
        sampled = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.floor(F.col("blocks") * size / SAMPLE), F.lit(1))) == 0
        first = written(dealt(large.where(sampled).withColumns({"a": zero, "b": zero, "side": F.lit(SAMPLED)})))
        marked = large.join(_few(of(first).withColumn("side", F.lit(PIVOT))), ["key", "doc_id"], "left").withColumn("side", F.coalesce("side", F.lit(MEMBER)))
        everywhere = F.when(F.col("side") == PIVOT, F.sequence(zero, F.col("blocks") - 1)).otherwise(F.array(own))
        second = written(dealt(marked.withColumn("a", F.explode(everywhere)).withColumn("b", zero)))
        links += [first, second]
        outside = of(second)
        lefts = written(outside.groupBy("key").agg(F.ceil(F.count(zero) / size).cast("int").alias("lefts")))
        if not lefts.isEmpty():
            held = large.join(_few(lefts), "key").withColumn("own", own)
            right = held.withColumn("a", F.explode(F.sequence(zero, F.col("lefts") - 1))).withColumn("b", F.col("own")).withColumn("side", F.lit(RIGHT))
            left = held.join(_few(outside), ["key", "doc_id"]).withColumn("a", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("lefts")).cast("int"))
            left = left.withColumn("b", F.explode(F.sequence(zero, F.col("blocks") - 1))).withColumn("side", F.lit(LEFT))
            links.append(dealt(left.unionByName(right).drop("own", "lefts")))
    return reduce(DataFrame.unionByName, links).where("j is not null").select("i", "j")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, lower: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach), one row for each row of docs."""
    spark = docs.sparkSession
    docs = documents(docs)
    first = written(docs.mapInArrow(tidy(_signatures(width, lower)), _ROWS))
    sets = first.where("slice is null").select("doc_id", "n", "k1", "k2")
    sent = spark.sparkContext.broadcast(_frequencies(first.where("slice is not null")))
    classes = written(sets.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")))

    prefixes = docs.mapInArrow(tidy(_prefixes(width, lower, percent, sent)), "doc_id long, n int, prefix array<long>, sums binary")
    prefixes = written(prefixes.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"))
    met = written(prefixes.select(F.explode("prefix").alias("hash")).groupBy("hash").count().where("count > 1"))

    def entries(of: DataFrame, column: str) -> DataFrame:
        """Of these shingles, and of a few more that the filter lets through."""
        found = prefixes.mapInArrow(tidy(_entries(HashFilter(of, column).reader())), "hash long, doc_id long, n int, place int, sums binary")
        return found.withColumnRenamed("hash", "key")

    every = entries(met, "hash")
    large = met.where(F.col("count") > BUCKET).select(F.col("hash").alias("key"), F.ceil(F.col("count") / BUCKET).cast("int").alias("blocks"))
    if n_large := large.count():
        known = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
        edges = _linked(every.join(known.select("key"), "key", "left_anti"), entries(large, "key").join(known, "key"), BUCKET, _bucket_edges(percent))
    else:
        edges = _linked(every, None, BUCKET, _bucket_edges(percent))

    def sized(found: DataFrame) -> DataFrame:
        """key, doc_id, blocks of each member of a group."""
        found = written(found.select(F.col("node").alias("doc_id"), F.col("component").alias("key")))
        sizes = written(found.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("blocks")))
        return written(found.join(_few(sizes), "key").select("key", "doc_id", "blocks"))

    def held(groups: DataFrame, kernel, column: str) -> DataFrame:
        texts = docs.join(_few(groups), "doc_id").select("key", "doc_id", "blocks", "text")
        return texts.mapInArrow(tidy(kernel(width, lower)), f"key long, doc_id long, blocks int, {column}")

    groups = sized(connected_components(edges, written))
    small, large = groups.where("blocks = 1"), groups.where("blocks > 1")
    if not large.isEmpty():
        found = connected_components(_linked(None, held(large, _group_sums, "sums binary"), GROUP, _alike(percent)), written)
        groups = written(small.unionByName(sized(found)))
        small, large = groups.where("blocks = 1"), groups.where("blocks > 1")
    rest = None if large.isEmpty() else held(large, _group_sets, "set array<long>")
    links = _linked(held(small, _group_sets, "set array<long>"), rest, GROUP, _verified(percent))
    linked = written(connected_components(links, written))

    named = classes.select("n", "k1", "k2", "rep").join(linked.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = written(named.select("n", "k1", "k2", F.coalesce("component", "rep").alias("component_id")))
    return sets.join(named, ["n", "k1", "k2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def near_unique(docs: DataFrame, width: int = 5, percent: int = 80, lower: bool = True) -> DataFrame:
    """The documents whose doc_id is their component's smallest, with all their columns."""
    found = jaccard_components(docs, width, percent, lower)
    return docs.join(found.where("doc_id <> component_id").select("doc_id"), "doc_id", "left_anti")
