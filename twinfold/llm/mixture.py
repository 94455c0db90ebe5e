"""Mixing sources to target weights: exact quotas of blocks, dealt out among shards by a splitting tree.

Targets. Sources in the order of their code points (null last) have weights in turn; together they share a multiple of
all words, none more than a multiple of its own: the excess is shared anew by weight until none is above.

Blocks. A source's documents, in the order of doc_id, are one row of words, cut into blocks of BLOCK_WORDS. A source's
quota is its target in whole words: as many passes over its blocks as go into it, and of the next pass the first blocks of
a keyed permutation, the last one cut short. So a source's words are its target, rounded.

The tree. Each node holds a range of shards and how many blocks of every source and pass they get together. Its left half
gets a draw without replacement from these (multivariate hypergeometric), its right half the rest; a leaf is a shard. A
node's generator is seeded by its range alone, so every task finds the same tree and walks only to its own shards. As a
node also holds which places of each permutation are its own, shards draw disjoint blocks without a join, and shuffle them.

Documents meet blocks in one join on (source, block), each block some hundred words, whatever the size of a source.

Cases: null text has no words and is never taken; null sources are one source; repeated rows are documents of their own
(with equal doc_id and text they are interchangeable); a null doc_id is first in its source; an empty table or one
without words gives an empty mix; other columns are ignored. Same rows, same mix, however they are partitioned.

The driver holds some numbers for each source, as do tasks; no row or block passes it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinfold.llm.common import batch, drop_written, mix, text_chunks, tidy, word_starts, written

BLOCK_WORDS = 512
#: Blocks of a shard: some 260,000 words.
SHARD_BLOCKS = 512
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Largest urn that numpy's generator draws from.
URN = 10**9
#: Most sources whose table is broadcast (some 50 bytes each).
FEW = 500_000


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> np.ndarray:
    """The words that each source should give."""
    sizes = np.array(sizes, np.float64)
    weight = np.resize(np.array(weights, np.float64), len(sizes))
    top, capped = most * sizes, np.zeros(len(sizes), bool)
    while not capped.all():
        unit = (share * sizes.sum() - top[capped].sum()) / weight[~capped].sum()
        above = ~capped & (unit * weight > top)
        if not above.any():
            return np.where(capped, top, unit * weight)
        capped |= above
    return top


class Permutation:
    """A keyed one-to-one map of the numbers below n to themselves: a Feistel network, walked until it falls below n."""

    def __init__(self, n: int, *key: int):
        self.n, self.half = n, max(1, (max(1, n - 1).bit_length() + 1) // 2)
        self.keys = np.random.SeedSequence(key).generate_state(6, np.uint64)

    def _step(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return right << half | left  # halves change places, so that the same steps in reverse undo it

    def _walk(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = self._step(np.asarray(x, np.uint64), keys)
        while len(high := np.flatnonzero(out >= np.uint64(self.n))):
            out[high] = self._step(out[high], keys)
        return out.astype(np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys[::-1])


@dataclass(frozen=True)
class Pass:
    """One pass over a source: which of its blocks a quota of words takes."""

    source: int
    number: int
    size: int
    words: int
    block: int
    seed: int

    @property
    def order(self) -> Permutation:
        return Permutation(self.blocks, self.seed, self.source, self.number)

    @property
    def blocks(self) -> int:
        return -(-self.size // self.block)

    def short(self) -> tuple[int, int]:
        """The place of the source's last block in the permutation, and what it lacks."""
        return int(self.order.inverse(np.array([self.blocks - 1]))[0]), self.blocks * self.block - self.size

    def drawn(self) -> int:
        """How many blocks hold the quota: all before the place at which it is reached."""
        if not self.words:
            return 0
        at, lacking = self.short()
        return -(-self.words // self.block) if self.words <= at * self.block else max(at + 1, -(-(self.words + lacking) // self.block))

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The blocks at places of the permutation, and how many words of each are taken."""
        at, lacking = self.short()
        before = places * self.block - lacking * (places > at)
        return self.order(places), np.minimum(self.words - before, self.block - lacking * (places == at))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n draws without replacement are good. Beyond URN, by inversion from the mode outward."""
    if good + bad < URN:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(good, n)
    x = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))

    def choose(a: int, b: int) -> float:
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    p = math.exp(choose(good, x) + choose(bad, n - x) - choose(good + bad, n))
    u, down, up, p_down, p_up = rng.random() - p, x, x, p, p
    while u > 0 and (down > low or up < high) and max(p_down, p_up) > 1e-18:
        if up < high:
            p_up *= (good - up) / (up + 1) * (n - up) / (bad - n + up + 1)
            up += 1
            if (u := u - p_up) <= 0:
                return up
        if down > low:
            p_down *= down / (good - down + 1) * (bad - n + down) / (n - down + 1)
            down -= 1
            if (u := u - p_down) <= 0:
                return down
    return x


def split(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """A draw of n without replacement: how many of each count."""
    if (total := int(counts.sum())) < URN:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    out = np.zeros(len(counts), np.int64)
    for i, c in enumerate(counts.tolist()):
        total -= c
        out[i] = hypergeometric(rng, c, total, n) if n else 0
        n -= int(out[i])
    return out


def leaves(quotas: np.ndarray, shards: int, seed: int, first: int, end: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """shard, first place and number of places in each permutation, of the shards from first to end."""
    each, more = divmod(int(quotas.sum()), shards)
    stack = [(0, shards, quotas, np.zeros(len(quotas), np.int64))]
    while stack:
        low, high, counts, places = stack.pop()
        if high <= first or low >= end:
            continue
        if high - low == 1:
            yield low, places, counts
            continue
        middle = (low + high) // 2
        left = split(np.random.default_rng([seed, low, high]), counts, each * (middle - low) + max(0, min(middle, more) - min(low, more)))
        stack += [(middle, high, counts - left, places + left), (low, middle, left, places)]


_DRAWS = pa.schema([("shard", pa.int64()), ("slot", pa.int32()), ("source_number", pa.int32()), ("pass", pa.int32()), ("block", pa.int64()), ("words", pa.int64())])
_DRAWS_SQL = "shard long, slot int, source_number int, pass int, block long, words long"


def block_draws(spark, passes: list[Pass], shard_blocks: int = SHARD_BLOCKS, seed: int = 0) -> DataFrame:
    """shard, slot (a block's place in its shard), source_number, pass, block, words (how many of its words are taken)."""
    quotas = np.array([p.drawn() for p in passes], np.int64)
    shards = -(-int(quotas.sum()) // shard_blocks)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column("id").to_numpy()
            for shard, places, counts in leaves(quotas, shards, seed, int(ids[0]), int(ids[-1]) + 1):
                own = np.flatnonzero(counts).tolist()
                taken = [passes[k].take(np.arange(places[k], places[k] + counts[k])) for k in own]
                n, kind = int(counts.sum()), np.repeat(own, counts[own])
                slots = np.random.default_rng([seed, shard]).permutation(n).astype(np.int32)
                source, number = (np.array([getattr(passes[k], a) for k in own], np.int32).repeat(counts[own]) for a in ("source", "number"))
                yield batch(_DRAWS, np.full(len(kind), shard), slots, source, number, np.concatenate([x[0] for x in taken]), np.concatenate([x[1] for x in taken]))

    return spark.range(0, shards, 1, max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))).mapInArrow(run, _DRAWS_SQL)


_SIZED = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("key", pa.int64()), ("size", pa.int64())])
_PLACED = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("key", pa.int64()), ("size", pa.int64()), ("part", pa.int32()), ("row", pa.int64()), ("at", pa.int64())])


def _sizes(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        counts = [np.diff(word_starts(data, bounds)[2]) for _, data, bounds in text_chunks(b.column("text"))]
        if counts:
            yield batch(_SIZED, *(b.column(c) for c in ("doc_id", "source", "key")), np.concatenate(counts))


def _placed(batches: Iterator[pa.RecordBatch]):
    """Words of the same source before each row of a sorted partition, and a number of each row."""
    part = TaskContext.get().partitionId()
    row, before, last = part << 33, 0, None
    for b in batches:
        if not b.num_rows:
            continue
        codes = b.column("source").dictionary_encode(null_encoding="encode")
        index, size = codes.indices.to_numpy(), b.column("size").to_numpy()
        new = np.append(row == part << 33 or codes.dictionary[int(index[0])].as_py() != last, index[1:] != index[:-1])
        total = np.cumsum(size) - size + before
        first = np.flatnonzero(new)
        base = np.zeros(len(size), np.int64)
        base[first] = np.diff(total[first], prepend=0)
        at = total - np.cumsum(base)
        yield batch(_PLACED, *(b.column(c) for c in ("doc_id", "source", "key", "size")), np.full(len(size), part, np.int32), np.arange(row, row + len(size)), at)
        row, before, last = row + len(size), int(at[-1] + size[-1]), codes.dictionary[int(index[-1])].as_py()


@dataclass
class Mix:
    """documents: row, doc_id, key (hash of the text), source_number, size, start (words of its source before it), one row
    a document; sources: source_number, source, source_size, target; pieces: shard, slot, pass, row, doc_id, key,
    block_start (where in its block the piece lies), start (word of the document), words."""

    documents: DataFrame
    sources: DataFrame
    pieces: DataFrame
    n_sources: int


def mixture(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = 0) -> Mix:
    """The mix of documents (doc_id, source, text). Sizes and places are written once to the shared folder."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64(text).alias("key"), text.alias("text"))
    sized = written(rows.mapInArrow(tidy(_sizes), "doc_id long, source string, key long, size long"))
    order = [F.col("source").asc_nulls_last(), "doc_id", "key", "tie"]
    placed = written(sized.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_placed, "doc_id long, source string, key long, size long, part int, row long, at long"))

    sums = placed.groupBy("source", "part").agg(F.sum("size").alias("words"))
    found = sums.groupBy("source").agg(F.sum("words").alias("words")).orderBy(F.col("source").asc_nulls_last()).collect()
    sizes = [r["words"] for r in found]
    wanted = targets(sizes, weights, share, most).tolist()
    sources = spark.createDataFrame([(i, r["source"], r["words"], t) for i, (r, t) in enumerate(zip(found, wanted, strict=True))], "source_number int, source string, source_size long, target double")
    passes = []
    for i, (size, t) in enumerate(zip(sizes, wanted, strict=True)):
        left = round(t)
        while left > 0 and size:
            passes.append(Pass(i, len(passes), size, min(left, size), block_words, seed))
            left -= size

    few = F.broadcast if len(found) <= FEW else (lambda x: x)
    starts = sums.withColumn("before", F.sum("words").over(Window.partitionBy("source").orderBy("part")) - F.col("words"))
    starts = starts.join(few(sources.select("source_number", F.col("source").alias("name"))), F.col("source").eqNullSafe(F.col("name"))).select("source", "part", "before", "source_number")
    p, s = placed.alias("p"), starts.alias("s")
    documents = p.join(s, (F.col("p.part") == F.col("s.part")) & F.col("p.source").eqNullSafe(F.col("s.source")))
    documents = written(documents.select("row", "doc_id", "key", "source_number", "size", (F.col("at") + F.col("before")).alias("start")))
    drop_written(sized, placed)

    last = F.expr(f"(start + size - 1) div {block_words}")
    cut = documents.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), last)))
    draws = block_draws(spark, passes, shard_blocks, seed).hint("merge")  # they grow with the input, which Spark cannot see
    cut = cut.join(draws, ["source_number", "block"])
    begin, end = F.greatest(F.col("start"), F.col("block") * block_words), F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("words"))
    pieces = cut.where(end > begin).select("shard", "slot", "pass", "row", "doc_id", "key", (begin - F.col("block") * block_words).cast("int").alias("block_start"), (begin - F.col("start")).alias("start"), (end - begin).alias("words"))
    return Mix(documents, sources, pieces, len(found))


def mixed_documents(mix: Mix) -> DataFrame:
    """doc_id, size, source, source_size, target, taken (words that the mix takes, repeats counted) of each document."""
    none = F.lit(0).cast("long")
    rows = mix.documents.select("row", "doc_id", "source_number", "size", none.alias("words"))
    rows = rows.unionByName(mix.pieces.select("row", "words"), allowMissingColumns=True)
    taken = rows.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("source_number").alias("source_number"), F.max("size").alias("size"), F.sum("words").alias("taken"))
    sources = F.broadcast(mix.sources) if mix.n_sources <= FEW else mix.sources
    return taken.join(sources, "source_number").select("doc_id", "size", "source", "source_size", "target", "taken")


def mixed_blocks(docs: DataFrame, mix: Mix) -> DataFrame:
    """shard, slot, text: the blocks of every shard in their shuffled order, words joined by a space. docs as in mixture()."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("id_"), F.xxhash64(text).alias("key_"), text.alias("text_")).dropDuplicates(["id_", "key_"])
    found = mix.pieces.join(texts, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("key") == F.col("key_")))
    words = F.filter(F.split("text_", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    found = found.select("shard", "slot", "block_start", F.array_join(F.slice(words, (F.col("start") + 1).cast("int"), F.col("words").cast("int")), " ").alias("text_"))
    parts = F.array_sort(F.collect_list(F.struct("block_start", "text_")))
    return found.groupBy("shard", "slot").agg(F.array_join(F.transform(parts, lambda x: x["text_"]), " ").alias("text"))
