"""What the operators share: the shared folder for written tables, document columns, and vectorised word hashing.

Columns: an operator reads `doc_id` and `text` (others where it says so) and ignores all other columns, whatever
their names. A null text counts as an empty one unless an operator says otherwise; rows with a null doc_id are kept.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a kernel holds in numpy arrays at once (a single longer document is held whole).
CHUNK_BYTES = 2_000_000

#: Bytes of an Arrow batch between the JVM and Python (a single larger row is a batch).
BATCH_BYTES = 8_000_000

#: Bytes of a partition whose worker keeps its memory.
SMALL_BYTES = 1_000_000

#: Largest filter of hashes that is broadcast, as a power of 2 of bits (32 MB). A fuller one only lets more through.
FILTER_BITS = 28

#: Rows of one key that a join deals out whole, and the most keys that are split, 20 bytes each.
HOT_ROWS = 100_000
HOT_KEYS = 200_000

_local: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder in spark.checkpoint.dir. Only a local session may lack one, as in tests: it gets a temporary one."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="twinfold-"))
        atexit.register(shutil.rmtree, _local[0], True)
    return f"file://{_local[0]}"


def written(df: DataFrame) -> DataFrame:
    """The rows of df, written as Parquet to the shared folder and read again: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/twinfold-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._twinfold_path = path
    return out


def drop_written(*frames: DataFrame) -> None:
    """Delete tables of written() that no later step reads."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._twinfold_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def documents(df: DataFrame) -> DataFrame:
    """doc_id and text alone; a null text becomes empty. Bounds the session's Arrow batches to BATCH_BYTES."""
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def row_key(text: str = "text") -> Column:
    """What tells a document from others in joins: its doc_id or, where that is null, its text."""
    return F.coalesce(F.col("doc_id").cast("string"), F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))


def join_split(rows: DataFrame, known: DataFrame, key: str, n: str, by: str, most: int | None = None) -> DataFrame:
    """rows joined with known on key, where known's column n says how many rows have the key (it is dropped).

    A key of more than `most` rows is split: its rows go by a hash of the column `by` to as many parts, and its entry
    in known is repeated for each. Which keys these are is broadcast: no more than HOT_KEYS, else `most` grows.
    """
    most = most or HOT_ROWS
    while (n_hot := (hot := known.where(F.col(n) > most).select(key, F.ceil(F.col(n) / most).cast("int").alias("_parts")).distinct()).count()) > HOT_KEYS:
        most *= 4
    if not n_hot:
        return rows.join(known.drop(n), key)
    rows = rows.join(F.broadcast(hot), key, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    known = known.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col(n) / most).cast("int"), F.lit(1)) - 1)))
    return rows.join(known.drop(n), [key, "_part"]).drop("_part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function for mapInArrow; a worker gives memory back when its partition is done, as it lives on. That takes
    some 50 ms, which a partition of less than SMALL_BYTES is not worth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0

        def counted() -> Iterator[pa.RecordBatch]:
            nonlocal seen
            for b in batches:
                seen += b.nbytes
                yield b

        yield from function(counted())
        if seen < SMALL_BYTES:
            return
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # there is no such function outside glibc
            ctypes.CDLL(None).malloc_trim(0)

    return run


def batch(schema: str | pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes of a piece


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def combine(columns: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash of each row of equally long columns of hashes; order counts."""
    out = np.full(len(columns[0]), 0x51ED270B, np.uint64)
    for c in columns:
        out = mix(out * _M3 + c)
    return out


def word_starts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes are in words `[^\\x20\\x09-\\x0D]+`, where words start, and n + 1 offsets into these, of documents that
    lie one after the other (bounds: n + 1 byte offsets)."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = bounds[bounds < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    return inside, starts, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, bounds: np.ndarray, lower: bool = False, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words `[^\\x20\\x09-\\x0D]+` of documents that lie one after the other in UTF-8 bytes.

    bounds: n + 1 byte offsets. Returns the hashes and n + 1 offsets into them, a document's words in order. A word is
    read in pieces of eight bytes; each is scrambled before it is chained to those before it, so that words of few
    letters in other orders do not meet. Other lanes give hashes of their own. Words of up to eight bytes and one length
    never collide.
    """
    if lower:
        data = _LOWER[data]
    inside, starts, offsets = word_starts(data, bounds)
    if not len(starts):
        return np.zeros(0, np.uint64), offsets
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = bounds[(bounds > 0) & (bounds < len(data))] - 1
    last[ends] = inside[ends]
    lengths = np.flatnonzero(last) + 1 - starts
    pieces = np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    seed = mix(np.full(1, lane, np.uint64) + _M3)[0]
    out = mix(mix((pieces[starts] & _KEEP[np.minimum(lengths, 8)]) ^ seed) + lengths.astype(np.uint64) * _M2)
    at, longer = 8, np.flatnonzero(lengths > 8)
    while len(longer):
        piece = pieces[starts[longer] + at] & _KEEP[np.minimum(lengths[longer] - at, 8)]
        out[longer] = mix(out[longer] * _M3 + mix(piece ^ seed))
        at += 8
        longer = longer[lengths[longer] > at]
    return out, offsets


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of an Arrow column as (first row, bytes, offsets), about CHUNK_BYTES at a time; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def hashed_texts(column: pa.Array, lower: bool = False, lane: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, word offsets) of each chunk of texts."""
    for row, data, bounds in text_chunks(column):
        yield row, *word_hashes(data, bounds, lower, lane)


def span_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all `width` consecutive entries of h, by doubling: as many steps as the width has binary digits."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    out, done, power, size = None, 0, h, 1
    while True:
        if width & size:
            if out is None:
                out = power
            else:
                n = min(len(out), len(power) - done)
                out = mix(out[:n] * _M3 + power[done : done + n])
            done += size
        if done == width:
            return out[: len(h) - width + 1]
        n = len(power) - size
        power = mix(power[:n] * _M1 + power[size:] + _M3)
        size *= 2


class HashFilter:
    """Whether a 64-bit hash may be in a column of a table: never a false no. Its bits are made where the table lies;
    the broadcast has 32 to 64 bits for each row, and 2 ** FILTER_BITS at most. It goes by the hashes' low bits, as the
    operators choose hashes by their high ones."""

    def __init__(self, table: DataFrame, column: str):
        self.log = min(FILTER_BITS, max(16, int(32 * table.count()).bit_length()))
        bit = F.col(column).bitwiseAND(F.lit((1 << self.log) - 1).cast("long"))
        rows = table.select(bit.alias("bit")).groupBy(F.shiftright("bit", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(32767)).alias("bits")).collect()
        found = np.zeros((1 << self.log) // 8, np.uint8)
        for r in rows:
            found[r["part"] * 4096 : r["part"] * 4096 + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)[: len(found)]
        self.sent = table.sparkSession.sparkContext.broadcast(found)

    def reader(self) -> Callable[[np.ndarray], np.ndarray]:
        sent, mask = self.sent, np.uint64((1 << self.log) - 1)

        def may_hold(hashes: np.ndarray) -> np.ndarray:
            bit = (hashes & mask).astype(np.int64)
            return (sent.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1

        return may_hold
