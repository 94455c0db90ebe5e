"""Token ids of a corpus as binary files of patched frame-of-reference blocks, in ascending doc_id order.

Documents are dealt out by ranges of doc_id, so each task encodes and writes its own files and no task holds more than
one file's ids (or one document's). Files are written under another name and then renamed; a task that runs again
writes the same file. Cases: a null or empty text has the end id alone; repeated rows are written each; an empty table
gives no file; other columns are ignored. doc_id must not be null (null ids are written as the smallest number).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinfold.llm import frame_blocks
from twinfold.llm.common import batch, documents, shared_folder, tidy, written
from twinfold.llm.tokens import encoder

#: Ids of a file, unless one document has more.
FILE_IDS = 4_000_000
#: Tasks whose files are numbered together.
STRIDE = 1000
_LEAST = -(2**63)


def _store(url: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(url)


def _writer(folder: str, path: str, end_id: int, file_ids: int):
    schema = pa.schema([("file", pa.string()), ("part", pa.int64()), ("seq", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]):
        store, base = _store(folder)
        ids_of, task = encoder(path).encode, TaskContext.get()
        part, doc_ids, texts, size, seq = task.partitionId(), [], [], 0, 0

        def flush():
            nonlocal doc_ids, texts, size, seq
            ids = np.frombuffer(b"".join(texts), "<u4")
            name = f"part-{part:06d}-{seq:06d}.pfb"
            draft = f"{base}/.{name}-{task.taskAttemptId()}"
            with store.open_output_stream(draft) as f:
                f.write(frame_blocks.encode(doc_ids, [len(t) // 4 for t in texts], ids))
            if store.get_file_info(f"{base}/{name}").is_file:  # of an attempt that was lost; not every store overwrites
                store.delete_file(f"{base}/{name}")
            store.move(draft, f"{base}/{name}")
            out = batch(schema, [name], [part], [seq], [len(doc_ids)], [len(ids)])
            doc_ids, texts, size, seq = [], [], 0, seq + 1
            return out

        for b in batches:
            for doc_id, text in zip(b.column("doc_id"), b.column("text"), strict=True):
                ids = ids_of(text.as_py()) + end
                if size and size + len(ids) > 4 * file_ids:
                    yield flush()
                doc_ids.append(_LEAST if doc_id.as_py() is None else doc_id.as_py())
                texts.append(ids)
                size += len(ids)
        if texts:
            yield flush()

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the files; returns one row for each: file, n_docs, n_ids, start (ids of all files before it).

    Starts are sums over files of a task, tasks of a STRIDE, and strides; no row of a file reaches the driver."""
    store, base = _store(folder)
    store.create_dir(base, recursive=True)
    ordered = documents(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = "file string, part long, seq long, n_docs long, n_ids long"
    files = written(ordered.mapInArrow(tidy(_writer(folder, tokenizer_path, end_id, file_ids)), schema))

    def before(within: list[str], by: str) -> Column:
        return F.sum("n_ids").over(Window.partitionBy(*within).orderBy(by)) - F.col("n_ids")

    stride = F.floor(F.col("part") / STRIDE).alias("stride")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", stride, "n_ids")
    strides = parts.groupBy("stride").agg(F.sum("n_ids").alias("n_ids")).select("stride", before([], "stride").alias("a"))
    parts = parts.select("part", "stride", before(["stride"], "part").alias("b")).join(strides, "stride")
    starts = files.select("file", "part", "n_docs", "n_ids", before(["part"], "seq").alias("c")).join(parts, "part")
    return written(starts.select("file", "n_docs", "n_ids", (F.col("a") + F.col("b") + F.col("c")).alias("start")))


def _read(batches: Iterator[pa.RecordBatch]):
    schema = pa.schema([("file", pa.string()), ("doc_id", pa.int64()), ("within", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for b in batches:
        for path, content in zip(b.column("path"), b.column("content"), strict=True):
            reader = frame_blocks.Reader(content.as_buffer().to_pybytes())
            data = memoryview(reader.all().astype("<u4")).cast("B")
            ends = np.cumsum(reader.lengths.astype(np.int64))
            starts = ends - reader.lengths
            sums = [zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield batch(schema, [path.as_py().rpartition("/")[2]] * len(sums), reader.doc_ids, starts, reader.lengths.astype(np.int64), sums)


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, file: read back from the files."""
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, file string")
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfb").load(folder).select("path", "content")
    rows = rows.mapInArrow(tidy(_read), "file string, doc_id long, within long, n_tokens long, ids_crc32 long")
    return rows.join(files.select("file", "start"), "file").select("doc_id", (F.col("start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "file")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write the ids of all documents to files in a folder that all executors share, and what a reader finds there."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/twinfold-ids-{uuid.uuid4().hex}"
    return read_token_files(spark, folder, write_token_files(docs, folder, tokenizer_path, end_id))
