"""Benchmark decontamination by a broadcast set of normalised n-grams, on built-in functions alone.

1. The hashes of all n-gram windows of the benchmark are a set (broadcast while small, else joined by a shuffle with
   the set repeated SALT times, so that no frequent window is one task's). Every token window of every document is
   looked up; a segment of a document with a hit is a candidate.
2. Candidates' windows are compared word for word with the benchmark's: the verified hits.
3. Hit words and items are counted per document; nothing is counted for a pair of a document and a window twice.

Documents are read in segments of SEGMENT words that overlap by a window, so that no row holds the windows of a long
text. Words: A-Z lower-cased, and no other letter, then `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. An item of fewer than n
words is one window, one without words none. Cases: null and empty texts have no words and are clean; repeated documents
or items count as themselves; a row with a null doc_id is told from others by its text; with an empty benchmark nothing
is hit; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import documents, drop_written, row_key, written
from twinfold.llm.native import let, upto

#: Most distinct windows (and candidate segments) of which a set is broadcast, and most bytes of their words.
BROADCAST_WINDOWS = 200_000
BROADCAST_TEXT = 64_000_000
#: Words of a document in one row.
SEGMENT = 4096
#: How often a set that is not broadcast is repeated.
SALT = 32
SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPLIT), "")


def exact_words(text: Column) -> Column:
    return words(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def window_set(benchmark: DataFrame, n: int = 13) -> DataFrame:
    """item_id, size, window (the words joined by spaces) of each distinct window of each item."""
    found = benchmark.select(F.col("item_id").cast("string").alias("item_id"), exact_words(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("w"))
    size = F.least(F.size("w"), F.lit(n))
    found = found.where(F.size("w") > 0).select("item_id", size.alias("size"), F.explode(F.transform(upto(F.size("w") - size + 1), lambda i: F.array_join(F.slice(F.col("w"), i, F.least(F.size("w"), F.lit(n))), " "))).alias("window"))
    return found.distinct()


def segments(words: Column, n: int) -> Column:
    """An array of (segment, w): SEGMENT entries each, and the n - 1 after them."""

    def cut(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / SEGMENT).cast("int")), lambda s: F.struct(s.alias("segment"), F.slice(w, s * SEGMENT + 1, SEGMENT + n - 1).alias("w")))

    return let(words, lambda w: F.when(F.size(w) > 0, cut(w)))


def _places(w: Column, size: int) -> Column:
    """Where in a segment windows of so many words begin."""
    return upto(F.least(F.size(w) - size + 1, F.lit(SEGMENT)))


def _hashes(h: Column, size: int) -> Column:
    return F.transform(_places(h, size), lambda i: F.xxhash64(F.slice(h, i, size)))


def _windows(w: Column, size: int) -> Column:
    return F.transform(_places(w, size), lambda i: F.struct(i.alias("at"), F.lit(size).alias("size"), F.array_join(F.slice(w, i, size), " ").alias("window")))


def _join(rows: DataFrame, known: DataFrame, keys: list[str], small: bool, how: str = "inner") -> DataFrame:
    """With a broadcast set, or dealt out so that rows of one frequent key go to SALT tasks."""
    if small:
        return rows.join(F.broadcast(known), keys, how)
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALT)).cast("int")).join(known, [*keys, "salt"], how).drop("salt")


def hits(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """key, place (from 1), size, item_ids of every window of a document that is also a window of the benchmark."""
    docs = documents(docs).select(row_key().alias("key"), "text")
    items = written(window_set(benchmark, n).groupBy("size", "window").agg(F.collect_set("item_id").alias("item_ids")))
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # n numbers at most
    if not sizes:
        return docs.select("key", F.lit(0).alias("place"), F.lit(0).alias("size"), F.array().cast("array<string>").alias("item_ids")).where("false")
    n_windows, n_bytes = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("window") + 24 * F.size("item_ids"))).first()
    few = n_windows <= BROADCAST_WINDOWS

    known = items.select(F.xxhash64(F.transform(F.split("window", " "), lambda x: F.xxhash64(x))).alias("hash")).distinct()
    hashed = docs.select("key", F.explode(segments(F.transform(exact_words(F.col("text")), lambda x: F.xxhash64(x)), n)).alias("s")).select("key", "s.segment", F.col("s.w").alias("h"))
    hashed = hashed.select("key", "segment", F.explode(F.flatten(F.array(*(_hashes(F.col("h"), k) for k in sizes)))).alias("hash"))
    near = written(_join(hashed, known, ["hash"], few, "left_semi").select("key", "segment").distinct())

    few_near = near.count() <= BROADCAST_WINDOWS
    near_docs = docs.join(F.broadcast(near.select("key").distinct()) if few_near else near.select("key").distinct(), "key", "left_semi")
    held = near_docs.select("key", F.explode(segments(exact_words(F.col("text")), n)).alias("s")).select("key", "s.segment", "s.w")
    held = held.join(F.broadcast(near) if few_near else near, ["key", "segment"], "left_semi")
    exact = held.select("key", "segment", F.explode(F.flatten(F.array(*(_windows(F.col("w"), k) for k in sizes)))).alias("x")).select("key", (F.col("segment") * SEGMENT + F.col("x.at")).alias("place"), "x.size", "x.window")
    out = written(_join(exact, items, ["size", "window"], few and n_bytes <= BROADCAST_TEXT).select("key", "place", "size", "item_ids"))
    drop_written(near, items)
    return out


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (a hit, and share * n_hit >= n_words), one row for
    each row of docs."""
    return _scan(docs, benchmark, n, share).drop("key")


def _scan(docs: DataFrame, benchmark: DataFrame, n: int, share: int) -> DataFrame:
    found = hits(docs, benchmark, n)
    covered = found.select("key", F.explode(F.expr("sequence(place, place + size - 1)")).alias("word")).groupBy("key").agg(F.countDistinct("word").alias("n_hit"))
    items = found.select("key", F.explode("item_ids").alias("item_id")).groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    n_words = F.size(words(F.col("text"))).cast("long")  # regexp_count() copies the text for each match
    none = F.array().cast("array<string>")
    out = documents(docs).select("doc_id", row_key().alias("key"), n_words.alias("n_words")).join(covered, "key", "left").join(items, "key", "left")
    out = out.select("key", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"))
    return out.select("key", "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    dirty = _scan(docs, benchmark, n, share).where("contaminated").select(F.col("key").alias("_dirty_key")).distinct()
    return docs.join(dirty, row_key() == F.col("_dirty_key"), "left_anti")
