"""Embedding persons through a content-addressed cache: equal texts of one model are embedded once, ever.

The service sits behind a provider: an object with embed(texts) -> vectors. New vectors are appended to the cache table
in small committed waves (operators/calls.py), and downstream plans read the table, so a retried plan never pays twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.functions.text import cache_key, embed_text
from twinfold.operators.calls import Tenths, answer
from twinfold.operators.numbering import placed
from twinfold.sources.caches import EMBEDDING, EmbeddingCache
from twinfold.sources.http import post_json
from twinfold.sources.shared import written


class EmbeddingProvider(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


def keyed(persons: DataFrame, model: str, fields: list[str]) -> DataFrame:
    """persons with text and key."""
    return persons.withColumn("text", embed_text(*fields)).withColumn("key", cache_key(model, F.col("text")))


def hits(keys: DataFrame, cache: DataFrame) -> DataFrame:
    return keys.join(cache.select("key", "vector"), "key")


def misses(keys: DataFrame, cache: DataFrame) -> DataFrame:
    """key, text of what the cache lacks, once each."""
    return keys.select("key", "text").join(cache.select("key"), "key", "left_anti").dropDuplicates(["key"])


def requests(missing: DataFrame, batch_size: int = 64) -> tuple[DataFrame, int]:
    """number, items (key, text) of requests of batch_size texts each, the last one of fewer; and how many. Written in
    the order of number."""
    rows = placed(missing.select("key", "text"), "key").withColumn("number", F.expr(f"place div {batch_size}"))
    held = rows.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("key", "text"))).alias("items"))
    held = written(held.repartitionByRange("number").sortWithinPartitions("number"))
    return held, held.count()


def fetched(provider: EmbeddingProvider) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For mapInPandas over requests: key, vector of each text."""

    def run(frames: Iterator[pd.DataFrame]):
        for f in frames:
            for items in f["items"]:
                vectors = provider.embed([x["text"] for x in items])
                if len(vectors) != len(items):
                    raise ValueError(f"asked for {len(items)} vectors, got {len(vectors)}")
                yield pd.DataFrame({"key": [x["key"] for x in items], "vector": vectors})

    return run


def embed(persons: DataFrame, provider: EmbeddingProvider, model: str, fields: list[str], cache_path: str, batch_size: int = 64, concurrency: int = 6, say: Callable[[str], None] | None = None, profile: ResourceProfile | None = None) -> DataFrame:
    """persons with key and vector; what the cache lacks is fetched and appended first, at most `concurrency` requests at
    a time. Each tenth of the requests is said."""
    cache = EmbeddingCache(persons.sparkSession, cache_path)
    cache.compact()
    keys = keyed(persons, model, fields)
    asked, n = requests(cache.missing(keys.select("key", "text")).dropDuplicates(["key"]), batch_size)
    answer(asked, n, fetched(provider), EMBEDDING, cache.appended, concurrency, progress=Tenths("embedded batches", n, say), profile=profile)
    return cache.vectors(keys.drop("text"))


@dataclass
class HttpEmbeddings:
    """A service that takes {model, input} and returns {data: [{index, embedding}]}."""

    url: str
    key: str
    model: str
    attempts: int = 6
    timeout: float = 180.0
    sleep: Callable[[float], None] = time.sleep

    def embed(self, texts: list[str]) -> list[list[float]]:
        answer = post_json(self.url, self.key, {"model": self.model, "input": texts}, self.attempts, self.timeout, self.sleep)
        rows = sorted(answer["data"], key=lambda r: r["index"])
        if len(rows) != len(texts):
            raise ValueError(f"asked for {len(texts)} vectors, got {len(rows)}")
        return [r["embedding"] for r in rows]
