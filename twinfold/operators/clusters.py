"""Clusters: components of the similarity graph, their statistics, and what an adjudicator gets of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.functions import vocabulary as V
from twinfold.functions.text import present
from twinfold.operators import embedding, idf, knn
from twinfold.operators.components import connected_components, split_join
from twinfold.operators.numbering import placed
from twinfold.sources.shared import written

#: Names that stand for a cluster in the log.
SAMPLE = 3

#: Declared order of a person's fields in a payload.
FIELDS = ["iri", "name", "github_username", "email", "url", "orcid", "infoscience_id", *V.LISTS, "bio", "location", "company", "properties"]


def clusters(edges: DataFrame) -> DataFrame:
    """cluster_id (the smallest member), members (ascending); no edge, no cluster."""
    found = connected_components(edges)
    return found.groupBy(F.col("component").alias("cluster_id")).agg(F.array_sort(F.collect_list("node")).alias("members"))


def cluster_persons(persons: DataFrame, provider: embedding.EmbeddingProvider, model: str, fields: list[str], cache_path: str, k: int = 20, threshold: float = 0.99, penalty: float = 0.02, batch_size: int = 64, concurrency: int = 6, say: Callable[[str], None] | None = None) -> DataFrame:
    """cluster_id (the smallest IRI), iri of persons whose embeddings are near: embed, weigh names, link, find components.
    Persons are numbered in the order of their IRIs, so a component's smallest number is its smallest IRI's."""
    held = embedding.embed(persons.select("iri", *{"name", *fields} - {"iri"}), provider, model, fields, cache_path, batch_size, concurrency, say)
    held = idf.with_idf(held) if penalty else held
    ids = written(placed(held.select("iri", "vector", *(["idf"] if penalty else [])), "iri").withColumnRenamed("place", "id"))
    found = written(connected_components(knn.edges(ids, k, threshold, penalty)).join(ids.select(F.col("id").alias("node"), "iri"), "node"))
    names = found.groupBy("component").agg(F.count(F.lit(1)).alias("n")).join(ids.select(F.col("id").alias("component"), F.col("iri").alias("cluster_id")), "component")
    return split_join(found, names, "component", "n", "node").select("cluster_id", "iri")


def statistics(sizes: DataFrame, total: int) -> DataFrame:
    """One row: clusters, clustered and single persons, smallest, largest and mean size. sizes: size of each cluster."""
    out = sizes.agg(F.count(F.lit(1)).alias("n_clusters"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("clustered"), F.min("size").alias("min_size"), F.max("size").alias("max_size"), F.avg("size").alias("mean_size"))
    return out.withColumn("singletons", F.lit(total).cast("long") - F.col("clustered"))


def histogram(sizes: DataFrame) -> DataFrame:
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n_clusters")).orderBy(F.desc("size"))


def status(size: Column, cap: int = 25) -> Column:
    """Clusters over the cap are never judged."""
    return F.when(size > cap, F.lit("skipped_oversized")).otherwise(F.lit("to_judge"))


def described(persons: DataFrame) -> DataFrame:
    """iri, name, json (the person as a JSON object, empty fields left out, in declared order) of each person."""
    missing = [F.when(F.size(c) > 0, F.col(c)).alias(c) if c in (*V.LISTS, "properties") else present(c).alias(c) for c in FIELDS]
    return persons.select("iri", "name", F.to_json(F.struct(*missing)).alias("json"))


def gathered(found: DataFrame, people: DataFrame, cap: int = 25) -> DataFrame:
    """cluster_id, size, names (a sample of three), iris and payload (a JSON array of persons in the order of their IRIs;
    both null above the cap) of each cluster. found: cluster_id, iri; people: as described() gives them.

    Sizes are counted first. Of a cluster, the first `cap` members alone are ever brought together: a window's group
    limit drops the others where they lie, so a cluster of millions costs its count."""
    sizes = found.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    nth = F.row_number().over(Window.partitionBy("cluster_id").orderBy("iri"))
    first = found.select("cluster_id", "iri").withColumn("nth", nth).where(F.col("nth") <= max(cap, SAMPLE))
    rows = first.join(sizes, "cluster_id").where((F.col("size") <= cap) | (F.col("nth") <= SAMPLE)).join(people.select("iri", "name", "json"), "iri")
    out = rows.groupBy("cluster_id", "size").agg(F.array_sort(F.collect_list(F.struct("iri", "name", "json"))).alias("people"))
    names = F.transform(F.slice("people", 1, SAMPLE), lambda p: p["name"].cast("string")).alias("names")
    judged = F.col("size") <= cap
    payload = F.concat(F.lit("["), F.array_join(F.transform("people", lambda p: p["json"]), ","), F.lit("]"))
    return out.select("cluster_id", "size", names, F.when(judged, F.transform("people", lambda p: p["iri"].cast("string"))).alias("iris"), F.when(judged, payload).alias("payload"))


def sample_names(names: Column) -> Column:
    """The first three names, for the log."""
    return F.array_join(F.slice(names, 1, SAMPLE), ", ")
