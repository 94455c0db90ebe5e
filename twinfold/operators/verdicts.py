"""Verdicts on clusters by a pluggable adjudicator, and what of them is accepted."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from typing import Protocol

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.operators.calls import Tenths, answer
from twinfold.operators.numbering import placed
from twinfold.sources.caches import exists
from twinfold.sources.http import post_json
from twinfold.sources.shared import shared_folder, written

POLICY = """Decide whether these person records of an open-source knowledge graph are one real person with several identities.
For: one username is a variant of the other; a repository both contributed to; the same name, hashed e-mail, social handle, blog or ORCID; a later account with hardly any activity.
Not against: another avatar, creation date, number of followers or repositories, or contributions elsewhere.
Answer with one JSON object: entities (every IRI given), is_duplicate, certainty from 0 to 1 in your verdict either way, reason in one or two sentences."""


@dataclass
class Verdict:
    entities: list[str]
    is_duplicate: bool
    certainty: float
    reason: str

    def __post_init__(self):
        if not 0.0 <= self.certainty <= 1.0:
            raise ValueError(f"certainty {self.certainty} is not within 0 and 1")


class Adjudicator(Protocol):
    def judge(self, payload: str) -> Verdict: ...


class SharedSignals:
    """An adjudicator without a model: counts signals that the persons of a cluster share. Deterministic."""

    def judge(self, payload: str) -> Verdict:
        people = json.loads(payload)
        shared = [f for f in ("name", "email", "orcid", "github_username", "url") if len(people) > 1 and len({p.get(f) for p in people}) == 1 and people[0].get(f)]
        held = [{*p.get("has_contribution", []), *p.get("owns", [])} for p in people]
        if held and set.intersection(*held):
            shared.append("repository")
        return Verdict([p["iri"] for p in people], bool(shared), min(1.0, 0.5 + 0.2 * len(shared)), f"shared: {', '.join(shared) or 'nothing'}")


@dataclass
class ChatAdjudicator:
    """A chat completion service that answers with the JSON object of POLICY; retried as embeddings are."""

    url: str
    key: str
    model: str
    attempts: int = 6
    timeout: float = 180.0

    def judge(self, payload: str) -> Verdict:
        body = {"model": self.model, "messages": [{"role": "system", "content": POLICY}, {"role": "user", "content": payload}], "response_format": {"type": "json_object"}}
        answer = post_json(self.url, self.key, body, self.attempts, self.timeout)
        said = json.loads(answer["choices"][0]["message"]["content"])
        return Verdict(list(said["entities"]), bool(said["is_duplicate"]), float(said["certainty"]), str(said["reason"]))


VERDICT = "cluster_id string, status string, entities array<string>, is_duplicate boolean, certainty double, reason string, prompt string, error string, size long, names array<string>"
_EMPTY = {"entities": None, "is_duplicate": None, "certainty": None, "reason": None, "error": None}


def asking(adjudicator: Adjudicator) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For mapInPandas over clusters to judge: a row of VERDICT each."""
    columns = [c.split()[0] for c in VERDICT.split(", ")]

    def run(frames: Iterator[pd.DataFrame]):
        for f in frames:
            for c, payload, size, names in zip(f["cluster_id"], f["payload"], f["size"], f["names"], strict=True):
                row = {"cluster_id": c, "prompt": payload, "size": size, "names": names} | _EMPTY
                try:
                    row |= {"status": "judged"} | asdict(adjudicator.judge(payload))
                except Exception as e:  # noqa: BLE001  one cluster's failure is its own
                    row |= {"status": "failed", "error": f"{type(e).__name__}: {e}"}
                yield pd.DataFrame([row], columns=columns)

    return run


def judge(clusters: DataFrame, adjudicator: Adjudicator, path: str | None = None, parallel: int = 6, say: Callable[[str], None] | None = None, profile: ResourceProfile | None = None) -> DataFrame:
    """A row for each cluster: judged, failed (with the error; the others go on) or skipped_oversized (no payload).
    clusters: cluster_id, size, names, payload. At most `parallel` are judged at a time; verdicts are appended to the
    table at path (a new one if None) in small committed waves, and clusters that it holds are not asked about again."""
    spark = clusters.sparkSession
    path = path or f"{shared_folder(spark)}/twinfold-verdicts-{uuid.uuid4().hex}"
    clusters = written(clusters.select(F.col("cluster_id").cast("string").alias("cluster_id"), F.col("size").cast("long").alias("size"), "names", "payload"))
    asked = clusters.where("payload is not null")
    if exists(spark, path):
        asked = asked.join(spark.read.schema(VERDICT).parquet(path).select("cluster_id", F.col("prompt").alias("payload")), ["cluster_id", "payload"], "left_anti")
    asked = written(placed(asked, "cluster_id").withColumnRenamed("place", "number"))
    n = asked.count()
    answer(asked, n, asking(adjudicator), VERDICT, path, parallel, progress=Tenths("judged clusters", n, say), profile=profile)
    said = spark.read.schema(VERDICT).parquet(path) if exists(spark, path) else spark.createDataFrame([], VERDICT)
    said = said.join(clusters.select("cluster_id", F.col("payload").alias("prompt")), ["cluster_id", "prompt"], "left_semi").dropDuplicates(["cluster_id"])
    skipped = clusters.where("payload is null").select("cluster_id", F.lit("skipped_oversized").alias("status"), "size", "names")
    return said.unionByName(skipped, allowMissingColumns=True)


def notices(verdicts: DataFrame) -> DataFrame:
    """line: a note on each cluster that was skipped or failed, by a sample of its persons' names."""
    sample = F.array_join("names", ", ")
    skipped = F.format_string("skipped a cluster of %d persons, more than may be judged (%s)", "size", sample)
    failed = F.format_string("no verdict on a cluster of %d persons (%s): %s", "size", sample, "error")
    return verdicts.where("status <> 'judged'").select(F.when(F.col("status") == "failed", failed).otherwise(skipped).alias("line"))


def counters(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(F.count_if(F.col("status") == "judged").alias("judged"), F.count_if(F.col("status") == "skipped_oversized").alias("skipped_oversized"), F.count_if(F.col("status") == "failed").alias("failed"))


def _entities(verdicts: DataFrame) -> DataFrame:
    return verdicts.where("is_duplicate").select("cluster_id", "certainty", "reason", F.explode(F.array_distinct("entities")).alias("iri"))


def accepted(verdicts: DataFrame, known: DataFrame) -> DataFrame:
    """entities, confidence, reason, method of positive verdicts with two known entities at least; unknown ones go."""
    named = _entities(verdicts).join(known.select("iri").distinct(), "iri", "left_semi")
    out = named.groupBy("cluster_id", "certainty", "reason").agg(F.array_sort(F.collect_list("iri")).alias("entities")).where(F.size("entities") >= 2)
    return out.select("entities", F.col("certainty").alias("confidence"), "reason", F.lit("llm").alias("method"))


def unknown(verdicts: DataFrame, known: DataFrame) -> DataFrame:
    """cluster_id, iri of entities that no person has."""
    return _entities(verdicts).join(known.select("iri").distinct(), "iri", "left_anti").select("cluster_id", "iri")
