"""The batch run: persons, rules, clusters, verdicts, groups, export.

A step that calls a service is followed by a write, and what comes after reads what was written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.functions.text import utc_iso
from twinfold.operators import clusters, groups, persons, rules, verdicts
from twinfold.operators.embedding import EmbeddingProvider
from twinfold.plans.config import Config
from twinfold.sources import caches
from twinfold.sources.shared import written


def run(spark: SparkSession, config: Config, triples: Callable[[], DataFrame], embeddings: EmbeddingProvider, adjudicator: verdicts.Adjudicator, export: Callable[[DataFrame], None], say: Callable[[str], None] = print) -> dict:
    """Returns groups_found, rule_based_groups, llm_groups, entities_covered, dedup_graph.

    triples() gives the table (s, pos, p, o); export(lines) writes N-Triples to the graph. Nothing is merged in the
    source. A run that is repeated under its config's run_id replaces its logs.
    """
    run_id = config.run_id or uuid.uuid4().hex
    people = caches.persons_from(spark, config.persons_cache_path, lambda: persons.persons(triples()), config.use_persons_cache)
    matches = written(rules.resolve(people))
    by_rule = groups.rule_groups(matches)
    groups.log_json(groups.audit_rows(by_rule), config.audit_log_path, run_id, "rules")

    pool = written(rules.remaining(people, matches))
    found = written(clusters.cluster_persons(pool, embeddings, config.embedding_model, list(config.embed_fields), config.embedding_cache_path, config.cluster_k, config.cluster_threshold, config.cluster_name_similarity_penalty, config.embed_batch_size, config.embed_concurrency, say))
    sizes = found.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    say(f"clusters: {clusters.statistics(sizes, pool.count()).first().asDict()}")

    gathered = clusters.gathered(found, clusters.described(pool), config.agent_max_cluster_size)
    said = written(verdicts.judge(gathered, adjudicator, parallel=config.embed_concurrency, say=say))
    for row in verdicts.notices(said).toLocalIterator():
        say(row["line"])
    log = said.where("status = 'judged'").select(utc_iso(F.current_timestamp()).alias("timestamp"), "prompt", F.struct("entities", "is_duplicate", "certainty", "reason").alias("response"))
    groups.log_json(log, config.llm_log_path, run_id, "verdicts")
    say(f"verdicts: {verdicts.counters(said).first().asDict()}")
    by_verdict = written(verdicts.accepted(said, people))
    groups.log_json(groups.audit_rows(by_verdict), config.audit_log_path, run_id, "verdicts")

    every = written(groups.identified(groups.all_groups(by_rule, by_verdict), config.dedup_graph))
    result = groups.summary(every, config.dedup_graph).first().asDict()
    say(f"{result['groups_found']} duplicate groups, sorted by method then confidence (highest first):")
    for row in groups.ranked(every).select(groups.report_line().alias("line")).toLocalIterator():
        say(row["line"])

    moment = spark.sql("SELECT current_timestamp() AS t").select(utc_iso(F.col("t")).alias("t")).first()["t"]
    export(groups.ntriples(groups.assertion_triples(every, F.lit(moment))))
    if not result["groups_found"]:
        say(f"nothing to write to {config.dedup_graph}")
    return {k: result[k] for k in ("groups_found", "rule_based_groups", "llm_groups", "entities_covered", "dedup_graph")}
