"""Settings of a run: secrets and endpoints from the environment, parameters with their defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from twinfold.functions import vocabulary as V


@dataclass(frozen=True)
class Config:
    sparql_endpoint: str
    sparql_update_endpoint: str
    llm_base_url: str
    llm_api_key: str
    llm_model: str
    sparql_user: str | None = None
    sparql_password: str | None = None
    dedup_graph: str = V.DEFAULT_GRAPH
    audit_log_path: str = "audit.jsonl"
    sparql_log_path: str = "sparql.jsonl"
    llm_log_path: str = "llm.jsonl"
    persons_cache_path: str = "persons_cache.jsonl"
    embedding_cache_path: str = "embedding_cache"
    run_id: str = ""
    cluster_k: int = 20
    cluster_threshold: float = 0.99
    cluster_name_similarity_penalty: float = 0.02
    embedding_model: str = "Qwen/Qwen3-Embedding-8B"
    embed_batch_size: int = 64
    embed_concurrency: int = 6
    embed_fields: tuple[str, ...] = ("name", "location")
    use_persons_cache: bool = True
    agent_max_cluster_size: int = 25


REQUIRED = ("sparql_endpoint", "llm_base_url", "llm_api_key", "llm_model")
OPTIONAL = ("sparql_user", "sparql_password", "dedup_graph", "audit_log_path", "sparql_log_path", "llm_log_path", "persons_cache_path", "embedding_cache_path", "run_id")


def from_environment(env: Mapping[str, str] | None = None) -> Config:
    """A missing required variable is a KeyError; the update endpoint is the endpoint if unset."""
    env = os.environ if env is None else env
    given = {k: env[k.upper()] for k in REQUIRED} | {k: env[k.upper()] for k in OPTIONAL if k.upper() in env}
    return Config(**given, sparql_update_endpoint=env.get("SPARQL_UPDATE_ENDPOINT", given["sparql_endpoint"]))
