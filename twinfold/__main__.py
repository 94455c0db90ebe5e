"""python -m twinfold [serve]: one run with the environment's settings, or the HTTP service."""

from __future__ import annotations

import logging
import os
import sys
import uuid
from dataclasses import replace

from pyspark.sql import SparkSession

from twinfold.operators.embedding import HttpEmbeddings
from twinfold.operators.groups import send
from twinfold.operators.verdicts import ChatAdjudicator
from twinfold.plans.config import Config, from_environment
from twinfold.plans.jobs import JobManager, serve
from twinfold.plans.run import run
from twinfold.sources.sparql import SparqlTriples


def execute(config: Config) -> dict:
    spark = SparkSession.builder.appName("twinfold").config("spark.sql.session.timeZone", "UTC").config("spark.sql.python.filterPushdown.enabled", "true").getOrCreate()
    spark.dataSource.register(SparqlTriples)
    config = replace(config, run_id=config.run_id or uuid.uuid4().hex)
    options = {"endpoint": config.sparql_endpoint, "update_endpoint": config.sparql_update_endpoint, "user": config.sparql_user or "", "password": config.sparql_password or "", "log": config.sparql_log_path, "run_id": config.run_id, "graph": config.dedup_graph, "push": "true"}
    return run(
        spark,
        config,
        lambda: spark.read.format("sparql_triples").options(**options).load(),
        HttpEmbeddings(f"{config.llm_base_url.rstrip('/')}/embeddings", config.llm_api_key, config.embedding_model),
        ChatAdjudicator(f"{config.llm_base_url.rstrip('/')}/chat/completions", config.llm_api_key, config.llm_model),
        lambda lines: send(lines, options),
    )


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    if sys.argv[1:] == ["serve"]:
        serve(JobManager(from_environment(), execute, os.environ.get("TWINFOLD_DATA_ROOT", "data"))).serve_forever()
    else:
        print(execute(from_environment()))
