"""Duplicate groups of all methods: union, order, summary, report, assertions and audit."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions import vocabulary as V
from twinfold.functions.text import decimal_text, iri_text, literal_text, utc_iso
from twinfold.operators.numbering import placed
from twinfold.sources.sparql import SparqlUpdates, insert_text

COLUMNS = ["entities", "confidence", "reason", "method"]


def rule_groups(matches: DataFrame) -> DataFrame:
    return matches.select("entities", F.lit(1.0).alias("confidence"), "reason", F.lit("rule-based").alias("method"))


def all_groups(*parts: DataFrame) -> DataFrame:
    out = parts[0].select(COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(COLUMNS))
    return out


def method_rank(method: Column) -> Column:
    return F.when(method == "rule-based", 0).when(method == "llm", 1).otherwise(99)


def ranked(groups: DataFrame) -> DataFrame:
    """Rule-based first, then llm, then others; surest first; ties by entities."""
    return groups.orderBy(method_rank(F.col("method")), F.desc("confidence"), F.array_join("entities", " "))


def numbered(groups: DataFrame) -> DataFrame:
    """groups with place, their number from 1 in the order of ranked()."""
    keys = [method_rank(F.col("method")), F.desc("confidence"), F.array_join("entities", " ")]
    return placed(groups, *keys).withColumn("place", F.col("place") + 1)


def summary(groups: DataFrame, graph: str = V.DEFAULT_GRAPH) -> DataFrame:
    """One row. entities_covered counts an entity in each of its groups; distinct_entities counts it once."""
    counts = groups.agg(F.count(F.lit(1)).alias("groups_found"), F.count_if(F.col("method") == "rule-based").alias("rule_based_groups"), F.count_if(F.col("method") == "llm").alias("llm_groups"), F.coalesce(F.sum(F.size("entities")), F.lit(0)).cast("long").alias("entities_covered"))
    distinct = groups.select(F.explode("entities").alias("e")).agg(F.countDistinct("e").alias("distinct_entities"))
    return counts.crossJoin(distinct).withColumn("dedup_graph", F.lit(graph))  # one row each


def report_line() -> Column:
    return F.format_string("  %.2f  [%-10s]  %s", "confidence", "method", F.array_join("entities", ", "))


def identified(groups: DataFrame, graph: str, ident: Column | None = None) -> DataFrame:
    """groups with the IRI of their assertion: random, so write the result before using it twice."""
    return groups.withColumn("assertion", F.concat(F.lit(f"{graph}/assertion/"), F.expr("uuid()") if ident is None else ident))


def assertion_triples(groups: DataFrame, moment: Column) -> DataFrame:
    """s, p, o of identified groups, o as an N-Triples term; one time for all; equal triples once.
    An assertion's IRI is its own, so triples can only be equal among its members, which are made distinct where they lie."""
    typed = F.array(
        F.struct(F.lit(V.RDF_TYPE).alias("p"), F.lit(f"<{V.DEDUP}DuplicateAssertion>").alias("o")),
        F.struct(F.lit(V.PROV_TIME).alias("p"), F.concat(literal_text(moment), F.lit(f"^^<{V.XSD}dateTime>")).alias("o")),
        F.struct(F.lit(V.DEDUP + "confidence").alias("p"), F.concat(literal_text(decimal_text(F.col("confidence"))), F.lit(f"^^<{V.XSD}decimal>")).alias("o")),
        F.struct(F.lit(V.DEDUP + "methodology").alias("p"), literal_text(F.col("method")).alias("o")),
        F.struct(F.lit(V.DEDUP + "reasoning").alias("p"), literal_text(F.col("reason")).alias("o")),
    )
    members = F.transform(F.array_distinct("entities"), lambda e: F.struct(F.lit(V.DEDUP + "member").alias("p"), iri_text(e).alias("o")))
    return groups.select(F.col("assertion").alias("s"), F.explode(F.concat(typed, members)).alias("t")).select("s", "t.p", "t.o")


def ntriples(triples: DataFrame) -> DataFrame:
    """line: one N-Triples statement."""
    return triples.select(F.concat_ws(" ", iri_text(F.col("s")), iri_text(F.col("p")), "o", F.lit(".")).alias("line"))


def insert_statements(lines: DataFrame, graph: str, most: int = 5000) -> DataFrame:
    """statement: INSERT DATA updates of at most so many lines each, made where the lines lie; none if there are none."""

    def run(frames: Iterator[pd.DataFrame]):
        held: list[str] = []
        for f in frames:
            held += f["line"].tolist()
            while len(held) >= most:
                yield pd.DataFrame({"statement": [insert_text(held[:most], graph)]})
                held = held[most:]
        if held:
            yield pd.DataFrame({"statement": [insert_text(held, graph)]})

    return lines.select("line").sortWithinPartitions("line").mapInPandas(run, "statement string")


def send(lines: DataFrame, options: dict[str, str], parallel: int = 1) -> None:
    """Insert N-Triples lines into a graph by the sink of sources/sparql.py, from at most `parallel` tasks at a time."""
    lines.sparkSession.dataSource.register(SparqlUpdates)
    lines.select("line").repartition(parallel).write.format("sparql_update").options(**options).mode("append").save()


def audit_rows(groups: DataFrame, moment: Column | None = None) -> DataFrame:
    """What the audit log gets: timestamp, operation, method, confidence, reason, entities."""
    return groups.select((utc_iso(F.current_timestamp()) if moment is None else moment).alias("timestamp"), F.lit("duplicate_group").alias("operation"), "method", "confidence", "reason", "entities")


def log_json(rows: DataFrame, path: str, run_id: str, step: str) -> None:
    """JSON lines of a step of a run, in a folder of their own: a run that is repeated under its id replaces them."""
    named = rows.withColumns({"run_id": F.lit(run_id), "step": F.lit(step)})
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "step").json(path)
