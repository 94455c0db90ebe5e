"""Deterministic rules: persons that share an identifier are one group. A registry of functions from persons to groups."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions.text import github_key, present, uuid_key

Resolver = Callable[[DataFrame], DataFrame]


def _groups(persons: DataFrame, key: Column, *aggregates: Column) -> DataFrame:
    keyed = persons.select("iri", "github_username", key.alias("key")).where("key is not null")
    entities = F.array_sort(F.collect_set("iri")).alias("entities")
    return keyed.groupBy("key").agg(entities, *aggregates).where(F.size("entities") >= 2)


# The reasons that the rules give.
SAME_USERNAME = "[github_username_bridge] Shared GitHub username '%s' (direct field or profile URL) across %d records."
SAME_UUID = "[infoscience_uuid] Shared Infoscience UUID %s across %d records."
CAUTION = " Caution: conflicting GitHub accounts attached (%s) — verify before trusting."


def by_github_username(persons: DataFrame) -> DataFrame:
    """key, entities, reason of persons with one GitHub account, by username or profile URL."""
    found = _groups(persons, github_key(F.col("github_username"), F.col("url")))
    return found.select("key", "entities", F.format_string(SAME_USERNAME, "key", F.size("entities")).alias("reason"))


def by_uuid(persons: DataFrame) -> DataFrame:
    """key, entities, reason, conflict (usernames differ, and the reason warns) of persons with one UUID."""
    names = F.array_sort(F.collect_set(present("github_username"))).alias("usernames")
    found = _groups(persons, uuid_key(F.col("infoscience_id")), names)
    caution = F.when(F.size("usernames") > 1, F.format_string(CAUTION, F.array_join("usernames", ", "))).otherwise("")
    return found.select("key", "entities", F.concat(F.format_string(SAME_UUID, "key", F.size("entities")), caution).alias("reason"), (F.size("usernames") > 1).alias("conflict"))


RESOLVERS: list[Resolver] = [by_github_username, by_uuid]


def resolve(persons: DataFrame, resolvers: list[Resolver] | None = None) -> DataFrame:
    """entities, reason of all rules in order; groups of two rules may overlap and are not merged."""
    return reduce(DataFrame.unionByName, (r(persons).select("entities", "reason") for r in (RESOLVERS if resolvers is None else resolvers)))


def resolved(matches: DataFrame) -> DataFrame:
    return matches.select(F.explode("entities").alias("iri")).distinct()


def remaining(persons: DataFrame, matches: DataFrame) -> DataFrame:
    """The persons that no rule resolved."""
    return persons.join(resolved(matches), "iri", "left_anti")
