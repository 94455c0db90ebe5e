"""Folding triples (s, pos, p, o) into validated person records.

pos is the order of arrival; where it ties, the smaller value comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.functions import vocabulary as V
from twinfold.functions.text import bare_orcid, present, shorten

COLUMNS = ["iri", "name", *V.SCALARS, *V.LISTS, "properties"]


def of_persons(triples: DataFrame) -> DataFrame:
    """All triples of every subject that is typed as a person, dealt out by subject. The type is looked for where a
    subject's triples lie together anyway, so they are read and shuffled once, and every grouping by subject that
    follows needs no shuffle of its own. A subject of very many triples spills; only persons are gathered later."""
    typed = F.max((F.col("p") == V.RDF_TYPE) & (F.col("o") == V.PERSON)).over(Window.partitionBy("s"))
    dealt = triples.select("s", "pos", "p", "o").repartition("s")
    return dealt.withColumn("typed", typed).where("typed").drop("typed")


def person_triples(triples: DataFrame) -> DataFrame:
    """of_persons() with predicates shortened."""
    return of_persons(triples).withColumn("p", shorten(F.col("p")))


def page_of_persons(triples: DataFrame, page: int, size: int = 5000) -> DataFrame:
    """The triples of one page of persons, pages counted over persons in the order of their IRIs."""
    typed = triples.where((F.col("p") == V.RDF_TYPE) & (F.col("o") == V.PERSON)).select("s").distinct()
    return triples.join(typed.orderBy("s").offset(page * size).limit(size), "s", "left_semi")


def property_values(triples: DataFrame) -> DataFrame:
    """s, p, values: the distinct values of each predicate in order of first arrival."""
    first = triples.groupBy("s", "p", "o").agg(F.min("pos").alias("pos"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "o")))
    return first.groupBy("s", "p").agg(F.transform(ordered, lambda x: x["o"]).alias("values"))


def property_bag(triples: DataFrame) -> DataFrame:
    """s, properties: a map from predicate to values."""
    return property_values(triples).groupBy("s").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("p", "values")))).alias("properties"))


def violations() -> Column:
    """Names of the rules that a record breaks: email, orcid, identifier."""
    broken = [
        F.when(~F.col("email").rlike(V.EMAIL), F.lit("email")),
        F.when(~F.col("orcid").rlike(V.ORCID), F.lit("orcid")),
        F.when(F.coalesce(*(present(c) for c in ("github_username", "email", "infoscience_id", "orcid"))).isNull(), F.lit("identifier")),
    ]
    return F.array_compact(F.array(*broken))


def candidates(triples: DataFrame) -> DataFrame:
    """A record for each named person, with its violations; persons without a name do not appear."""
    bag = property_bag(person_triples(triples))
    values = {p: F.col("properties")[p] for p in (V.NAME, *V.SCALARS.values(), *V.LISTS.values())}
    scalars = [F.get(values[p], F.lit(0)).alias(c) if c != "orcid" else bare_orcid(F.get(values[p], F.lit(0))).alias(c) for c, p in V.SCALARS.items()]
    lists = [F.coalesce(values[p], F.array().cast("array<string>")).alias(c) for c, p in V.LISTS.items()]
    named = bag.where(F.size(values[V.NAME]) > 0)
    out = named.select(F.col("s").alias("iri"), F.array_join(values[V.NAME], " / ").alias("name"), *scalars, *lists, "properties")
    return out.withColumn("violations", violations())


def valid(found: DataFrame) -> DataFrame:
    return found.where(F.size("violations") == 0).drop("violations")


def rejected(found: DataFrame) -> DataFrame:
    """iri, name and violations of the records that break a rule; each is dropped whole."""
    return found.where(F.size("violations") > 0).select("iri", "name", "violations")


def persons(triples: DataFrame) -> DataFrame:
    return valid(candidates(triples))
