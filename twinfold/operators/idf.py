"""How rare a name is: the logarithm of its inverse frequency, scaled to 0 (commonest) to 1 (rarest)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name_frequency(persons: DataFrame, name: str = "name") -> DataFrame:
    return persons.groupBy(name).count()


def name_idf(persons: DataFrame, name: str = "name") -> DataFrame:
    """name, count, idf of each distinct name; all 1 where all names are equally frequent."""
    counts = name_frequency(persons, name)
    span = counts.agg(F.sum("count").alias("n"), F.min("count").alias("least"), F.max("count").alias("most"))
    raw, low, high = (F.log(F.col("n") / F.col(c)) for c in ("count", "most", "least"))
    idf = F.when(F.col("least") == F.col("most"), F.lit(1.0)).otherwise((raw - low) / (high - low))
    return counts.crossJoin(F.broadcast(span)).select(name, "count", idf.alias("idf"))  # span is one row


def with_idf(persons: DataFrame, name: str = "name") -> DataFrame:
    return persons.join(name_idf(persons, name).select(name, "idf"), name)


def effective_threshold(base: float, penalty: float, idf_i: Column, idf_j: Column) -> Column:
    """The commoner the commoner name, the more similar two persons must be."""
    return F.lit(base) + F.lit(penalty) * (F.lit(1.0) - F.least(idf_i, idf_j))
