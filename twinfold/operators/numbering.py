"""Numbers for rows, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.sources.shared import written


def placed(rows: DataFrame, *order: Column | str) -> DataFrame:
    """rows with place, their number from 0 in an order. Rows are sorted by ranges and counted by range, so no task holds
    more than a range; an offset for each range is all that is broadcast. Written, as numbers depend on the ranges."""
    held = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    offsets = held.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n"))
    out = held.withColumn("_part", part).join(F.broadcast(offsets.select("_part", "_before")), "_part")
    return out.select(*rows.columns, (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias("place"))
