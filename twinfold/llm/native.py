"""Column expressions that the operators on built-in functions share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stands around matches; where a text has this character, which is none, it counts as another.
MARK = "\ufffe"
#: Entries of an array that are summed together.
BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for each row however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def upto(n: Column) -> Column:
    """The whole numbers from 1 to n, none where n < 1."""
    return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def running_sums(x: Column) -> Column:
    """Of whole numbers: the sum of all entries up to each one. Sums are carried on within blocks and then from block to
    block, as an array that grows by one entry is copied each time."""
    none = F.array().cast("array<int>")

    def carried(entries: Column, start: Column) -> Column:
        first = F.struct(start.alias("sum"), none.alias("out"))
        return F.aggregate(entries, first, lambda a, v: F.struct((a["sum"] + v).alias("sum"), F.concat(a["out"], F.array(a["sum"] + v)).alias("out")), lambda a: a["out"])

    def total(entries: Column) -> Column:
        return F.aggregate(entries, F.lit(0), lambda a, v: a + v)

    def of(blocks: Column) -> Column:
        ends = carried(F.transform(blocks, total), F.lit(0))
        return F.flatten(let(ends, lambda e: F.transform(blocks, lambda b, i: carried(b, F.coalesce(F.get(e, i - 1), F.lit(0))))))

    return let(x, lambda v: let(F.transform(F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(BLOCK)), lambda i: F.slice(v, i, BLOCK)), of))


def match_spans(text: Column, pattern: str, group: int, keep: Callable[[Column, Column], Column]) -> Column:
    """All leftmost non-overlapping matches of a pattern that keep(match, group) lets through, as an array of structs
    (start, end, value) in code points, end exclusive. The pattern must match ASCII characters alone, one at least, and
    look at none around a match.

    Matches are set between marks and the text is parted there, so that places follow from the lengths of the parts.
    regexp_extract_all() would copy the text for each match.
    """
    marked = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit("\ufffd")), pattern, f"{MARK}$0{MARK}")

    def spans(parts: Column) -> Column:
        lengths = F.transform(parts, lambda m: F.length(m))
        rows = F.filter(F.arrays_zip(parts.alias("m"), lengths.alias("n"), running_sums(lengths).alias("e")), lambda r, i: i % 2 == 1)
        rows = F.transform(rows, lambda r: F.struct((r["e"] - r["n"]).alias("start"), r["e"].alias("end"), r["m"].alias("m"), (F.regexp_extract(r["m"], pattern, group) if group else r["m"]).alias("value")))
        rows = F.filter(rows, lambda r: keep(r["m"], r["value"]))
        return F.transform(rows, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["value"].alias("value")))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return let(F.split(marked, MARK, -1), lambda parts: F.when(F.size(parts) > 1, spans(parts)).otherwise(none))
