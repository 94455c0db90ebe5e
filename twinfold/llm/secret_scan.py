"""Secret scan with corpus-wide ownership frequency, on built-in functions alone.

Base kinds (fixed by pattern) are always reported. Candidates are the base kinds' values and, besides, any run of 20
and more token characters that mixes letters and digits. Every candidate's hash is aggregated over the corpus by
distinct repositories and owners: a value that at least `wide` owners or at least `spread` repositories hold is a widely
copied example, another one is owner-specific. An owner-specific run outside the base spans that looks random (at least
`variety` different characters) is added as kind `live`. Here a document is a repository and its source the owner,
unless other columns are named.

Distinct (hash, repository) and (hash, owner) are counted in two steps each, and a value that very many documents hold
is dealt out to as many parts when its verdict goes back to them. Cases: null and empty texts have no span; repeated
rows have the same spans each; a row with a null doc_id is told from others by its text; all null owners are one owner;
an empty table gives no rows; other columns are ignored. Places are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.llm.common import join_split, row_key, written
from twinfold.llm.native import match_spans

# The base kinds in their order, their patterns, and the least length of the value.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
KINDS = ("assign", "access", "hex", "live")
#: `[0-9a-f]+` of 24 characters at least is `[0-9a-f]{24,}`: both find whole runs.
BASE = ((ASSIGN, 2, 6), (ACCESS, 0, 20), (r"[0-9a-f]{24,}", 0, 24))
#: The method's own candidates.
RUN = r"[A-Za-z0-9+/_-]{20,}"


def _of_kind(text: Column, rank: int, pattern: str, group: int, least: int) -> Column:
    found = match_spans(text, pattern, group, lambda m, g: F.length(g) >= least)
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.xxhash64(s["value"]).alias("hash"), F.lit(0).alias("variety")))


def _runs(text: Column) -> Column:
    found = match_spans(text, RUN, 0, lambda m, _: m.rlike("[0-9]") & m.rlike("[A-Za-z]"))
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("rank"), s["end"].alias("end"), F.xxhash64(s["value"]).alias("hash"), F.size(F.array_distinct(F.split(s["value"], ""))).alias("variety")))


def candidates(docs: DataFrame, owner: str = "source", repository: Column | None = None) -> DataFrame:
    """key (of the document), repository, owner, rank, start, end, hash, variety of every candidate span."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select(row_key().alias("key"), F.coalesce(F.col(owner).cast("string"), F.lit("?")).alias("owner"), (row_key() if repository is None else F.coalesce(repository.cast("string"), F.lit("?"))).alias("repository"), text.alias("t"))
    spans = F.concat(*(_of_kind(F.col("t"), i, *b) for i, b in enumerate(BASE)), _runs(F.col("t")))
    return held.select("key", "repository", "owner", F.explode(spans).alias("s")).select("key", "repository", "owner", "s.*")


def ownership(found: DataFrame, wide: int = 3, spread: int = 20) -> DataFrame:
    """hash, n (spans), n_repositories, n_owners, live (fewer than `spread` and `wide` of them) of each candidate value."""
    known = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("repository").alias("n_repositories"), F.count_distinct("owner").alias("n_owners"))
    return known.withColumn("live", (F.col("n_owners") < wide) & (F.col("n_repositories") < spread))


def _apart(found: DataFrame, variety: int) -> DataFrame:
    """The base spans, and the owner-specific runs that look random and touch no base span; sorted sweeps both ways."""
    base, order = F.col("rank") < 3, Window.partitionBy("key")
    ends = F.max(F.when(base, F.col("end"))).over(order.orderBy("start", "rank", "end").rowsBetween(Window.unboundedPreceding, -1))
    starts = F.min(F.when(base, F.col("start"))).over(order.orderBy(F.desc("start"), F.desc("rank"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1))
    held = found.where(base | (F.col("live") & (F.col("variety") >= variety))).withColumn("before", ends).withColumn("after", starts)
    return held.where(base | ((F.coalesce("before", "start") <= F.col("start")) & (F.coalesce("after", "end") >= F.col("end"))))


def secret_scan(docs: DataFrame, wide: int = 3, spread: int = 20, variety: int = 10, owner: str = "source", repository: Column | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live (owner-specific base spans), n_copied (the rest)."""
    found = written(candidates(docs, owner, repository))
    known = written(ownership(found, wide, spread))
    each = _apart(join_split(found, known.select("hash", "live", "n"), "hash", "n", "key"), variety)
    grouped = each.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "rank", "end", "live"))).alias("all"))

    none = F.array().cast("array<struct<start:int,rank:int,end:int,live:boolean>>")
    out = docs.select("doc_id", row_key().alias("key")).join(grouped, "key", "left").select("doc_id", F.coalesce("all", none).alias("all"))
    out = out.select("doc_id", "all", F.filter("all", lambda s: s["rank"] < 3).alias("base"))
    names = F.array(*map(F.lit, KINDS))

    def said(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")

    counts = [_count(rank).alias(f"n_{KINDS[rank]}") for rank in range(3)]
    live = F.size(F.filter("base", lambda s: s["live"])).cast("long")
    return out.select("doc_id", *counts, F.sha2(said("base"), 256).alias("base_sha256"), said("all").alias("spans"), live.alias("n_live"), (F.size("base").cast("long") - live).alias("n_copied"))


def _count(rank: int) -> Column:
    return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
