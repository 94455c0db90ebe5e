"""What the queries' contracts add around the operators: damage done to their input and digests of their output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import documents
from twinfold.llm.native import let

SPACES = r"[\x20\x09-\x0D]+"


def crc(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text: in every tenth document by the checksum h of its id, the words from a on repeat p words, where
    g = floor(h / 10), a = g mod n and p = 1 + floor((n - a) / (3 + g mod 8)); its words are joined by a space."""
    h = crc(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        return let(F.struct(a.alias("a"), p.alias("p")), lambda x: F.array_join(F.transform(words, lambda w, i: F.when(i < x["a"], w).otherwise(F.get(words, x["a"] + F.pmod(i - x["a"], x["p"])))), " "))

    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    text = F.when(F.pmod(h, F.lit(10)) == 0, let(words, lambda w: F.when(F.size(w) > 0, repeated(w)))).otherwise(F.col("text"))
    return documents(docs).select("doc_id", text.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """n_runs, the run of most periods (exactly compared; ties: first start, then period), and hashes of runs and text."""

    def more(a: Column, r: Column) -> Column:
        return F.when(a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a)

    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), more)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("best.length * 1000 div best.period")
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by the checksum of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its
    text, 2 removes its marks . ! ?, 3 repeats it, 4 makes it the user's. Nulls count as one space."""
    said = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.pmod(crc(said), F.lit(20)).alias("code")).where("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).select("conv_id", "turn", "role", "text")
