"""Quality rules: fixed base rules, then robust multivariate outliers per language and source, on built-in functions.

Each document's statistics become a vector of five transformed numbers. For every (language, source) with at least
`least` documents (smaller ones go to their language's rest) the minimum-covariance-determinant estimate is sought from
two starts: the documents nearest to the median, by the floor of each statistic and by its quartiles' distance. Each
concentrates: mean and covariance of the nearest `share` of the documents, new Mahalanobis distances, and again. Of the
two estimates the one with the smaller determinant counts. A document whose squared distance exceeds `cut` times the
chi-square scale of its group is rejected.

A concentration step is one pass: sums for mean and covariance are aggregated by group and by bin of the distance
(BINS for each doubling), so the nearest share follows from counts of bins, ties go together, and a group of any
size is summed before anything is shuffled. Covariances get a floor on the diagonal, as many statistics are constant.

Cases: null and empty texts have no words and fail the base rules; repeated rows get the same verdict; a null language
or source counts as an empty one; groups too small to estimate keep what passes the base rules; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.llm.common import drop_written, written
from twinfold.llm.native import let, upto

# What counts as a space between words, and as a symbol.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
#: 0.75 quantile of chi-square with 5 degrees of freedom.
CHI2_SHARE = 6.6257
P = 5
#: The distance of the quartiles of a normal distribution, in standard deviations.
IQR = 1.349
#: Bins of a distance for each doubling.
BINS = 16
#: Floors of the covariance's diagonal, in units of the transformed statistics.
FLOOR = (0.04, 0.04, 0.0025, 0.02, 0.02)


def _repeated(words: Column, width: int) -> Column:
    """Words inside windows of so many words that the text holds twice or more."""
    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(upto(F.size(h) - width + 1), lambda i: F.xxhash64(F.slice(h, i, width))))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(at, start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(i - a["last"], F.lit(width))).alias("n")), lambda a: a["n"])

    def count(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def twice(o: Column) -> Column:
            same = F.filter(o, lambda s, i: ((i > 0) & (F.get(o, i - 1)["x"] == s["x"])) | ((i < F.size(o) - 1) & (F.get(o, i + 1)["x"] == s["x"])))
            return F.array_sort(F.transform(same, lambda s: s["i"]))

        return F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0)).otherwise(covered(let(ordered, twice)))

    return let(hashes, count)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), text.alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(NOT_SPACE))
    by_words = let(F.array_remove(F.split("t", SPACE), ""), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w, 8).cast("long").alias("n_repeat_words")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    out = held.select("doc_id", "lang", "source", by_words.alias("w"), by_lines.alias("l"), F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"), F.length(F.regexp_replace("t", NOT_SYMBOL, "")).cast("long").alias("n_symbols"))
    out = out.select("doc_id", "lang", "source", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _vector() -> list[Column]:
    words = F.greatest("n_words", F.lit(1))
    return [
        F.log(1 + F.col("n_words")),
        F.log((1 + F.col("word_chars")) / words),
        F.sqrt(F.col("n_symbols") / F.greatest("word_chars", F.lit(1))),
        F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


_PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _distance() -> Column:
    """Squared Mahalanobis distance of z0..z4 by a group's mean (m) and lower Cholesky factor (l)."""
    y: list[Column] = []
    for i in range(P):
        y.append((F.col(f"z{i}") - F.col(f"m{i}") - sum((F.col(f"l{i}{j}") * y[j] for j in range(i)), F.lit(0.0))) / F.col(f"l{i}{i}"))
    return sum((v * v for v in y), F.lit(0.0))


def _bin(d: Column) -> Column:
    return F.floor(F.log2(d + 1e-9) * BINS).cast("int")


def _estimate(sums: DataFrame) -> DataFrame:
    """Group, m, l (covariance with floor, factored) from n and sums of z and of products."""
    out = sums.select("lang", "part", "start", "n", *((F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(P)), *(F.col(f"p{i}{j}") for i, j in _PAIRS))
    out = out.select("lang", "part", "start", "n", *(f"m{i}" for i in range(P)), *((F.greatest(F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"), F.lit(0.0)) + FLOOR[i] if i == j else F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")).alias(f"c{i}{j}") for i, j in _PAIRS))
    for j in range(P):
        pivot = F.sqrt(F.greatest(F.col(f"c{j}{j}") - sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0)), F.lit(1e-6)))
        out = out.withColumn(f"l{j}{j}", pivot)
        for i in range(j + 1, P):
            out = out.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}"))
    return out.select("lang", "part", "start", *(f"m{i}" for i in range(P)), *(f"l{i}{j}" for i, j in _PAIRS))


def robust_estimates(stats: DataFrame, share: float = 0.75, steps: int = 4) -> DataFrame:
    """lang, part, m, l, scale: of each group of documents with columns lang, part and z0..z4."""
    keys = ["lang", "part", "start"]
    quartiles = stats.groupBy("lang", "part").agg(*(F.percentile_approx(f"z{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(P)))
    quartiles = quartiles.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))

    def spread(i: int) -> Column:
        wide = (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / IQR
        return F.sqrt(F.when(F.col("start") == 0, FLOOR[i]).otherwise(F.greatest(wide * wide, F.lit(FLOOR[i]))))

    now = written(quartiles.select(*keys, *(F.col(f"q{i}")[1].alias(f"m{i}") for i in range(P)), *((spread(i) if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in _PAIRS)))
    for step in range(steps + 1):
        z = [F.col(f"z{i}") for i in range(P)]
        sums = stats.join(now, ["lang", "part"]).withColumn("key", F.struct(*keys, _bin(_distance()).alias("bin"))).groupBy("key").agg(F.count(F.lit(1)).alias("n"), *(F.sum(z[i]).alias(f"s{i}") for i in range(P)), *(F.sum(z[i] * z[j]).alias(f"p{i}{j}") for i, j in _PAIRS))
        sums = sums.select("key.*", *sums.columns[1:])  # by key first, so that a large group's sums are few rows
        group = Window.partitionBy(*keys)
        sums = sums.withColumn("total", F.sum("n").over(group)).withColumn("below", F.sum("n").over(group.orderBy("bin")) - F.col("n"))
        near = sums.where(F.col("below") < F.ceil(share * F.col("total")))
        if step == steps:
            scale = near.groupBy(*keys).agg(F.max("bin").alias("bin"), F.max("total").alias("total")).select(*keys, "total", (F.pow(F.lit(2.0), (F.col("bin") + 1) / BINS) / CHI2_SHARE).alias("scale"))
            size = F.round(sum((F.log(f"l{i}{i}") for i in range(P)), F.lit(0.0)), 9)  # half the determinant's logarithm
            best = F.row_number().over(Window.partitionBy("lang", "part").orderBy(size, "start"))
            return written(now.join(scale, keys).withColumn("best", best).where("best = 1").drop("best", "start"))
        following = written(_estimate(near.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(P)), *(F.sum(f"p{i}{j}").alias(f"p{i}{j}") for i, j in _PAIRS))))
        drop_written(now)
        now = following
    raise AssertionError


def quality_rules(docs: DataFrame, share: float = 0.75, steps: int = 4, least: int = 100, cut: float = 30.0) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance (null where
    the base rules failed or the group is too small), one row for each row of docs."""
    stats = written(statistics(docs))
    passed = stats.where("not base_failed")
    sizes = passed.groupBy("lang", "source").count()
    parts = written(sizes.select("lang", "source", F.when(F.col("count") >= least, F.col("source")).otherwise("\0rest").alias("part")))
    held = stats.join(parts, ["lang", "source"], "left").select("doc_id", "lang", "part", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *(v.alias(f"z{i}") for i, v in enumerate(_vector())))
    held = written(held)
    known = robust_estimates(held.where("not base_failed"), share, steps)
    joined = held.join(known.where(F.col("total") >= least), ["lang", "part"], "left")
    distance = F.when(~F.col("base_failed"), _distance() / F.greatest("scale", F.lit(1.0)))
    out = joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", distance.alias("distance"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut))
