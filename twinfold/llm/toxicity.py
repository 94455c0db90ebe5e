"""Toxicity after noisy-channel deobfuscation.

1. A character language model (trigrams with interpolation) is counted over the whole corpus: each task sums its own
   trigrams, and the sums are added up. Letters beyond U+017F are one letter to it, so that at most 125 letters, and
   2 million trigrams, can come together. Words with a letter three times in a row are left out of the counts.
2. Disguised words are decoded: digits and symbols that stand for letters, letters repeated three times and more, and
   single letters set apart by spaces or any marks form a lattice of letters, and Viterbi search takes the path of highest
   probability under the channel and the language model. Between letters set apart there may be an edge of words.
3. Restored texts are scored by a logistic regression over words and word beginnings. It is fitted to the `sample`
   labelled documents with the smallest hashes of their ids: features are all words whose documents of either label
   differ beyond chance (log-likelihood ratio at least `least`), and never a language, source or id.

Letters set apart are parted by trigrams and by the words that are features, with their counts in the sample: these alone
bear on a score. Cases: null and empty texts have the score of a text without any known word; without labels of both kinds every
score is the share of toxic ones; a document with labels that contradict each other is not learned from, equal ones count
once; repeated rows score alike, and are learned from each; a null doc_id has no label and is scored; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import batch, documents, drop_written, tidy, written
from twinfold.llm.tokens import Memo, encoder

# What a character may stand for, besides itself.
CHANNEL = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "*": "aeiou"}
_MARKS = re.escape("".join(c for c in CHANNEL if not c.isdigit()))
#: Where a stand-in touches a letter, a word may be disguised; its characters are letters, digits and stand-ins, and _
#: joins such words.
STAND_IN = re.compile(rf"[0-9{_MARKS}]+")
DISGUISED = re.compile(rf"[\w{_MARKS}]+")
REMEMBERED = 100  # letters of a word whose decoding is worth remembering; longer ones are decoded each time
OTHER = re.compile("[\u0180-\U0010ffff]")
REPEATED = re.compile(r"([^\W\d_])\1\1")
STRETCHED = re.compile(r"(.)\1\1+", re.DOTALL)
#: Single letters, digits and stand-ins set apart by any other marks, three and more; and a quick test for them. A *
#: between other marks, or before or after all, may be a stand-in or a mark.
_STANDS = r"@$!|+€"
_ONE = rf"(?:[^\W_]|[{_STANDS}])"
_GAP = rf"(?:[^\w\s{_STANDS}]|[ _])"
_MARK = rf"(?:[^\w\s{_STANDS}*]|[ _])"
_ENDS = rf"(?=[!?]*(?:[^\w{_STANDS}]|_|$))"
SPACED = re.compile(rf"(?<![^\W_])(?<![{_STANDS}])(?:\*{_MARK}++)?{_ONE}{_ENDS}(?:{_GAP}++{_ONE}{_ENDS}){{2,}}+(?:{_MARK}++\*(?![^\s.,;:]))?")
APART = re.compile(rf"{_GAP}{_ONE}{_GAP}++{_ONE}(?![^\W_])")
SEPARATOR = re.compile(rf"({_MARK}+)")
#: A word of one letter, if more than a letter stands before it.
SINGLE = re.compile(r" ([^\W\d_])(?= [^\W\d_]{2})")
WORD = re.compile(r"[^\W\d_]+")
COST = 3.0  # of a stand-in, in nats
ALL = ""  # counts documents among the counts of words
EDGE = 3.0  # of an edge of words between letters set apart, or of none where they stand further apart, in nats
PREFIX = 4  # letters of a word's beginning that is a feature


class LanguageModel:
    """log_p(a, b, c): of letter c after a and b; from counts of trigrams (a space is the edge of a word). Known words,
    with their counts among `total` ones, help to part words whose letters stand apart; others are parted by trigrams."""

    def __init__(self, trigrams: dict[str, int], words: dict[str, int] | None = None, total: int = 0):
        two, one, base = Counter(), Counter(), Counter()
        for t, n in trigrams.items():
            two[t[:2]] += n
            one[t[1:]] += n
            base[t[2]] += n
        self.three, self.two, self.one, self.base = trigrams, two, one, base
        self.mid = Counter()
        for t, n in one.items():
            self.mid[t[0]] += n
        self.total, self.kinds = sum(base.values()), len(base) + 1
        self.known: dict[tuple[str, str, str], float] = {}
        self.words, self.of_words, self.begun = words or {}, total or sum((words or {}).values()), None

    def knowing(self, words: dict[str, int], total: int) -> LanguageModel:
        return LanguageModel(self.three, words, total)

    def log_p(self, a: str, b: str, c: str) -> float:
        a, b, c = key = tuple(OTHER.sub("\ufffd", x) for x in (a, b, c)) if max(a, b, c) > "\u017f" else (a, b, c)
        if (p := self.known.get(key)) is None:
            low = (self.base[c] + 1) / (self.total + self.kinds)
            low = (self.one[b + c] + 5 * low) / (self.mid[b] + 5)
            p = math.log((self.three.get(a + b + c, 0) + 5 * low) / (self.two[a + b] + 5))
            if len(self.known) < 200_000:
                self.known[key] = p
        return p

    def decode(self, seen: str, apart: bool = False) -> str:
        """The likeliest letters behind a disguised word of any length. An underscore is an edge of words. Of letters
        set `apart`, any may begin a word, and those after a space in `seen` are likely to."""
        groups, i = [], 0  # of one character: what it may be, and how often in a row it stands
        while i < len(seen):
            j = i
            while j < len(seen) and seen[j] == seen[i]:
                j += 1
            c = seen[i]
            if c == "_" and not apart:
                groups.append([(" ", 0.0)])
            elif c == " ":
                groups.append([(" ", 0.0), ("", EDGE)])
            else:
                choices = [(c, 0.0)] if c.isalpha() else [] if c in CHANNEL else [(c, 0.0)]
                choices += [(x, COST) for x in CHANNEL.get(c, "")]
                if apart:  # an edge may lie between equal characters too, and all but the first may be stretching
                    for k in range(i, j):
                        if k and seen[k - 1] != " ":
                            groups.append([("", 0.0), (" ", EDGE)])
                        gone = [("", 0.5 * (k == i + 1))] if k > i else [("", COST)] if c == "*" else []
                        groups.append(choices + gone)
                else:
                    lengths = [(1, 0.0)] if j - i == 1 else [(1, 0.5), (2, 0.5)]
                    groups.append([(x * n, cost * min(j - i, 2) + more) for x, cost in choices for n, more in lengths])
            i = j
        return self._likeliest(groups, apart)

    def beginnings(self) -> dict[str, float | None]:
        """Every beginning of a known word, with its logarithmic share of all words if it is one itself."""
        if self.begun is None:
            total, self.begun = math.log(max(1, self.of_words)), {}
            for w, n in self.words.items():
                for i in range(1, len(w)):
                    self.begun.setdefault(w[:i], None)
                self.begun[w] = math.log(n) - total
        return self.begun

    def _likeliest(self, groups: list[list[tuple[str, float]]], words: bool = False) -> str:
        """The path of highest probability that takes one of each group's (letters, cost); a space is an edge of words.
        Paths share their beginnings, so time and memory grow with the number of groups alone."""
        paths: dict[tuple[str, str], tuple[float, tuple | None]] = {(" ", " "): (0.0, None)}  # by the last two letters
        edge, begun = (" ", " "), self.beginnings() if words else {}
        arrived: dict[int, tuple[float, tuple | None]] = {}  # by groups used: the best path that ends in a known word
        for k, choices in enumerate(groups):
            if begun and edge in paths:
                start, before = paths[edge]
                open_words, end = {"": start}, k
                while open_words and end < len(groups):
                    longer: dict[str, float] = {}
                    for w, p in open_words.items():
                        for letters, cost in groups[end]:
                            x, q = w + letters, p - cost
                            if (x in begun or not x) and q > longer.get(x, -math.inf):
                                longer[x] = q
                    open_words, end = longer, end + 1
                    open_words.pop("", None)
                    for w, q in open_words.items():
                        if begun[w] is not None and (end not in arrived or q + begun[w] > arrived[end][0]):
                            arrived[end] = (q + begun[w], (before, w + " "))
            new: dict[tuple[str, str], tuple[float, tuple | None]] = {}
            for (a, b), (p, before) in paths.items():
                for letters, cost in choices:
                    x, y, q = a, b, p - cost
                    for c in letters:
                        if c != " ":
                            q += self.log_p(x, y, c)
                            x, y = y, c
                        elif y != " ":
                            q += self.log_p(x, y, c)
                            x = y = c
                    if (x, y) not in new or q > new[x, y][0]:
                        new[x, y] = (q, (before, letters))
            paths = new
            if (found := arrived.pop(k + 1, None)) and (edge not in paths or found[0] > paths[edge][0]):
                paths[edge] = found
        _, (_, path) = max(paths.items(), key=lambda r: (r[1][0] + (self.log_p(*r[0], " ") if r[0][1] != " " else 0.0), r[0]))
        out = []
        while path is not None:
            path, letters = path
            out.append(letters)
        return "".join(reversed(out))


def mixed(text: str) -> list[str]:
    """Words of a text in small letters that mix letters and stand-ins."""
    out, end = [], 0
    for m in STAND_IN.finditer(text):
        a, b = m.span()
        if a >= end and (text[a - 1 : a].isalpha() or text[b : b + 1].isalpha()):
            s = a
            while s > end and (text[s - 1].isalnum() or text[s - 1] in CHANNEL):
                s -= 1
            end = DISGUISED.match(text, s).end()
            if end - s >= 3:
                out.append(text[s:end])
    return out


def set_apart(text: str) -> list[str]:
    """Runs of single letters that stand apart, without what is between them, but with a space where that is longer than
    elsewhere in the run."""
    out = []
    if APART.search(text):
        for m in SPACED.finditer(text):
            ones, gaps = [], []  # the characters, and how much stands before each
            for i, part in enumerate(SEPARATOR.split(m[0])):
                if i % 2:
                    gap = len(part)
                elif not part.strip("*"):
                    ones.append("*")
                    gaps.append(gap if i else 0)
                else:
                    kept = [(n, c) for n, c in enumerate(part) if c != "*"]
                    ones += [c for _, c in kept]
                    gaps += [(n + gap if i else n) if k == 0 else n - kept[k - 1][0] - 1 for k, (n, _) in enumerate(kept)]
            if any(c.isalpha() for c in ones):
                least = min(gaps[1:])
                out.append(ones[0] + "".join(" " * (g > least) + c for g, c in zip(gaps[1:], ones[1:], strict=True)))
    return out


def disguised(text: str) -> list[str]:
    """Words of a text in small letters that mix letters and stand-ins, or whose letters stand apart."""
    return mixed(text) + set_apart(text)


def word_trigrams(words: list[str], n: np.ndarray) -> dict[str, int]:
    """Counts of the trigrams of words, each of which stands n times: those of two letters and more and none three times
    in a row. Two spaces stand before a word and one after it."""
    if not words:
        return {}
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(f"  {w} " for w in words).encode("utf-32-le"), np.uint32)
    code = np.where(code > 0x17F, 0xFFFD, code)
    owner = np.repeat(np.arange(len(words)), lengths + 1)  # of each trigram
    at = np.arange(len(owner)) + 2 * owner
    a, b, c = code[at], code[at + 1], code[at + 2]
    kept = lengths > 1
    kept[owner[(a == b) & (b == c)]] = False
    letters, code = np.unique(code, return_inverse=True)
    k = len(letters)
    ids = (code[at] * k + code[at + 1]) * k + code[at + 2]
    sums = np.bincount(ids, np.where(kept, n, 0)[owner], k**3)
    found = np.flatnonzero(sums)
    letters = [chr(x) for x in letters]
    return {letters[x // k // k] + letters[x // k % k] + letters[x % k]: int(y) for x, y in zip(found.tolist(), sums[found], strict=True)}


def _trigrams(batches: Iterator[pa.RecordBatch]):
    schema = pa.schema([("gram", pa.string()), ("n", pa.int64())])
    encoder.cache_clear()  # a worker that has encoded texts for another query gives that memory back
    words, alone = Counter(), Counter()

    def out():
        found, (seen, n) = Counter(), (list(words), np.fromiter(words.values(), np.int64, len(words)))
        for w, k in alone.items():
            w = OTHER.sub("\ufffd", w)
            found[f"  {w}"] += k
            found[f" {w} "] += k
        found.update(word_trigrams(seen, n))
        words.clear()
        alone.clear()
        return batch(schema, list(found), list(found.values()))

    for b in batches:
        for text in b.column("text"):
            text = text.as_py().lower()
            words.update(WORD.findall(text))
            alone.update(m[1] for m in SINGLE.finditer(text) if m.start() > 1 and text[m.start() - 2 : m.start()].isalpha())
            if len(words) > 300_000:
                yield out()
    if words:
        yield out()


def language_model(docs: DataFrame) -> LanguageModel:
    """From all words of all texts."""
    rows = documents(docs).select("text").mapInArrow(tidy(_trigrams), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return LanguageModel({r["gram"]: r["n"] for r in rows.collect()})


def tripled(text: str) -> bool:
    """Whether a character beyond @ stands three times in a row."""
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return bool(((c[2:] == c[1:-1]) & (c[1:-1] == c[:-2]) & (c[2:] > 64)).any())


def restorer(model: LanguageModel) -> Callable[[str], set[str]]:
    """A function from a text to its distinct restored words."""
    decoded, joined = Memo(model.decode, 50_000), Memo(lambda run: model.decode(run, True), 10_000)

    def decode(word: str) -> str:
        word = STRETCHED.sub(r"\1\1", word)  # decodes to the same
        return decoded[word] if len(word) <= REMEMBERED else model.decode(word)

    def words(text: str) -> set[str]:
        text = text.lower()
        found = set(WORD.findall(text))
        if tripled(text):
            found = {decode(w) if REPEATED.search(w) else w for w in found}
        for w in mixed(text):
            found.update(WORD.findall(decode(w)))
        for run in set_apart(text):
            found.update(WORD.findall(joined[run] if len(run) <= REMEMBERED else model.decode(run, True)))
        return found

    return words


def beginnings(words: set[str]) -> set[str]:
    return {w[:PREFIX] for w in words if len(w) > PREFIX}


def selector(model: LanguageModel, features: Iterable[str]) -> Callable[[str], list[str]]:
    """A function from a text to which of the features it has, in order. A beginning ends in a dash."""
    whole = {f for f in features if not f.endswith("-")}
    begun = {f[:-1] for f in features if f.endswith("-")}
    restored = restorer(model)

    def found(text: str) -> list[str]:
        words = restored(text)
        return sorted(words & whole) + sorted(b + "-" for b in beginnings(words) & begun)

    return found


def _word_rows(model: LanguageModel):
    schema = pa.schema([("toxic", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]):
        restored = restorer(model)
        for b in batches:
            found: Counter = Counter((t, ALL) for t in b.column("toxic").to_pylist())
            for toxic, text in zip(b.column("toxic").to_pylist(), b.column("text"), strict=True):
                words = restored(text.as_py())
                found.update((toxic, w) for w in words)
                found.update((toxic, w + "-") for w in beginnings(words))
            if found:
                yield batch(schema, [t for t, _ in found], [w for _, w in found], list(found.values()))

    return run


def _hit_rows(model: LanguageModel, features: list[str]):
    schema = pa.schema([("toxic", pa.int32()), ("hits", pa.list_(pa.int32()))])
    index = {w: i for i, w in enumerate(features)}

    def run(batches: Iterator[pa.RecordBatch]):
        found = selector(model, features)
        for b in batches:
            if b.num_rows:
                yield batch(schema, b.column("toxic"), [sorted(index[f] for f in found(t.as_py())) for t in b.column("text")])

    return run


def fit(labels: np.ndarray, hits: list[list[int]], n: int, steps: int = 800) -> tuple[float, np.ndarray]:
    """Bias and weights of a logistic regression on binary features, by gradient descent with a ridge."""
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    col = np.concatenate([np.asarray(h, np.int64) for h in hits]) if len(row) else np.zeros(0, np.int64)
    y, rows = labels.astype(float), max(1, len(labels))
    share = np.clip(y.mean(), 0.5 / rows, 1 - 0.5 / rows) if len(y) else 0.5
    bias, w = math.log(share / (1 - share)), np.zeros(n)
    scale = 1 / np.sqrt(np.bincount(col, minlength=n) / rows + 1e-3)  # rare features learn as fast as frequent ones
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(bias + np.bincount(row, w[col], len(y)))))
        g = np.bincount(col, (p - y)[row], n) / rows
        w -= 0.5 * scale * (g + 1e-4 * w) * scale
        bias -= 0.5 * float((p - y).mean()) if len(y) else 0.0
    return bias, w


class Model:
    """A language model and the weights of words."""

    def __init__(self, language: LanguageModel, bias: float, weights: dict[str, float]):
        self.language, self.bias, self.weights = language, bias, weights

    def scorer(self) -> Callable[[str], float]:
        weights, bias, found = self.weights, self.bias, selector(self.language, self.weights)
        return lambda text: 1 / (1 + math.exp(-max(-30.0, min(30.0, bias + sum(weights[f] for f in found(text))))))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, least: float = 15.0) -> Model:
    """From all texts, and from the labelled documents that are not held out, at most `sample` of them."""
    language = language_model(docs)
    given = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    given = given.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").select("doc_id", "toxic")
    given = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    given = written(given)
    texts = documents(docs).join(F.broadcast(given), "doc_id").select("toxic", "text")
    counts = texts.mapInArrow(tidy(_word_rows(language)), "toxic int, word string, n long").groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
    counts = written(counts)
    bad, good = next(((r["bad"], r["good"]) for r in counts.where(F.col("word") == ALL).collect()), (0, 0))

    def part(n: Column, total: int, other: Column) -> Column:
        """Of the log-likelihood ratio: n documents where the word's share of all would give other's."""
        return F.when(n > 0, 2 * n * F.log(n / (other * (total / max(1, bad + good))))).otherwise(0.0)

    b, g = F.col("bad"), F.col("good")
    ratio = part(b, bad, b + g) + part(g, good, b + g) + part(bad - b, bad, bad + good - b - g) + part(good - g, good, bad + good - b - g)
    best = counts.select("word", ratio.alias("ratio")).where((F.col("ratio") >= least) & (F.col("word") != ALL))
    chosen = sorted(r["word"] for r in best.collect())  # of the sample's words
    telling = counts.where(~F.col("word").endswith("-") & (F.col("word") != ALL))
    total = telling.agg(F.coalesce(F.sum(F.col("bad") + F.col("good")), F.lit(0))).first()[0]
    known = telling.join(F.broadcast(best.select("word")), "word").select("word", (F.col("bad") + F.col("good")).alias("n"))
    language = language.knowing({r["word"]: r["n"] for r in known.collect()}, total)
    rows = texts.mapInArrow(tidy(_hit_rows(language, chosen)), "toxic int, hits array<int>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["hits"]))
    bias, w = fit(np.array([r["toxic"] for r in rows]), [r["hits"] for r in rows], len(chosen))
    drop_written(given, counts)
    return Model(language, bias, {c: float(x) for c, x in zip(chosen, w, strict=True) if abs(x) > 1e-3})


def _scores(sent):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]):
        score = sent.value.scorer()
        for b in batches:
            yield batch(schema, b.column("doc_id"), [score(t.as_py()) for t in b.column("text")])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted, one row for each row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))
    out = documents(docs).mapInArrow(tidy(_scores(sent)), "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.5, sample: int = 20_000) -> DataFrame:
    """The documents that score below cut, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]):
        score = sent.value.scorer()
        for b in batches:
            yield b.filter(pa.array([score(t or "") < cut for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
