"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs the labelers,
and a span classifier trained on the result decides.

Base kinds (email, ip, card, phone) are found by fixed patterns and always reported. Candidates are these spans and, by
looser patterns, local phone numbers, national ids, bank accounts and names. Labelers vote 1, 0 or abstain: two by
regular expression, one by gazetteer, two by context. What leaves the executors is a count for each combination of kind,
votes and features, all of small fixed ranges (at most COMBINATIONS), over every span of the corpus. From these counts:

* expectation-maximisation (a two-class latent model: for each kind a prior, and how each labeler votes on either class)
  gives each vote pattern a probability;
* a logistic regression on features, trained on those probabilities, is the span classifier. Its features say more than
  the votes do: the bucket of the word before, what touches the span on either side, length and share of digits, each by
  kind; so it learns from spans the labelers know where others of that kind stand.

A looser candidate is reported if the classifier gives it at least `cut` and it overlaps no base span and no candidate
of an earlier kind. All kinds are swept in order of place, so time grows with the text alone. Places are code points,
end exclusive. Cases: null and empty texts have no span; repeated rows have the same spans, and count each in training;
a null doc_id stays null; a corpus without candidates trains nothing and reports base spans alone; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import batch, documents, tidy

KINDS = ("email", "ip", "card", "phone", "local", "national", "account", "name")
BASE = 4

# Patterns of the base kinds. A run of digits is tried from its start alone, which finds the same.
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
DIGIT = re.compile(r"[0-9]")

# The looser candidates.
LOCAL = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Capital and small letters of the Latin, Greek and Cyrillic blocks; a name is two words, each of parts with hyphens.
_CAPITAL, _SMALL = ("".join(c for c in map(chr, range(0x530)) if of(c) and c.isalpha()) for of in (str.isupper, str.islower))
_PART = f"[{_CAPITAL}][{_SMALL}]++"
NAME = re.compile(rf"(?<![^\W_])(?<!-){_PART}(?:-{_PART})*+ {_PART}(?:-{_PART})*+(?![^\W_])")

# Gazetteers and context words.
GIVEN = frozenset("James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen Christopher Daniel Nancy Matthew Anthony Margaret Steven Andrew Paul Joshua Kenneth Kevin Brian George Edward Hans Jürgen Klaus Wolfgang Sabine Ursula Monika Petra Jean Pierre Michel Philippe Nathalie Isabelle Sylvie Catherine Jose Antonio Manuel Francisco Carmen Dolores Pilar".split())
DOMAINS = frozenset("com org net edu gov info biz io de fr es uk eu ch at it nl be us ca".split())
ACCOUNT_LANDS = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
CONTEXT = {
    "email": "mail contact write reach".split(),
    "ip": "ip address host server".split(),
    "card": "card visa master credit payment".split(),
    "phone": "phone tel call mobile fax".split(),
    "local": "phone tel call mobile fax".split(),
    "national": "ssn social security id".split(),
    "account": "iban account bank".split(),
    "name": "name mr mrs ms dr herr frau monsieur madame señor señora".split(),
}
AGAINST = "version example sample test isbn section figure table chapter order".split()
ABOUT = 30  # characters before a span that are its context
WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 16  # of the word before a span
#: Kinds, votes, lengths, shares of digits, what touches either side, words before.
COMBINATIONS = len(KINDS) * 2**5 * 4 * 3 * 3 * 3 * BUCKETS


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        if m := DOMAIN.match(text, at + 1):
            start = at
            while start > end and text[start - 1] in LOCAL_PART:
                start -= 1
            if start < at:
                out.append((0, start, m.end()))
                end = m.end()
                at = text.find("@", end)
                continue
        at = text.find("@", at + 1)
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def clear_of(taken: list[tuple[int, int]], found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of found that overlap nothing taken; both in order of place, taken without overlaps."""
    out, k = [], 0
    for s, e in found:
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if k == len(taken) or e <= taken[k][0]:
            out.append((s, e))
    return out


def candidate_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The looser candidates that overlap no base span and, in the order of kinds, no earlier candidate."""
    digits = DIGIT.search(text)
    found = [(kind, [m.span() for m in p.finditer(text)]) for kind, p in ((4, LOCAL), (5, NATIONAL), (6, ACCOUNT), (7, NAME)) if digits or p is NAME]
    out, taken = [], []
    if any(spans for _, spans in found):
        for s, e in sorted((s, e) for _, s, e in base):
            if taken and s < taken[-1][1]:
                taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
            else:
                taken.append((s, e))
    for kind, spans in found:
        if spans := clear_of(taken, spans):
            out += [(kind, *x) for x in spans]
            taken = sorted(taken + spans)
    return out


def _checksum(value: str) -> bool:
    """Of a bank account number: the remainder by 97 of its letters as numbers, the first four characters last."""
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _side(c: str) -> int:
    """What touches a span: nothing or space, a mark, or a letter or digit."""
    return 0 if not c.strip() else 2 if c.isalnum() else 1


def votes_and_features(text: str, kind: int, start: int, end: int) -> tuple[str, str]:
    """A character 1, 0 or - of each labeler; and of each feature one that stands for a small number."""
    value, name = text[start:end], KINDS[kind]
    near_words = [w.lower() for w in WORD.findall(text[max(0, start - ABOUT) : start])]
    before = set(near_words)
    near, against = any(w in before for w in CONTEXT[name]), any(w in before for w in AGAINST)
    digits = sum(c.isdigit() for c in value)
    # by regular expression: the strict form of the kind; and clean edges
    strict = {"email": value.count("@") == 1 and ".." not in value, "ip": not value.startswith("0."), "card": True, "phone": digits >= 10, "local": "(" in value, "national": not value.startswith(("000", "666", "9")), "account": kind == 6 and _checksum(value), "name": False}[name]
    left, right = _side(text[start - 1 : start]), _side(text[end : end + 1])
    apart = left < 2 and right < 2
    # by gazetteer
    if name == "email":
        listed = "1" if value.rpartition(".")[2].lower() in DOMAINS else "0"
    elif name == "name":
        listed = "1" if GIVEN.intersection(value.split()[0].split("-")) else "0"
    elif name == "account":
        listed = "1" if value[:2] in ACCOUNT_LANDS else "0"
    else:
        listed = "-"
    votes = ("1" if strict else "0" if name in ("account", "national", "ip") else "-") + ("-" if apart else "0") + listed + ("1" if near else "-") + ("0" if against else "-")
    length, share = min(3, (end - start) // 8), min(2, 3 * digits // (end - start))
    word = zlib.crc32(near_words[-1].encode("utf-8", "replace")) % (BUCKETS - 1) + 1 if near_words else 0
    return votes, "".join(chr(48 + x) for x in (kind, strict, apart, int(listed == "1"), int(listed == "0"), near, against, length, share, left, right, word))


def _count_rows(batches: Iterator[pa.RecordBatch]):
    schema = pa.schema([("votes", pa.string()), ("features", pa.string()), ("n", pa.int64())])
    for b in batches:
        found: Counter = Counter()
        for text in b.column("text"):
            text = text.as_py()
            base = base_spans(text)
            for span in base + candidate_spans(text, base):
                found[votes_and_features(text, *span)] += 1
        if found:
            yield batch(schema, [v for v, _ in found], [f for _, f in found], list(found.values()))


#: What is believed of a labeler before any data, as counts: how often it abstains, says 0 and says 1 of spans that are
#: no personal data, and of spans that are.
BELIEF = np.array([[10.0, 8.0, 2.0], [10.0, 2.0, 8.0]])


def reliabilities(kinds: np.ndarray, votes: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM over counted vote patterns (1, 0, -1 for none): each pattern's probability to be personal data, and the share
    of each labeler's votes that are right. A labeler has a distribution of its votes for either class of each kind, as
    one may know few of a kind's spans and yet be sure of those, and abstaining tells something too."""
    patterns, at = np.unique(np.column_stack([kinds, votes]), axis=0, return_inverse=True)
    at, n = at.ravel(), np.bincount(at.ravel(), n, len(patterns))
    kind, said, labelers = patterns[:, 0], patterns[:, 1:] + 1, np.arange(votes.shape[1])
    given = np.broadcast_to(BELIEF, (len(KINDS), len(labelers), 2, 3)).copy()
    prior, p = np.full(len(KINDS), 0.5), np.full(len(n), 0.5)
    for _ in range(rounds):
        share = np.log(given / given.sum(3, keepdims=True))
        of = share[kind[:, None], labelers, :, said]  # pattern, labeler, class
        p = 1 / (1 + np.exp(-(np.log(prior / (1 - prior))[kind] + (of[:, :, 1] - of[:, :, 0]).sum(1))))
        given = np.broadcast_to(BELIEF, given.shape).copy()
        for k, weight in enumerate(((1 - p) * n, p * n)):
            np.add.at(given[:, :, k], (kind[:, None], labelers, said), weight[:, None])
        prior = np.clip((np.bincount(kind, p * n, len(KINDS)) + 10) / (np.bincount(kind, n, len(KINDS)) + 20), 0.05, 0.95)
    right = given[:, :, 0, 1].sum(0) + given[:, :, 1, 2].sum(0)
    return p[at], right / given[:, :, :, 1:].sum((0, 2, 3))


#: Of each feature, how many values it has; and whether its weight is one for all kinds.
_RANGES = (len(KINDS), 2, 2, 2, 2, 2, 2, 4, 3, 3, 3, BUCKETS)
_SHARED = 7


def _columns(features: list[str]) -> np.ndarray:
    """The numbers of the weights that count for each combination of features."""
    f = np.array([[ord(c) - 48 for c in x] for x in features]).reshape(-1, len(_RANGES))
    out, at = [], 0
    for i, size in enumerate(_RANGES):
        out.append(at + f[:, i] if i < _SHARED else at + f[:, 0] * size + f[:, i])
        at += size if i < _SHARED else size * len(KINDS)
    return np.stack(out, 1)


WEIGHTS = sum(_RANGES[:_SHARED]) + len(KINDS) * sum(_RANGES[_SHARED:])


class Classifier:
    """A probability for each combination of features, from one weight for each of its columns; without weights, 0."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights, self.known = weights, {}

    def __call__(self, features: str) -> float:
        if self.weights is None:
            return 0.0
        if (p := self.known.get(features)) is None:
            p = self.known[features] = float(1 / (1 + np.exp(-self.weights[_columns([features])[0]].sum())))
        return p


def train(rows: list[tuple[str, str, int]], steps: int = 500) -> Classifier:
    """From (votes, features, count)."""
    if not rows:
        return Classifier()
    features = [f for _, f, _ in rows]
    n = np.array([c for *_, c in rows], float)
    votes = np.array([[{"1": 1, "0": 0}.get(c, -1) for c in v] for v, *_ in rows])
    p, _ = reliabilities(np.array([ord(f[0]) - 48 for f in features]), votes, n)
    columns, w = _columns(features), n / n.sum()
    weights, flat = np.zeros(WEIGHTS), columns.ravel()
    scale = 1 / np.sqrt(np.bincount(flat, np.repeat(w, columns.shape[1]), WEIGHTS) + 1e-3)  # rare features learn as fast as frequent ones
    for _ in range(steps):  # gradient descent on the expected log loss with a small ridge
        q = 1 / (1 + np.exp(-weights[columns].sum(1)))
        g = np.bincount(flat, np.repeat(w * (q - p), columns.shape[1]), WEIGHTS)
        weights -= 0.1 * scale * (g + 1e-4 * weights) * scale
    return Classifier(weights)


def classifier(docs: DataFrame) -> Classifier:
    """Learned from all candidate spans of docs; only counts of combinations reach the driver."""
    rows = documents(docs).select("text").mapInArrow(tidy(_count_rows), "votes string, features string, n long").groupBy("votes", "features").agg(F.sum("n").alias("n"))
    return train(sorted((r["votes"], r["features"], r["n"]) for r in rows.collect()))


def all_spans(text: str, known: Classifier, cut: float) -> tuple[list, list]:
    base = base_spans(text)
    extra = [s for s in candidate_spans(text, base) if known(votes_and_features(text, *s)[1]) >= cut]
    return base, sorted(base + extra)


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _found(known: Classifier, cut: float):
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS[:BASE]), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            rows = []
            for text in b.column("text"):
                base, every = all_spans(text.as_py(), known, cut)
                n = Counter(k for k, *_ in base)
                rows.append((*(n[k] for k in range(BASE)), hashlib.sha256(_said(base).encode()).hexdigest(), _said(every)))
            if rows:
                yield batch(schema, b.column("doc_id"), *zip(*rows, strict=True))

    return run


def pii_spans(docs: DataFrame, cut: float = 0.5) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end), one row for each row of docs."""
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return documents(docs).mapInArrow(tidy(_found(classifier(docs), cut)), schema)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span as its kind in angle brackets; of overlapping spans, the first and longest."""
    out, at = [], 0
    for s, e, k in sorted((s, -e, k) for k, s, e in spans):
        if s >= at:
            out += text[at:s], f"<{KINDS[k].upper()}>"
            at = -e
        elif -e > at:
            at = -e
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame, cut: float = 0.5, length: str | None = "n_chars") -> DataFrame:
    """docs with personal data in `text` masked and its length in code points set; all other columns as they are."""
    known = classifier(docs)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = [None if t is None else masked(t, all_spans(t, known, cut)[1]) for t in b.column("text").to_pylist()]
            i = b.schema.get_field_index("text")
            b = b.set_column(i, b.schema.field(i), pa.array(texts, b.schema.field(i).type))
            if length in b.schema.names:
                i = b.schema.get_field_index(length)
                b = b.set_column(i, b.schema.field(i), pa.array([None if t is None else len(t) for t in texts], b.schema.field(i).type))
            yield b

    return docs.mapInArrow(tidy(run), docs.schema)
