"""Token counts under a unigram model by dynamic programming over a trie of distinct pre-tokens.

The best score of a prefix depends on the prefix alone, so pre-tokens with a common prefix share its forward scores.
Distinct pre-tokens are inserted in sorted order, which walks the trie depth first: only the path to the present node
is kept, and a node's score is computed once. A terminal node's count is stored for its pre-token; a document's count
is the sum over its pre-tokens.

The vocabulary is public and has ranks but no probabilities. A piece of rank r has the log-probability
-ln(r + `shift`), a Zipf law up to a constant; of equal scores the split into fewer pieces counts.

Cases: a null or empty text has 0 tokens; repeated rows count each; an empty table gives an empty result; other
columns are ignored; a null doc_id stays null. Memory: one batch of texts, at most MEMO remembered pre-tokens a worker and
those of the texts at hand (about 500,000, or one text's), whatever the corpus.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from twinfold.llm.common import batch, documents, tidy
from twinfold.llm.tokens import MEMO, pretokens


def read_scores(path: str, shift: float = 10.0) -> dict[bytes, float]:
    """Log-probabilities of the pieces of a vocabulary of ranks (a base64 piece and its rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): -math.log(int(rank) + shift) for piece, rank in map(bytes.split, f)}


def trie_counts(parts: Iterable[str], scores: dict[bytes, float]) -> dict[str, int]:
    """Pieces in the best split of each distinct pre-token. Bytes without a piece score as the worst piece does."""
    longest, worst = max(map(len, scores)), min(scores.values())
    best, count, before, out = [0.0], [0], b"", {}
    for part in sorted((p.encode(), p) for p in parts):
        word, name = part
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            top, pieces = best[end - 1] + worst, count[end - 1] + 1
            for start in range(max(0, end - longest), end):
                if (s := scores.get(word[start:end])) is not None:
                    total = best[start] + s
                    if total > top or total == top and count[start] + 1 < pieces:
                        top, pieces = total, count[start] + 1
            best.append(top)
            count.append(pieces)
        before, out[name] = word, count[len(word)]
    return out


def _counts(path: str, shift: float):
    schema = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]):
        scores, split, memo = read_scores(path, shift), pretokens(), {}
        for b in batches:
            rows: list[list[str]] = []
            out, size, ids = [], 0, b.column("doc_id")

            def flush():
                new = set().union(*rows).difference(memo)
                if len(memo) + len(new) > MEMO:
                    memo.clear()
                    new = set().union(*rows)
                memo.update(trie_counts(new, scores))
                out.extend((len(parts), sum(map(memo.__getitem__, parts))) for parts in rows)
                rows.clear()

            for text in b.column("text"):
                rows.append(split(text.as_py()))
                size += len(rows[-1])
                if size > 500_000:
                    flush()
                    size = 0
            flush()
            yield batch(schema, ids, [n for n, _ in out], [n for _, n in out])

    return run


def token_counts(docs: DataFrame, vocabulary_path: str, shift: float = 10.0) -> DataFrame:
    """doc_id, n_pretokens, n_tokens."""
    return documents(docs).mapInArrow(tidy(_counts(vocabulary_path, shift)), "doc_id long, n_pretokens long, n_tokens long")
