"""Token files, packing and counts against the library and brute force."""

import zlib
from functools import lru_cache

import numpy as np
import pytest
from fixtures import TEXTS, awkward, by_id, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from twinfold.llm import frame_blocks
from twinfold.llm.pattern_packing import best_fit, fit, pattern_packing, patterns, plan, rounded, sequences
from twinfold.llm.token_counts import read_scores, token_counts, trie_counts
from twinfold.llm.token_output import token_output
from twinfold.llm.tokens import Encoder, default_path, pretokens


@lru_cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def ids(text):
    return np.array(library().encode(text or "", add_special_tokens=False).ids + [0], "<u4")


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=3000), st.sampled_from([64, 1024]), st.floats(0.01, 1.0))
@settings(max_examples=60, deadline=None)
def test_file_format_round_trip(values, block, percentile):
    x = np.array(values, np.uint32)
    reader = frame_blocks.Reader(frame_blocks.encode([5, -7], [len(x) // 3, len(x) - len(x) // 3], x, block, percentile))
    assert (reader.all() == x).all() and reader.doc_ids.tolist() == [5, -7]
    a, b = len(x) // 4, len(x) // 2
    assert (reader.range(a, b) == x[a:b]).all()


def test_a_wrong_file_is_refused():
    with pytest.raises(ValueError):
        frame_blocks.Reader(b"nothing of that kind")


@given(st.text(st.characters(codec="utf-8"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_encoder_equals_the_library(text):
    assert encoder().encode(text) == ids(text)[:-1].tobytes()


@lru_cache
def encoder():
    return Encoder(default_path())


def test_encoder_forgets_without_harm(monkeypatch):
    from twinfold.llm import tokens

    monkeypatch.setattr(tokens, "MEMO", 3)
    own = Encoder(default_path())
    text = "many different words here, and many more words here"
    assert own.encode(text) == own.encode(text) == ids(text)[:-1].tobytes()


def test_token_output(spark):
    got, start = by_id(token_output(awkward(spark), default_path()).drop("file", "start")), {}
    rows = sorted(token_output(awkward(spark), default_path()).collect(), key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert r["start"] == at and r["doc_id"] >= start.get("before", 0)
        at, start["before"] = at + r["n_tokens"], r["doc_id"]
    assert len(rows) == len(TEXTS) + 1
    for i, text in enumerate(TEXTS):
        assert (got[i]["n_tokens"], got[i]["ids_crc32"]) == (len(ids(text)), zlib.crc32(ids(text).tobytes()))
    assert token_output(empty(spark), default_path()).count() == 0


def test_token_files_are_cut(spark, tmp_path, monkeypatch):
    from twinfold.llm import token_output

    monkeypatch.setattr(token_output, "STRIDE", 2)
    files = token_output.write_token_files(awkward(spark), f"file://{tmp_path}/ids", default_path(), file_ids=50)
    at = 0
    for r in files.orderBy("file").collect():
        assert r["start"] == at
        at += r["n_ids"]
    assert files.count() > 3
    assert sum(r["n_tokens"] for r in token_output.read_token_files(spark, f"file://{tmp_path}/ids", files).collect()) == sum(len(ids(t)) for t in [*TEXTS, TEXTS[6]])


def test_pattern_packing(spark):
    rows = pattern_packing(awkward(spark), default_path()).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], set()).add((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in enumerate(TEXTS):
        x, at = ids(text), 0
        for k, (piece, start, length, crc) in enumerate(sorted(pieces[i])):
            assert (piece, start) == (k, at) and crc == zlib.crc32(x[start : start + length].tobytes())
            assert length == 2048 or k == 0 and length < 2048
            at += length
        assert at == len(x)
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert pattern_packing(empty(spark), default_path()).count() == 0


@given(st.lists(st.integers(1, 64), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_a_plan_packs_every_piece_and_is_no_worse_than_best_fit(lengths):
    counts = np.bincount(lengths, minlength=65)
    made = plan(counts, 64)
    assert (sum((n * np.bincount(p, minlength=65) for n, p in made), np.zeros(65, int)) == counts).all()
    assert all(sum(p) <= 64 for _, p in made)
    assert sequences(made) <= sequences(best_fit(counts, 64))


def test_a_plan_of_many_pieces_is_nearly_full():
    counts = np.bincount(np.minimum(2048, np.random.default_rng(3).lognormal(6, 1, 50_000).astype(int) + 1), minlength=2049)
    least = -(-int((counts * np.arange(2049)).sum()) // 2048)
    made = plan(counts, 2048)
    found = patterns(np.flatnonzero(counts), 2048)
    fitted, _ = rounded(found, fit(found, counts), counts)
    assert sequences(made) <= least * 1.002 and made[: len(fitted)] == fitted and sequences(fitted) > 0.8 * sequences(made)


def test_patterns_fill_the_sequence():
    found = patterns(np.array([2, 3, 5, 10]), 10)
    assert {tuple(p) for p in found.tolist()} == {(10, 0, 0), (5, 5, 0), (5, 3, 2)}


def test_trie_counts_equal_plain_dynamic_programming():
    scores = read_scores(default_path("byte_bpe_50k.tiktoken"))
    parts = {p for t in TEXTS if t and len(t) < 5000 for p in pretokens()(t)} | {" " * 40, "ab" * 30, "漢字", ""}
    got = trie_counts(parts, scores)
    for p in parts:
        w, best = p.encode(), [(0.0, 0)]
        for e in range(1, len(w) + 1):
            best.append(max((best[s][0] + scores[w[s:e]], best[s][1] - 1) for s in range(e) if w[s:e] in scores))
        assert got[p] == -best[-1][1]


def test_token_counts(spark):
    path = default_path("byte_bpe_50k.tiktoken")
    got, scores, split = by_id(token_counts(awkward(spark), path)), read_scores(path), pretokens()
    for i, text in enumerate(TEXTS):
        parts = split(text or "")
        counts = trie_counts(parts, scores)
        assert (got[i]["n_pretokens"], got[i]["n_tokens"]) == (len(parts), sum(counts[p] for p in parts))
    assert token_counts(empty(spark), path).count() == 0
