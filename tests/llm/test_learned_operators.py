"""Personal data, toxicity, and the pipeline."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as fn
from conftest import TESTDATA
from fixtures import TEXTS, awkward, by_id, empty

import corpus_pipeline
from twinfold.llm import pii, toxicity

PRIVATE = [
    "é a@b.co, a@b.c@d.e @x.y ..@-.- u@v 1.2.3.4.5.6.7.8 256.1.1.1 0001.1.1.255 99999999999.1.1.1",
    "+1 (926) 555-1234, 4111-1111 1111 1111 +123 4 +1234567890123456 4111111111111112 4012888888881881",
    "call 555-123-4567 now; ssn 123-45-6789, iban DE89 3704 0044 0532 0130 00",
    "Dear Mr Michael Smith wrote; Section Example text",
    "1" * 3000 + "." + "2" * 3000,
]


def brute_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    found += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return found + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]


def test_pii_base_spans_stay(spark):
    texts = [*TEXTS, *PRIVATE]
    got = by_id(pii.pii_spans(awkward(spark, texts)))
    for i, text in enumerate(texts):
        base = brute_base(text or "")
        said = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        r = got[i]
        assert [r[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(x[0] == k for x in base) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest() and set(said.split(",")) - {""} <= set(r["spans"].split(","))
    assert "national:" in got[len(TEXTS) + 2]["spans"] and "account:" in got[len(TEXTS) + 2]["spans"]
    assert pii.pii_spans(empty(spark)).count() == 0


def bank_account(rng, right):
    body = "".join(str(rng.integers(10)) for _ in range(18))
    check = 98 - int(body + "131400") % 97  # DE00
    return f"DE{check if right else (check + 7) % 97:02d} " + " ".join(body[i : i + 4] for i in range(0, 18, 4))


def labelled(rng, n):
    """Texts with the spans of personal data in them, and lookalikes that are none."""
    d = lambda k: "".join(str(rng.integers(10)) for _ in range(k))
    pick = lambda x: str(rng.choice(x.split()))
    family = "Klein Müller García Ångström Smith Novák Rossi Şahin"
    texts, truth = [], []
    for _ in range(n):
        text, spans = "", []
        for _ in range(6):
            text += " ".join(rng.choice("the of when a stone river runs over green hills".split(), int(rng.integers(4, 9)))) + " "
            kind, right = int(rng.integers(4, 8)), rng.random() < 0.6
            if kind == 4:
                lead, value = (pick("phone call tel mobile fax"), f"({d(3)}) {d(3)}-{d(4)}" if rng.random() < 0.5 else f"{d(3)}-{d(3)}-{d(4)}") if right else (pick("version order section table"), f"{d(3)}.{d(3)}.{d(4)}")
            elif kind == 5:
                lead, value = (pick("ssn social security"), f"{rng.integers(100, 600)}-{d(2)}-{d(4)}") if right else (pick("isbn version chapter"), f"{pick('000 666 9' + d(2))}-{d(2)}-{d(4)}")
            elif kind == 6:
                account = bank_account(rng, right)
                lead, value = (pick("iban account bank"), account) if right else (pick("sample test example"), "XQ" + account[2:])
            else:
                lead, value = (pick("mr mrs herr frau madame"), f"{pick('Jürgen Sabine Maria-Petra Anna Piotr José Olga Hans')} {pick(family)}") if right else (pick("section figure example table"), f"{pick('Apache General Stone Upper')} {pick('License Public River Hills')}")
            text += lead + " "
            if right and not pii.base_spans(value):  # a tenth of the accounts hold a card number
                spans.append((kind, len(text), len(text) + len(value)))
            text += value + ", "
        texts.append(text)
        truth.append(spans)
    return texts, truth


def test_added_kinds_are_found_and_nothing_else(spark):
    """Recall and precision of each added kind on texts with known spans."""
    texts, truth = labelled(np.random.default_rng(3), 600)
    got = by_id(pii.pii_spans(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(4)))
    want = {(i, f"{pii.KINDS[k]}:{s}:{e}") for i, spans in enumerate(truth) for k, s, e in spans}
    found = {(i, x) for i, r in got.items() for x in r["spans"].split(",") if x}
    for kind in pii.KINDS[4:]:
        w, f = ({x for x in y if x[1].startswith(kind)} for y in (want, found))
        assert len(w) > 100 and len(w & f) >= 0.95 * len(w) and len(w & f) >= 0.95 * len(f), (kind, len(w), len(f), len(w & f))


def test_classifier_learns_what_no_labeler_says():
    """After a word on no list the gazetteer knows half of the names: the others there gain, and stand out from titles."""
    texts = labelled(np.random.default_rng(4), 200)[0]
    texts += [f"so said {g} {f} and left" for g in ("Hans", "Thomas", "Sabine", "Olga", "Piotr", "Ivana") for f in ("Klein", "Rossi", "Novák")] * 10
    texts += [f"under the {a} {b} as is" for a in ("Apache", "General", "Upper") for b in ("License", "Public", "River")] * 20
    rows = {}
    for t in texts:
        for x in pii.candidate_spans(t, pii.base_spans(t)):
            vf = pii.votes_and_features(t, *x)
            rows[vf] = rows.get(vf, 0) + 1
    known = pii.train(sorted((v, f, n) for (v, f), n in rows.items()))
    p = lambda t: known(pii.votes_and_features(t, *pii.candidate_spans(t, [])[0])[1])
    assert p("so said Hans Klein and left") > 0.5 and p("under the Apache License as is") < 0.5
    assert p("so said Olga Rossi and left") > p("under the Olga Rossi as is")


def test_spans_of_names_and_marks_in_linear_time():
    import time

    text = ("Hans Klein 555-123-4567 a@b.co " * 70_000)[:2_000_000]
    began = time.perf_counter()
    base, every = pii.all_spans(text, pii.Classifier(np.full(pii.WEIGHTS, 1.0)), 0.5)
    assert len(base) > 60_000 and len(every) > 190_000 and time.perf_counter() - began < 30
    brute = [(0, 3), (2, 9), (12, 14)]
    assert pii.clear_of([(0, 9), (12, 14)], [(1, 2), (8, 10), (9, 12), (13, 20), (14, 15)]) == [(9, 12), (14, 15)]
    assert pii.candidate_spans("x" * 20, brute) == []


def test_names_of_all_languages():
    text = "Jürgen Klein, Anna-Lena Müller; José García. Élodie Ångström x-Anna Bell McDonald Old, Иван Петров"
    assert [text[s:e] for _, s, e in pii.candidate_spans(text, [])] == ["Jürgen Klein", "Anna-Lena Müller", "José García", "Élodie Ångström", "Иван Петров"]


def test_mask(spark):
    docs = awkward(spark, ["write a@b.co or +1 (926) 555-1234 é", None, "nothing"])
    out = {r["doc_id"]: r for r in pii.mask_pii(docs).collect()}
    assert out[0]["text"] == "write <EMAIL> or <PHONE> é" and out[0]["n_chars"] == len(out[0]["text"])
    assert out[1]["text"] is None and out[1]["n_chars"] is None and out[2]["text"] == "nothing"
    assert pii.masked("0123456789", [(0, 2, 5), (1, 4, 7), (2, 8, 9)]) == "01<EMAIL>7<CARD>9"


def test_em_finds_the_planted_reliabilities():
    rng = np.random.default_rng(1)
    truth, accuracy = rng.random(20_000) < 0.4, np.array([0.9, 0.75, 0.6])
    votes = np.where(rng.random((20_000, 3)) < accuracy, truth[:, None], ~truth[:, None]).astype(int)
    p, got = pii.reliabilities(np.zeros(20_000, int), votes, np.ones(20_000), 200)
    assert np.abs(got - accuracy).max() < 0.06 and ((p > 0.5) == truth).mean() > 0.85


def test_decoding():
    words = ["idiot"] * 60 + ["stupid"] * 60 + "the that and this with trash moron loser then tree letter silly still".split() * 10
    grams = {}
    for w in words:
        w = f"  {w} "
        for i in range(len(w) - 2):
            grams[w[i : i + 3]] = grams.get(w[i : i + 3], 0) + 1
    model = toxicity.LanguageModel(grams)
    for seen, meant in {"1d10t": "idiot", "idi0t": "idiot", "stuuupid": "stupid", "5tup1d": "stupid", "tr@sh": "trash", "m0r0n": "moron", "l0$er": "loser", "letter": "letter"}.items():
        assert model.decode(seen) == meant
    found = toxicity.restorer(model)("You i d i o t, s.t.u.p.i.d 1d10t!")
    assert {"you", "idiot", "stupid"} <= found


def test_letters_beyond_the_alphabet_are_one():
    model = toxicity.LanguageModel({"  \ufffd": 3, " \ufffd\ufffd": 2})
    assert model.log_p(" ", " ", "漢") == model.log_p(" ", " ", "字") and model.decode("漢字") == "漢字"


def test_letters_three_times_in_a_row():
    assert toxicity.tripled("a bééé") and toxicity.tripled("xyyyz") and not toxicity.tripled("aab  c 0000 ... éé") and not toxicity.tripled("")


def grams_of(words):
    grams = {}
    for w in words:
        w = f"  {w} "
        for i in range(len(w) - 2):
            grams[w[i : i + 3]] = grams.get(w[i : i + 3], 0) + 1
    return grams


def test_trigrams_equal_plain_counts():
    words, n = ["idiot", "a", "éß", "stuuupid", "漢字", "ab", "abab"], [3, 5, 2, 7, 1, 4, 2**40]
    got = toxicity.word_trigrams(words, np.array(n))
    want = grams_of([])
    for w, k in zip(words, n, strict=True):
        if len(w) > 1 and w != "stuuupid":
            w = "  " + w.replace("漢", "\ufffd").replace("字", "\ufffd") + " "
            for i in range(len(w) - 2):
                want[w[i : i + 3]] = want.get(w[i : i + 3], 0) + k
    assert got == want and toxicity.word_trigrams([], np.zeros(0, np.int64)) == {}


def test_words_of_any_length():
    model = toxicity.LanguageModel(grams_of(["idiot"] * 60 + ["stupid"] * 60 + "the that and this with trash moron loser worthless then tree letter silly still".split() * 10))
    found = toxicity.restorer(model)
    for seen, meant in {"st" + "u" * 35 + "pid": "stupid", "id1" + "o" * 30 + "t": "idiot", "1d" + "i" * 500 + "0t": "idiot", "stup1d_m0r0n_l0ser_w0rthless_tr4sh": "stupid moron loser worthless trash"}.items():
        assert set(meant.split()) <= found(f"you {seen}, the"), seen
    assert model.decode("1d10t_" * 5_000).split() == ["idiot"] * 5_000


def test_letters_set_apart_begin_words_anywhere():
    words = {w: 60 for w in "idiot stupid moron loser worthless".split()} | {w: 10 for w in "the that and this with man".split()}
    trigrams = grams_of([w for w, n in words.items() for _ in range(n)]) | {"  a": 200, " a ": 150}
    for model in (toxicity.LanguageModel(trigrams, words | {"a": 150}), toxicity.LanguageModel(trigrams)):
        found = toxicity.restorer(model)
        for seen in ("s t u p ! d", "$ t u p i d", "s  t  u  p  i  d", "s t * p i d", "(s.t.u.p.i.d)", "s t u u u u p i d", "s t u p i d!", "s - t - u - p - i - d", "s/t/u/p/i/d", "s,t,u,p,i,d", "s;t;u;p;i;d", "s~t~u~p~i~d", "s·t·u·p·i·d", "'s' 't' 'u' 'p' 'i' 'd'", "#s#t#u#p#i#d#"):
            assert "stupid" in found(f"the {seen} man"), seen
        assert {"idiot", "stupid"} <= found("1 d i o t   s t u p i d")
    found = toxicity.restorer(toxicity.LanguageModel(trigrams, words | {"a": 150}))
    assert {"a", "stupid"} <= found("this a s t u p i d man")
    assert {"idiot", "stupid"} <= found("i d i o t s t u p i d")
    assert {"moron", "worthless", "stupid", "loser"} <= found("-".join("moronworthlessstupidloser"))
    told = toxicity.restorer(toxicity.LanguageModel(trigrams).knowing({w: 60 for w in "idiot stupid moron loser worthless".split()}, 1000))
    assert {"stupid"} <= told("this a s t u p i d man") and {"idiot", "stupid"} <= told("i d i o t s t u p i d")
    assert {"moron", "worthless", "stupid", "loser"} <= told("/".join("moronworthlessstupidloser"))
    assert toxicity.set_apart("1 2 3 4, 5") == [] and toxicity.set_apart("a b c  d") == ["abc d"]


def test_language_model_counts_whole_words(spark):
    model = toxicity.language_model(awkward(spark, ["ab" * 30 + "xyz"]))
    assert model.three["xyz"] == 1 and model.three["yz "] == 1
    long = "x" + "ab" * 80
    model = toxicity.language_model(awkward(spark, [long, "see a man"]))
    assert model.three["  x"] == 1 and model.three["aba"] == 79 and model.three["man"] == 1


def test_disguised_words():
    assert toxicity.disguised("a 1d10t x, plain 2024 and s t u p i d") == ["1d10t", "stupid"]
    assert toxicity.disguised("") == [] and toxicity.disguised("| | |") == []


LABELS = "doc_id long, toxic int, quality int, text string, source string"


def corpus(spark):
    rng = np.random.default_rng(7)
    plain = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    texts, labels = [], []
    for i in range(400):
        words = list(rng.choice(plain, 40))
        if i % 4 == 0:
            for _ in range(3):
                words.insert(int(rng.integers(40)), ["idiot", "1diot", "i d i o t", "idiooot"][int(rng.integers(4))])
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_toxicity_on_held_out_documents(spark):
    texts, labels = corpus(spark)
    frame = spark.createDataFrame([(i, y, 1, "x", "y") for i, y in enumerate(labels) if i % 10], LABELS)
    got = by_id(toxicity.toxicity(awkward(spark, [*texts, None, "", "é"]), frame))
    assert len(got) == len(texts) + 3 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    right = [got[i]["predicted"] == y for i, y in enumerate(labels) if got[i]["held_out"]]
    assert np.mean(right) > 0.97 and got[len(texts)]["predicted"] == 0
    left = toxicity.without_toxic(awkward(spark, texts), frame)
    assert left.columns == awkward(spark).columns and left.count() < 320


def test_held_out_documents_of_the_tables(spark):
    """Accuracy, recall and ranking on labels that the model has not seen. About a tenth of the documents labelled toxic
    are missed: labels are noisy, and but for one they hold no toxic word, plain or disguised."""
    d = f"{TESTDATA}/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").where("toxic is not null")
    got = by_id(toxicity.toxicity(spark.read.parquet(f"{d}/documents.parquet"), labels))
    held = [(got[r["doc_id"]], r["toxic"]) for r in labels.collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    bad, good = ([r["score"] for r, y in held if y == k] for k in (1, 0))
    assert len(bad) > 50 and len(good) > 500
    right, caught, clean = np.mean([r["predicted"] == y for r, y in held]), np.mean([s >= 0.5 for s in bad]), np.mean([s < 0.5 for s in good])
    above = np.mean([a > b for a in bad for b in good])
    telling = {"idiot", "stupid", "moron", "loser", "trash", "scum", "worthless", "pathetic"}
    model = toxicity.language_model(spark.read.parquet(f"{d}/documents.parquet")).knowing(dict.fromkeys(telling, 100), 100_000)
    missed = [r["doc_id"] for r, y in held if y and r["score"] < 0.5]
    texts = spark.read.parquet(f"{d}/documents.parquet").where(fn.col("doc_id").isin(missed)).select("text").collect()
    restored = toxicity.restorer(model)
    assert len(texts) == len(missed) and sum(bool(restored(r["text"]) & telling) for r in texts) <= 1
    assert min(right, clean) > 0.98 and caught > 0.85 and above > 0.9, (right, caught, clean, above)


def test_held_out_labels_are_not_learned(spark):
    texts, labels = corpus(spark)
    rows = [(i, y, 1, "x", "y") for i, y in enumerate(labels)]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, *r) for i, y, *r in rows]
    a, b = (by_id(toxicity.toxicity(awkward(spark, texts), spark.createDataFrame(x, LABELS))) for x in (rows, turned))
    assert a == b


@pytest.mark.parametrize("labels", [[], [(0, 1, 1, "", "")], [(0, None, 1, "", "")]])
def test_toxicity_without_labels_of_both_kinds(spark, labels):
    assert toxicity.toxicity(awkward(spark), spark.createDataFrame(labels, LABELS)).count() == len(TEXTS) + 1
    assert toxicity.toxicity(empty(spark), spark.createDataFrame(labels, LABELS)).count() == 0


def test_pipeline(spark):
    """Each stage against a plain computation over its own input, texts and all."""
    from test_text_operators import brute_components, brute_scan
    from tokenizers import Tokenizer

    from twinfold.llm.tokens import default_path

    d, columns = f"{TESTDATA}/sf0.001", ["doc_id", "text", "lang", "source", "n_chars"]
    docs, held = spark.read.parquet(f"{d}/documents.parquet"), {}
    stages, items = dict(corpus_pipeline.STAGES), [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "pii", "packing"]

    def rows(frame):
        return {r["doc_id"]: tuple(r) for r in frame.select(columns).collect()}

    before = rows(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, d))
        assert docs.columns == columns
        held[name] = before, rows(docs)
        before = held[name][1]

    old, new = held["toxicity"]
    scores = by_id(toxicity.toxicity(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")))
    assert new == {i: r for i, r in old.items() if scores[i]["predicted"] == 0}
    old, new = held["near_duplicates"]
    ids = sorted(old)
    _, labels = brute_components([old[i][1] for i in ids], 5, 80)
    assert new == {i: old[i] for k, i in enumerate(ids) if labels[k] == k} and len(new) < len(old)
    old, new = held["decontamination"]
    assert new == {i: r for (i, r), found in zip(old.items(), brute_scan([r[1] for r in old.values()], items), strict=True) if not found[3]}
    old, new = held["pii"]
    spans = by_id(pii.pii_spans(spark.createDataFrame(list(old.values()), docs.schema)))
    names, hidden = {k: i for i, k in enumerate(pii.KINDS)}, 0
    for i, (_, text, lang, source, n_chars) in old.items():
        found = [(names[k], int(s), int(e)) for k, s, e in (x.split(":") for x in spans[i]["spans"].split(",") if x)]
        assert {(k, s, e) for k, s, e in brute_base(text or "")} <= set(found)
        merged = []  # spans that overlap are hidden as one, by the kind of the first and longest
        for k, s, e in sorted(found, key=lambda x: (x[1], -x[2], x[0])):
            if merged and s < merged[-1][2]:
                merged[-1][2] = max(e, merged[-1][2])
            else:
                merged.append([k, s, e])
        for k, s, e in reversed(merged):
            text, hidden = text[:s] + f"<{pii.KINDS[k].upper()}>" + text[e:], hidden + 1
        assert new[i] == (i, text, lang, source, None if text is None else len(text))
    assert hidden and new.keys() == old.keys()

    packed = {}
    for r in stages["packing"](spark, docs, d).collect():
        packed.setdefault(r["doc_id"], []).append(r)
    library = Tokenizer.from_file(default_path())
    for i, r in new.items():
        x = np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(packed[i], key=lambda p: p["piece"])
        assert [p["start"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces)])[:-1].tolist() and sum(p["length"] for p in pieces) == len(x)
        assert all(p["ids_crc32"] == zlib.crc32(x[p["start"] : p["start"] + p["length"]].tobytes()) for p in pieces)
    assert packed.keys() == new.keys()
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_applies_the_stages_in_order(spark, monkeypatch):
    stages = [("even", lambda spark, docs, d: docs.where("doc_id % 2 = 0")), ("half", lambda spark, docs, d: docs.withColumn("n_chars", (docs.doc_id / 2).cast("long"))), ("last", lambda spark, docs, d: docs.where("n_chars < 10").select("doc_id", "n_chars"))]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    assert sorted(map(tuple, corpus_pipeline.run(spark, f"{TESTDATA}/sf0.001").collect())) == [(2 * i, i) for i in range(10)]


def test_labels_that_contradict_each_other_are_not_learned(spark):
    texts, labels = corpus(spark)
    rows = [(i, y, 1, "x", "y") for i, y in enumerate(labels) if i % 3]
    both = rows + [(i, y, 1, "x", "y") for i in range(0, 400, 3) for y in (0, 1)] + rows[:50] + [(None, 1, 1, "", "")]
    a, b = (by_id(toxicity.toxicity(awkward(spark, texts), spark.createDataFrame(x, LABELS))) for x in (rows, both))
    assert a == b


def test_pipeline_of_nothing(spark, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{TESTDATA}/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
