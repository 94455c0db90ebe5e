"""Services, export, the whole run and its jobs, against local stand-ins."""

import io
import json
import os
import re
import subprocess
import sys
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
from collections import Counter
from dataclasses import replace
from datetime import datetime, timezone
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from twinfold.functions import text, vocabulary as V
from twinfold.operators import calls, embedding, groups, verdicts
from twinfold.plans import config as C
from twinfold.plans.fixtures import triples
from twinfold.plans.jobs import JobManager, Overrides, serve
from twinfold.plans.run import run
from twinfold.sources import caches
from twinfold.sources.sparql import Endpoint, SparqlTriples, statement_log


class Letters:
    """Embeds a text as its counts of letters."""

    def embed(self, texts):
        return [[float(t.lower().count(c)) for c in "abcdefghijklmnopqrstuvwxyz0123456789"] for t in texts]


class Short:
    def embed(self, texts):
        return [[1.0]] * (len(texts) - 1)


def answering(monkeypatch, *answers):
    """Makes urlopen give these answers in turn; an exception is raised."""
    left = list(answers)

    def urlopen(request, timeout=None):
        a = left.pop(0)
        if isinstance(a, Exception):
            raise a
        return io.BytesIO(json.dumps(a).encode())

    monkeypatch.setattr(urllib.request, "urlopen", urlopen)


def error(code, **headers):
    return urllib.error.HTTPError("u", code, "m", headers, None)


def rows(*index):
    return {"data": [{"index": i, "embedding": [float(i)]} for i in index]}


def test_provider_retries_and_orders(monkeypatch):
    slept = []
    answering(monkeypatch, TimeoutError(), error(429, **{"Retry-After": "7"}), error(429), error(503), rows(1, 0))
    assert embedding.HttpEmbeddings("http://u", "k", "m", sleep=slept.append).embed(["a", "b"]) == [[0.0], [1.0]]
    assert slept == [1, 7.0, 40, 8]


def test_provider_gives_up(monkeypatch):
    answering(monkeypatch, *[error(500)] * 6)
    with pytest.raises(RuntimeError):
        embedding.HttpEmbeddings("http://u", "k", "m", sleep=lambda s: None).embed(["a"])
    answering(monkeypatch, error(401))
    with pytest.raises(urllib.error.HTTPError):
        embedding.HttpEmbeddings("http://u", "k", "m", sleep=lambda s: None).embed(["a"])
    answering(monkeypatch, rows(0))
    with pytest.raises(ValueError):
        embedding.HttpEmbeddings("http://u", "k", "m").embed(["a", "b"])


def test_equal_texts_are_embedded_once_and_then_cached(spark, tmp_path):
    people = spark.createDataFrame([("1", "A", "x"), ("2", "A", "x"), ("3", "B", None), ("4", "", "")], "iri string, name string, location string")
    seen = str(tmp_path / "seen")

    class Counting(Letters):
        def embed(self, texts):
            with open(seen, "a") as f:
                f.write("".join(f"{t!r}\n" for t in texts))
            return super().embed(texts)

    path = str(tmp_path / "cache")
    for _ in range(2):
        out = embedding.embed(people, Counting(), "m", ["name", "location"], path).collect()
    assert len(out) == 4 and sorted(open(seen).read().split("\n")[:-1]) == ["''", "'A x'", "'B'"]
    with pytest.raises(Exception, match="asked for"):
        embedding.embed(people, Short(), "m", ["name"], str(tmp_path / "other"))


def test_the_cache_is_never_shuffled(spark, tmp_path):
    path = str(tmp_path / "cache")
    people = spark.createDataFrame([(str(i), f"name{i % 150:03}") for i in range(300)], "iri string, name string")
    embedding.embed(people.where("int(iri) < 100"), Letters(), "m", ["name"], path).count()
    cache = caches.EmbeddingCache(spark, path, buckets=6)
    spark.read.parquet(cache.appended).limit(3).write.mode("append").parquet(cache.appended)  # a task that ran twice
    assert cache.base().count() == 0 and cache.rows().count() == 100
    cache.compact()
    cache.compact()
    assert cache.base().count() == cache.rows().count() == 100 and os.listdir(tmp_path / "cache") == ["base-000001-6"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = embedding.keyed(people, "m", ["name"]).select("key", "iri")
        for frame in (keys.join(cache.base(), "key"), keys.join(cache.base().select("key"), "key", "left_anti")):
            assert frame.count() in (200, 100)
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(key") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    seen = str(tmp_path / "seen")

    class Counting(Letters):
        def embed(self, texts):
            with open(seen, "a") as f:
                f.write("\n".join(texts) + "\n")
            return super().embed(texts)

    assert embedding.embed(people, Counting(), "m", ["name"], path).count() == 300
    assert sorted(open(seen).read().split()) == [f"name{i:03}" for i in range(100, 150)]
    cache.compact()
    assert cache.base().count() == 150 and os.listdir(tmp_path / "cache") == ["base-000002-6"]


class Recorder(Letters):
    """Notes each request; fails, or kills its process, at the first request that holds a certain text."""

    def __init__(self, folder, bad=None, kill=False):
        self.folder, self.bad, self.kill = str(folder), bad, kill

    def embed(self, texts):
        with open(f"{self.folder}/calls", "a") as f:
            f.write(json.dumps(texts) + "\n")
        if self.bad in texts and not os.path.exists(f"{self.folder}/failed"):
            open(f"{self.folder}/failed", "w").close()
            if self.kill:
                os._exit(1)
            raise OSError("down")
        return super().embed(texts)


def requested(folder):
    return [json.loads(x) for x in open(f"{folder}/calls")]


def test_what_was_answered_before_a_failure_is_not_asked_again(spark, tmp_path):
    people = spark.createDataFrame([(str(i), f"name{i:03}") for i in range(200)], "iri string, name string")
    ask, said, path = Recorder(tmp_path, "name150"), [], str(tmp_path / "cache")
    with pytest.raises(Exception, match="down"):
        embedding.embed(people, ask, "m", ["name"], path, batch_size=4, concurrency=2)
    held = caches.EmbeddingCache(spark, path).rows().count()
    out = embedding.embed(people, ask, "m", ["name"], path, batch_size=4, concurrency=2, say=said.append)
    assert out.count() == 200 and all(len(r["vector"]) == 36 for r in out.collect())
    sent = Counter(t for texts in requested(tmp_path) for t in texts)
    assert len(sent) == 200 and max(map(len, requested(tmp_path))) == 4
    assert sum(sent.values()) - 200 <= 2 * calls.PER_TASK * 4  # two tasks' requests
    assert said[-1].startswith("embedded batches ") and said[-1].endswith("(100 %)") and len(said) <= 10 and held % 4 == 0


KILLED = """
import sys
from pyspark.sql import SparkSession
from test_services import Recorder
from twinfold.operators import embedding
folder = sys.argv[1]
spark = SparkSession.builder.master("local[3, 4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate()
people = spark.createDataFrame([(str(i), f"name{i:03}") for i in range(100)], "iri string, name string")
assert embedding.embed(people, Recorder(folder, "name050", True), "m", ["name"], folder + "/cache", batch_size=4, concurrency=2).count() == 100
"""


def test_a_killed_task_costs_its_own_requests(tmp_path):
    """The worker dies in a request; Spark runs its task again, and no other one."""
    subprocess.run([sys.executable, "-c", KILLED, str(tmp_path)], check=True, env=os.environ, timeout=300, capture_output=True)
    sent = Counter(t for texts in requested(tmp_path) for t in texts)
    assert len(sent) == 100 and os.path.exists(tmp_path / "failed")
    assert 4 <= sum(sent.values()) - 100 <= calls.PER_TASK * 4


def test_no_more_calls_at_a_time_than_allowed(spark, tmp_path):
    class Slow(Letters):
        def embed(self, texts):
            began = time.time()
            time.sleep(0.2)
            with open(f"{tmp_path}/times", "a") as f:
                f.write(f"{began} {time.time()}\n")
            return super().embed(texts)

    people = spark.createDataFrame([(str(i), f"n{i}") for i in range(24)], "iri string, name string")
    embedding.embed(people, Slow(), "m", ["name"], str(tmp_path / "cache"), batch_size=2, concurrency=2)
    times = [tuple(map(float, x.split())) for x in open(tmp_path / "times")]
    assert len(times) == 12 and max(sum(a <= t < b for a, b in times) for t, _ in times) == 2


def test_person_cache(spark, tmp_path):
    path = str(tmp_path / "persons")
    assert caches.read_persons(spark, path).count() == 0
    (tmp_path / "persons").mkdir()
    (tmp_path / "persons" / "a.json").write_text('{"iri": "1", "name": "A", "owns": ["r"], "properties": {"p": ["v"]}}\n\n   \n')
    assert caches.read_persons(spark, path).first()["owns"] == ["r"]
    (tmp_path / "persons" / "a.json").write_text("{broken\n")
    with pytest.raises(Exception):  # noqa: B017
        caches.read_persons(spark, path).collect()


def test_payload_leaves_empty_fields_out(spark):
    from twinfold.operators import clusters

    people = spark.createDataFrame([("1", "A", [], {}, ""), ("2", "B", ["r"], {"p": ["v"]}, "l")], "iri string, name string, owns array<string>, properties map<string,array<string>>, location string")
    for c in clusters.FIELDS:
        if c not in people.columns:
            people = people.withColumn(c, F.array().cast("array<string>") if c in V.LISTS else F.lit(None).cast("string"))
    people = people.withColumn("cluster_id", F.lit(1))
    (row,) = clusters.gathered(people, clusters.described(people)).collect()
    assert (row["size"], row["names"], row["iris"]) == (2, ["A", "B"], ["1", "2"])
    out = json.loads(row["payload"])
    assert out == [{"iri": "1", "name": "A"}, {"iri": "2", "name": "B", "owns": ["r"], "location": "l", "properties": {"p": ["v"]}}]


class Moody:
    """Fails on one cluster; else names an unknown and a repeated entity."""

    def judge(self, payload):
        people = [p["iri"] for p in json.loads(payload)]
        if "bad" in people:
            raise OSError("down")
        return verdicts.Verdict([*people, people[0], "nobody"], "no" not in people, 0.75, "r")


def test_chat_adjudicator_retries(monkeypatch):
    from twinfold.sources import http

    monkeypatch.setattr(http.time, "sleep", lambda s: None)
    content = json.dumps({"entities": ["a", "b"], "is_duplicate": True, "certainty": 0.9, "reason": "r"})
    answering(monkeypatch, error(503), ConnectionError(), {"choices": [{"message": {"content": content}}]})
    got = verdicts.ChatAdjudicator("http://u", "k", "m").judge("[]")
    assert (got.entities, got.is_duplicate, got.certainty) == (["a", "b"], True, 0.9)
    answering(monkeypatch, error(401))
    with pytest.raises(urllib.error.HTTPError):
        verdicts.ChatAdjudicator("http://u", "k", "m").judge("[]")


def test_progress_is_said_in_tenths():
    said = []
    progress = calls.Tenths("judged clusters", 20, said.append)
    for i in range(21):
        progress.reached(i)
    assert said == [f"judged clusters {2 * i}/20 ({10 * i} %)" for i in range(1, 11)] and calls.percent(0, 0) == 100 and calls.percent(1, 3) == 33
    progress = calls.Tenths("x", 3, said.append)
    progress.reached(3)
    assert said[-1] == "x 3/3 (100 %)"


def test_a_cluster_of_a_million_is_counted_and_not_gathered(spark):
    from twinfold.operators import clusters

    ids = spark.range(1_000_030).select(F.col("id").alias("iri"))
    found = ids.select(F.when(F.col("iri") < 1_000_000, 0).otherwise(F.col("iri") % 2 + 1).alias("cluster_id"), "iri")
    people = ids.select("iri", F.concat(F.lit("n"), "iri").alias("name"), F.to_json(F.struct(F.col("iri").cast("string").alias("iri"))).alias("json"))
    out = clusters.gathered(found, people, 25)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    got = {r["cluster_id"]: r for r in out.collect()}
    assert tuple(got[0])[1:] == (1_000_000, ["n0", "n1", "n2"], None, None)
    assert [got[c]["size"] for c in (1, 2)] == [15, 15] and got[1]["iris"] == [str(i) for i in range(1_000_000, 1_000_030, 2)]
    assert json.loads(got[2]["payload"]) == [{"iri": str(i)} for i in range(1_000_001, 1_000_030, 2)]
    said = verdicts.judge(out, Moody())
    lines = sorted(r["line"] for r in verdicts.notices(said).collect())
    assert lines[-1] == "skipped a cluster of 1000000 persons, more than may be judged (n0, n1, n2)" and said.count() == 3


def test_verdicts_are_isolated_and_checked(spark):
    clusters = [("1", ["a", "b"]), ("2", ["bad", "c"]), ("3", ["no", "d"]), ("4", [str(i) for i in range(26)]), ("5", ["e", "gone"])]
    rows = [(c, len(iris), iris[:3], json.dumps([{"iri": i} for i in iris]) if len(iris) < 26 else None) for c, iris in clusters]
    said = verdicts.judge(spark.createDataFrame(rows, "cluster_id string, size long, names array<string>, payload string"), Moody()).cache()
    assert sorted(r["line"] for r in verdicts.notices(said).collect()) == ["no verdict on a cluster of 2 persons (bad, c): OSError: down", "skipped a cluster of 26 persons, more than may be judged (0, 1, 2)"]
    assert verdicts.counters(said).first().asDict() == {"judged": 3, "skipped_oversized": 1, "failed": 1}
    assert said.where("status = 'failed'").first()["error"] == "OSError: down"
    known = spark.createDataFrame([(x,) for x in "abcde"], "iri string")
    assert [tuple(r) for r in verdicts.accepted(said, known).collect()] == [(["a", "b"], 0.75, "r", "llm")]
    assert {(r["cluster_id"], r["iri"]) for r in verdicts.unknown(said, known).collect()} == {("1", "nobody"), ("5", "nobody"), ("5", "gone")}
    with pytest.raises(ValueError):
        verdicts.Verdict(["a"], True, 1.5, "r")


def test_text_of_literals(spark):
    frame = spark.createDataFrame([(1.0, 'a"\\\n\r'), (1e-5, "é"), (0.25, "")], "c double, t string")
    got = [tuple(r) for r in frame.select(text.decimal_text(F.col("c")), text.literal_text(F.col("t"))).collect()]
    assert got == [("1.0", '"a\\"\\\\\\n\\r"'), ("0.00001", '"é"'), ("0.25", '""')]


def test_insert_is_cut_and_empty_groups_write_nothing(spark):
    none = spark.createDataFrame([], "line string")
    assert groups.insert_statements(none, "urn:g").count() == 0
    three = spark.createDataFrame([(f"<urn:{i}> <p> <o> .",) for i in range(3)], "line string").coalesce(1)
    made = [r["statement"] for r in groups.insert_statements(three, "urn:g", most=2).collect()]
    assert len(made) == 2 and made[0].startswith("INSERT DATA { GRAPH <urn:g> {\n<urn:0>") and made[1].count("<p>") == 1
    bad = spark.createDataFrame([(["x> } ; DROP ALL #", "y"], 1.0, 'a" . } DROP', "llm")], "entities array<string>, confidence double, reason string, method string")
    lines = groups.ntriples(groups.assertion_triples(groups.identified(bad, "urn:g", F.lit("1")), F.lit("t"))).collect()
    assert any("<x%3E%20%7D%20;%20DROP%20ALL%20#>" in r["line"] for r in lines) and any('"a\\" . } DROP"' in r["line"] for r in lines)


class Store:
    """A SPARQL endpoint over persons in memory that remembers what it is asked. grow(n) is called before each answer."""

    def __init__(self):
        self.people, self.seen, self.grow, self.refuse = [f"urn:p{i:02}" for i in range(11)], [], lambda n: None, lambda q: False

    def rows(self, s):
        return [(V.RDF_TYPE, V.PERSON), ("http://schema.org/name", s[4:]), ("urn:x", 'a "b"'), ("http://schema.org/email", s[4:] + "@x.org")]

    def model(self, path, asked):
        """Equal vectors for all texts; one verdict that all persons of a cluster are one."""
        if path.endswith("/embeddings"):
            return {"data": [{"index": i, "embedding": [1.0, 2.0]} for i in range(len(asked["input"]))]}
        iris = [p["iri"] for p in json.loads(asked["messages"][1]["content"])]
        return {"choices": [{"message": {"content": json.dumps({"entities": iris, "is_duplicate": True, "certainty": 0.8, "reason": "r"})}}]}

    def answer(self, q):
        people = sorted(self.people)
        for sign, value in re.findall(r'STR\(\?s\) (>|<=|=) ("(?:[^"\\]|\\.)*")', q):
            value = json.loads(value)
            people = [x for x in people if (x > value if sign == ">" else x <= value if sign == "<=" else x == value)]
        only = {json.loads(x) for x in re.findall(r'STR\(\?p\) = ("[^"]*")', q)}
        if "COUNT" in q:
            return [{"n": {"value": str(len(people))}}]
        size, at = int(re.search(r"LIMIT (\d+)", q)[1]), int((re.search(r"OFFSET (\d+)", q) or [0, 0])[1])
        people = people[at : at + size]
        if "?o" not in q:
            return [{"s": {"value": x}} for x in people]
        return [{"s": {"value": x}, "p": {"value": p}, "o": {"value": o, "xml:lang": "en"}} for x in people for p, o in self.rows(x) if not only or p in only]


@pytest.fixture
def store():
    held = Store()

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = self.rfile.read(int(self.headers["Content-Length"]))
            if "json" in self.headers["Content-Type"]:  # the two services of a model
                return self.say(json.dumps(held.model(self.path, json.loads(body))).encode())
            (kind, (said,)), *_ = urllib.parse.parse_qs(body.decode()).items()
            held.grow(len(held.seen))
            held.seen.append((self.headers.get("Authorization"), kind, said))
            self.say(json.dumps({"results": {"bindings": held.answer(said) if kind == "query" else []}}).encode(), 500 if held.refuse(said) else 200)

        def say(self, body, code=200):
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    held.url = f"http://127.0.0.1:{server.server_port}"
    yield held
    server.shutdown()


def source(spark, store, **options):
    spark.dataSource.register(SparqlTriples)
    return spark.read.format("sparql_triples").options(endpoint=store.url, **options).load()


def test_endpoint_as_a_source(spark, store, tmp_path):
    log = str(tmp_path / "job" / "sparql.jsonl")
    options = {"page_size": "2", "ranges": "3", "user": "u", "password": "p", "log": log, "run_id": "r1"}
    for _ in range(2):
        got = source(spark, store, **options)
        rows = [tuple(r) for r in got.collect()]
    assert sorted(rows) == [(x, i, p, o) for x in store.people for i, (p, o) in enumerate(store.rows(x))]
    assert all(a and a.startswith("Basic ") for a, *_ in store.seen) and got.rdd.getNumPartitions() == 3
    sent = {q for _, _, q in store.seen}
    pages = {q for q in sent if "?o" in q}
    assert len(sent - pages) == 3 and not any("OFFSET" in q for q in pages)  # a count and two bounds
    logged = spark.read.json(log).collect()
    assert sorted(r["statement"] for r in logged) == sorted(sent) and {r["operation"] for r in logged} == {"query"}  # read twice, logged once
    Endpoint(store.url, user="only", log=statement_log(log)).update("  INSERT DATA {} ")
    assert store.seen[-1] == (None, "update", "  INSERT DATA {} ")
    assert [r["statement"] for r in spark.read.json(log).where("operation = 'update'").collect()] == ["INSERT DATA {}"]


def test_filters_go_into_the_queries(spark, store):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = source(spark, store, page_size="4", push="true").where("p = 'http://schema.org/name' AND o <> 'p03'")
        assert sorted(r["s"] for r in got.collect()) == [x for x in store.people if x != "urn:p03"]
        pages = [q for _, _, q in store.seen if "?o" in q]
        assert pages and all(q.count('STR(?p) = "http://schema.org/name"') == 2 and "FILTER EXISTS" in q for q in pages)
        store.seen.clear()
        assert [r["p"] for r in source(spark, store, push="true").where("s = 'urn:p05'").collect()] == [p for p, _ in store.rows("")]
        assert all('STR(?s) = "urn:p05"' in q for _, _, q in store.seen)
        odd = 'a"b\\c'
        assert source(spark, store, push="true").where(F.col("s") == odd).count() == 0 and f"STR(?s) = {json.dumps(odd)}" in store.seen[-1][2]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_a_store_that_changes_between_pages_loses_nobody(spark, store):
    """Before every answer a person appears at the front and another at the back, and one that was read is gone."""
    first = list(store.people)

    def grow(n):
        if n > 3:
            store.people += [f"urn:a{n:02}", f"urn:z{n:02}"]
            if first[0] in store.people and n > 6:
                store.people.remove(first[0])

    store.grow = grow
    rows = [(r["s"], r["p"]) for r in source(spark, store, page_size="2", ranges="2").collect()]
    assert {s for s, _ in rows} >= set(first) - {first[0]} and len(rows) == len(set(rows))


def test_endpoint_as_a_sink(spark, store, tmp_path):
    log, lines = str(tmp_path / "log"), [f"<urn:{i}> <urn:p> <urn:o> ." for i in range(25)]
    frame = spark.createDataFrame([(x, 1) for x in lines], "line string, other int")
    options = {"endpoint": store.url, "graph": "urn:g", "most": "4", "log": log, "run_id": "r"}
    groups.send(frame, options, 2)
    sent = [q for _, kind, q in store.seen if kind == "update"]
    assert len(sent) in (7, 8) and sorted(x for q in sent for x in q.split("\n")[1:-1]) == sorted(lines)
    assert all(q.startswith("INSERT DATA { GRAPH <urn:g> {\n") and q.count("<urn:p>") <= 4 for q in sent)
    logged = spark.read.json(log)
    assert sorted(r["statement"] for r in logged.where("operation = 'update'").collect()) == sorted(sent)
    assert [r["statement"] for r in logged.where("operation = 'commit'").collect()] == [f"{len(sent)} updates of 25 lines to urn:g"]

    groups.send(frame.limit(0), options | {"run_id": "none"})
    assert [r["statement"] for r in spark.read.json(log).where("run_id = 'none'").collect()] == ["nothing to write to urn:g"]
    store.refuse = lambda q: "<urn:7>" in q
    with pytest.raises(Exception, match="500"):
        groups.send(frame, options | {"run_id": "bad"}, 2)
    assert "it can be repeated" in spark.read.json(log).where("run_id = 'bad' AND operation = 'abort'").first()["statement"]


def test_a_repeated_run_replaces_its_logs(spark, tmp_path):
    path = str(tmp_path / "audit")
    for _ in range(2):
        groups.log_json(spark.range(3), path, "a", "rules")
        groups.log_json(spark.range(2), path, "a", "verdicts")
    groups.log_json(spark.range(5), path, "b", "rules")
    assert {(r["run_id"], r["step"], r["count"]) for r in spark.read.json(path).groupBy("run_id", "step").count().collect()} == {("a", "rules", 3), ("a", "verdicts", 2), ("b", "rules", 5)}


ENV = {"SPARQL_ENDPOINT": "http://s", "LLM_BASE_URL": "http://l", "LLM_API_KEY": "k", "LLM_MODEL": "m"}


def test_config():
    got = C.from_environment(ENV | {"DEDUP_GRAPH": "urn:g"})
    assert (got.sparql_update_endpoint, got.dedup_graph, got.cluster_k, got.cluster_threshold) == ("http://s", "urn:g", 20, 0.99)
    with pytest.raises(KeyError):
        C.from_environment({"SPARQL_ENDPOINT": "x"})


def test_run_end_to_end(spark, store, tmp_path):
    names = ("audit_log", "sparql_log", "llm_log", "persons_cache", "embedding_cache")
    cfg = replace(C.from_environment(ENV), cluster_threshold=0.999, cluster_name_similarity_penalty=0.0, **{f"{n}_path": str(tmp_path / n) for n in names})
    cfg, said = replace(cfg, run_id="once"), []
    options = {"endpoint": store.url, "graph": cfg.dedup_graph, "log": cfg.sparql_log_path, "run_id": cfg.run_id}
    result = run(spark, cfg, lambda: triples(spark, f"{TESTDATA}/sf0.001"), Letters(), verdicts.SharedSignals(), lambda lines: groups.send(lines, options), said.append)
    updates = [q for _, kind, q in store.seen if kind == "update"]
    assert result["rule_based_groups"] == 14 and result["groups_found"] == 14 + result["llm_groups"] and result["llm_groups"] > 0
    assert updates and updates[0].startswith(f"INSERT DATA {{ GRAPH <{V.DEFAULT_GRAPH}>")
    assert spark.read.json(cfg.audit_log_path).count() == result["groups_found"]
    assert spark.read.json(cfg.llm_log_path).count() >= result["llm_groups"]
    assert sorted(r["statement"] for r in spark.read.json(cfg.sparql_log_path).where("operation = 'update'").collect()) == sorted(x.strip() for x in updates)
    assert any(x.startswith("judged clusters ") and x.endswith("(100 %)") for x in said) and any(x.startswith("embedded batches ") for x in said)
    fetched = []
    run(spark, cfg, lambda: fetched.append(1), Letters(), verdicts.SharedSignals(), lambda lines: lines.collect(), said.append)
    assert not fetched  # the person cache served the second run
    assert spark.read.json(cfg.audit_log_path).count() == result["groups_found"]  # which has the first one's id


def test_the_command_runs_over_http(spark, store, tmp_path, monkeypatch):
    """python -m twinfold's run: endpoint, both services and the update, all over HTTP."""
    from twinfold.__main__ import execute

    env = {"SPARQL_ENDPOINT": store.url, "LLM_BASE_URL": store.url + "/v1/", "LLM_API_KEY": "k", "LLM_MODEL": "m", "RUN_ID": "r"}
    env |= {f"{n}_PATH": str(tmp_path / n.lower()) for n in ("AUDIT_LOG", "SPARQL_LOG", "LLM_LOG", "PERSONS_CACHE", "EMBEDDING_CACHE")}
    result = execute(C.from_environment(env))
    assert result == {"groups_found": 1, "rule_based_groups": 0, "llm_groups": 1, "entities_covered": 11, "dedup_graph": V.DEFAULT_GRAPH}
    (update,) = [q for _, kind, q in store.seen if kind == "update"]
    assert update.count("member>") == 11 and f"GRAPH <{V.DEFAULT_GRAPH}>" in update
    (audit,) = spark.read.json(env["AUDIT_LOG_PATH"]).collect()
    assert (audit["method"], audit["confidence"], len(audit["entities"]), audit["run_id"], audit["step"]) == ("llm", 0.8, 11, "r", "verdicts")
    (said,) = spark.read.json(env["LLM_LOG_PATH"]).collect()
    assert [p["iri"] for p in json.loads(said["prompt"])] == sorted(store.people) and said["response"]["is_duplicate"]
    logged = {r["operation"] for r in spark.read.json(env["SPARQL_LOG_PATH"]).collect()}
    assert logged == {"query", "update", "commit"}


def test_times_and_ids(spark):
    (row,) = spark.sql("SELECT TIMESTAMP '2024-02-03 04:05:06.789012' AS t").select(text.utc_iso(F.col("t")).alias("t")).collect()
    assert datetime.fromisoformat(row["t"]) == datetime(2024, 2, 3, 4, 5, 6, 789012, timezone.utc)
    frame = spark.createDataFrame([([str(i)], 1.0, "r", "llm") for i in range(50)], "entities array<string>, confidence double, reason string, method string")
    ids = [r["assertion"] for r in groups.identified(frame, "urn:g").collect()]
    assert len(set(ids)) == 50 and all(re.fullmatch(r"urn:g/assertion/[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", x) for x in ids)


def test_the_policy_names_every_signal():
    said = verdicts.POLICY.lower()
    assert all(x in said for x in ("variant", "repository", "name", "e-mail", "handle", "blog", "orcid", "avatar", "creation date", "followers", "every iri"))


def test_a_penalty_switches_name_weights_on(spark, tmp_path, monkeypatch):
    """Two persons of one very common name and equal vectors: linked without a penalty, not with one."""
    from twinfold.operators import clusters, idf

    people = spark.createDataFrame([("1", "common"), ("2", "common"), ("3", "rare")], "iri string, name string")
    weighed = []
    monkeypatch.setattr(clusters.idf, "with_idf", lambda p, f=idf.with_idf: weighed.append(1) or f(p))
    found = [clusters.cluster_persons(people, Letters(), "m", ["name"], str(tmp_path / "cache"), threshold=0.99, penalty=p).count() for p in (0.0, 0.02)]
    assert found == [2, 0] and weighed == [1]


def test_jobs_over_http(tmp_path):
    gate, seen = threading.Event(), []

    def work(cfg):
        seen.append(cfg)
        gate.wait(5)
        if cfg.cluster_k == 7:
            raise ValueError("seven")
        return {"groups_found": 1}

    manager = JobManager(C.from_environment(ENV), work, str(tmp_path))
    server = serve(manager, 0, "127.0.0.1")
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"

    def call(path, body=None):
        try:
            with urllib.request.urlopen(urllib.request.Request(base + path, None if body is None else json.dumps(body).encode())) as r:
                return r.status, json.load(r)
        except urllib.error.HTTPError as e:
            return e.code, json.load(e)

    assert call("/health") == (200, {"status": "ok"})
    code, job = call("/runs", {"cluster_k": 7})
    assert code == 202 and job["status"] in ("queued", "running") and call("/runs", {})[0] == 409
    gate.set()
    for _ in range(100):
        if (state := call(f"/runs/{job['job_id']}")[1])["finished_at"]:
            break
        time.sleep(0.02)
    assert (state["status"], state["error"]) == ("failed", "ValueError: seven") and call("/runs/nothing")[0] == 404
    assert seen[0].persons_cache_path.endswith(f"{job['job_id']}/persons_cache.jsonl") and seen[0].embedding_cache_path == "embedding_cache"
    time.sleep(0.05)
    assert manager.submit(Overrides()).overrides.given() == {}
    server.shutdown()


def test_plans(spark):
    """The top k is cut before the shuffle; no properties travel with vectors."""
    from twinfold.operators import knn
    from twinfold.plans import queries

    pairs = spark.createDataFrame([(1, 2, 0.5)], "i long, j long, sim double")
    assert "WindowGroupLimit" in knn.top_k(pairs, 3)._jdf.queryExecution().toString()
    plan = queries.QUERIES["name_idf"](spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan or "BroadcastExchange" in plan
