"""The library's queries over the driver's tables, by name, and the same in SQL.

Compared columns are strings, integers, booleans and rounded doubles; arrays are joined strings. Persons come from the
synthetic graph of fixtures.py, vectors from `embeddings` (threshold 0.35, as no pair there reaches 0.99; both are
shown). The stand-in for names of vectors is their label.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.functions import text, vocabulary as V
from twinfold.functions.vectors import norm, unit
from twinfold.operators import clusters, embedding, groups, idf, knn, persons, rules, verdicts
from twinfold.operators.components import connected_components
from twinfold.sources.shared import written
from twinfold.plans.fixtures import TRIPLES, triples, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

K, T, PENALTY, CAP, MODEL, FIELDS = 20, 0.35, 0.02, 5, "Qwen/Qwen3-Embedding-8B", ["name", "location"]
#: What makes neighbours() partition vectors by cells at every size, in blocks of 128 vectors of 64 numbers.
CELLS = {"broadcast_bytes": 0, "block_bytes": 64 << 10}


def query(sql: str):
    def keep(f):
        name = f.__name__.removesuffix("_query")
        QUERIES[name], ORACLE_SQL[name] = f, sql
        return f

    return keep


def joined(c: Column | str, by: str = "|") -> Column:
    return F.array_join(c, by)


# SQL of the steps, each a common table expression that may use those before it.
_SHORT = "CASE " + " ".join(f"WHEN starts_with(p, '{n}') THEN '{x}' || substr(p, {len(n) + 1})" for n, x in V.NAMESPACES.items()) + " ELSE p END"
_FIRST = ", ".join(f"arg_min(o, pos) FILTER (WHERE p = '{p}') AS {c}" if c != "orcid" else f"regexp_replace(arg_min(o, pos) FILTER (WHERE p = '{p}'), '^.*/', '') AS orcid" for c, p in V.SCALARS.items())
_LISTS = ", ".join(f"coalesce(string_agg(o, '|' ORDER BY pos) FILTER (WHERE p = '{p}'), '') AS {c}" for c, p in V.LISTS.items())
_STEPS = {
    "triples": TRIPLES,
    "typed": f"SELECT s, pos, p, o FROM triples WHERE s IN (SELECT s FROM triples WHERE p = '{V.RDF_TYPE}' AND o = '{V.PERSON}')",
    "vals": f"SELECT s, {_SHORT} AS p, o, min(pos) AS pos FROM typed GROUP BY ALL",
    "found": f"SELECT s AS iri, string_agg(o, ' / ' ORDER BY pos) FILTER (WHERE p = 'schema:name') AS name, {_FIRST}, {_LISTS} FROM vals GROUP BY s HAVING count(*) FILTER (WHERE p = 'schema:name') > 0",
    "checked": r"SELECT *, concat_ws('|', CASE WHEN NOT regexp_matches(email, '^[\w\-.]+@([\w-]+\.)+[\w-]{2,4}$') THEN 'email' END, CASE WHEN NOT regexp_matches(orcid, '^\d{4}-\d{4}-\d{4}-\d{3}[0-9X]$') THEN 'orcid' END, CASE WHEN coalesce(nullif(github_username, ''), nullif(email, ''), nullif(infoscience_id, ''), nullif(orcid, '')) IS NULL THEN 'identifier' END) AS violations FROM found",
    "people": "SELECT * FROM checked WHERE violations = ''",
    "keys": r"SELECT iri, github_username, lower(coalesce(nullif(github_username, ''), nullif(regexp_extract(url, '^https?://(?:www\.)?github\.com/([^/]+)/?$', 1), ''))) AS account, nullif(lower(regexp_extract(infoscience_id, '(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}')), '') AS uuid FROM people",
    "github": "SELECT account AS key, string_agg(DISTINCT iri, '|' ORDER BY iri) AS entities, count(DISTINCT iri) AS n, '[github_username_bridge] Shared GitHub username ''' || account || ''' (direct field or profile URL) across ' || count(DISTINCT iri) || ' records.' AS reason FROM keys WHERE account IS NOT NULL GROUP BY account HAVING count(DISTINCT iri) >= 2",
    "uuids": "SELECT uuid AS key, string_agg(DISTINCT iri, '|' ORDER BY iri) AS entities, count(DISTINCT iri) AS n, count(DISTINCT nullif(github_username, '')) AS n_usernames, string_agg(DISTINCT nullif(github_username, ''), ', ' ORDER BY nullif(github_username, '')) AS usernames FROM keys WHERE uuid IS NOT NULL GROUP BY uuid HAVING count(DISTINCT iri) >= 2",
    "uuid": "SELECT key, entities, n, n_usernames, '[infoscience_uuid] Shared Infoscience UUID ' || key || ' across ' || n || ' records.' || CASE WHEN n_usernames > 1 THEN ' Caution: conflicting GitHub accounts attached (' || usernames || ') — verify before trusting.' ELSE '' END AS reason FROM uuids",
    "matches": "SELECT entities, n, reason FROM github UNION ALL SELECT entities, n, reason FROM uuid",
    "resolved": "SELECT DISTINCT unnest(string_split(entities, '|')) AS iri FROM matches",
    "pool": "SELECT * FROM people WHERE iri NOT IN (SELECT iri FROM resolved)",
    "names": "SELECT name, count(*) AS n FROM pool GROUP BY name",
    "idfs": "SELECT name, n, CASE WHEN max(n) OVER () = min(n) OVER () THEN 1.0 ELSE (ln(sum(n) OVER () / n::double) - ln(sum(n) OVER () / (max(n) OVER ())::double)) / (ln(sum(n) OVER () / (min(n) OVER ())::double) - ln(sum(n) OVER () / (max(n) OVER ())::double)) END AS idf FROM names",
    "vec": "SELECT vec_id AS id, embedding::double[] AS v, label FROM embeddings",
    "units": "SELECT id, label, list_transform(v, lambda x: x / (sqrt(list_dot_product(v, v)) + 1e-10)) AS u FROM vec",
    "pairs": "SELECT a.id AS i, b.id AS j, list_dot_product(a.u, b.u) AS sim FROM units a JOIN units b ON a.id <> b.id",
    "topk": f"SELECT i, j, sim, rank FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY round(sim, 12) DESC, j) AS rank FROM pairs) WHERE rank <= {K}",
    "labels_n": "SELECT label, count(*) AS n FROM vec GROUP BY label",
    "labels_idf": "SELECT label, CASE WHEN max(n) OVER () = min(n) OVER () THEN 1.0 ELSE (ln(sum(n) OVER () / n::double) - ln(sum(n) OVER () / (max(n) OVER ())::double)) / (ln(sum(n) OVER () / (min(n) OVER ())::double) - ln(sum(n) OVER () / (max(n) OVER ())::double)) END AS idf FROM labels_n",
    "edges": f"SELECT i, j, sim FROM topk WHERE sim >= {T}",
    "mirrored": "SELECT i, j FROM edges UNION SELECT j, i FROM edges",
    "reach": "SELECT i AS node, i AS label FROM mirrored UNION SELECT b.j, r.label FROM reach r JOIN mirrored b ON b.i = r.node WHERE r.label < b.j",
    "comps": "SELECT node, min(label) AS component FROM (SELECT node, label FROM reach) GROUP BY node",
    "groups_v": "SELECT component AS cluster_id, count(*) AS size, string_agg(node::varchar, '|' ORDER BY node) AS members FROM comps GROUP BY component",
    "judged": f"SELECT c.component AS cluster_id, count(*) AS size, count(DISTINCT v.label) = 1 AS is_duplicate, round(1.0 / count(*), 6) AS certainty, string_agg(c.node::varchar, '|' ORDER BY c.node) AS members FROM comps c JOIN vec v ON v.id = c.node GROUP BY c.component HAVING count(*) <= 25 AND c.component % 11 <> 0",
}
_NEEDS = {
    "typed": ["triples"], "vals": ["typed"], "found": ["vals"], "checked": ["found"], "people": ["checked"], "keys": ["people"], "github": ["keys"], "uuids": ["keys"], "uuid": ["uuids"],
    "matches": ["github", "uuid"], "resolved": ["matches"], "pool": ["people", "resolved"], "names": ["pool"], "idfs": ["names"], "units": ["vec"], "pairs": ["units"], "topk": ["pairs"],
    "labels_n": ["vec"], "labels_idf": ["labels_n"], "edges": ["topk"], "mirrored": ["edges"], "reach": ["mirrored"], "comps": ["reach"], "groups_v": ["comps"], "judged": ["comps", "vec"],
}


def sql(body: str, *steps: str) -> str:
    """A statement with all common table expressions that the named ones need."""
    order: list[str] = []

    def add(step: str) -> None:
        for s in _NEEDS.get(step, []):
            add(s)
        if step not in order:
            order.append(step)

    for s in steps:
        add(s)
    return "WITH RECURSIVE " + ",\n".join(f"{s} AS ({_STEPS[s]})" for s in order) + "\n" + body


def _people(spark: SparkSession, d: str) -> DataFrame:
    """Written once, as a run's person cache is, since most queries read them more than once."""
    return written(persons.persons(triples(spark, d)))


def _pool(spark: SparkSession, d: str) -> DataFrame:
    people = _people(spark, d)
    return rules.remaining(people, rules.resolve(people))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return knn.edges(vectors(spark, d), K, T)


def _components(spark: SparkSession, d: str) -> DataFrame:
    return connected_components(_edges(spark, d))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return _components(spark, d).groupBy(F.col("component").alias("cluster_id")).agg(F.count(F.lit(1)).alias("size"))


# Sources and folding

@query(sql("SELECT s, p, o, count(*) AS n FROM typed GROUP BY ALL", "typed"))
def triples_typed_scan(spark, d):
    return persons.of_persons(triples(spark, d)).groupBy("s", "p", "o").agg(F.count(F.lit(1)).alias("n"))


@query(sql(f"SELECT s, p, o FROM triples WHERE s IN (SELECT DISTINCT s FROM triples WHERE p = '{V.RDF_TYPE}' AND o = '{V.PERSON}' ORDER BY s LIMIT 50 OFFSET 50)", "triples"))
def paged_scan(spark, d):
    return persons.page_of_persons(triples(spark, d), page=1, size=50).select("s", "p", "o")


@query(sql(f"SELECT {_SHORT} AS predicate, count(*) AS n FROM triples GROUP BY 1", "triples"))
def predicate_shorten(spark, d):
    return triples(spark, d).groupBy(text.shorten(F.col("p")).alias("predicate")).agg(F.count(F.lit(1)).alias("n"))


@query(sql("SELECT s, p, string_agg(o, '|' ORDER BY pos) AS vals FROM vals GROUP BY s, p", "vals"))
def property_bag(spark, d):
    bag = persons.property_bag(persons.person_triples(triples(spark, d)))
    return bag.select("s", F.explode("properties").alias("p", "v")).select("s", "p", joined("v").alias("vals"))


@query(sql("SELECT * EXCLUDE (violations) FROM people", "people"))
def persons_valid(spark, d):
    return persons.persons(triples(spark, d)).select("iri", "name", *V.SCALARS, *(joined(c).alias(c) for c in V.LISTS))


@query(sql("SELECT iri, name, violations FROM checked WHERE violations <> ''", "checked"))
def persons_rejected(spark, d):
    return persons.rejected(persons.candidates(triples(spark, d))).select("iri", "name", joined("violations").alias("violations"))


@query(sql("SELECT o AS raw, regexp_replace(o, '^.*/', '') AS orcid, count(*) AS n FROM vals WHERE p = 'pulse:orcidIdentifier' GROUP BY o", "vals"))
def orcid_normalise(spark, d):
    t = persons.person_triples(triples(spark, d)).where("p = 'pulse:orcidIdentifier'")
    return t.groupBy(F.col("o").alias("raw"), text.bare_orcid(F.col("o")).alias("orcid")).agg(F.count(F.lit(1)).alias("n"))


# Rules

@query(sql("SELECT iri, account FROM keys WHERE account IS NOT NULL", "keys"))
def github_key(spark, d):
    return persons.persons(triples(spark, d)).select("iri", text.github_key(F.col("github_username"), F.col("url")).alias("account")).where("account is not null")


@query(sql("SELECT key, entities, n, reason FROM github", "github"))
def github_groups(spark, d):
    return rules.by_github_username(persons.persons(triples(spark, d))).select("key", joined("entities").alias("entities"), F.size("entities").cast("long").alias("n"), "reason")


@query(sql("SELECT key, entities, n, reason FROM uuid", "uuid"))
def uuid_groups(spark, d):
    return rules.by_uuid(persons.persons(triples(spark, d))).select("key", joined("entities").alias("entities"), F.size("entities").cast("long").alias("n"), "reason")


@query(sql("SELECT key, reason FROM uuid WHERE n_usernames > 1", "uuid"))
def uuid_conflicts(spark, d):
    return rules.by_uuid(persons.persons(triples(spark, d))).where("conflict").select("key", "reason")


@query(sql("SELECT entities, reason FROM matches", "matches"))
def rule_matches_all(spark, d):
    return rules.resolve(_people(spark, d)).select(joined("entities").alias("entities"), "reason")


@query(sql("SELECT iri FROM resolved", "resolved"))
def resolved_set(spark, d):
    return rules.resolved(rules.resolve(_people(spark, d)))


@query(sql("SELECT iri, name FROM pool", "pool"))
def remaining_pool(spark, d):
    return _pool(spark, d).select("iri", "name")


# Name frequency

@query(sql("SELECT name, n FROM names", "names"))
def name_frequency(spark, d):
    return idf.name_frequency(_pool(spark, d)).withColumnRenamed("count", "n")


@query(sql("SELECT name, round(idf, 9) AS idf FROM idfs", "idfs"))
def name_idf(spark, d):
    return idf.name_idf(_pool(spark, d)).select("name", F.round("idf", 9).alias("idf"))


@query(sql("SELECT iri, round(idf, 9) AS idf FROM pool JOIN idfs USING (name)", "pool", "idfs"))
def person_idf(spark, d):
    return idf.with_idf(_pool(spark, d)).select("iri", F.round("idf", 9).alias("idf"))


# Embedding and cache

_TEXT = "concat_ws(' ', nullif(name, ''), nullif(location, ''))"
_KEY = f"sha256('{MODEL}' || chr(0) || %s)"


@query(sql(f"SELECT iri, {_TEXT} AS text FROM pool", "pool"))
def embed_text(spark, d):
    return _pool(spark, d).select("iri", text.embed_text(*FIELDS).alias("text"))


@query(sql(f"SELECT iri, {_KEY % _TEXT} AS key FROM pool", "pool"))
def embed_key(spark, d):
    return embedding.keyed(_pool(spark, d), MODEL, FIELDS).select("iri", "key")


def _document_keys(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Keys of all texts; and a cache that holds those of even ids."""
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    keys = docs.withColumn("key", text.cache_key(MODEL, F.coalesce("text", F.lit(""))))
    return keys, keys.where("doc_id % 2 = 0").select("key", F.array(F.lit(0.0)).alias("vector")).dropDuplicates(["key"])


_CACHE = "WITH k AS (SELECT doc_id, " + _KEY % "coalesce(text, '')" + " AS key FROM documents), c AS (SELECT DISTINCT key FROM k WHERE doc_id % 2 = 0) "


@query(_CACHE + "SELECT DISTINCT key FROM k WHERE key NOT IN (SELECT key FROM c)")
def cache_misses(spark, d):
    keys, cache = _document_keys(spark, d)
    return embedding.misses(keys, cache).select("key")


@query(_CACHE + "SELECT doc_id, key FROM k WHERE key IN (SELECT key FROM c)")
def cache_hits(spark, d):
    keys, cache = _document_keys(spark, d)
    return embedding.hits(keys, cache).select("doc_id", "key")


# Nearest neighbours

@query(sql("SELECT id, round(list_dot_product(u, u), 6) AS squared FROM units", "units"))
def unit_vectors(spark, d):
    return vectors(spark, d).select("id", F.round(F.pow(norm(unit(F.col("vector"))), 2), 6).alias("squared"))


@query(sql("SELECT i, j, round(sim, 6) AS sim FROM pairs WHERE i < j AND sim >= 0.3", "pairs"))
def pair_similarity(spark, d):
    return knn.similar_pairs(vectors(spark, d), 0.3).select("i", "j", F.round("sim", 6).alias("sim"))


@query(sql("SELECT i, j, rank, round(sim, 6) AS sim FROM topk", "topk"))
def knn_topk(spark, d):
    return knn.neighbours(vectors(spark, d), K, -2.0).select("i", "j", F.col("rank").cast("long").alias("rank"), F.round("sim", 6).alias("sim"))


@query(sql(f"SELECT i, j, round(sim, 6) AS sim FROM topk WHERE sim >= {T}", "topk"))
def knn_edges_threshold(spark, d):
    return _edges(spark, d).select("i", "j", F.round("sim", 6).alias("sim"))


@query(sql("SELECT i, j, rank, round(sim, 6) AS sim FROM topk", "topk"))
def knn_topk_cells(spark, d):
    return knn.neighbours(vectors(spark, d), K, -2.0, **CELLS).select("i", "j", F.col("rank").cast("long").alias("rank"), F.round("sim", 6).alias("sim"))


@query(sql(f"SELECT i, j, rank, round(sim, 6) AS sim FROM topk WHERE sim >= {T}", "topk"))
def knn_edges_cells(spark, d):
    return knn.neighbours(vectors(spark, d), K, T, **CELLS).select("i", "j", F.col("rank").cast("long").alias("rank"), F.round("sim", 6).alias("sim"))


@query(sql("SELECT i, j FROM topk WHERE sim >= 0.99", "topk"))
def knn_edges_default(spark, d):
    return knn.edges(vectors(spark, d)).select("i", "j")


@query(sql(f"SELECT i, j, round(sim, 6) AS sim FROM topk JOIN vec a ON a.id = i JOIN vec b ON b.id = j JOIN labels_idf x ON x.label = a.label JOIN labels_idf y ON y.label = b.label WHERE sim >= {T} + {PENALTY} * (1 - least(x.idf, y.idf))", "topk", "labels_idf"))
def knn_edges_idf(spark, d):
    weighed = idf.with_idf(vectors(spark, d), "label")
    return knn.edges(weighed, K, T, PENALTY).select("i", "j", F.round("sim", 6).alias("sim"))


@query(sql(f"SELECT round({T} + {PENALTY} * (1 - least(x.idf, y.idf)), 9) AS threshold, count(*) AS n FROM topk JOIN vec a ON a.id = i JOIN vec b ON b.id = j JOIN labels_idf x ON x.label = a.label JOIN labels_idf y ON y.label = b.label WHERE sim >= {T} GROUP BY 1", "topk", "labels_idf"))
def effective_threshold(spark, d):
    weight = idf.with_idf(vectors(spark, d), "label").select("id", "idf")
    both = _edges(spark, d).join(weight.toDF("i", "a"), "i").join(weight.toDF("j", "b"), "j")
    return both.groupBy(F.round(idf.effective_threshold(T, PENALTY, F.col("a"), F.col("b")), 9).alias("threshold")).agg(F.count(F.lit(1)).alias("n"))


# Components and clusters

@query(sql("SELECT node, component FROM comps", "comps"))
def connected_components_query(spark, d):
    return _components(spark, d)


@query(sql("SELECT node, component FROM comps", "comps"))
def connected_components_stars(spark, d):
    """By rounds of stars, as graphs above components.SMALL are searched."""
    return connected_components(_edges(spark, d), small=0)


@query(sql("SELECT cluster_id, size, members FROM groups_v", "groups_v"))
def clusters_query(spark, d):
    return clusters.clusters(_edges(spark, d)).select("cluster_id", F.size("members").cast("long").alias("size"), joined(F.col("members").cast("array<string>")).alias("members"))


@query(sql("SELECT count(*) AS n_clusters, sum(size)::bigint AS clustered, min(size) AS min_size, max(size) AS max_size, round(avg(size), 6) AS mean_size, (SELECT count(*) FROM vec) - sum(size)::bigint AS singletons FROM groups_v", "groups_v", "vec"))
def cluster_stats(spark, d):
    return clusters.statistics(_sizes(spark, d), vectors(spark, d).count()).withColumn("mean_size", F.round("mean_size", 6))


@query(sql("SELECT size, count(*) AS n_clusters FROM groups_v GROUP BY size", "groups_v"))
def cluster_histogram(spark, d):
    return clusters.histogram(_sizes(spark, d))


@query(sql(f"SELECT CASE WHEN size > {CAP} THEN 'skipped_oversized' ELSE 'to_judge' END AS status, count(*) AS n FROM groups_v GROUP BY 1", "groups_v"))
def cluster_status(spark, d):
    return _sizes(spark, d).groupBy(clusters.status(F.col("size"), CAP).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(sql("SELECT component AS cluster_id, string_agg(node::varchar, ', ' ORDER BY node) AS sample FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY node) AS r FROM comps) WHERE r <= 3 GROUP BY component", "comps"))
def cluster_sample(spark, d):
    found = clusters.clusters(_edges(spark, d))
    return found.select("cluster_id", clusters.sample_names(F.col("members").cast("array<string>")).alias("sample"))


_HAS = "concat_ws('|', 'iri', 'name', " + ", ".join(f"CASE WHEN nullif({c}, '') IS NOT NULL THEN '{c}' END" for c in clusters.FIELDS[2:-1]) + ", 'properties')"


@query(sql(f"SELECT iri, {_HAS} AS fields FROM people", "people"))
def llm_payload_fields(spark, d):
    people = _people(spark, d)
    found = clusters.gathered(people.select("iri", F.col("iri").alias("cluster_id")), clusters.described(people))
    return found.select(F.col("cluster_id").alias("iri"), joined(F.json_object_keys(F.get_json_object("payload", "$[0]"))).alias("fields"))


# Verdicts

class OneLabel:
    """A stand-in adjudicator: vectors of one label are duplicates, with certainty 1 / size; it gives no answer for a
    cluster whose first member's id is a multiple of 11."""

    def judge(self, payload: str) -> verdicts.Verdict:
        people = json.loads(payload)
        if people[0]["iri"] % 11 == 0:
            raise OSError("no answer")
        return verdicts.Verdict([str(p["iri"]) for p in people], len({p["name"] for p in people}) == 1, round(1.0 / len(people), 6), "one \"label\"\nin all\\")


def _all_verdicts(spark: SparkSession, d: str) -> DataFrame:
    found = _components(spark, d).select(F.col("component").alias("cluster_id"), F.col("node").alias("iri"))
    people = vectors(spark, d).select(F.col("id").alias("iri"), F.col("label").alias("name"), F.to_json(F.struct(F.col("id").alias("iri"), F.col("label").alias("name"))).alias("json"))
    said = written(verdicts.judge(clusters.gathered(found, people), OneLabel()))
    return said.withColumn("cluster_id", F.col("cluster_id").cast("long"))


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    return _all_verdicts(spark, d).where("status = 'judged'")


def _with_unknown(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Verdicts that also name an entity nobody has; and the known entities, of which every seventh is missing."""
    said = _verdicts(spark, d).withColumn("entities", F.concat("entities", F.array(F.lit("nobody"), F.lit("nobody"))))
    return said, vectors(spark, d).where("id % 7 <> 0").select(F.col("id").cast("string").alias("iri"))


_ENTITY = "(SELECT cluster_id, certainty, unnest(string_split(members, '|')) AS e FROM judged WHERE is_duplicate)"


@query(sql("SELECT cluster_id, is_duplicate, certainty, members AS entities FROM judged", "judged"))
def stub_verdicts(spark, d):
    return _verdicts(spark, d).select("cluster_id", "is_duplicate", "certainty", joined("entities").alias("entities"))


@query(sql(f"SELECT string_agg(e, '|' ORDER BY e) AS entities, certainty AS confidence, 'llm' AS method FROM {_ENTITY} WHERE e::bigint % 7 <> 0 GROUP BY cluster_id, certainty HAVING count(*) >= 2", "judged"))
def valid_verdicts(spark, d):
    return verdicts.accepted(*_with_unknown(spark, d)).select(joined("entities").alias("entities"), "confidence", "method")


@query(sql(f"SELECT cluster_id, e AS iri FROM {_ENTITY} WHERE e::bigint % 7 = 0 UNION ALL SELECT cluster_id, 'nobody' FROM judged WHERE is_duplicate", "judged"))
def unknown_entities(spark, d):
    return verdicts.unknown(*_with_unknown(spark, d))


@query(sql("SELECT (SELECT count(*) FROM judged) AS judged, (SELECT count(*) FROM groups_v WHERE size > 25) AS skipped_oversized, (SELECT count(*) FROM groups_v WHERE size <= 25 AND cluster_id % 11 = 0) AS failed", "judged", "groups_v"))
def verdict_counters(spark, d):
    return verdicts.counters(_all_verdicts(spark, d))


@query(sql("SELECT cluster_id, size, string_agg(label::varchar, ', ' ORDER BY node) AS names FROM (SELECT c.component AS cluster_id, c.node, v.label, count(*) OVER (PARTITION BY c.component) AS size, row_number() OVER (PARTITION BY c.component ORDER BY c.node) AS r FROM comps c JOIN vec v ON v.id = c.node) WHERE size > 25 AND r <= 3 GROUP BY cluster_id, size", "comps", "vec"))
def skipped_clusters(spark, d):
    """Of a cluster above the cap its size and three names are known, and nothing else is gathered."""
    return _all_verdicts(spark, d).where("status = 'skipped_oversized'").select("cluster_id", "size", F.array_join("names", ", ").alias("names"))


@query(sql("SELECT cluster_id, 'OSError: no answer' AS error FROM groups_v WHERE size <= 25 AND cluster_id % 11 = 0", "groups_v"))
def failed_verdicts(spark, d):
    return _all_verdicts(spark, d).where("status = 'failed'").select("cluster_id", "error")


# Groups and export

_REASON = "'one \"label\"' || chr(10) || 'in all\\'"
_GROUPS = f"""SELECT entities, n, 1.0::double AS confidence, reason, 'rule-based' AS method FROM matches
UNION ALL SELECT string_agg(e, '|' ORDER BY e), count(*), certainty, {_REASON}, 'llm' FROM {_ENTITY} GROUP BY cluster_id, certainty HAVING count(*) >= 2"""
_GRAPH = "urn:graph:duplicates"


def _groups(spark: SparkSession, d: str) -> DataFrame:
    every = vectors(spark, d).select(F.col("id").cast("string").alias("iri"))
    return groups.all_groups(groups.rule_groups(rules.resolve(_people(spark, d))), verdicts.accepted(_verdicts(spark, d), every))


def _assertions(spark: SparkSession, d: str) -> DataFrame:
    named = groups.identified(_groups(spark, d), _GRAPH, F.md5(F.concat_ws("|", "method", joined("entities"))))
    return groups.assertion_triples(named, F.lit("2024-01-01T00:00:00+00:00"))


def _escaped(x: str) -> str:
    return f"replace(replace(replace({x}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')"


_NUMBER = "CASE WHEN regexp_replace(confidence::decimal(18,6)::varchar, '0+$', '') LIKE '%.' THEN regexp_replace(confidence::decimal(18,6)::varchar, '0+$', '') || '0' ELSE regexp_replace(confidence::decimal(18,6)::varchar, '0+$', '') END"
_ASSERTED = f"""g AS ({_GROUPS}), a AS (SELECT *, '{_GRAPH}/assertion/' || md5(method || '|' || entities) AS s FROM g), t AS (
SELECT s, '{V.RDF_TYPE}' AS p, '<{V.DEDUP}DuplicateAssertion>' AS o FROM a
UNION SELECT s, '{V.PROV_TIME}', '"2024-01-01T00:00:00+00:00"^^<{V.XSD}dateTime>' FROM a
UNION SELECT s, '{V.DEDUP}confidence', '"' || {_NUMBER} || '"^^<{V.XSD}decimal>' FROM a
UNION SELECT s, '{V.DEDUP}methodology', '"' || method || '"' FROM a
UNION SELECT s, '{V.DEDUP}reasoning', '"' || {_escaped('reason')} || '"' FROM a
UNION SELECT s, '{V.DEDUP}member', '<' || unnest(string_split(entities, '|')) || '>' FROM a)"""


def _with(more: str, body: str, *steps: str) -> str:
    return sql("", *steps).rstrip() + ",\n" + more + "\n" + body


@query(_with(f"g AS ({_GROUPS})", "SELECT entities, confidence, reason, method FROM g", "matches", "judged"))
def groups_all(spark, d):
    return _groups(spark, d).select(joined("entities").alias("entities"), "confidence", "reason", "method")


@query(_with(f"g AS ({_GROUPS})", "SELECT entities, method, row_number() OVER (ORDER BY CASE method WHEN 'rule-based' THEN 0 WHEN 'llm' THEN 1 ELSE 99 END, confidence DESC, replace(entities, '|', ' ')) AS place FROM g", "matches", "judged"))
def groups_ranked(spark, d):
    return groups.numbered(_groups(spark, d)).select(joined("entities").alias("entities"), "method", "place")


@query(_with(f"g AS ({_GROUPS})", f"SELECT count(*) AS groups_found, count(*) FILTER (WHERE method = 'rule-based') AS rule_based_groups, count(*) FILTER (WHERE method = 'llm') AS llm_groups, sum(n)::bigint AS entities_covered, (SELECT count(DISTINCT e) FROM (SELECT unnest(string_split(entities, '|')) AS e FROM g)) AS distinct_entities, '{_GRAPH}' AS dedup_graph FROM g", "matches", "judged"))
def run_summary(spark, d):
    return groups.summary(_groups(spark, d), _GRAPH)


@query(_with(_ASSERTED, "SELECT s, p, o FROM t", "matches", "judged"))
def assertion_triples(spark, d):
    return _assertions(spark, d)


@query(_with(_ASSERTED, "SELECT '<' || s || '> <' || p || '> ' || o || ' .' AS line FROM t", "matches", "judged"))
def ntriples_text(spark, d):
    return groups.ntriples(_assertions(spark, d))


@query(_with(f"g AS ({_GROUPS})", "SELECT '2024-01-01T00:00:00+00:00' AS timestamp, 'duplicate_group' AS operation, method, confidence, reason, entities FROM g", "matches", "judged"))
def audit_rows(spark, d):
    rows = groups.audit_rows(_groups(spark, d), F.lit("2024-01-01T00:00:00+00:00"))
    return rows.withColumn("entities", joined("entities"))


@query(_with(f"g AS ({_GROUPS})", "SELECT printf('  %.2f  [%-10s]  %s', confidence, method, replace(entities, '|', ', ')) AS line FROM g", "matches", "judged"))
def report_lines(spark, d):
    return _groups(spark, d).select(groups.report_line().alias("line"))
