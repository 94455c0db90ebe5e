"""Hand-written records: validation, rules and name weights."""

from pyspark.sql import functions as F

from twinfold.functions import text, vocabulary as V
from twinfold.operators import idf, persons, rules

FULL = {x: n for n, x in V.NAMESPACES.items()}


def triples(spark, people):
    rows = []
    for iri, values in people.items():
        rows.append((iri, 0, V.RDF_TYPE, V.PERSON))
        for pos, (p, o) in enumerate(values, 1):
            prefix, _, rest = p.partition(":")
            rows.append((iri, pos, FULL[prefix + ":"] + rest, o))
    return spark.createDataFrame(rows, "s string, pos int, p string, o string")


def found(spark, *values):
    return {r["iri"]: r for r in persons.candidates(triples(spark, {f"urn:{i}": v for i, v in enumerate(values)})).collect()}


def test_the_first_value_wins_and_then_drops_the_record(spark):
    r = found(spark, [("schema:name", "A"), ("schema:email", "bad+x@mail.org"), ("schema:email", "ok@mail.org")])["urn:0"]
    assert (r["email"], r["violations"]) == ("bad+x@mail.org", ["email"])


def test_a_url_is_no_identifier(spark):
    assert found(spark, [("schema:name", "A"), ("schema:url", "https://github.com/a")])["urn:0"]["violations"] == ["identifier"]


def test_an_orcid_with_a_trailing_slash_is_empty_and_invalid(spark):
    r = found(spark, [("schema:name", "A"), ("pulse:orcidIdentifier", "https://orcid.org/0000-0001-2345-678X/")])["urn:0"]
    assert r["orcid"] == "" and "orcid" in r["violations"]


def test_names_collapse_and_join_in_order_of_arrival(spark):
    r = found(spark, [("schema:name", "B"), ("schema:name", "A"), ("schema:name", "B"), ("schema:email", "é@x.org")])["urn:0"]
    assert (r["name"], r["violations"]) == ("B / A", [])


def test_without_a_name_there_is_no_record(spark):
    assert found(spark, [("schema:email", "a@x.org")]) == {}


def test_strict_pattern_ends(spark):
    values = ["a@x.org\n", "a@x.museum", "a@x.org", "a b@x.org"]
    frame = spark.createDataFrame([(v,) for v in values], "v string").select("v", F.col("v").rlike(V.EMAIL).alias("ok"))
    assert {r["v"]: r["ok"] for r in frame.collect()} == dict(zip(values, [False, False, True, False], strict=True))


def test_a_username_shadows_the_url_and_case_folds(spark):
    frame = spark.createDataFrame([("Own", "https://github.com/other"), ("", "http://www.github.com/Other/"), (None, "https://github.com/a/b"), (None, None)], "u string, url string")
    assert [r[0] for r in frame.select(text.github_key(F.col("u"), F.col("url"))).collect()] == ["own", "other", None, None]


def test_person_in_both_rules_gives_two_groups_and_one_removal(spark):
    uuid = "01234567-89ab-cdef-0123-456789abcdef"
    person = [("schema:name", "A"), ("pulse:githubUsername", "A"), ("pulse:infosciencePersonIdentifier", f"x/{uuid.upper()}")]
    other = [("schema:name", "B"), ("pulse:githubUsername", "a"), ("pulse:infosciencePersonIdentifier", f"y/{uuid}")]
    third = [("schema:name", "C"), ("schema:email", "c@x.org")]
    people = persons.persons(triples(spark, {"urn:0": person, "urn:1": other, "urn:2": third}))
    matches = rules.resolve(people)
    rows = matches.collect()
    assert [r["entities"] for r in rows] == [["urn:0", "urn:1"]] * 2
    assert sum("Caution" in r["reason"] and "(A, a)" in r["reason"] for r in rows) == 1
    assert [r["iri"] for r in rules.remaining(people, matches).collect()] == ["urn:2"]


def test_resolved_and_remaining_partition_the_persons(spark):
    from conftest import TESTDATA

    from twinfold.plans.fixtures import triples as fixture

    people = persons.persons(fixture(spark, f"{TESTDATA}/sf0.001"))
    matches = rules.resolve(people)
    assert (people.count(), rules.resolved(matches).count(), rules.remaining(people, matches).count()) == (127, 26, 101)


def test_idf_of_equally_frequent_names_is_one(spark):
    for names in (["a", "b", "c"], ["a", "a"]):
        frame = spark.createDataFrame([(n,) for n in names], "name string")
        assert {r["idf"] for r in idf.name_idf(frame).collect()} == {1.0}
    assert idf.name_idf(spark.createDataFrame([], "name string")).count() == 0


def test_default_penalty_asks_for_more_than_one_below_half(spark):
    frame = spark.createDataFrame([(0.4, 1.0), (0.6, 0.9)], "a double, b double")
    high = [r[0] for r in frame.select(idf.effective_threshold(0.99, 0.02, F.col("a"), F.col("b"))).collect()]
    assert high[0] > 1.0 > high[1]


def test_keys_equal_hashlib(spark):
    import hashlib

    frame = spark.createDataFrame([("é x",)], "t string").select(text.cache_key("m", F.col("t")))
    assert frame.first()[0] == hashlib.sha256("m\0é x".encode()).hexdigest()


def test_the_fold_shuffles_once(spark):
    from conftest import TESTDATA

    from twinfold.plans.queries import QUERIES

    for name in ("persons_valid", "property_bag", "triples_typed_scan"):
        frame = QUERIES[name](spark, f"{TESTDATA}/sf0.001")
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan, name


def test_only_subjects_typed_as_persons_are_folded(spark):
    rows = [("urn:a", 0, V.RDF_TYPE, V.PERSON), ("urn:a", 1, "urn:p", "x"), ("urn:b", 0, V.RDF_TYPE, "urn:Other"), ("urn:b", 1, "urn:p", V.PERSON), ("urn:c", 0, "urn:p", "y"), ("urn:d", 0, None, None)]
    got = persons.of_persons(spark.createDataFrame(rows, "s string, pos int, p string, o string")).collect()
    assert sorted(r["p"] for r in got) == sorted([V.RDF_TYPE, "urn:p"]) and {r["s"] for r in got} == {"urn:a"}
