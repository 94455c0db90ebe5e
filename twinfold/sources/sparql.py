"""A SPARQL endpoint as a data source of triples (s, pos, p, o), and as a sink of updates.

    spark.dataSource.register(SparqlTriples)
    spark.read.format("sparql_triples").option("endpoint", url).load()
    spark.dataSource.register(SparqlUpdates)
    lines.write.format("sparql_update").option("endpoint", url).option("graph", iri).mode("append").save()

Options of both: endpoint, update_endpoint (the endpoint if unset), user and password (sent only if both are given),
timeout (seconds), log and run_id (where and under what name statements are logged, each before it is sent). Of the
source: page_size (persons of a query), ranges (most partitions) and push. Of the sink: graph and most (lines of a statement).

The source cuts the order of persons into ranges by a few queries for bounds, and reads a range in pages, each asking for
what follows the last person of the page before. So no page sorts what others have read, and a person that is added or
removed meanwhile moves no other one over a border. With push set to true, filters on s and p go into the queries; Spark
asks for its setting spark.sql.python.filterPushdown.enabled beside it. pos then counts the triples that pass.
"""

from __future__ import annotations

import base64
import hashlib
import json
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage

from twinfold.functions import vocabulary as V

Log = Callable[..., None]
SCHEMA = "s string, pos int, p string, o string"


class Endpoint:
    """Queries and updates of one endpoint; every statement is logged before it is sent."""

    def __init__(self, endpoint: str, update_endpoint: str | None = None, user: str | None = None, password: str | None = None, log: Log | None = None, timeout: float = 300.0):
        self.endpoint, self.update_endpoint, self.log, self.timeout = endpoint, update_endpoint or endpoint, log, timeout
        self.login = base64.b64encode(f"{user}:{password}".encode()).decode() if user and password else None

    def _post(self, url: str, field: str, statement: str) -> bytes:
        if self.log:
            self.log(field, statement)
        headers = {"Accept": "application/sparql-results+json", "Content-Type": "application/x-www-form-urlencoded"}
        if self.login:
            headers["Authorization"] = f"Basic {self.login}"
        with urllib.request.urlopen(urllib.request.Request(url, urllib.parse.urlencode({field: statement}).encode(), headers), timeout=self.timeout) as answer:
            return answer.read()

    def query(self, statement: str) -> list[dict[str, str]]:
        """The bindings' values; types and languages of literals are not kept."""
        result = json.loads(self._post(self.endpoint, "query", statement))
        if not isinstance(result, dict):
            raise ValueError(f"unexpected answer of type {type(result).__name__}")
        return [{k: v["value"] for k, v in row.items()} for row in result["results"]["bindings"]]

    def update(self, statement: str) -> None:
        self._post(self.update_endpoint, "update", statement)


def statement_log(folder: str, run_id: str = "0") -> Log:
    """log(operation, statement, ...) adds a file to the folder (a path or URL), with one JSON line for each statement:
    timestamp, operation, statement. The file's place follows from run, operation and statements, so what is logged again
    by a repeated task or run replaces its file. Makes the folder if there is none."""

    def log(operation: str, *statements: str) -> None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        base = f"{base.rstrip('/')}/run_id={run_id}/step={operation}"
        store.create_dir(base, recursive=True)
        lines = [json.dumps({"timestamp": datetime.now(timezone.utc).isoformat(), "operation": operation, "statement": x.strip()}, ensure_ascii=False) for x in statements]
        with store.open_output_stream(f"{base}/{hashlib.sha256(chr(0).join(statements).encode()).hexdigest()}.json") as f:
            f.write(("\n".join(lines) + "\n").encode())

    return log


def _endpoint(options: dict) -> Endpoint:
    log = statement_log(options["log"], options.get("run_id", "0")) if options.get("log") else None
    return Endpoint(options["endpoint"], options.get("update_endpoint"), options.get("user"), options.get("password"), log, float(options.get("timeout", 300)))


def string(value: str) -> str:
    """A SPARQL string literal."""
    return json.dumps(value)


def condition(f: Filter) -> tuple[str, str] | None:
    """The variable that a filter restricts and its SPARQL condition; None if the query can't say it."""
    name = f.attribute[0] if getattr(f, "attribute", None) in (("s",), ("p",)) else None
    if name and isinstance(f, EqualTo):
        return name, f"STR(?{name}) = {string(f.value)}"
    if name and isinstance(f, In):
        return name, f"STR(?{name}) IN ({', '.join(map(string, f.value))})"
    if name and isinstance(f, StringStartsWith):
        return name, f"STRSTARTS(STR(?{name}), {string(f.value)})"
    return None


@dataclass(frozen=True)
class Persons:
    """Query texts for the typed persons that pass conditions on ?s, and their triples that pass conditions on ?p."""

    subject: tuple[str, ...] = ()
    predicate: tuple[str, ...] = ()

    def _where(self, *bounds: str) -> str:
        parts = [f"?s <{V.RDF_TYPE}> <{V.PERSON}>", *(f"FILTER({c})" for c in (*self.subject, *bounds))]
        if self.predicate:  # a person without such a triple is none here, so a page's persons all show
            parts.append(f"FILTER EXISTS {{ ?s ?p ?v FILTER({' && '.join(self.predicate)}) }}")
        return " . ".join(parts)

    def count(self) -> str:
        return f"SELECT (COUNT(DISTINCT ?s) AS ?n) WHERE {{ {self._where()} }}"

    def bound(self, place: int) -> str:
        return f"SELECT DISTINCT ?s WHERE {{ {self._where()} }} ORDER BY ?s LIMIT 1 OFFSET {place}"

    def page(self, after: str | None, upto: str | None, size: int) -> str:
        """All triples of the next `size` persons behind `after`, none behind `upto`."""
        bounds = [f"STR(?s) {sign} {string(x)}" for sign, x in ((">", after), ("<=", upto)) if x is not None]
        inner = f"SELECT DISTINCT ?s WHERE {{ {self._where(*bounds)} }} ORDER BY ?s LIMIT {size}"
        kept = f" FILTER({' && '.join(self.predicate)})" if self.predicate else ""
        return f"SELECT ?s ?p ?o WHERE {{ {{ {inner} }} ?s ?p ?o{kept} }} ORDER BY ?s"


@dataclass
class _Range(InputPartition):
    after: str | None
    upto: str | None


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.size, self.most = int(options.get("page_size", 5000)), int(options.get("ranges", 32))
        self.endpoint, self.persons = _endpoint(options), Persons()

    def partitions(self) -> list[_Range]:
        n = int(self.endpoint.query(self.persons.count())[0]["n"])
        ranges = max(1, min(self.most, -(-n // self.size)))
        found = [r[0]["s"] for k in range(1, ranges) if (r := self.endpoint.query(self.persons.bound(k * n // ranges - 1)))]
        bounds = [None, *sorted(set(found)), None]
        return [_Range(a, b) for a, b in zip(bounds, bounds[1:], strict=False)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        after, seen = partition.after, self.size
        while seen == self.size:
            seen, pos, before = 0, 0, None
            for r in self.endpoint.query(self.persons.page(after, partition.upto, self.size)):
                pos = pos + 1 if r["s"] == before else 0
                seen += r["s"] != before
                before = r["s"]
                yield r["s"], pos, r["p"], r["o"]
            after = before


class _PushingReader(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        found: dict[str, list[str]] = {"s": [], "p": []}
        for f in filters:
            if said := condition(f):
                found[said[0]].append(said[1])
            else:
                yield f
        self.persons = Persons(tuple(found["s"]), tuple(found["p"]))


class SparqlTriples(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sparql_triples"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return (_PushingReader if self.options.get("push") == "true" else _Reader)(self.options)


def insert_text(lines: list[str], graph: str) -> str:
    return "INSERT DATA { GRAPH <%s> {\n%s\n} }" % (graph, "\n".join(lines))


@dataclass
class Sent(WriterCommitMessage):
    statements: int
    lines: int


class _Writer(DataSourceWriter):
    """Each task sends its lines in statements of at most `most`; a task that runs again sends them again, which inserts
    nothing new. What was sent is summed on commit."""

    def __init__(self, options: dict):
        self.endpoint, self.graph, self.most = _endpoint(options), options["graph"], int(options.get("most", 5000))

    def write(self, iterator: Iterator) -> Sent:
        held, statements, lines = [], 0, 0

        def send() -> None:
            nonlocal held, statements, lines
            self.endpoint.update(insert_text(held, self.graph))
            held, statements, lines = [], statements + 1, lines + len(held)

        for row in iterator:
            held.append(row["line"])
            if len(held) == self.most:
                send()
        if held:
            send()
        return Sent(statements, lines)

    def _note(self, operation: str, text: str) -> None:
        if self.endpoint.log:
            self.endpoint.log(operation, text)

    def commit(self, messages: list[Sent | None]) -> None:
        sent = [m for m in messages if m is not None]
        n, lines = sum(m.statements for m in sent), sum(m.lines for m in sent)
        self._note("commit", f"{n} updates of {lines} lines to {self.graph}" if n else f"nothing to write to {self.graph}")

    def abort(self, messages: list[Sent | None]) -> None:
        sent = [m for m in messages if m is not None]
        self._note("abort", f"at least {sum(m.statements for m in sent)} updates reached {self.graph} before the write failed; it can be repeated")


class SparqlUpdates(DataSource):
    """Takes rows with a column line, one N-Triples statement each."""

    @classmethod
    def name(cls) -> str:
        return "sparql_update"

    def schema(self) -> str:
        return "line string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)
