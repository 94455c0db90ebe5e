"""The vocabulary that the triples and the published assertions use."""

from __future__ import annotations

# Namespaces and their prefixes, tried in this order.
NAMESPACES = {
    "http://schema.org/": "schema:",
    "https://open-pulse.epfl.ch/ontology#": "pulse:",
    "http://www.w3.org/ns/org#": "org:",
    "https://openpulse.science/git-metadata-extractor#": "gme:",
    "http://www.w3.org/1999/02/22-rdf-syntax-ns#": "rdf:",
}

# Predicates with one value, and predicates with a list of values.
SCALARS = {
    "github_username": "pulse:githubUsername",
    "email": "schema:email",
    "url": "schema:url",
    "orcid": "pulse:orcidIdentifier",
    "infoscience_id": "pulse:infosciencePersonIdentifier",
    "bio": "gme:bio",
    "location": "gme:location",
    "company": "gme:company",
}
LISTS = {"has_contribution": "pulse:hasContribution", "has_membership": "org:hasMembership", "owns": "pulse:owns"}

RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
PERSON = "http://schema.org/Person"
NAME = "schema:name"

# Terms of a published assertion.
DEDUP = "https://open-pulse.epfl.ch/ontology/dedup#"
PROV_TIME = "http://www.w3.org/ns/prov#generatedAtTime"
XSD = "http://www.w3.org/2001/XMLSchema#"
DEFAULT_GRAPH = "https://open-pulse.epfl.ch/graph/dedup"

# Patterns, in Java's dialect (Unicode classes, strict end).
EMAIL = r"(?U)^[\w\-.]+@([\w-]+\.)+[\w-]{2,4}\z"
ORCID = r"(?U)^\d{4}-\d{4}-\d{4}-\d{3}[0-9X]\z"
GITHUB_URL = r"^https?://(?:www\.)?github\.com/([^/]+)/?$"
UUID = r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
