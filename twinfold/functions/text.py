"""Column expressions on strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinfold.functions import vocabulary as V


def present(c: Column | str) -> Column:
    """The value, or null where it is empty: an empty string counts as missing."""
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))


def shorten(iri: Column) -> Column:
    """The first matching namespace replaced by its prefix; other IRIs as they are."""
    out = iri
    for base, prefix in reversed(V.NAMESPACES.items()):
        out = F.when(iri.startswith(base), F.concat(F.lit(prefix), F.substring(iri, len(base) + 1, 2**31 - 1))).otherwise(out)
    return out


def bare_orcid(value: Column) -> Column:
    return F.substring_index(value, "/", -1)


def github_key(username: Column, url: Column) -> Column:
    """The case-folded account: the username if there is one, else the one segment of a profile URL; else null."""
    own = F.nullif(username, F.lit(""))
    return F.lower(F.coalesce(own, F.nullif(F.regexp_extract(url, V.GITHUB_URL, 1), F.lit(""))))


def uuid_key(value: Column) -> Column:
    """The first UUID anywhere in the value, in small letters; else null."""
    return F.nullif(F.lower(F.regexp_extract(value, V.UUID, 0)), F.lit(""))


def embed_text(*fields: str) -> Column:
    """Non-empty fields joined by a space."""
    return F.concat_ws(" ", *(present(f) for f in fields))


def cache_key(model: str, text: Column) -> Column:
    """SHA-256 of model, NUL and text."""
    return F.sha2(F.concat(F.lit(model), F.lit("\0"), text).cast("binary"), 256)


def decimal_text(value: Column) -> Column:
    """Plain decimal digits: no exponent, no trailing zeros but one digit after the point."""
    text = F.regexp_replace(value.cast("decimal(18,6)").cast("string"), "0+$", "")
    return F.when(text.endswith("."), F.concat(text, F.lit("0"))).otherwise(text)


def literal_text(value: Column) -> Column:
    """A quoted N-Triples literal: backslash, quote, line feed, carriage return and other controls escaped."""
    out = value
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), out, F.lit('"'))


def iri_text(value: Column) -> Column:
    """An IRI in angle brackets; characters that may not stand there are percent-encoded."""
    out = value
    for c in '<>"{}|^`\\ \n\r\t':
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.concat(F.lit("<"), out, F.lit(">"))


def utc_iso(moment: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
