"""Substring and token predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A token is a run of ASCII letters and digits, lower-cased.
TOKEN_BREAK = "[^a-z0-9]+"


def contains(text: Column, term: str, ignore_case: bool = False) -> Column:
    """``term`` occurs anywhere in ``text``.

    The case-sensitive form is pushed to the Parquet reader; the other is not,
    because the reader cannot lower-case a column.
    """
    if ignore_case:
        return F.lower(text).contains(term.lower())
    return text.contains(term)


def tokens(text: Column) -> Column:
    """All tokens of ``text`` in order, without the empty edge pieces."""
    return F.array_remove(F.split(F.lower(text), TOKEN_BREAK), "")


def normal_term(term: str) -> str:
    """The single token a search term stands for."""
    parts = [p for p in re.split(TOKEN_BREAK, term.lower()) if p]
    if len(parts) != 1:
        raise ValueError(f"a search term must be one token, got {term!r}")
    return parts[0]


def has_token(text: Column, term: str) -> Column:
    """``term`` is one of the tokens of ``text``.

    The plain substring test runs first: it rejects most rows without the
    regular expression, and a token is always also a substring.
    """
    token = normal_term(term)
    lowered = F.lower(text)
    return lowered.contains(token) & lowered.rlike(f"(^|[^a-z0-9]){token}([^a-z0-9]|$)")


def parsed_once(text: Column, schema: StructType, options: dict[str, str] | None = None) -> Column:
    """JSON text as a struct, to be used in a ``select`` by itself.

    Spark copies an expression into every filter on its fields, and would parse
    a record once per copy. It does not move filters below an ``explode``, so the
    record is exploded from an array of one.
    """
    return F.explode(F.array(F.from_json(text, schema, options or {})))
