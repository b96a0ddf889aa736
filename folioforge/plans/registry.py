"""The catalogue of queries: a name, a plan over a folder of tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ops: tuple[str, ...]
    run: Run
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(*ops: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Registers a plan under its function's name."""

    def add(run: Run) -> Run:
        if run.__name__ in CATALOGUE:
            raise ValueError(f"query {run.__name__} is registered twice")
        CATALOGUE[run.__name__] = Query(run.__name__, ops, run, sql)
        return run

    return add


# Common table expressions of the SQL side.
BOOKS = "books AS (SELECT *, concat(coalesce(source, ''), '/', CAST(doc_id // 1000 AS VARCHAR)) AS book, doc_id AS page FROM documents)"
LINES = BOOKS + ", lines AS (SELECT book, page, doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line_no FROM books)"
PREFIX = r"'^[ \t]*(#{1,6}[ \t]+|[-*+][ \t]+|[0-9]+[.)][ \t]+|>[ \t]*)?'"


def core(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, {PREFIX}, ''), '[^\p{{L}}\p{{N}}]', '', 'g')"


KIND = r"""CASE WHEN trim({x}) = '' THEN 'blank' WHEN regexp_matches({x}, '^ {{0,3}}(```|~~~)') THEN 'fence' WHEN regexp_matches({x}, '^ {{0,3}}#{{1,6}}[ \t]') THEN 'heading'
 WHEN regexp_matches({x}, '^ {{0,3}}([-*_][ \t]*){{3,}}$') THEN 'rule' WHEN regexp_matches({x}, '^[ \t]*([-*+]|[0-9]+[.)])[ \t]+') THEN 'list'
 WHEN regexp_matches({x}, '^[ \t]*\|') OR regexp_matches({x}, ' \| ') THEN 'table' WHEN regexp_matches({x}, '^[ \t]*>') THEN 'quote' WHEN regexp_matches({x}, '^(  |\t)') THEN 'indented' ELSE 'prose' END"""


def kind(x: str) -> str:
    return KIND.format(x=x)
