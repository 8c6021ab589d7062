"""Registry of named queries: an operator applied to a view of the tables, with the same thing in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from .plans.views import VIEW_SQL, Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a function of Views. sql may use the named views (and what they are built from)."""
    def wrap(f: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Views(spark, sf_dir))

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(views, dedent(sql).strip())
        return f

    return wrap


def with_views(views: str, sql: str) -> str:
    """sql with the views it uses, and those they use, before it."""
    order: list[str] = []

    def add(v: str) -> None:
        needs, _ = VIEW_SQL[v]
        for n in needs:
            add(n)
        if v not in order:
            order.append(v)

    for v in views.split():
        add(v)
    if not order:
        return sql
    own, recursive = ("", sql)
    if sql.upper().startswith("WITH RECURSIVE "):
        own, recursive = ", " + sql[15:], ""
    elif sql.upper().startswith("WITH "):
        own, recursive = ", " + sql[5:], ""
    head = "WITH RECURSIVE " if "WITH RECURSIVE" in sql.upper()[:16] else "WITH "
    return head + ",\n".join(f"{v} AS ({dedent(VIEW_SQL[v][1]).strip()})" for v in order) + (own or "\n" + recursive)


from .plans import annotation, coverage, formats, hits, matrix, sequences, stages  # noqa: E402, F401
