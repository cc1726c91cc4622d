"""Registration of queries: a callable (spark, sf_dir) -> DataFrame, and the same result in SQL over the fixtures."""

from __future__ import annotations

from collections.abc import Callable

from hillframe.sources.fixtures import ctes, fixture


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, names: str, sql: str | None = None):
        """Decorate a function of the named fixtures' DataFrames; sql begins after their WITH clauses."""
        used = names.split()

        def wrap(f):
            self.queries[name] = lambda spark, sf_dir: f(*(fixture(spark, sf_dir, n) for n in used))
            if sql:
                body, tables = sql.strip(), ctes(*used)
                if body.startswith("WITH RECURSIVE "):
                    body, tables = "WITH " + body[15:], tables.replace("WITH ", "WITH RECURSIVE ", 1)
                self.oracles[name] = tables + (",\n" + body[5:] if body.startswith("WITH ") else "\n" + body)
            return f

        return wrap

    def table(self, name: str, table: str, sql: str | None = None):
        """Decorate a function of one table's DataFrame, as it is stored."""

        def wrap(f):
            self.queries[name] = lambda spark, sf_dir: f(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
            if sql:
                self.oracles[name] = sql.strip()
            return f

        return wrap
