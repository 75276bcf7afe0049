"""How a module of queries keeps its functions and their SQL."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict, Callable]:
    """QUERIES, SQL, and a decorator that enters a function under a name with its SQL."""
    queries: dict[str, Callable] = {}
    texts: dict[str, str] = {}

    def query(name: str, sql: str | None = None) -> Callable:
        def keep(function: Callable) -> Callable:
            queries[name] = function
            if sql:
                texts[name] = sql
            return function

        return keep

    return queries, texts, query
