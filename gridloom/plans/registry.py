"""The registered queries of the library's own operators, each with its SQL where SQL can express it."""

from __future__ import annotations

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function (spark, sf_dir) under its own name."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _load() -> None:
    from gridloom.plans import catalog  # noqa: F401  (registers on import)


def queries() -> dict:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
