"""Query registry. ``@query(sql)`` registers a function under its own name.

Oracle texts may use the shared table expressions in ``CTES`` (the driver tables seen as
messages, calls, schedules ...); the ones a text mentions are put in front of it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def full_sql(body: str) -> str:
    """Prefix ``body`` with every CTE it needs, in definition order."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        text = texts.pop()
        for name, sql in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                texts.append(sql)
    parts = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed]
    own = body.strip()
    if own.upper().startswith("WITH "):
        parts.append(own[5:].strip())
        return "WITH " + ",\n".join(parts[:-1] + [parts[-1]])
    return ("WITH " + ",\n".join(parts) + "\n" + own) if parts else own


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def oracle_texts() -> dict[str, str]:
    return {name: full_sql(sql) for name, sql in ORACLES.items()}
