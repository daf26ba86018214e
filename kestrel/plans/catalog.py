"""Registry of named queries over the test tables, each with an independent SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> str`` (DuckDB SQL
over views named after the test tables). Queries without an oracle are compared on
row counts only (fitted models, checksums whose text form differs between engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _bigint_count_if(sql: str) -> str:
    """DuckDB's ``count_if`` returns HUGEINT; Spark's returns bigint. Wrap every call in a
    bigint cast so both engines report the same column type."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(token)])
            i = j + len(token)
            continue
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = _bigint_count_if(sql)
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries (idempotent)."""
    import importlib
    import importlib.util

    for mod in MODULES:
        name = f"kestrel.plans.{mod}"
        if importlib.util.find_spec(name) is not None:
            importlib.import_module(name)


MODULES = ("q_panel", "q_clean", "q_integrate", "q_validate", "q_explore", "q_model", "q_ml",
           "q_ingest", "q_views", "q_supplier")
