"""All registered queries and their DuckDB oracles, by name."""

from __future__ import annotations

from linkweave.plans import oracle_api, oracle_graph, oracle_io, oracle_links, oracle_text
from linkweave.plans import queries_api, queries_graph, queries_io, queries_links, queries_text


def queries():
    out = {}
    out.update(queries_text.QUERIES)
    out.update(queries_links.QUERIES)
    out.update(queries_graph.QUERIES)
    out.update(queries_api.QUERIES)
    out.update(queries_io.QUERIES)
    return out


def oracle_sql():
    out = {}
    out.update(oracle_text.oracle_sql())
    out.update(oracle_links.oracle_sql())
    out.update(oracle_graph.oracle_sql())
    out.update(oracle_api.oracle_sql())
    out.update(oracle_io.oracle_sql())
    return out
