"""DuckDB SQL for the part-supplier graph queries and the traversal depths."""

from __future__ import annotations

GRAPH_CTES = """
e0 AS (
  SELECT 2 * l_partkey AS s, 2 * l_suppkey + 1 AS t, l_quantity AS w, l_orderkey, l_linenumber FROM lineitem
),
g AS (
  SELECT least(s, t) AS u, greatest(s, t) AS v,
         arg_max(w, {'o': l_orderkey, 'l': l_linenumber}) AS w
  FROM e0 GROUP BY least(s, t), greatest(s, t)
),
nodes AS (SELECT u AS Id FROM g UNION SELECT v AS Id FROM g),
deg AS (
  SELECT Id, CAST(count(*) AS BIGINT) AS degree FROM (SELECT u AS Id FROM g UNION ALL SELECT v AS Id FROM g) GROUP BY Id
),
part AS (
  SELECT n.Id, CAST(CASE WHEN n.Id % 2 = 0 THEN (n.Id // 2) % 25 ELSE s.s_nationkey END AS BIGINT) AS community
  FROM nodes n LEFT JOIN supplier s ON n.Id = 2 * s.s_suppkey + 1
),
met AS (
  SELECT d.Id, CASE WHEN d.Id % 2 = 0 THEN 'P' || CAST(d.Id // 2 AS VARCHAR) ELSE 'S' || CAST((d.Id - 1) // 2 AS VARCHAR) END AS Label,
         d.degree, p.community AS modularity_class
  FROM deg d JOIN part p USING (Id)
),
sizes AS (SELECT modularity_class, CAST(count(*) AS BIGINT) AS size FROM met WHERE modularity_class IS NOT NULL GROUP BY modularity_class),
topc AS (
  SELECT CAST(row_number() OVER (ORDER BY size DESC, modularity_class) AS BIGINT) AS rank, modularity_class, size,
         round(size * 100.0 / (SELECT count(*) FROM met), 2) AS pct
  FROM sizes QUALIFY rank <= 10
)"""


def _w(body: str) -> str:
    return f"WITH {GRAPH_CTES}\n{body}"


TRAVERSAL = """
WITH RECURSIVE
pairs AS (SELECT DISTINCT 'P' || CAST(l_partkey AS VARCHAR) AS p, 'S' || CAST(l_suppkey AS VARCHAR) AS s FROM lineitem),
links AS (SELECT p AS source, s AS target FROM pairs UNION ALL SELECT s AS source, p AS target FROM pairs),
avail AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS url FROM part
  UNION SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS url FROM supplier
),
seed AS (
  SELECT 'P' || CAST(l_partkey AS VARCHAR) AS url FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 1
),
bfs(url, depth) AS (
  SELECT url, 0 FROM seed WHERE url IN (SELECT url FROM avail)
  UNION
  SELECT l.target, b.depth + 1 FROM bfs b JOIN links l ON l.source = b.url
  WHERE b.depth < 100 AND l.target IN (SELECT url FROM avail)
)
SELECT url, CAST(min(depth) AS BIGINT) AS depth FROM bfs GROUP BY url
"""


def _ordered(levels: int = 12, cap: int = 100) -> str:
    """Visit order with the levels written out: a level's pages by their earliest parent, then by url.  Only the first ``cap`` pages
    are asked for, and a level that is cut is the last one that counts."""
    parts = ["l0 AS (SELECT url, 0 AS depth, CAST(0 AS BIGINT) AS ord FROM seed WHERE url IN (SELECT url FROM avail))"]
    for d in range(1, levels + 1):
        seen = " UNION ALL ".join(f"SELECT url, ord FROM l{k}" for k in range(d))
        parts.append(f"""s{d} AS ({seen}),
l{d} AS (
  SELECT url, {d} AS depth, (SELECT count(*) FROM s{d}) - 1 + row_number() OVER (ORDER BY parent, url) AS ord
  FROM (
    SELECT l.target AS url, min(p.ord) AS parent FROM l{d - 1} p JOIN links l ON l.source = p.url
    WHERE l.target IN (SELECT url FROM avail) AND l.target NOT IN (SELECT url FROM s{d}) AND (SELECT count(*) FROM s{d}) < {cap}
    GROUP BY l.target
  )
)""")
    every = " UNION ALL ".join(f"SELECT * FROM l{k}" for k in range(levels + 1))
    head = TRAVERSAL[: TRAVERSAL.index("bfs(url, depth)")].replace("RECURSIVE", "")
    return head + ",\n".join(parts) + f",\nvisited AS (SELECT url, depth, ord FROM ({every}) WHERE ord < {cap})\n"


def oracle_sql() -> dict[str, str]:
    return {
        "simple_graph": _w("SELECT u, v, CAST(w AS DOUBLE) AS w FROM g"),
        "node_degree": _w("SELECT Id, degree FROM deg"),
        "modularity": _w(
            """, ec AS (SELECT g.w, pu.community AS cu, pv.community AS cv FROM g JOIN part pu ON pu.Id = g.u JOIN part pv ON pv.Id = g.v),
dc AS (SELECT c, sum(w) AS d FROM (SELECT cu AS c, w FROM ec UNION ALL SELECT cv AS c, w FROM ec) GROUP BY c)
SELECT round(coalesce((SELECT sum(w) FILTER (WHERE cu = cv) FROM ec), 0) / (SELECT sum(w) FROM ec)
             - (SELECT sum(d * d) FROM dc) / (4.0 * (SELECT sum(w) FROM ec) * (SELECT sum(w) FROM ec)), 6) AS modularity"""
        ).replace("WITH \ne0", "WITH e0").replace(")\n, ec", "), ec"),
        "community_sizes": _w("SELECT community, CAST(count(*) AS BIGINT) AS size FROM part GROUP BY community"),
        "top_communities": _w("SELECT rank, modularity_class, size, pct FROM topc"),
        "top_nodes": _w(
            """SELECT modularity_class, node_rank, Id, Label, degree FROM (
  SELECT m.*, CAST(row_number() OVER (PARTITION BY m.modularity_class ORDER BY m.degree DESC, m.Id) AS BIGINT) AS node_rank
  FROM met m WHERE m.modularity_class IN (SELECT modularity_class FROM topc)
) WHERE node_rank <= 10"""
        ),
        "traversal_depth": TRAVERSAL,
        "traversal_order": _ordered() + "SELECT url, depth, ord FROM visited",
        "visited_list": _ordered() + "SELECT url FROM visited",
    }
