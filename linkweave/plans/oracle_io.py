"""DuckDB SQL for the queries that write files and read them back: the same rows without any file."""

from __future__ import annotations

from linkweave.plans import oracle_graph, oracle_links, oracle_text

SUMMARY = """, ranked AS (
  SELECT CAST(row_number() OVER (ORDER BY size DESC, CAST(modularity_class AS VARCHAR)) AS BIGINT) AS rank, modularity_class, size,
         round(size * 100.0 / (SELECT count(*) FROM met), 2) AS pct
  FROM sizes QUALIFY rank <= 10
),
tops AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY modularity_class ORDER BY degree DESC, Id) AS BIGINT) AS node_rank FROM met QUALIFY node_rank <= 10
)
SELECT CAST(modularity_class AS VARCHAR) AS modularity_class, rank, size, pct, node_rank, Id, Label, CAST(degree AS DOUBLE) AS degree
FROM ranked JOIN tops USING (modularity_class)"""


NETWORKS = """, vl AS (SELECT source, target FROM links WHERE source IN (SELECT url FROM visited)),
kept AS (SELECT target FROM vl GROUP BY target HAVING count(*) >= 3)
SELECT 'visited' AS kind, 'https://w.test/wiki/' || url AS a, NULL AS b, NULL AS Type, CAST(NULL AS DOUBLE) AS Weight FROM visited
UNION ALL
SELECT 'link', 'https://w.test/wiki/' || source, 'https://w.test/wiki/' || target, 'Directed', 1.0 FROM vl WHERE target IN (SELECT target FROM kept)"""


def oracle_sql() -> dict[str, str]:
    return {
        "usable_pages": "SELECT page_id, url FROM pages WHERE page_id % 4 <> 0 AND page_id % 7 <> 0 AND page_id % 3 <> 0 AND page_id % 5 <> 0",
        "graph_csv": oracle_text.with_ctes(
            "SELECT s.node AS a, s.grp AS a_group, t.node AS b, t.Attribute AS b_attribute, e2.Type, CAST(e2.Weight AS DOUBLE) AS Weight "
            "FROM e2 JOIN ids x ON e2.a = x.node JOIN ids y ON e2.b = y.node "
            "JOIN ids s ON s.Id = least(x.Id, y.Id) JOIN ids t ON t.Id = greatest(x.Id, y.Id)",
            graph=True,
        ),
        "label_csv": f"SELECT CAST(Id AS VARCHAR) AS Id, Label, \"Group\", CAST(Attribute AS VARCHAR) AS Attribute FROM ({oracle_links.oracle_sql()['clean_labels']})",
        "visited_file": oracle_graph.oracle_sql()["visited_list"],
        "metrics_csv": f"WITH {oracle_graph.GRAPH_CTES}\nSELECT Id, Label, CAST(degree AS DOUBLE) AS degree, CAST(modularity_class AS VARCHAR) AS modularity_class FROM met",
        "job_networks": oracle_graph._ordered() + NETWORKS,
        "job_summary": f"WITH {oracle_graph.GRAPH_CTES}{SUMMARY}",
    }
