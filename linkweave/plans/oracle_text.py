"""DuckDB SQL for the text and word-network queries (the correctness oracle).

Written independently of the Spark plans: one row per token with window
functions (DuckDB), and the co-occurrence weight by enumerating every window
that holds a pair, not by the closed form used in Spark.
"""

from __future__ import annotations

import re

from linkweave.functions.fixed import (
    DEFAULT_EDGE_PRUNE_PERCENTILE,
    DEFAULT_MIN_EDGE_WEIGHT,
    DEFAULT_MIN_NODE_FREQ,
    DEFAULT_NODE_PRUNE_PERCENTILE,
    DEFAULT_TOP_N_BIGRAMS,
    DEFAULT_WINDOW_SIZE,
    default_lexicon,
    default_stop_words,
)
from linkweave.functions.text import lexicon_split


def _quote_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(words))


def text_ctes(window: int = DEFAULT_WINDOW_SIZE, top_n: int = DEFAULT_TOP_N_BIGRAMS) -> str:
    """CTEs: raw tokens -> content words (cw) -> vocabulary (voc) -> bigrams
    (big) -> word counts (g1) -> pair weights (cooc) -> top bigrams (topb)."""
    dropped, lemmas = lexicon_split(default_lexicon())
    drop = _quote_list(set(default_stop_words()) | set(dropped))
    word_expr = "t"
    if lemmas:
        cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(lemmas.items()))
        word_expr = f"CASE t {cases} ELSE t END"
    return f"""
raw AS (
  SELECT doc_id, regexp_split_to_array(regexp_replace(lower(text), '[^a-zA-Z\\s]', '', 'g'), '\\s+') AS l
  FROM documents
),
tok AS (SELECT doc_id, unnest(l) AS t, unnest(range(1, len(l) + 1)) AS p FROM raw),
cw AS (
  SELECT doc_id, {word_expr} AS word,
         CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS BIGINT) AS pos
  FROM tok
  WHERE t <> '' AND length(t) >= 3 AND t NOT IN ({drop})
),{count_ctes(window, top_n)}"""


def count_ctes(window: int = DEFAULT_WINDOW_SIZE, top_n: int = DEFAULT_TOP_N_BIGRAMS) -> str:
    """What is counted over the tokens ``cw``."""
    return f"""
cnt AS (SELECT doc_id, word, count(*) AS n, min(pos) AS first FROM cw GROUP BY doc_id, word),
top100 AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS r0 FROM cnt
  QUALIFY r0 <= 100
),
voc AS (
  SELECT doc_id, word, n, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY r0) AS BIGINT) AS rank
  FROM top100 WHERE regexp_full_match(word, '\\pL+')
),
big0 AS (
  SELECT doc_id, rank, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY rank) AS bigram FROM voc
),
big AS (SELECT doc_id, rank, bigram FROM big0 WHERE bigram IS NOT NULL),
g1 AS (
  SELECT word, count(*) AS freq, min({{'d': doc_id, 'p': pos}}) AS first FROM cw GROUP BY word
),
lens AS (SELECT doc_id, count(*) AS n FROM cw GROUP BY doc_id),
cwn AS (SELECT cw.*, lens.n FROM cw JOIN lens USING (doc_id) WHERE lens.n >= {window}),
pairwin AS (
  SELECT least(a.word, b.word) AS w1, greatest(a.word, b.word) AS w2,
         unnest(range(greatest(0, b.pos - {window - 1}), least(a.pos, a.n - {window}) + 1)) AS s
  FROM cwn a JOIN cwn b ON a.doc_id = b.doc_id AND b.pos > a.pos AND b.pos <= a.pos + {window - 1}
),
cooc AS (SELECT w1, w2, count(*) AS Weight FROM pairwin GROUP BY w1, w2),
bc AS (SELECT bigram, count(*) AS n, min({{'d': doc_id, 'r': rank}}) AS first FROM big GROUP BY bigram),
topb AS (
  SELECT bigram, n, CAST(row_number() OVER (ORDER BY n DESC, first) AS BIGINT) AS rank FROM bc
  QUALIFY rank <= {top_n}
)"""


def graph_ctes(
    edge_pct: float = DEFAULT_EDGE_PRUNE_PERCENTILE,
    min_w: int = DEFAULT_MIN_EDGE_WEIGHT,
    node_pct: float = DEFAULT_NODE_PRUNE_PERCENTILE,
    min_f: int = DEFAULT_MIN_NODE_FREQ,
) -> str:
    """CTEs on top of :func:`text_ctes`: nodes0/alle (unpruned), n1/e2 (pruned),
    ids (numbered pruned nodes)."""
    return f"""
nodes0 AS (
  SELECT coalesce(w.word, t.bigram) AS node,
         CASE WHEN t.bigram IS NOT NULL THEN 'bigram' ELSE 'word' END AS grp,
         CAST(coalesce(t.n, w.freq) AS BIGINT) AS Attribute,
         CASE WHEN w.word IS NOT NULL THEN 0 ELSE 1 END AS k1,
         CASE WHEN w.word IS NOT NULL THEN w.first.d ELSE t.rank END AS k2,
         CASE WHEN w.word IS NOT NULL THEN w.first.p ELSE 0 END AS k3
  FROM g1 w FULL OUTER JOIN topb t ON w.word = t.bigram
),
und AS (SELECT w1 AS a, w2 AS b, 'Undirected' AS Type, CAST(Weight AS BIGINT) AS Weight, 1 AS prio FROM cooc),
split2 AS (
  SELECT bigram, string_split(bigram, ' ') AS sp FROM topb
  WHERE len(string_split(bigram, ' ')) = 2
),
con AS (
  SELECT DISTINCT least(bigram, w) AS a, greatest(bigram, w) AS b, 'Contains' AS Type, CAST(1 AS BIGINT) AS Weight, 2 AS prio
  FROM (SELECT bigram, unnest(sp) AS w FROM split2
        WHERE sp[1] IN (SELECT node FROM nodes0) AND sp[2] IN (SELECT node FROM nodes0))
),
coo AS (
  SELECT DISTINCT least(x.bigram, y.bigram) AS a, greatest(x.bigram, y.bigram) AS b,
         'Co-occurs' AS Type, CAST(1 AS BIGINT) AS Weight, 3 AS prio
  FROM topb x JOIN topb y ON x.rank < y.rank
  WHERE len(list_intersect(string_split(x.bigram, ' '), string_split(y.bigram, ' '))) > 0
),
alle AS (
  SELECT a, b, arg_max(Type, prio) AS Type, arg_max(Weight, prio) AS Weight
  FROM (SELECT * FROM und UNION ALL SELECT * FROM con UNION ALL SELECT * FROM coo)
  GROUP BY a, b
),
ethr AS (SELECT quantile_cont(Weight, {edge_pct / 100.0}) AS t FROM alle),
e1 AS (SELECT alle.* FROM alle, ethr WHERE Weight >= ethr.t AND Weight >= {min_w}),
nthr AS (SELECT quantile_cont(Attribute, {node_pct / 100.0}) AS t FROM nodes0 WHERE grp = 'word'),
n1 AS (
  SELECT nodes0.* FROM nodes0, nthr
  WHERE grp <> 'word' OR (Attribute >= nthr.t AND Attribute >= {min_f})
),
e2 AS (
  SELECT * FROM e1 WHERE a IN (SELECT node FROM n1) AND b IN (SELECT node FROM n1)
),
ids AS (SELECT *, CAST(row_number() OVER (ORDER BY k1, k2, k3) AS BIGINT) AS Id FROM n1),
ids0 AS (SELECT *, CAST(row_number() OVER (ORDER BY k1, k2, k3) AS BIGINT) AS Id FROM nodes0)"""


def with_ctes(body: str, graph: bool = False) -> str:
    ctes = text_ctes()
    if graph:
        ctes += "," + graph_ctes()
    return f"WITH {ctes}\n{body}"


ENTITY_BODY = """,
alltok AS (SELECT doc_id, t, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS BIGINT) AS i FROM tok WHERE t <> ''),
grams AS (
  SELECT doc_id, i, t || ' ' || lead(t) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM alltok
),
hits AS (SELECT doc_id, i, g FROM grams WHERE g IN (SELECT bigram FROM topb)),
runs AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS grp FROM hits
),
chosen AS (
  SELECT doc_id, i, g, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM (
    SELECT *, min(i) OVER (PARTITION BY doc_id, grp) AS start FROM runs
  ) WHERE (i - start) % 2 = 0
),
nw AS (SELECT doc_id, count(*) AS n FROM cw GROUP BY doc_id)
SELECT c.doc_id, CAST(coalesce(nw.n, 0) + c.k - 1 AS BIGINT) AS pos, c.g AS entity
FROM chosen c LEFT JOIN nw USING (doc_id)"""


def entity_graph_sql(body: str) -> str:
    """The graph of words and entities: the counts once more, over words followed by entities."""
    entities = ENTITY_BODY.lstrip(",").replace("\nSELECT c.doc_id,", ",\nents AS (SELECT c.doc_id,") + ")"
    tokens = "cwe AS (SELECT doc_id, word, pos FROM cw UNION ALL SELECT doc_id, entity, pos FROM ents)"
    again = count_ctes() + "," + graph_ctes()
    for name in ("cw", "cnt", "top100", "voc", "big0", "big", "g1", "lens", "cwn", "pairwin", "cooc", "bc", "topb"):
        again = re.sub(rf"\b{name}\b", f"{name}e", again)
    return f"WITH {text_ctes()},{entities},\n{tokens},{again}\n{body}"


def annotated_words_sql() -> str:
    verbs = ", ".join(f"('{s}', '{x}')" for s, x, _ in default_lexicon())
    return f"""WITH {text_ctes()},
lex AS (SELECT surface, min(verb) AS verb FROM (VALUES {verbs}) AS v(surface, verb) GROUP BY surface),
alltok AS (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS i FROM tok WHERE t <> ''),
lemmas AS (
  SELECT doc_id, i, CASE WHEN length(t) >= 6 AND t LIKE '%s' THEN t[:-2] ELSE t END AS word
  FROM alltok WHERE length(t) >= 3 AND t NOT IN (SELECT surface FROM lex) AND t NOT IN ({_quote_list(default_stop_words())})
),
words AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos FROM lemmas),
islands AS (SELECT doc_id, i, t, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM alltok WHERE length(t) >= 7),
named AS (
  SELECT doc_id, min(i) AS i, string_agg(t, ' ' ORDER BY i) AS word FROM islands GROUP BY doc_id, run HAVING count(*) > 1
),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
ents AS (
  SELECT doc_id, word, coalesce(n, 0) + row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos
  FROM named LEFT JOIN sizes USING (doc_id)
)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, word FROM words UNION ALL SELECT doc_id, CAST(pos AS BIGINT), word FROM ents"""


NODES = 'SELECT Id, node AS Label, grp AS "Group", Attribute FROM ids'
EDGES = (
    "SELECT least(s.Id, t.Id) AS Source, greatest(s.Id, t.Id) AS Target, e2.Type, e2.Weight "
    "FROM e2 JOIN ids s ON e2.a = s.node JOIN ids t ON e2.b = t.node"
)


def oracle_sql() -> dict[str, str]:
    return {
        "entity_tokens": f"WITH {text_ctes()}{ENTITY_BODY}",
        "entity_graph_nodes": entity_graph_sql(NODES),
        "entity_graph_edges": entity_graph_sql(EDGES),
        "annotated_words": annotated_words_sql(),
        "normalised_text": "SELECT doc_id, regexp_replace(lower(text), '[^a-zA-Z\\s]', '', 'g') AS text FROM documents",
        "content_words": with_ctes("SELECT doc_id, pos, word FROM cw"),
        "doc_vocabulary": with_ctes("SELECT doc_id, rank, word, CAST(n AS BIGINT) AS n FROM voc"),
        "doc_bigrams": with_ctes("SELECT doc_id, CAST(rank AS BIGINT) AS rank, bigram FROM big"),
        "word_nodes": with_ctes(
            "SELECT word, CAST(freq AS BIGINT) AS freq, CAST(first.d AS BIGINT) AS first_doc, "
            "CAST(first.p AS BIGINT) AS first_pos FROM g1"
        ),
        "cooccurrence": with_ctes("SELECT w1, w2, CAST(Weight AS BIGINT) AS Weight FROM cooc"),
        "top_bigrams": with_ctes("SELECT bigram, CAST(n AS BIGINT) AS n, rank FROM topb"),
        "contains_edges": with_ctes("SELECT a, b, Type, Weight FROM con", graph=True),
        "bigram_edges": with_ctes("SELECT a, b, Type, Weight FROM coo", graph=True),
        "merged_edges": with_ctes("SELECT a, b, Type, Weight FROM alle", graph=True),
        "edge_threshold": with_ctes("SELECT round(t, 6) AS threshold FROM ethr", graph=True),
        "node_threshold": with_ctes("SELECT round(t, 6) AS threshold FROM nthr", graph=True),
        "word_graph_unpruned_nodes": with_ctes(
            'SELECT Id, node AS Label, grp AS "Group", Attribute FROM ids0', graph=True
        ),
        "word_graph_nodes": with_ctes(NODES, graph=True),
        "word_graph_edges": with_ctes(EDGES, graph=True),
    }
