"""Approximate nearest neighbours by learned partitions.

On a bounded sample a neighbour graph is built and cut into balanced parts of nearby vectors; a small classifier (one hidden
layer) learns to tell a vector's part.  Every vector of the table goes to its most probable part; a query goes to the most
probable parts for it and is ranked exactly against all they hold.

Parts are split into cells of at most so many rows, and their queries into blocks, by hash: no part, however many rows are alike,
is one task.  A cell answers a block with its best, ties included by id, and the best of all cells are merged.

Defined results: vectors that are null, zero, hold null or non-finite components, or have another length than most,
take no part, nor do rows without an id; rows with one id count once (the smallest vector); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkweave.session import materialize

#: Vectors that parts and classifier are learned from, at most.
SAMPLE = 6000
PARTS = 16
NEIGHBOURS = 12
HIDDEN = 128
EPOCHS = 60
#: A query goes to so many parts.
PROBES = 12
#: Rows of a cell and queries of a block, about.
CELL_ROWS, BLOCK_QUERIES = 8000, 2000


@dataclass
class Router:
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts by falling probability, one row a vector."""
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        hidden = np.maximum(x @ self.w1 + self.b1, 0)
        return np.argsort(-(hidden @ self.w2 + self.b2), axis=1, kind="stable")


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest others by inner product."""
    near = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 1000):
        score = x[at : at + 1000] @ x.T
        score[np.arange(len(score)), np.arange(at, at + len(score))] = -np.inf
        near[at : at + 1000] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return near


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rng: np.random.Generator, slack: float = 1.1, rounds: int = 20) -> np.ndarray:
    """Cuts the graph into parts of at most ``slack`` times the mean size: parts start around spread-out vectors, then vectors
    move, strongest wish first, to the part most of their neighbours are in as long as it has room."""
    most = math.ceil(len(x) / parts * slack)
    seeds = [int(rng.integers(len(x)))]
    closest = x @ x[seeds[0]]
    while len(seeds) < parts:
        seeds.append(int(closest.argmin()))
        closest = np.maximum(closest, x @ x[seeds[-1]])
    centre = x[seeds]
    for _ in range(8):
        part = _fill(x @ centre.T, most)
        centre = np.stack([x[part == p].mean(0) if (part == p).any() else centre[p] for p in range(parts)])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1)
        np.add.at(votes, (near.ravel(), np.repeat(part, near.shape[1])), 1)
        new = _fill(votes + 1e-3 * (x @ centre.T), most)
        if (new == part).all():
            break
        part = new
    return part


def _fill(wish: np.ndarray, most: int) -> np.ndarray:
    """Each row to its best column with room, rows with the clearest wish first."""
    order = np.argsort(-(np.sort(wish, 1)[:, -1] - np.median(wish, 1)), kind="stable")
    ranked, room = np.argsort(-wish, axis=1, kind="stable"), np.full(wish.shape[1], most)
    out = np.empty(len(wish), np.int64)
    for i in order:
        for p in ranked[i]:
            if room[p]:
                room[p] -= 1
                out[i] = p
                break
    return out


def learn(x: np.ndarray, parts: int = PARTS, probes: int = PROBES, seed: int = 0) -> Router:
    """Router from sample vectors (rows)."""
    rng = np.random.default_rng(seed)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    parts = max(1, min(parts, len(x) // 40))
    near = neighbour_graph(x, min(NEIGHBOURS, len(x) - 1)) if len(x) > 1 else np.zeros((len(x), 0), np.int64)
    part = balanced_parts(x, near, parts, rng)
    # A vector's target is spread over the parts of its neighbours: where a query's answers are.
    target = np.zeros((len(x), parts))
    target[np.arange(len(x)), part] = 1.0
    if near.shape[1]:
        np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1.0)
    target /= target.sum(1, keepdims=True)
    d = x.shape[1]
    values = [rng.normal(0, math.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, math.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            hidden = np.maximum(x[rows] @ values[0] + values[1], 0)
            logits = hidden @ values[2] + values[3]
            p = np.exp(logits - logits.max(1, keepdims=True))
            gap = (p / p.sum(1, keepdims=True) - target[rows]) / len(rows)
            back = (gap @ values[2].T) * (hidden > 0)
            step += 1
            for k, g in enumerate((x[rows].T @ back, back.sum(0), hidden.T @ gap, gap.sum(0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                values[k] -= 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Router(*values, probes=min(probes, parts))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, v)``: finite, non-zero vectors of the most frequent length as doubles, one row an id."""
    v = F.col(vector).cast("array<double>")
    one = vectors.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), v.alias("v"))
    finite = "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)"
    one = one.filter(f"size(v) > 0 and {finite}")
    length = one.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return one.filter(F.size("v") == (length[0]["n"] if length else 0)).groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def best(index_ids: np.ndarray, index: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of each query's k best rows other than itself.  The product of matrices only
    preselects, with room for its rounding; scores are summed row by row, alike for alike vectors."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    scale = np.linalg.norm(index, axis=1).max(initial=0)
    for at in range(0, len(queries), 256):
        rough = queries[at : at + 256] @ index.T
        for row, q, qid in zip(rough, queries[at : at + 256], query_ids[at : at + 256], strict=True):
            row[index_ids == qid] = -np.inf
            bound = np.partition(row, len(row) - k)[len(row) - k] - 1e-12 * (1 + scale * np.linalg.norm(q)) if len(row) > k else -np.inf
            found = np.flatnonzero((row >= bound) & (row > -np.inf))
            exact = np.einsum("nd,d->n", index[found], q)
            order = np.lexsort((index_ids[found], -exact))[:k]
            out.append((np.full(len(order), qid), index_ids[found][order], exact[order]))
    return tuple(np.concatenate(c) if out else np.empty(0) for c in zip(*out, strict=True)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def search(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, parts: int = PARTS, probes: int = PROBES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible by ``every`` its ``k`` nearest found by inner product."""
    rows = materialize(usable(vectors, key, vector), "ann-rows")
    spark, total = vectors.sparkSession, rows.count()
    out_schema = "query_id bigint, vec_id bigint, score double"
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    step = max(1, total // sample)
    # A hash picks about ``sample`` rows; the limit makes the bound sure.
    picked = rows.filter(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).select("v").limit(2 * sample).toArrow()
    router = learn(_matrix(picked.column("v")), parts, probes) if picked.num_rows else learn(_matrix(rows.limit(sample).select("v").toArrow().column("v")), parts, probes)
    told = spark.sparkContext.broadcast(router)

    def route(batches):
        for batch in batches:
            ranked = told.value.ranked(_matrix(batch.column(1))) if batch.num_rows else np.empty((0, 1), np.int64)
            first = pa.array(ranked[:, 0].astype(np.int32))
            probed = pa.array(list(ranked[:, : told.value.probes].astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), first, probed], ["id", "v", "part", "probes"])

    routed = materialize(rows.mapInArrow(route, "id bigint, v array<double>, part int, probes array<int>"), "ann-routed")
    sizes = {r["part"]: r["count"] for r in routed.groupBy("part").count().collect()}  # a row a part
    asked = {r["part"]: r["count"] for r in routed.filter(F.col("id") % every == 0).select(F.explode("probes").alias("part")).groupBy("part").count().collect()}
    cells = {p: math.ceil(n / CELL_ROWS) for p, n in sizes.items()}
    blocks = {p: math.ceil(n / BLOCK_QUERIES) for p, n in asked.items()}
    number = lambda told, part: F.coalesce(F.element_at(F.create_map(*[F.lit(int(x)) for kv in told.items() for x in kv]), part), F.lit(0)) if told else F.lit(0)
    n_cells, n_blocks = number(cells, F.col("part")), number(blocks, F.col("part"))
    spread = lambda n, mine: F.transform(F.sequence(F.lit(0), n - 1), lambda x: x)
    # Every cell of a part meets every block of its queries.
    index = routed.filter(n_blocks > 0).withColumn("cell", F.pmod(F.xxhash64("id"), n_cells)).withColumn("block", F.explode(spread(n_blocks, None))).select("part", F.col("cell").cast("int"), "block", "id", "v")
    queries = routed.filter(F.col("id") % every == 0).select("id", "v", F.explode("probes").alias("part")).filter(n_cells > 0)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), n_blocks).cast("int")).withColumn("cell", F.explode(spread(n_cells, None))).select("part", "cell", "block", "id", "v")

    def answer(held: pa.Table, asks: pa.Table) -> pa.Table:
        if not held.num_rows or not asks.num_rows:
            got = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        else:
            got = best(held.column("id").to_numpy(), _matrix(held.column("v")), asks.column("id").to_numpy(), _matrix(asks.column("v")), k)
        return pa.table({"query_id": pa.array(got[0], pa.int64()), "vec_id": pa.array(got[1], pa.int64()), "score": pa.array(got[2], pa.float64())})

    by = ["part", "cell", "block"]
    found = index.groupBy(*by).cogroup(queries.groupBy(*by)).applyInArrow(answer, out_schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
