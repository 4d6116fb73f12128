"""Language-model scoring by deleted interpolation.

A text's probability is the product over its tokens of

    l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1)

with maximum-likelihood estimates from the training texts, v the token before (a mark before the first), and b the
bucket of how often v was seen (powers of two).  The weights l of each bucket come from expectation
maximisation on the training tokens with each token's own occurrence deleted from the counts.

Texts are dealt into blocks by their id.  A block sends its distinct n-grams, sorted and packed, to ranges of
the hash space, which add up the counts of all blocks and answer each block in its own order; so a frequent word
is one entry a block, and an answer is a plain array.  Counts cover all texts and grow with them; what reaches the
driver is the block count, N and V, and a table of sums for the weights: for contexts seen about 2^b times, 2 b cells of the
bigram's estimate by 2 log2(N) of the unigram's, so about 2 log2(N)^3 rows at most, whatever the texts.

Defined results: a null or blank text is the end token alone; a null id is trained on; repeated rows count and are
scored each; an empty table gives no rows, and without training texts the model is uniform; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.shingles import U64, scramble, word_hashes, words
from linkweave.session import materialize, scratch_path

#: Bytes of text in a block, about.
BLOCK_BYTES = 6_000_000
#: Buckets of context frequency (0, 1, 2-3, 4-7, ...) and cells of a probability's logarithm, for the weights.  Both reach as far as
#: 64-bit counts: one of N tokens has a probability of 1/N, and needs 2 * log2(N) + 2 cells.
BUCKETS, CELLS = 64, 128
EM_STEPS = 60
END, START = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)


def held_out(key: Column) -> Column:
    """True for the texts that nothing is learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))


class Block:
    """Tokens of a block's texts: word and bigram hashes, one after the other, and each text's end."""

    def __init__(self, texts: list[str | None], train: np.ndarray):
        parts, sizes = [], []
        for t in texts:
            h = word_hashes(words(t) if t else [])
            parts += [h, np.array([END])]
            sizes.append(len(h) + 1)
        self.sizes = np.array(sizes, np.int64)
        self.word = np.concatenate(parts) if parts else np.empty(0, U64)
        self.first = np.cumsum(self.sizes) - self.sizes
        before = np.empty_like(self.word)
        before[1:] = self.word[:-1]
        before[self.first] = START
        self.before = before
        self.pair = scramble(scramble(before) + self.word)
        self.train = np.repeat(train, self.sizes)

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of words and bigrams, ascending, each token's index into them (words, then bigrams).  A word's
        hash is even and a bigram's odd, so both share one table."""
        both = np.concatenate([self.word & ~U64(1), self.pair | U64(1)])
        distinct, index = np.unique(both, return_inverse=True)
        return distinct, index[: len(self.word)], index[len(self.word) :]

    def counts(self, index: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(index[self.train], minlength=size).astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    """Steps between ascending numbers, all first bytes, then all second bytes, ...: the shuffle's compressor takes the high ones away."""
    steps = np.diff(values, prepend=U64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U64).ravel(), dtype=U64)


def pack_counts(values: np.ndarray) -> bytes:
    """As 1, 2, 4 or 8 bytes each, whatever the largest needs."""
    top = int(values.max(initial=0))
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    return values.astype(kind).tobytes()


def unpack_counts(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // n}").astype(np.int64) if n else np.empty(0, np.int64)


def _texts(table: pa.Table) -> tuple[list, np.ndarray]:
    return table.column("text").to_pylist(), ~np.asarray(table.column("held_out").to_pylist(), bool)


def _block_counts(ranges: int):
    """A block's distinct n-grams and training counts, one row for each range of the hash space."""

    def run(table: pa.Table) -> pa.Table:
        block = Block(*_texts(table))
        distinct, uni, bi = block.grams()
        counts = block.counts(uni, len(distinct)) + block.counts(bi, len(distinct))
        cuts = np.searchsorted(distinct, range_starts(ranges))
        at = table.column("block")[0].as_py()
        rows = [(r, at, pack_sorted(distinct[a:b]), pack_counts(counts[a:b])) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pa.Table.from_pydict(dict(zip(("range", "block", "grams", "counts"), map(list, zip(*rows, strict=True)) if rows else ([], [], [], []), strict=True)), COUNTS_ARROW)

    return run


COUNTS_ARROW = pa.schema([("range", pa.int32()), ("block", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())])
COUNTS = "range int, block int, grams binary, counts binary"


def range_starts(ranges: int) -> np.ndarray:
    """Starts of equal ranges of the hash space, and its end."""
    step = (1 << 64) // ranges
    return np.array([i * step for i in range(ranges)] + [(1 << 64) - 1], U64)


def _range_totals(table: pa.Table) -> pa.Table:
    """Adds up a range's counts and answers every block with the totals of its own n-grams, in its own order."""
    grams = [unpack_sorted(g.as_py()) for g in table.column("grams")]
    counts = [unpack_counts(c.as_py(), len(g)) for c, g in zip(table.column("counts"), grams, strict=True)]
    distinct, index = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(index, weights=np.concatenate(counts).astype(np.float64), minlength=len(distinct)).astype(np.int64)
    words_only = total[distinct & U64(1) == 0]
    ends = np.cumsum([len(g) for g in grams])
    answers = [pack_counts(total[index[e - len(g) : e]]) for g, e in zip(grams, ends, strict=True)]
    n = len(grams)
    out = {
        "block": table.column("block").to_pylist(),
        "range": table.column("range").to_pylist(),
        "totals": answers,
        # Once a range: its training tokens and distinct training words.
        "tokens": [int(words_only.sum())] + [0] * (n - 1),
        "types": [int((words_only > 0).sum())] + [0] * (n - 1),
    }
    return pa.Table.from_pydict(out, TOTALS_ARROW)


TOTALS_ARROW = pa.schema([("block", pa.int32()), ("range", pa.int32()), ("totals", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64())])
TOTALS = "block int, range int, totals binary, tokens bigint, types bigint"


class Estimates:
    """Per token of a block: counts of the word, its context and the bigram, with or without its own occurrence."""

    def __init__(self, texts: pa.Table, totals: pa.Table, n: int, v: int, texts_trained: int):
        self.block = block = Block(*_texts(texts))
        distinct, uni, bi = block.grams()
        parts = sorted(zip(totals.column("range").to_pylist(), totals.column("totals").to_pylist(), strict=True))
        cuts = np.searchsorted(distinct, range_starts(int(totals.column("ranges")[0].as_py())))
        all_counts = np.concatenate([unpack_counts(raw, cuts[r + 1] - cuts[r]) for r, raw in parts])
        self.n, self.v = n, v
        self.c1, self.c2 = all_counts[uni], all_counts[bi]
        ctx = np.empty_like(self.c1)
        ctx[1:] = self.c1[:-1]
        ctx[block.first] = texts_trained
        self.context = ctx

    def probabilities(self, deleted: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(bigram, unigram) estimates with ``deleted`` occurrences taken off."""
        c2, ctx, c1 = self.c2 - deleted, self.context - deleted, self.c1 - deleted
        p2 = np.divide(c2, ctx, out=np.zeros(len(c2)), where=ctx > 0)
        return p2, c1 / max(self.n - (1 if np.ndim(deleted) or deleted else 0), 1)


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2)."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def cell(p: np.ndarray) -> np.ndarray:
    """0 for nothing, else steps of a factor of sqrt(2) down from 1."""
    with np.errstate(divide="ignore"):
        steps = np.where(p > 0, np.round(-2 * np.log2(np.maximum(p, 1e-300))) + 1, 0)
    return np.minimum(steps, CELLS - 1).astype(np.int64)


def cell_value(c: np.ndarray) -> np.ndarray:
    return np.where(c > 0, 2.0 ** (-(c - 1) / 2.0), 0.0)


def learn_weights(sums: list[tuple[int, int, int, int]], v: int) -> np.ndarray:
    """Weights (bucket, 3) of bigram, unigram and uniform estimate, by expectation maximisation on
    (bucket, cell of p2, cell of p1, tokens).  A bucket without tokens weighs unigram and uniform alike."""
    out = np.tile([0.0, 0.5, 0.5], (BUCKETS, 1))
    for b in range(BUCKETS):
        rows = np.array([s[1:] for s in sums if s[0] == b], np.int64).reshape(-1, 3)
        if not len(rows):
            continue
        p = np.stack([cell_value(rows[:, 0]), cell_value(rows[:, 1]), np.full(len(rows), 1.0 / (v + 1))], 1)
        tokens, weights = rows[:, 2].astype(np.float64), np.full(3, 1 / 3)
        for _ in range(EM_STEPS):
            share = p * weights
            share /= share.sum(1, keepdims=True)
            weights = tokens @ share / tokens.sum()
        # The uniform part keeps every text possible.
        weights = np.maximum(weights, 1e-6)
        out[b] = weights / weights.sum()
    return out


def _dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """``docs`` written once, one bucket a block on average (as long as the session allows so many): grouping by block
    needs no further exchange."""
    spark = docs.sparkSession
    blocks = min(blocks, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    name = f"lm_blocks_{uuid.uuid4().hex}"
    writer = docs.repartition(blocks, "block").write.bucketBy(blocks, "block").option("compression", "zstd")
    writer.option("path", scratch_path(spark, f"tables/{name}")).saveAsTable(name)
    return spark.table(name)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(body)), F.lit(0)), F.coalesce(F.sum((~held_out(F.col(key))).cast("long")), F.lit(0))).first()
    blocks = max(1, math.ceil(size[0] / block_bytes))
    n_texts = int(size[1])
    # The partition parts rows with one id and text, which may be a third of all.
    block = F.pmod(F.xxhash64(key, F.crc32(body.cast("binary")), F.spark_partition_id()), F.lit(blocks)).cast("int")
    slim = _dealt(docs.select(F.col(key).alias("id"), body.alias("text"), held_out(F.col(key)).alias("held_out"), block.alias("block")), blocks)
    counted = slim.groupBy("block").applyInArrow(_block_counts(blocks), COUNTS)
    totals = materialize(counted.groupBy("range").applyInArrow(_range_totals, TOTALS), "lm-totals")
    row = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    n, v = int(row[0]), int(row[1])
    answers = totals.select("block", "range", "totals", F.lit(blocks).alias("ranges")).groupBy("block")

    def sums(texts: pa.Table, told: pa.Table) -> pa.Table:
        est = Estimates(texts, told, n, v, n_texts)
        train = est.block.train
        p2, p1 = est.probabilities(1)
        code = (bucket(est.context[train] - 1) * CELLS + cell(p2[train])) * CELLS + cell(p1[train])
        codes, tokens = np.unique(code, return_counts=True)
        return pa.table({"code": pa.array(codes, pa.int64()), "tokens": pa.array(tokens, pa.int64())})

    cells = slim.groupBy("block").cogroup(answers).applyInArrow(sums, "code bigint, tokens bigint").groupBy("code").agg(F.sum("tokens").alias("tokens"))
    weights = learn_weights([(r["code"] // (CELLS * CELLS), r["code"] // CELLS % CELLS, r["code"] % CELLS, r["tokens"]) for r in cells.collect()], v)
    kind = slim.schema["id"].dataType.simpleString()

    def scores(texts: pa.Table, told: pa.Table) -> pa.Table:
        est = Estimates(texts, told, n, v, n_texts)
        block = est.block
        p2, p1 = est.probabilities()
        w = weights[bucket(est.context)]
        model = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (v + 1))
        base = np.log10((est.c1 + 0.5) / (n + 0.5 * (v + 1)))
        add = lambda x: np.add.reduceat(x, block.first) if len(block.first) else np.empty(0)
        return pa.table(
            {
                key: texts.column("id"),
                "held_out": texts.column("held_out"),
                "n_tokens": pa.array(block.sizes, pa.int64()),
                "n_known": pa.array(add((est.c1 > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array(np.full(len(block.sizes), n), pa.int64()),
                "base_score": pa.array(add(base), pa.float64()),
                "score": pa.array(add(model), pa.float64()),
            }
        )

    schema = f"`{key}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return slim.groupBy("block").cogroup(answers).applyInArrow(scores, schema)
