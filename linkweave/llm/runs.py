"""Periodic runs of words, by string synchronising sets, and texts with the repeats taken out.

A run is a maximal stretch of words with smallest period q that is at least ``EXPONENT`` times q long.  The words of many
texts are one flat array of numbers with a number of its own after each text, so nothing crosses from text to text.

1. Periods 1 to 3 are found by comparing the array with itself shifted.
2. For t = 4, 8, 16, ...: a position is highly periodic where the t words from it have a period of t / 4 at most.  Such stretches
   are parts of runs that were found before.  The others get an identifier, the hash of their t words; position i belongs to the
   synchronising set where the smallest identifier of i .. i + t stands at i or at i + t.  Whether it does depends on the 2t words
   from i alone.
3. A run with period q, t <= q < 2t, has such a position s among its first t, and s + q is the next one with the same 2t words.
   So neighbours in a sort by (hash of 2t words, position) propose all periods; each is extended word by word, once a run.
4. A text in which no such 2t words repeat has no longer period either and leaves the array.

Positions in the sets fall as 1 / t, and runs of periods in one range overlap little, so a text of n words takes O(n log n).
Hashes have 64 bits and only propose; every run is compared word by word.

Defined results: a null or blank text has no words, no runs and an empty collapsed text; repeated rows and null keys each
get their row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.shingles import scramble

#: Periods that a run holds at least, and words that it has at least.
EXPONENT, MIN_WORDS = 4, 6
#: Periods found by shifting.
SHIFTS = (1, 2, 3)
#: Words handled at once in a task (a longer text is handled alone).
CHUNK_WORDS = 250_000
U64 = np.uint64
NEVER = U64(0xFFFFFFFFFFFFFFFF)


class Numbers(dict):
    """Word -> number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        got = self[word] = len(self)
        return got


def ahead(x: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` places further on (around the end, where a separator stands in between)."""
    return np.concatenate((x[by:], x[:by]))


def shifted_runs(s: np.ndarray, q: int) -> np.ndarray:
    """Runs with the short period q, as rows (start, end, period)."""
    same = np.zeros(max(len(s) - q, 0) + 2, np.int8)
    same[1:-1] = s[q:] == s[:-q]
    edge = np.diff(same)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + q
    long = end - start >= EXPONENT * q
    start, end = start[long], end[long]
    # 2 and 3 are prime: a shorter period could only be 1.
    smallest = np.ones(len(start), bool) if q == 1 else ~np.all([s[start] == s[start + k] for k in range(1, q)], axis=0)
    return np.column_stack((start[smallest], end[smallest], np.full(smallest.sum(), q)))


def matching(s: np.ndarray, a: int, q: int, step: int) -> int:
    """How many places from ``a`` on, going by ``step`` 1 or -1, hold the same as the place q further."""
    done, size = 0, 64
    while True:
        if step > 0:
            size = min(size, len(s) - q - a - done)
            x, y = s[a + done : a + done + size], s[a + q + done : a + q + done + size]
        else:
            size = min(size, a + 1 - done)
            x, y = s[a + 1 - done - size : a + 1 - done][::-1], s[a + q + 1 - done - size : a + q + 1 - done][::-1]
        if size <= 0:
            return done
        differ = x != y
        if differ.any():
            return done + int(differ.argmax())
        done += size
        size *= 2


def extended(s: np.ndarray, places: np.ndarray, periods: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs around proposed (place, period), each once."""
    order = np.lexsort((places, periods))
    out, last, reach = [], 0, -1
    for a, q in zip(places[order].tolist(), periods[order].tolist(), strict=True):
        if q == last and a < reach:
            continue  # inside the stretch extended before
        start = a - matching(s, a - 1, q, -1)
        last, reach = q, a + matching(s, a, q, 1)
        if reach + q - start >= EXPONENT * q:
            out.append((start, reach + q, q))
    return out


def synchronising(h: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """Positions of the t-synchronising set, from the hashes of the t words from each position."""
    value = np.where(periodic, NEVER, h)
    least, width = value, 1
    while width < t:
        least, width = np.minimum(least, ahead(least, width)), 2 * width
    last = ahead(value, t)
    least = np.minimum(least, last)
    return np.flatnonzero((least < NEVER) & ((least == value) | (least == last)))


def find_runs(s: np.ndarray, text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs of a flat array, as rows (start, end, period) in no special order.

    ``s`` numbers the words, each text followed by a number of its own; ``text`` is each place's text, ``sizes`` the
    words of each text."""
    found = [shifted_runs(s, q) for q in SHIFTS]
    place, t = np.arange(len(s)), 4
    live = sizes >= EXPONENT * t
    keep = live[text]
    s, text, place = s[keep], text[keep], place[keep]
    h = scramble(s.astype(U64))
    for width in (1, 2):
        h = scramble(h * U64(0x9E3779B97F4A7C15) + ahead(h, width))
    while len(s):
        runs = np.concatenate(found)
        runs = runs[(runs[:, 2] <= t // EXPONENT) & (runs[:, 1] - runs[:, 0] >= t)]
        at = np.searchsorted(place, runs[:, 0])
        here = at < len(place)
        here[here] = place[at[here]] == runs[here, 0]
        at, runs = at[here], runs[here]
        marks = np.zeros(len(s) + 1, np.int64)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + (runs[:, 1] - runs[:, 0]) - t + 1, -1)
        periodic = np.cumsum(marks[:-1]) > 0

        picked = synchronising(h, t, periodic)
        h = scramble(h * U64(0x9E3779B97F4A7C15) + ahead(h, t))
        context = h[picked]
        order = np.argsort(context, kind="stable")
        context, picked = context[order], picked[order]
        twice = (context[1:] == context[:-1]) & (text[picked[1:]] == text[picked[:-1]])
        a, b = picked[:-1][twice], picked[1:][twice]
        fit = (b - a >= t) & (b - a < 2 * t)
        got = extended(s, a[fit], (b - a)[fit])
        if got:
            rows = np.array(got, np.int64)
            rows[:, 1] += place[rows[:, 0]] - rows[:, 0]
            rows[:, 0] = place[rows[:, 0]]
            found.append(rows)

        t *= 2
        repeats = np.zeros(len(live), bool)
        repeats[text[a]] = True
        live &= repeats & (sizes >= EXPONENT * t)
        keep = live[text]
        s, text, place, h = s[keep], text[keep], place[keep], h[keep]
    runs = np.concatenate(found)
    return runs[runs[:, 1] - runs[:, 0] >= MIN_WORDS]


def runs_and_rest(texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, str]]:
    """For each text's words: its runs (start, length, period), by start and period, and the words left when every run
    keeps its first period alone, joined by one space."""
    number = Numbers()
    sizes = np.array([len(words) for words in texts], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    s = np.empty(first[-1], np.int64)
    for words, begin in zip(texts, first[:-1].tolist(), strict=True):
        s[begin : begin + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    s[first[1:] - 1] = -1 - np.arange(len(texts))
    runs = find_runs(s, np.repeat(np.arange(len(texts)), sizes + 1), sizes)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    marks = np.zeros(len(s) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 1], -1)
    kept = np.cumsum(marks[:-1]) == 0
    bounds = np.searchsorted(runs[:, 0], first)
    for k, words in enumerate(texts):
        begin, mine = int(first[k]), runs[bounds[k] : bounds[k + 1]]
        if len(mine):
            words = [words[i] for i in np.flatnonzero(kept[begin : begin + len(words)]).tolist()]
            mine = np.column_stack((mine[:, 0] - begin, mine[:, 1] - mine[:, 0], mine[:, 2]))
        yield mine, b" ".join(words).decode("utf-8")


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", change: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``(key, n_words, runs array<struct<start, length, period>>, collapsed)`` for every row.

    Words are maximal stretches without the six ASCII white space characters.  ``change(key, words)`` may put other words in
    place of a text's own.  ``collapsed`` drops each word that lies in any run after that run's first period."""
    slim = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def done(keys: list, texts: list[list[bytes]], type_: pa.DataType) -> pa.RecordBatch:
        runs, rest = zip(*runs_and_rest(texts), strict=True)
        flat = np.concatenate(runs)
        fields = [pa.array(flat[:, k]) for k in range(3)]
        offsets = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(kind.value_type)))
        n = pa.array([len(t) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(keys, type_), n, lists, pa.array(rest, pa.string())], [key, "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, total = [], [], 0
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = value.as_py().encode("utf-8").split()
                keys.append(k)
                texts.append(change(k, words) if change else words)
                total += len(words)
                if total >= CHUNK_WORDS:
                    yield done(keys, texts, batch.schema.types[0])
                    keys, texts, total = [], [], 0
            if keys:
                yield done(keys, texts, batch.schema.types[0])

    return slim.mapInArrow(run, f"`{key}` {slim.schema[0].dataType.simpleString()}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
