"""SentencePiece encoding and decoding (BPE models with byte fallback), in vectorised merge rounds.

The words of many texts are one flat numpy array of symbols.  No piece joins two words, nor two neighbouring characters
that no piece holds side by side, so the array falls into segments that are merged apart from each other.  A round takes each
segment's smallest pair rank and merges all pairs of that rank at once, in a chain of overlapping ones every second from the
left; the array is compacted, ranks are looked up again beside merged symbols only, and segments without any pair leave.

One pair after the other, leftmost first, is what defines the result.  Merging several at once differs only if one of
these merges makes a pair that is ranked as good or better (runs of spaces do: their pieces share one rank).  Every round checks
this; such a segment, like one of more than ``LONG`` symbols, is merged in order by a priority queue instead.

Supported are models of kind BPE with byte fallback and without a character map, unused or user-defined pieces; others are an
error.  The file's path is a parameter; it is read where it is.

Defined results: a null or empty text has no tokens and decodes to an empty text; repeated rows and null keys each get their
row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words a worker remembers, and the length of the longest that it does.
CACHE_WORDS, CACHE_LENGTH = 200_000, 40
#: Texts, and characters, handled at once in a task (a longer text is handled alone).
CHUNK_TEXTS, CHUNK_CHARS = 500, 4_000_000
#: Symbols in the longest segment that is merged in rounds.
LONG = 20_000
#: The character that stands for a space (fixed value), and what an unknown token decodes to.
MARK, UNKNOWN = "▁", " ⁇ "
#: Kinds of pieces in a model file (fixed values).
NORMAL, UNK, CONTROL, BYTE = 1, 2, 3, 6
NO_RANK = np.int64(1) << 40

OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32())),
    "decoded": ("string", pa.string()),
    "n_tokens": ("bigint", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; numbers of fixed size as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


class PieceBpe:
    """A model file, and a cache of words: (number of ids, ids as text, decoded text, ids)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(message_fields(f.read()))
        trainer, rules = (dict(x for v in (v for k, v in model if k == n) for x in message_fields(v)) for n in (2, 3))
        if trainer.get(3) != 2 or not trainer.get(35) or rules.get(2) or rules.get(4, 1):
            raise ValueError("not a BPE model with byte fallback, without character map and kept white space")
        entries = [dict(message_fields(v)) for k, v in model if k == 1]
        self.pieces = [e[1].decode("utf-8") for e in entries]
        self.kinds = [e.get(3, NORMAL) for e in entries]
        if set(self.kinds) - {NORMAL, UNK, CONTROL, BYTE}:
            raise ValueError("unused and user-defined pieces are not supported")
        self.prefix = bool(rules.get(3, 1))
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        normal = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("pieces across words are not supported")
        score = [struct.unpack("<f", e[2])[0] if 2 in e else 0.0 for e in entries]
        level = {x: n for n, x in enumerate(sorted({score[i] for i in normal.values()}, reverse=True))}
        # Symbols: pieces, then characters that pieces hold but that are none, then all others by their code point.
        letters = sorted({c for p in normal for c in p})
        symbol = normal | {c: len(entries) + n for n, c in enumerate(c for c in letters if c not in normal)}
        self.letters = np.array([ord(c) for c in letters], np.int64)
        self.letter_symbols = np.array([symbol[c] for c in letters], np.int64)
        self.others = len(entries) + len(letters)
        self.names = {i: c for c, i in symbol.items()}
        pairs = {
            (symbol[p[:k]] << 22) + symbol[p[k:]]: (level[score[i]], i)
            for p, i in normal.items()
            for k in range(1, len(p))
            if p[:k] in symbol and p[k:] in symbol
        }
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int64)
        self.joins = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)
        self.touching = np.array(sorted({(ord(a) << 21) + ord(b) for p in normal for a, b in zip(p, p[1:])}), np.int64)
        # A character that touches no other in any piece is a word of its own.
        joined = "".join(re.escape(c) for c in sorted({c for p in normal if len(p) > 1 for c in p} - {MARK}))
        self.words = re.compile(f" *[{joined}]+| +|[^{joined}]").findall
        self.cache: dict[str, tuple[int, str, str, list[int]]] = {}
        self.shown = [p.replace(MARK, " ") if k == NORMAL else None for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.numerals = [str(i) for i in range(len(entries))]

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols, and the symbol that it makes."""
        key = (a << 22) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], NO_RANK), np.where(known, self.joins[at], -1)

    def in_order(self, symbols: list[int]) -> list[tuple[int, int]]:
        """(place, symbol) after merging one pair at a time: best rank, then leftmost."""
        n, sym = len(symbols), list(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))

        def look(places: list[int]) -> list[tuple[int, int, int, int, int]]:
            places = [i for i in places if i >= 0 and after[i] < n]
            left, right = [sym[i] for i in places], [sym[after[i]] for i in places]
            ranks, joins = self.pair(np.array(left, np.int64), np.array(right, np.int64))
            return [x for x in zip(ranks.tolist(), places, left, right, joins.tolist(), strict=True) if x[0] < NO_RANK]

        queue = look(list(range(n)))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, joined = heapq.heappop(queue)
            j = after[i]
            if sym[i] != left or j >= n or sym[j] != right:
                continue  # stale: a symbol has been merged since
            sym[i], sym[j] = joined, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for entry in look([before[i], i]):
                heapq.heappush(queue, entry)
        return [(i, x) for i, x in enumerate(sym) if x >= 0]

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of each word (not empty; spaces stand before the other characters)."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        chars[chars == 32] = ord(MARK)
        at = np.minimum(np.searchsorted(self.letters, chars), len(self.letters) - 1)
        sym = np.where(self.letters[at] == chars, self.letter_symbols[at], self.others + chars)
        first = np.cumsum([0, *map(len, words)])
        cut = np.zeros(len(sym), bool)
        near = (chars[:-1] << 21) + chars[1:]
        cut[1:] = self.touching[np.minimum(np.searchsorted(self.touching, near), len(self.touching) - 1)] != near
        cut[first[:-1]] = True
        places, symbols = self.rounds(sym, np.cumsum(cut))
        bounds = np.searchsorted(places, first).tolist()
        ids = symbols.tolist()
        out = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        strange = places[symbols >= len(self.pieces)]
        for k in np.unique(np.searchsorted(first, strange, "right") - 1).tolist():
            out[k] = self.with_bytes(out[k])
        return out

    def with_bytes(self, symbols: list[int]) -> list[int]:
        """Ids, with the bytes of a character in place of one that is no piece."""
        out: list[int] = []
        for x in symbols:
            if x < len(self.pieces):
                out.append(x)
            else:
                out += [self.bytes[b] for b in (self.names.get(x) or chr(x - self.others)).encode("utf-8")]
        return out

    def rounds(self, sym: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, symbols) that are left of all segments, by place; ``segment`` ascends."""
        place = np.arange(len(sym))
        ranks, joins = np.full(len(sym), NO_RANK), np.full(len(sym), -1, np.int64)
        inner = np.flatnonzero(segment[1:] == segment[:-1])
        ranks[inner], joins[inner] = self.pair(sym[inner], sym[inner + 1])
        out_place, out_sym = [], []

        def queue(rows: np.ndarray) -> None:
            for part in np.split(rows, np.flatnonzero(np.diff(segment[rows])) + 1):
                left = self.in_order(sym[part].tolist())
                out_place.append(place[part[[i for i, _ in left]]])
                out_sym.append(np.array([x for _, x in left], np.int64))

        def keep(rows: np.ndarray) -> None:
            nonlocal sym, segment, place, ranks, joins
            sym, segment, place, ranks, joins = sym[rows], segment[rows], place[rows], ranks[rows], joins[rows]

        long = (np.bincount(segment) > LONG)[segment] if len(sym) else np.zeros(0, bool)
        if long.any():
            queue(np.flatnonzero(long))
            keep(~long)
        while len(sym):
            start = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            size = np.diff(np.append(start, len(sym)))
            least = np.minimum.reduceat(ranks, start)
            open_ = np.repeat(least < NO_RANK, size)
            if not open_.all():
                out_place.append(place[~open_])
                out_sym.append(sym[~open_])
                least = np.repeat(least, size)[open_]
                keep(open_)
                if not len(sym):
                    break
            else:
                least = np.repeat(least, size)
            # The last symbol of a segment has no rank, so a chain ends there at the latest.
            hit = ranks == least
            index = np.arange(len(sym))
            begins = hit & ~np.concatenate(([False], hit[:-1]))
            hit &= (index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 0
            merged = np.flatnonzero(hit)

            made = sym.copy()
            made[merged] = joins[merged]
            stays = np.ones(len(sym), bool)
            stays[merged + 1] = False
            rows = np.flatnonzero(stays)
            changed = hit[rows]
            changed[:-1] |= changed[1:]
            beside = np.flatnonzero(changed[:-1])
            left, right = rows[beside], rows[beside + 1]
            inside = segment[left] == segment[right]
            rank, joined = self.pair(made[left], made[right])
            rank[~inside] = NO_RANK

            several = np.flatnonzero(segment[merged[1:]] == segment[merged[:-1]])
            bad = np.zeros(0, np.int64)
            if len(several):
                many = np.zeros(segment[-1] + 1, bool)
                many[segment[merged[several]]] = True
                early = merged[several][merged[several + 1] == merged[several] + 2]
                between = self.pair(made[early], sym[early + 2])[0] <= least[early]
                late = left[rank <= least[left]]
                bad = np.concatenate((segment[early[between]], segment[late][many[segment[late]]]))
            if len(bad):
                wrong = np.zeros(segment[-1] + 1, bool)
                wrong[bad] = True
                queue(np.flatnonzero(wrong[segment]))
            sym = made
            ranks[left], joins[left] = rank, joined
            if len(bad):
                rows = rows[~wrong[segment[rows]]]
            # A symbol merged into its left neighbour hands on nothing; the left one's pair was looked up above, or ended the array.
            if stays.size and not stays[-1]:
                ranks[merged[-1]] = NO_RANK
            keep(rows)
        if not out_place:
            return place, sym
        place, sym = np.concatenate(out_place), np.concatenate(out_sym)
        order = np.argsort(place)
        return place[order], sym[order]

    def encoded_words(self, texts: Sequence[str]) -> list[list[tuple[int, str, str, list[int]]]]:
        """For each text, what the cache holds of each of its words, in order."""
        cache, numerals = self.cache, self.numerals
        if len(cache) >= CACHE_WORDS:
            cache.clear()
        split = [self.words((" " if self.prefix and t else "") + t.replace(MARK, " ")) for t in texts]
        missing = list(set().union(*split).difference(cache))
        for word, ids in zip(missing, self.merge(missing), strict=True) if missing else ():
            cache[word] = (len(ids), ",".join([numerals[i] for i in ids]), self.surface(ids), ids)
        out = [[cache[w] for w in words] for words in split]
        for word in missing:
            if len(word) > CACHE_LENGTH:
                del cache[word]
        return out

    def encode(self, text: str) -> list[int]:
        return [i for w in self.encoded_words([text])[0] for i in w[3]]

    def surface(self, ids: Sequence[int]) -> str:
        """Vocabulary strings put together, byte pieces as the characters that they spell."""
        shown = [self.shown[i] for i in ids]
        if None not in shown:
            return "".join(shown)
        out, run = [], bytearray()
        for i in ids:
            if self.kinds[i] == BYTE:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(characters(bytes(run)))
                run.clear()
            if self.kinds[i] == NORMAL:
                out.append(self.pieces[i].replace(MARK, " "))
            elif self.kinds[i] == UNK:
                out.append(UNKNOWN)
        if run:
            out.append(characters(bytes(run)))
        return "".join(out)

    def decode(self, ids: Sequence[int]) -> str:
        """The text; the space that encoding puts in front is taken off the first piece that is not a control piece."""
        text = self.surface(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        lead = self.prefix and first is not None and self.kinds[first] == NORMAL and self.pieces[first].startswith(MARK)
        return text[1:] if lead else text


def characters(data: bytes) -> str:
    """UTF-8 with a replacement character for every byte that is part of no character."""
    out = []
    while data:
        try:
            out.append(data.decode("utf-8"))
            break
        except UnicodeDecodeError as e:
            out.append(data[: e.start].decode("utf-8") + "�")
            data = data[e.start + 1 :]
    return "".join(out)


@functools.cache
def load(path: str) -> PieceBpe:
    """One model per Python worker."""
    return PieceBpe(path)


def _column(name: str, words: list, decoded: str) -> object:
    if name == "ids":
        return [i for w in words for i in w[3]]
    if name == "n_tokens":
        return sum([w[0] for w in words])
    if name == "ids_sha256":
        return hashlib.sha256(",".join([w[1] for w in words]).encode()).hexdigest()
    return decoded if name == "decoded" else hashlib.sha256(decoded.encode("utf-8")).hexdigest()


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of bounded size."""
    start, texts, total = 0, [], 0
    for k, value in enumerate(column):
        texts.append(value.as_py())
        total += len(texts[-1])
        if len(texts) >= CHUNK_TEXTS or total >= CHUNK_CHARS:
            yield start, texts
            start, texts, total = k + 1, [], 0
    if texts:
        yield start, texts


def encode_documents(docs: DataFrame, model: str, outputs: Sequence[str] = ("ids", "decoded"), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, *outputs)`` for every row; ``outputs`` from ``OUTPUTS``: ids, the text decoded from them, their number and digests."""
    slim = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = [pa.field(name, OUTPUTS[name][1]) for name in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(model)
        for batch in batches:
            for start, texts in _chunks(batch.column(1)):
                rows: list[list] = [[] for _ in fields]
                for words in bpe.encoded_words(texts):
                    # Words start with the spaces before them, so only the very first can lose one.
                    decoded = "".join([w[2] for w in words])
                    decoded = decoded[1:] if bpe.prefix and decoded.startswith(" ") else decoded
                    for out, f in zip(rows, fields, strict=True):
                        out.append(_column(f.name, words, decoded))
                columns = [batch.column(0).slice(start, len(texts)), *(pa.array(r, f.type) for r, f in zip(rows, fields, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, [key, *outputs])

    kind = slim.schema[0].dataType.simpleString()
    return slim.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{n} {OUTPUTS[n][0]}" for n in outputs))


def decode_documents(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, text)`` from token ids; an unknown id is an error, null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(model)
        for batch in batches:
            texts = [bpe.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    slim = encoded.select(F.col(key), F.col(ids))
    return slim.mapInArrow(run, f"`{key}` {slim.schema[0].dataType.simpleString()}, text string")
