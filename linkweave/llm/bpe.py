"""BPE encoding and decoding with the files of a public tokenizer.

Encoding a word keeps its symbols in a doubly linked list and the ranks of neighbouring pairs in a priority
queue; an entry whose symbols have changed since it was pushed is stale and skipped.  Words repeat, so each
Python worker keeps a bounded cache of encoded words.  Decoding concatenates vocabulary strings.

Supported are tokenizer files of the kind "BPE with word ends" over bytes: NFC, white space folding, lower case,
a split pattern, bytes as printable characters.  The file's path is a parameter; it is read where it is.

Defined results: a null or blank text has no tokens and decodes to an empty text; repeated rows each get their
row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in a worker's cache; two generations are kept, so a frequent word is not lost when one is full.
CACHE_WORDS = 200_000
#: Texts handled at once in a task.
CHUNK = 500
#: Unicode white space, as the tokenizer's pattern language has it (fixed value).
BLANK = r"\t-\r\x20\x85\xa0  -     　"

OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32())),
    "decoded": ("string", pa.string()),
    "n_tokens": ("bigint", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    for n, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(256 + n)
    return out


class WordBpe:
    """A tokenizer file, and a cache of words: (ids, ids as text, decoded text)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: s for s, i in (self.vocab | self.special).items()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(self.vocab[a], self.vocab[b]): (n, self.vocab[a + b]) for n, (a, b) in enumerate(pairs)}
        self.end = model["end_of_word_suffix"] or ""
        chars = byte_characters()
        self.first = [self.vocab[c] for c in chars]
        self.last = [self.vocab[c + self.end] for c in chars]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(pattern.replace(r"\s", BLANK)).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.new: dict[str, tuple[list[int], str, str]] = {}
        self.old: dict[str, tuple[list[int], str, str]] = {}

    def merge(self, word: str) -> list[int]:
        """Ids of one word."""
        raw = word.encode("utf-8")
        sym = [self.first[b] for b in raw]
        sym[-1] = self.last[raw[-1]]
        n, rank = len(sym), self.rank
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(*rank[p], i, p) for i in range(n - 1) if (p := (sym[i], sym[i + 1])) in rank]
        heapq.heapify(queue)
        while queue:
            _, joined, i, pair = heapq.heappop(queue)
            j = after[i] if sym[i] >= 0 else n
            if j >= n or (sym[i], sym[j]) != pair:
                continue  # stale: a symbol has been merged since
            sym[i], sym[j] = joined, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := (joined, sym[k])) in rank:
                    heapq.heappush(queue, (*rank[p], i, p))
            h = before[i]
            if h >= 0 and (p := (sym[h], joined)) in rank:
                heapq.heappush(queue, (*rank[p], h, p))
        return [s for s in sym if s >= 0]

    def word(self, word: str) -> tuple[list[int], str, str]:
        got = self.old.get(word)
        if got is None:
            ids = self.merge(word)
            got = (ids, " ".join(map(str, ids)), self.decode(ids))
        if len(self.new) >= CACHE_WORDS:
            self.old, self.new = self.new, {}
        self.new[word] = got
        return got

    def words(self, text: str) -> list[tuple[list[int], str, str]]:
        out: list = []
        for piece in self.cut(text) if self.cut and "<" in text else (text,):
            if piece in self.special:
                out.append(([self.special[piece]], str(self.special[piece]), piece))
                continue
            if not piece.isascii():
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")  # no final-sigma rule
            found, new = self.find(piece.lower()), self.new
            for w in found:
                got = new.get(w)
                if got is None:
                    got = self.word(w)
                    new = self.new
                out.append(got)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for w in self.words(text) for i in w[0]]

    def decode(self, ids: Sequence[int]) -> str:
        """Vocabulary strings, one space apart (the file names no decoder)."""
        return " ".join(self.names[i] for i in ids)


@functools.cache
def load(path: str) -> WordBpe:
    """One tokenizer per Python worker."""
    return WordBpe(path)


def _column(name: str, words: list) -> object:
    if name == "ids":
        return [i for w in words for i in w[0]]
    if name == "n_tokens":
        return sum(len(w[0]) for w in words)
    if name == "ids_sha256":
        return hashlib.sha256(" ".join([w[1] for w in words]).encode()).hexdigest()
    decoded = " ".join([w[2] for w in words])
    return decoded if name == "decoded" else hashlib.sha256(decoded.encode("utf-8")).hexdigest()


def encode_documents(docs: DataFrame, tokenizer: str, outputs: Sequence[str] = ("ids", "decoded"), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, *outputs)`` for every row; ``outputs`` from ``OUTPUTS``: ids, the decoded text, their number and digests."""
    slim = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = [pa.field(name, OUTPUTS[name][1]) for name in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                rows: list[list] = [[] for _ in fields]
                for t in part.column(1):
                    words = model.words(t.as_py())
                    for out, f in zip(rows, fields, strict=True):
                        out.append(_column(f.name, words))
                columns = [part.column(0), *(pa.array(r, f.type) for r, f in zip(rows, fields, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, [key, *outputs])

    kind = slim.schema[0].dataType.simpleString()
    return slim.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{n} {OUTPUTS[n][0]}" for n in outputs))


def decode_documents(encoded: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, text)`` from token ids; an unknown id is an error, null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(tokenizer)
        for batch in batches:
            texts = [model.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    slim = encoded.select(F.col(key), F.col(ids))
    return slim.mapInArrow(run, f"`{key}` {slim.schema[0].dataType.simpleString()}, text string")
