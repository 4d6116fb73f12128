"""Whitening, periodic runs and piece encoding against plain models of their definitions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from linkweave.llm import pieces, queries, runs, whitening
from linkweave.llm.common import table

MODEL = queries.tokenizer_path(queries.PIECES)


# -- whitening ----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, n string, component string"


def plain_whitening(rows, top=4):
    """Rows (id, vector) whitened with the eigenvectors of the covariance matrix, sums as Python numbers."""
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    rows = [(k, [int(np.floor(256 * c)) for c in v]) for k, v in rows]
    fit = sorted({tuple(x) for _, x in rows})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[n * a - b for a, b in zip(x, s)] for x in fit], float) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    out = {}
    for k, x in rows:
        y = [n * a - b for a, b in zip(x, s)]
        for j in range(min(top, len(s))):
            out[k, j + 1, sum(a * a for a in y)] = (n, float(np.array(y) / n @ v[:, j] / np.sqrt(e[j])), e[j] / e.sum())
    return out


def compare_whitening(got, rows):
    want = plain_whitening(rows)
    signs = {}
    assert {(r["vec_id"], r["component"], r["deviation"]) for r in got} == set(want)
    for r in got:
        n, value, share = want[r["vec_id"], r["component"], r["deviation"]]
        if abs(value) > 0.1:
            sign = signs.setdefault(r["component"], np.sign(value) * np.sign(r["whitened"]))
            assert r["whitened"] * sign == pytest.approx(value, rel=1e-9, abs=1e-9)
        assert abs(abs(r["whitened"]) - abs(value)) < 1e-9
        assert (r["n"], r["explained"]) == (n, pytest.approx(share, rel=1e-9))
        assert 0 <= r["identity_error"] < 1e-9


def test_whitening_of_the_table(spark, sf_dir):
    got = queries.op11_whitening(spark, sf_dir).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    compare_whitening(got, rows)


def test_whitening_of_odd_rows(spark):
    rng = random.Random(4)
    # Scales far apart, a third of all rows alike, -0.0 and 0.0, repeated ids.
    rows = [(i, [rng.gauss(0, 10.0 ** (3 - j)) for j in range(5)]) for i in range(60)]
    rows += [(100 + i, [0.0, -0.0, 1.0, 2.0, -1 / 512]) for i in range(30)] + [(3, rows[3][1])]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan")] * 5), (903, [float("inf")] * 5), (904, []), (905, [1.0, 2.0]), (906, [1e30] * 5)]
    table_ = spark.createDataFrame([(*r, "x", "y") for r in rows + bad] + [(None, rows[0][1], None, None)], VECTORS).repartition(7)
    got = whitening.whiten(table_).collect()
    assert [r["component"] for r in sorted((r for r in got if r["vec_id"] is None), key=lambda r: r["component"])] == [1, 2, 3, 4]
    assert Counter(r["vec_id"] for r in got)[3] == 8
    compare_whitening([r for r in got if r["vec_id"] is not None], rows)


def test_whitening_with_dependent_dimensions(spark):
    rng = random.Random(5)
    rows = [(i, [a := rng.gauss(0, 5), b := rng.gauss(0, 1), 0.0, 3.0]) for i in range(50)]
    doubled = [(i, [*v, v[0], v[0]]) for i, v in rows]
    got = whitening.whiten(spark.createDataFrame([(*r, "x", "y") for r in doubled], VECTORS)).collect()
    assert {r["component"] for r in got} == {1, 2}
    assert all(r["identity_error"] < 1e-9 for r in got)
    values = np.array([[r["whitened"] for r in got if r["component"] == k] for k in (1, 2)])
    assert np.allclose(values @ values.T / 50, np.eye(2))


def test_whitening_of_one_vector_and_none(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], "", ""), (2, [1.0, 2.0], "", "")], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, "", "")], VECTORS)).count() == 0


def test_deviation_beyond_64_bits():
    centre = whitening.Centre(1 << 40, [0, 0])
    x = np.array([[1 << 20, 0], [1, 1]])
    assert centre.deviations(x) == [None, None]
    assert whitening.Centre(3, [1, 2]).deviations(np.array([[5, -1]])) == [14**2 + 5**2]
    assert whitening.Centre(1 << 30, [1, 0]).deviations(np.array([[2, 0], [1 << 40, 0]])) == [((1 << 31) - 1) ** 2, None]


# -- runs ---------------------------------------------------------------------

def plain_runs(w):
    """Every stretch of words that agree with those q further on, by each q."""
    found, dropped = [], set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size, part = j + q - i, w[i : j + q]
            if size >= max(6, 4 * q) and not any(part[p:] == part[: size - p] for p in range(1, q)):
                found.append((i, size, q))
                dropped.update(range(i + q, i + size))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2])), [x for k, x in enumerate(w) if k not in dropped]


def periodic_text(rng):
    words, n = [], rng.choice((0, 5, 40, 150, 300))
    while len(words) < n:
        few = rng.choice((1, 2, 2, 3, 5, 30))
        root = [f"w{rng.randrange(few)}" for _ in range(rng.randrange(1, rng.choice((3, 9, 20, 60))))]
        if rng.random() < 0.3:
            root = root[:1] * rng.randrange(1, 12) + root[1:]  # highly periodic inside a longer period
        words += root * rng.choice((1, 1, 2, 4, 5, 9)) + root[: rng.randrange(len(root))]
        if rng.random() < 0.1:
            words = words * 4
    return words[:700]


def test_runs_of_random_texts():
    rng = random.Random(5)
    for _ in range(40):
        texts = [periodic_text(rng) for _ in range(20)]
        for w, (got, rest) in zip(texts, runs.runs_and_rest([[x.encode() for x in w] for w in texts]), strict=True):
            want, kept = plain_runs(w)
            assert [tuple(r) for r in got.tolist()] == want
            assert rest == " ".join(kept)


def test_long_periodic_texts():
    big = [[b"a"] * 200_000, [b"%d" % (i % 5000) for i in range(200_000)], [b"%d" % (i % 7 if i < 20_000 else i) for i in range(30_000)]]
    got = [r.tolist() for r, _ in runs.runs_and_rest(big)]
    assert got == [[[0, 200_000, 1]], [[0, 200_000, 5000]], [[0, 20_000, 7]]]
    # The Thue-Morse word has no run of three periods.
    assert not len(next(runs.runs_and_rest([[b"%d" % (bin(i).count("1") % 2) for i in range(1 << 15)]]))[0])


def plain_op12(key, text):
    w = (text or "").encode().split()
    h, n = zlib.crc32(str(key).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return plain_runs(w)


def test_op12_of_the_table(spark, sf_dir):
    import hashlib

    got = {r["doc_id"]: r for r in queries.op12_runs(spark, sf_dir).collect()}
    seen = 0
    for doc_id, text in table(spark, sf_dir, "documents").select("doc_id", "text").collect():
        if len((text or "").split()) > 1500 and doc_id % 7:
            continue  # plain_runs is quadratic; every seventh long text is compared too
        want, kept = plain_op12(doc_id, text)
        r = got[doc_id]
        top = min(want, key=lambda x: (-x[1], x[0], x[2])) if want else (None, None, None)
        seen += bool(want)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(want), *top)
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if want else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in want).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(kept)).hexdigest()
    assert seen > 5


def test_runs_of_odd_rows(spark, odd_docs, no_docs):
    got = Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in runs.periodic_runs(odd_docs).collect())
    want = Counter()
    for r in odd_docs.collect():
        words = (r["text"] or "").encode().split()
        found, kept = plain_runs(words)
        want[r["doc_id"], len(words), tuple(found), b" ".join(kept).decode()] += 1
    assert got == want
    assert runs.periodic_runs(no_docs).count() == 0


# -- pieces -------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_strings():
    rng = random.Random(1)
    out = ["", " ", "  a", "▁a b", "a\nb", "<s> x <0x41> <unk> </s>", "café \U0001f600 \x00 z", "�", "ＡＢ", "a ", " " * 40 + "x" + " " * 37]
    out += ["the" * 500, "ab" * 400, "a" * 1000, "\n" * 50, "日本語テキスト" * 30, "é​ x", "=-" * 90, "▁▁▁ ▁x▁▁"]
    alphabets = ["theinra ", "ab ", "0123456789", "é日\U0001f600", " \n\t▁", "the and ing er", "x"]
    return out + ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(1, 60))) for _ in range(2000)]


def test_pieces_equal_the_library(library):
    bpe, texts = pieces.PieceBpe(MODEL), odd_strings()
    for text, words in zip(texts, bpe.encoded_words(texts), strict=True):
        ids = [i for w in words for i in w[3]]
        assert ids == library.encode(text)
        assert bpe.decode(ids) == library.decode(ids)


def test_long_words_equal_the_library(library, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("etaoinsh") for _ in range(5000)), " " * 5000, "the" * 3000]
    bpe = pieces.PieceBpe(MODEL)
    assert [bpe.encode(t) for t in texts] == library.encode(texts)
    monkeypatch.setattr(pieces, "LONG", 50)  # the queue gives what the rounds give
    bpe.cache.clear()
    assert [bpe.encode(t) for t in texts] == library.encode(texts)


def test_decoding_any_ids(library):
    rng, bpe = random.Random(3), pieces.PieceBpe(MODEL)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.choice([0, 1, 2, 259, 260, 28705])]) for _ in range(rng.randrange(8))]
        assert bpe.decode(ids) == library.decode(ids)


def test_cache_is_bounded(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 50)
    bpe = pieces.PieceBpe(MODEL)
    for k in range(0, 1000, 10):
        texts = [f"word{i} " + "y" * 100 + str(i) for i in range(k, k + 10)]
        assert [[i for w in words for i in w[3]] for words in bpe.encoded_words(texts)] == library.encode(texts)
        assert len(bpe.cache) < 100 and max(map(len, bpe.cache)) <= pieces.CACHE_LENGTH


def test_pieces_of_documents(spark, sf_dir, odd_docs, no_docs, library):
    for docs in (odd_docs, table(spark, sf_dir, "documents")):
        texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
        got = pieces.encode_documents(docs, MODEL, ("ids", "decoded", "n_tokens"))
        want = {(k, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for k, t in texts}
        rows = got.collect()
        assert {(r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in rows} == want
        assert all(r["n_tokens"] == len(r["ids"]) for r in rows)
        back = pieces.decode_documents(got, MODEL).collect()
        assert {(r["doc_id"], r["text"]) for r in back} == {(k, d) for k, _, d in want}
    assert pieces.encode_documents(no_docs, MODEL).count() == 0


def test_op13_digests(spark, sf_dir, library):
    import hashlib

    want = set()
    for doc_id, text in table(spark, sf_dir, "documents").select("doc_id", "text").collect():
        ids = library.encode(text or "")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want.add((doc_id, len(ids), *digests))
    assert {tuple(r) for r in queries.op13_pieces(spark, sf_dir).collect()} == want
