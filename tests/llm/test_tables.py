"""Sharding, mixing, Jaccard join, language model, page text, neighbours and the pipeline against plain Python."""

import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from linkweave.llm import ann, connect, html_extract, jaccard, lm, mixing, sharding, trees
from linkweave.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def jump_one(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64)
    for n in (1, 2, 8, 9, 100):
        assert sharding.jump(keys, n).tolist() == [jump_one(int(k), n) for k in keys]


def test_sharding(spark, sf_dir, odd_docs):
    for docs in (odd_docs, table(spark, sf_dir, "documents")):
        rows = sharding.shard_documents(docs, 8).collect()
        plain = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == plain
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
            assert r["grown_shard"] in (r["shard"], 8)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert len({(r["doc_id"], r["shard"], r["grown_shard"]) for r in rows}) == len({r["doc_id"] for r in rows})


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out = sum(sizes.values()), {}
    free = set(names)
    while True:
        rest = total - sum(out.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = most * sizes[s]
            free.remove(s)
        if not free:
            return out


def test_mixing(spark, sf_dir, odd_docs):
    skewed = spark.createDataFrame([(i, "w " * (1 + i % 50), "big" if i % 3 else f"s{i % 30}") for i in range(2000)], "doc_id long, text string, source string")
    for docs in (odd_docs, skewed, table(spark, sf_dir, "documents")):
        sizes = Counter()
        for r in docs.collect():
            sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
        want = targets(sizes)
        rows = mixing.mix(docs).collect()
        assert len(rows) == docs.count()
        taken, largest = Counter(), defaultdict(int)
        for r in rows:
            assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-9)
            assert r["source_size"] == sizes[r["source"]]
            assert r["taken"] in [k * r["size"] for k in range(4)]
            taken[r["source"]] += r["taken"]
            largest[r["source"]] = max(largest[r["source"]], r["size"])
        for s in sizes:
            assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
        again = Counter(map(tuple, mixing.mix(docs.repartition(7)).collect()))
        assert again == Counter(map(tuple, rows))


def test_mixing_parts_rows_alike(spark):
    """A third of the rows are equal: their sums go on without gaps, whatever partition they are in."""
    rows = [(None, "same old words", "a")] * 300 + [(i, "w " * (i % 9 + 1), "ab"[i % 2]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mixing.mix(docs, weights=(1.0, 5.0)).collect()
    assert len(got) == 900
    for s in "ab":
        of = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in of) - of[0]["target"]) <= max(r["size"] for r in of) / 2
    first = mixing.mix(docs, weights=(1.0, 5.0)).groupBy("doc_id", "source").agg({"taken": "sum"}).collect()
    again = mixing.mix(docs.coalesce(1), weights=(1.0, 5.0)).groupBy("doc_id", "source").agg({"taken": "sum"}).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))


def test_mixed_documents(spark, odd_docs):
    out = mixing.mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    words = sum(len(WORD.findall(r["text"] or "")) for r in out.collect())
    assert words == mixing.mix(odd_docs).agg({"taken": "sum"}).first()[0]


def test_better_documents_come_first(spark):
    docs = spark.createDataFrame([(i, ("good words of plain text " if i % 2 else "### 123 $$$ 456 %%% ") * 4, "a") for i in range(2000)] + [(9000 + i, "x " * 20, "b") for i in range(2000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, weights=(1.0, 3.0)).filter("source = 'a'").collect()
    good = sum(r["picked"] for r in rows if r["doc_id"] % 2)
    assert good > 1.5 * sum(r["picked"] for r in rows if r["doc_id"] % 2 == 0)


def sets_of(text, width):
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_components(rows, percent, width):
    sets = [sets_of(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    for group in {tuple(v) for v in at.values() if len(v) > 1}:
        for n, i in enumerate(group):
            for j in group[:n]:
                if top(i) != top(j) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    root[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(least.get(top(i), key), key)
    return Counter((key, len(sets[i]), least.get(top(i), key)) for i, (key, _) in enumerate(rows))


def near_copies(seed, groups=6, each=25):
    rng, rows = random.Random(seed), []
    shared = [rng.choice("abcdefgh") * 3 + str(rng.randrange(40)) for _ in range(60)]
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(rng.choice((5, 30, 120, 300)))] + shared
        for _ in range(each):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(words) // 18))):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("percent", "width", "few"), [(85, 4, 16), (80, 5, 4)])
def test_jaccard_components(spark, sf_dir, odd_docs, percent, width, few, monkeypatch):
    monkeypatch.setattr(jaccard, "FEW", few)
    inputs = [near_copies(percent + few, 4, 14)]
    if few == 16:
        inputs += [[(r["doc_id"], r["text"]) for r in odd_docs.collect()], [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]]
    for rows in inputs:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = Counter(tuple(r) for r in jaccard.join_components(docs, percent, width).collect())
        assert got == brute_components(rows, percent, width)


def test_one_of_each(spark, odd_docs):
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    # 5, 6, 7 and the repeated rows of 5 are one group; blank texts stay; 11 is one repeated word.
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, i) for i in (0, 1, 2, 3, 4, 5, 8, 9, 10, 11)] + [(True, None)]


def test_components_of_random_links(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(7, 1000 + i) for i in range(200)] + [(2000 + i, 2001 + i) for i in range(60)]
    rows = connect.components(spark.createDataFrame(links, "u long, v long")).collect()
    label = {r["u"]: r["label"] for r in rows}
    assert len(rows) == len(label)
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = sorted((top(u), top(v)))
        parent[b] = a
    linked = {x for u, v in links if u != v for x in (u, v)}
    assert label == {x: top(x) for x in linked}


def test_no_rows(spark, no_docs):
    assert sharding.shard_documents(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0
    assert jaccard.join_components(no_docs).count() == 0
    assert jaccard.one_of_each(no_docs).count() == 0
    assert lm.score(no_docs).count() == 0
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def lm_tokens(text):
    return ["".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(text or "")] + [None]


def lm_brute(rows):
    train = [t for k, t in rows if k is None or zlib.crc32(str(k).encode()) % 5 != 1]
    c1, c2, start = Counter(), Counter(), object()
    for t in train:
        tokens = lm_tokens(t)
        c1.update(tokens)
        c2.update(zip([start, *tokens[:-1]], tokens, strict=True))
    return c1, c2, start, len(train), sum(c1.values()), len(c1)


@pytest.mark.parametrize("block_bytes", [lm.BLOCK_BYTES, 20_000])
def test_lm(spark, sf_dir, odd_docs, block_bytes):
    for docs in (odd_docs, table(spark, sf_dir, "documents")):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        c1, c2, start, texts, n, v = lm_brute(rows)
        cells = Counter()
        for k, t in rows:
            if k is None or zlib.crc32(str(k).encode()) % 5 != 1:
                tokens = lm_tokens(t)
                for a, b in zip([start, *tokens[:-1]], tokens, strict=True):
                    ctx = (texts if a is start else c1[a]) - 1
                    p2 = (c2[a, b] - 1) / ctx if ctx else 0.0
                    x = [int(lm.bucket(np.array([ctx]))[0]), int(lm.cell(np.array([p2]))[0]), int(lm.cell(np.array([(c1[b] - 1) / max(n - 1, 1)]))[0])]
                    cells[tuple(x)] += 1
        weights = lm.learn_weights([(*k, m) for k, m in cells.items()], v)
        got = defaultdict(list)
        for r in lm.score(docs, block_bytes=block_bytes).collect():
            got[r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)].append(r)
        assert sum(map(len, got.values())) == len(rows)
        for k, t in rows:
            tokens = lm_tokens(t)
            base = sum(math.log10((c1[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
            model = 0.0
            for a, b in zip([start, *tokens[:-1]], tokens, strict=True):
                ctx = texts if a is start else c1[a]
                w = weights[int(lm.bucket(np.array([ctx]))[0])]
                model += math.log10(w[0] * (c2[a, b] / ctx if ctx else 0.0) + w[1] * c1[b] / max(n, 1) + w[2] / (v + 1))
            found = got[k, len(tokens), sum(w in c1 for w in tokens), round(base, 6)]
            assert found
            assert found[0]["score"] == pytest.approx(model, rel=1e-9)
            assert found[0]["train_tokens"] == n and found[0]["held_out"] == (k is not None and zlib.crc32(str(k).encode()) % 5 == 1)


def test_model_beats_base_on_held_out_text(spark, sf_dir):
    row = lm.score(table(spark, "/root/testdata/sf0.01", "documents")).filter("held_out").selectExpr("sum(score) m", "sum(base_score) b").first()
    assert row["m"] > row["b"]


def unrounded_em(p2, p1, tokens, v):
    p = np.stack([p2, p1, np.full(len(p1), 1.0 / (v + 1))], 1)
    weights = np.full(3, 1 / 3)
    for _ in range(lm.EM_STEPS):
        share = p * weights
        share /= share.sum(1, keepdims=True)
        weights = tokens @ share / tokens.sum()
    return weights


@pytest.mark.parametrize("n", [1 << 27, 5_000_000_000, 1 << 40])
def test_weights_of_many_tokens(n):
    # Types by count as in a Zipf vocabulary: about n / (c * c) words are seen c times, and each token's own occurrence is deleted.
    c = np.unique(np.geomspace(1, n / 20, 400).astype(np.int64))
    types = np.maximum(np.diff(np.append(-1.0 / c, 0.0)) * n / 20, 1.0)
    tokens = np.ceil(types * c).astype(np.int64)
    total, v = int(tokens.sum()), int(types.sum())
    p1, p2 = (c - 1) / (total - 1), np.zeros(len(c))
    sums = Counter()
    for x, m in zip(lm.cell(p1), tokens, strict=True):
        sums[5, 0, int(x)] += int(m)
    got = lm.learn_weights([(*k, m) for k, m in sums.items()], v)[5]
    want = np.maximum(unrounded_em(p2, p1, tokens, v), 1e-6)
    assert got == pytest.approx(want / want.sum(), rel=0.15, abs=1e-6)


def test_cells_tell_all_counts_apart():
    # Powers of two up to the largest count that fits: none shares a cell or a bucket with the next.
    p = 2.0 ** -np.arange(63)
    assert (np.diff(lm.cell(p)) == 2).all() and (lm.cell_value(lm.cell(p)) == pytest.approx(p, rel=1e-9))
    assert (np.diff(lm.bucket(1 << np.arange(62))) == 1).all()


def test_counts_pack():
    rng = np.random.default_rng(0)
    x = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(x)) == x).all()
    for top in (5, 300, 70_000, 1 << 40):
        c = rng.integers(0, top, 100)
        assert (lm.unpack_counts(lm.pack_counts(c), 100) == c).all()


def article(page):
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    import html

    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>|<br>", " " if False else "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_page_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        assert got[r["page_id"]] == article(r["html"])


ODD_PAGES = [
    (1, None, None),
    (2, "u", ""),
    (3, "u", "just text &amp; more"),
    (4, "u", "<article><p>one<p>two <b>bold</b> x<ul><li>a<li>b</ul></article><footer>f</footer>"),
    (5, "u", "<html><body><nav><a href=x>menu</a></nav><main><h1>T</h1><p>Some  long\ntext &lt;here&gt;.</p><aside>side</aside><div class='comments'><p>reader says</p></div></main></body>"),
    (6, "u", "<p title=\"x>unclosed <i>" + "<div>" * 300 + "deep"),
    (7, "u", "<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><article><p>yes</p></article>"),
]


def test_odd_pages(spark, sf_dir):
    model = html_extract.train(table(spark, "/root/testdata/sf0.01", "pages"))
    pages = spark.createDataFrame(ODD_PAGES * 2, "page_id long, url string, html string")
    rows = html_extract.extract(pages, model=model).collect()
    assert len(rows) == 2 * len(ODD_PAGES)
    got = {r["page_id"]: r["text"] for r in rows}
    assert got[1] == "" and got[2] == ""
    assert "no" not in got[7].split() and "menu" not in got[5]


FORMS = {
    "div": lambda p: p.replace("<article>", "<div>").replace("</article>", "</div>"),
    "named": lambda p: p.replace("<article>", '<div class="post">').replace("</article>", "</div>"),
    "stripped": lambda p: p.replace("<article>", "").replace("</article>", ""),
    "no names": lambda p: re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", p).replace(' class="ad"', ""),
}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("own", [True, False])
def test_page_text_without_article_markup(spark, sf_dir, form, own):
    """Trained on the pages as they are, and (where anything is named) on the changed pages themselves."""
    if own and form == "no names":
        pytest.skip("nothing on such pages tells the article")
    pages = [r["html"] for r in table(spark, "/root/testdata/sf0.01", "pages").collect()]
    changed = spark.createDataFrame([(i, "u", FORMS[form](p)) for i, p in enumerate(pages)], "page_id long, url string, html string")
    model = html_extract.train(changed if own else table(spark, sf_dir, "pages"))
    got = {r["page_id"]: r["text"] for r in html_extract.extract(changed, model=model).collect()}
    right = found = other = every = 0
    for i, page in enumerate(pages):
        want, lines = Counter(article(page).split("\n")), Counter(got[i].split("\n"))
        blocks = Counter(b for x in html_extract.parse(page) for _, b in x.blocks)
        size = lambda c: sum(len(x) * n for x, n in c.items())
        right += size(want)
        found += size(want & lines)
        other += size(lines - want)
        every += size(blocks - want)
    assert found >= 0.9 * right and other <= 0.1 * every


@pytest.mark.parametrize(
    "page",
    ["<a " * 300_000, '<a "' * 250_000, "<center>" * 120_000, "<a ='>'" * 140_000, "<textarea>" * 100_000, "<!-- " * 200_000, "<li><section>" + "<center>" * 50_000 + "</li>" * 50_000, "<" * 10**6, '<a ="' * 200_000 + ">"],
    ids=range(9),
)
def test_parsing_is_linear(page):
    start = time.process_time()
    html_extract.parse(page)
    assert time.process_time() - start < 10


def test_character_references():
    assert html_extract.unescaped("&eacute;&#33;&#x21;&amp;lt;") == "é!!&lt;"
    assert html_extract.unescaped("a&#" + "0" * 9000 + "65;" + "&#" + "9" * 9000 + ";") == "aA\ufffd"


def test_quoted_values_hide_the_end_of_a_tag():
    blocks = lambda page: [b for x in html_extract.parse(page) for _, b in x.blocks]
    assert blocks('<p title="a>b">c</p>') == ["c"]
    assert blocks("<p it's>c</p>") == ["c"]
    assert blocks('<p title="a>b c') == ['b c']


def test_labels_by_each_cue():
    prose = "<p>" + "Some words of an article. " * 9 + "</p>"
    frame = "<body><nav><a href=x>menu</a></nav>{}<div class=ad>buy now</div><footer>small print</footer></body>"
    for inside in ("<article>{}</article>", "<div class=post>{}</div>", "<div>{}</div>", "{}"):
        nodes = html_extract.parse(frame.format(inside.format(prose * 2)))
        labels = html_extract.weak_labels(nodes)
        assert {x.tag for x, y in zip(nodes, labels, strict=True) if y and x.blocks} == {"p"}
        assert not any(y for x, y in zip(nodes, labels, strict=True) if x.blocks and x.tag != "p")
    assert html_extract.weak_labels(html_extract.parse("<nav><a href=x>menu</a></nav>")) is None


def test_decoding_equals_the_best_of_all_labellings():
    """Every labelling where what is below an article's rejected node is rejected, too."""
    rng = random.Random(5)
    for _ in range(40):
        nodes = [html_extract.Node("#root", None, frozenset())]
        for n in range(rng.randrange(1, 7)):
            nodes.append(html_extract.Node("div", rng.choice(nodes), frozenset()))
            nodes[-1].blocks = [(n, "x" * rng.randrange(1, 50))] * rng.randrange(2)
        order = {id(x): i for i, x in enumerate(nodes)}
        up = [order[id(x.parent)] if x.parent else -1 for x in nodes]
        p = np.array([rng.uniform(0.02, 0.98) for _ in nodes])
        weight = [0.25 + math.log1p(sum(len(b) for _, b in x.blocks)) for x in nodes]
        best = (-math.inf, None)
        for states in itertools.product((0, 1, 2), repeat=len(nodes)):  # outside, inside, rejected
            if any(u < 0 and s == 2 or u >= 0 and (s != 2 and states[u] == 2 or s == 0 and states[u] == 1) for s, u in zip(states, up, strict=True)):
                continue
            total = sum(w * math.log(q if s == 1 else 1 - q) for s, w, q in zip(states, weight, p, strict=True))
            best = max(best, (total, tuple(s == 1 for s in states)))
        kept = html_extract.decode(nodes, p)
        assert sum(w * math.log(q if k else 1 - q) for k, w, q in zip(kept, weight, p, strict=True)) == pytest.approx(best[0])


def test_decoding_is_consistent():
    nodes = html_extract.parse("<div><article><p>a</p><div class=ad><p>b</p></div></article></div>")
    names = [x.tag for x in nodes]
    kept = html_extract.decode(nodes, np.array([0.1, 0.1, 0.9, 0.9, 0.01, 0.55]))
    assert [n for n, k in zip(names, kept, strict=True) if k] == ["article", "p"]


def test_blocks():
    nodes = html_extract.parse("<p>a <b>b</b>\n c<br>d<p>&eacute;&#33;</p>tail")
    assert [b for x in nodes for _, b in sorted(x.blocks)] != []
    assert [b for _, b in sorted(b for x in nodes for b in x.blocks)] == ["a b c d", "é!", "tail"]


def test_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = trees.fit(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == (y[1500:] > 0)).mean() > 0.95


def neighbours(rows, k, every):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = np.array([float((x[j] * x[i]).sum()) for j in range(len(x))])
        order = sorted((j for j in range(len(x)) if ids[j] != ids[i]), key=lambda j: (-score[j], ids[j]))[:k]
        out[int(ids[i])] = [int(ids[j]) for j in order]
    return out


def test_neighbours_recall_and_scores(spark):
    for sf in ("sf0.001", "sf0.01"):
        vectors = table(spark, f"/root/testdata/{sf}", "embeddings")
        rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
        want = neighbours(rows, 20, 20)
        by = dict(rows)
        got = defaultdict(list)
        for r in ann.search(vectors).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append(r["vec_id"])
            assert r["rank"] == len(got[r["query_id"]])
            assert r["score"] == pytest.approx(float(np.dot(np.array(by[r["query_id"]], np.float64), np.array(by[r["vec_id"]], np.float64))), abs=1e-12)
        hits = sum(len(set(got[q]) & set(w)) for q, w in want.items())
        assert hits / sum(map(len, want.values())) >= 0.9


def test_odd_vectors(spark):
    rows = [(i, [1.0, 0.0, 2.0], "x") for i in range(30)] + [(40, None, "x"), (60, [0.0, 0.0, 0.0], "x"), (80, [1.0, None, 1.0], "x"), (100, [float("nan"), 1.0, 1.0], "x"), (120, [1.0], "x"), (None, [1.0, 1.0, 1.0], "x"), (0, [1.0, 0.0, 2.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = ann.search(df).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, n, n) for n in range(1, 21)] + [(20, n + 1, n) for n in range(20)]
