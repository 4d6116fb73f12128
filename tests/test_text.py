import random

from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from brute import docs_df
from linkweave.functions.text import normalise_text
from linkweave.operators.annotate import annotated_documents
from linkweave.operators.text import (
    content_words_long,
    document_vocabulary,
    phrase_entities,
    text_pipeline,
)


def test_normalise_deletes_non_letters(spark):
    df = spark.createDataFrame([("Café L'eau 3-way",)], "t string")
    assert df.select(normalise_text("t")).first()[0] == "caf leau way"


def test_content_words_drop_stop_words_short_tokens_and_verbs(spark):
    out = text_pipeline(docs_df(spark, ["The pain relief was used, and it is said the dose works."])).first()
    assert list(out.words) == ["pain", "relief", "dose"]


def test_vocabulary_ranks_by_count_then_first_occurrence(spark):
    tok = spark.createDataFrame([(0, ["xxx", "yyy", "yyy", "zzz", "yyy", "xxx"])], "doc_ord long, tokens array<string>")
    r = document_vocabulary(tok).first()
    assert [(v.word, v.n) for v in r.vocab] == [("yyy", 3), ("xxx", 2), ("zzz", 1)]
    assert list(r.bigrams) == ["yyy xxx", "xxx zzz"]


def test_vocabulary_filter_comes_after_the_cut(spark):
    # 100 entries more frequent than the 101st; one of them holds a space.
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100)]
    words[5] = "two words"
    tokens = [w for w in words for _ in range(3)] + ["late"]
    tokens = [t.replace("0", "") for t in tokens]
    tok = spark.createDataFrame([(0, tokens)], "doc_ord long, tokens array<string>")
    r = document_vocabulary(tok).first()
    assert len(r.vocab) == 99 and "late" not in [v.word for v in r.vocab]
    assert len(r.bigrams) == 98


def test_single_entry_vocabulary_gives_no_bigrams(spark):
    tok = spark.createDataFrame([(0, ["alone", "alone"]), (1, [])], "doc_ord long, tokens array<string>")
    rows = {r.doc_ord: r for r in document_vocabulary(tok).collect()}
    assert list(rows[0].bigrams) == [] and list(rows[1].bigrams) == []


def test_phrase_entities_longest_leftmost_without_overlap(spark):
    docs = docs_df(spark, ["heart rate heart rate monitor rate monitor", "nothing here"])
    ents = {r.doc_ord: list(r.entities) for r in phrase_entities(docs, ["heart rate", "rate monitor", "heart rate monitor"]).collect()}
    assert ents[0] == ["heart rate", "heart rate monitor", "rate monitor"]
    assert ents[1] == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abc DEé'-\n", min_size=0, max_size=60), min_size=1, max_size=5))
def test_text_pipeline_matches_plain_python(spark, texts):
    out = {r.doc_ord: r for r in text_pipeline(docs_df(spark, texts)).collect()}
    for i, t in enumerate(texts):
        words = brute.content_words(t)
        assert list(out[i].words) == words
        vocab = brute.vocabulary(words)
        assert [v.word for v in out[i].vocab] == vocab
        assert list(out[i].bigrams) == brute.rank_bigrams(vocab)


def test_long_format_positions(spark):
    tok = text_pipeline(docs_df(spark, ["alpha beta gamma", "delta"]))
    rows = sorted((r.doc_ord, r.pos, r.word) for r in content_words_long(tok).collect())
    assert rows == [(0, 0, "alpha"), (0, 1, "beta"), (0, 2, "gamma"), (1, 0, "delta")]


def test_lexicon_list_and_table_agree(spark):
    from linkweave.operators.text import document_words

    # Several rows a surface: "works" is a low-information verb in one of them, "runs" has two lemmas.
    lexicon = [("works", "work", "VERB"), ("works", "work", "NOUN"), ("runs", "sprint", "NOUN"), ("runs", "run", "VERB"), ("doors", "door", "NOUN"), ("odd", None, None)]
    docs = docs_df(spark, ["Hard works and runs near odd doors", "", "nothing special"])
    table = spark.createDataFrame(lexicon, "surface string, lemma string, pos_tag string")
    for given in (lexicon, lexicon[::-1], table, table.repartition(3)):
        got = {r.doc_ord: list(r.words) for r in document_words(docs, lexicon=given).collect()}
        assert got == {0: ["hard", "run", "near", "odd", "door"], 1: [], 2: ["nothing", "special"]}


def test_separators_are_white_space(spark):
    df = spark.createDataFrame([("oak\x1celm\x1f ash",)], "t string")
    assert df.select(normalise_text("t")).first()[0].split() == ["oak", "elm", "ash"]


def leftmost_longest(tokens, phrases):
    out, i, sizes = [], 0, sorted({len(p.split()) for p in phrases}, reverse=True)
    while i < len(tokens):
        hit = next((n for n in sizes if " ".join(tokens[i : i + n]) in phrases and i + n <= len(tokens)), 0)
        if hit:
            out.append(" ".join(tokens[i : i + hit]))
        i += hit or 1
    return out


def test_a_hundred_thousand_phrases(spark):
    rnd = random.Random(6)
    words = [a + b + c for a in "abcde" for b in "fghij" for c in "klmno"]
    # A third of the phrases, and of the tokens, start with one word.
    phrases = set()
    while len(phrases) < 100_000:
        phrases.add(" ".join([words[0] if rnd.random() < 0.3 else rnd.choice(words), *rnd.choices(words, k=rnd.randrange(0, 4))]))
    texts = [" ".join(words[0] if rnd.random() < 0.3 else rnd.choice(words) for _ in range(rnd.choice((0, 1, 40, 400)))) for _ in range(30)]
    table = spark.createDataFrame([(p,) for p in [*sorted(phrases), "  ", None, words[1] + "   " + words[2]]], "phrase string")
    got = {r.doc_ord: list(r.entities) for r in phrase_entities(docs_df(spark, [*texts, None]), table).collect()}
    phrases.add(f"{words[1]} {words[2]}")
    assert got == {i: leftmost_longest((t or "").split(), phrases) for i, t in enumerate([*texts, None])}


def test_no_phrases(spark):
    assert [list(r.entities) for r in phrase_entities(docs_df(spark, ["one two"]), []).collect()] == [[]]


NOTES = "doc_id long, pos int, surface string, lemma string, pos_tag string, entity long"


def test_annotations_are_merged_by_place(spark):
    docs = docs_df(spark, ["The Heart-rate studies used new hearts; new york city.", "plain words only", None])
    # Tokens of the first text: the heartrate studies used new hearts new york city
    notes = [
        (0, 1, "heartrate", "heartrate", "NOUN", 1), (0, 2, "studies", "study", "NOUN", 1),
        (0, 3, "used", "use", "VERB", None), (0, 5, "hearts", "heart", "NOUN", None),
        (0, 6, "new", "new", "PROPN", 2), (0, 7, "york", "york", "PROPN", 2), (0, 8, "city", "city", "NOUN", 3),
        # No such place, document or surface; a second row for a token; rows without a place or surface.
        (0, 99, "studies", "wrong", "NOUN", 9), (7, 0, "the", "wrong", "NOUN", 9), (0, 5, "heart", "wrong", "VERB", 9),
        (0, 7, "york", "zork", "PROPN", 2), (0, None, "york", "wrong", "X", 9), (0, 4, None, "wrong", "X", 9), (0, -1, "the", "wrong", "X", 9),
        (1, 0, "plain", None, None, None),
    ]
    got = {r.doc_ord: r for r in annotated_documents(docs, spark.createDataFrame(notes, NOTES)).collect()}
    assert list(got[0].words) == ["heartrate", "study", "new", "heart", "new", "york", "city"]
    assert list(got[0].entities) == ["heartrate studies", "new york", "city"]
    assert (list(got[1].words), list(got[1].entities)) == (["plain", "words"], [])
    assert (list(got[2].words), list(got[2].entities)) == ([], [])
    tokens = {r.doc_ord: list(r.tokens) for r in text_pipeline(docs, annotations=spark.createDataFrame(notes, NOTES)).collect()}
    assert tokens[0] == [*got[0].words, *got[0].entities]


def test_no_annotations(spark):
    got = annotated_documents(docs_df(spark, ["red green", ""]), spark.createDataFrame([], NOTES)).collect()
    assert sorted((r.doc_ord, list(r.words), list(r.entities)) for r in got) == [(0, ["red", "green"], []), (1, [], [])]


def test_counted_tokens_by_count_and_place(spark):
    from linkweave.functions.text import counted_tokens

    rows = [(0, ["b", "two words", "b", "a", "ä", "a", "c"]), (1, None), (2, []), (3, ["c", "b"]), (4, ["z"] * 3)]
    df = spark.createDataFrame(rows, "doc_ord long, tokens array<string>").coalesce(1)
    got = {r.doc_ord: r.c for r in df.select("doc_ord", counted_tokens("tokens", 3).alias("c")).collect()}
    assert got[0].runs == [(-2, 3, "a"), (-2, 0, "b"), (-1, 6, "c"), (-1, 1, "two words"), (-1, 4, "ä")]
    assert got[0].top == [(-2, 0, "b"), (-2, 3, "a"), (-1, 1, "two words")]
    assert got[1].runs is None and got[1].top is None and got[2].runs == [] and got[2].top == []
    assert got[3].top == [(-1, 0, "c"), (-1, 1, "b")] and got[4].runs == got[4].top == [(-3, 0, "z")]


def test_entity_graph_splits_texts_once(spark, tmp_path, monkeypatch):
    from linkweave.operators import text as ops
    from linkweave.plans import queries_text

    rows = [(i, "Pain relief with dose control, pain relief and heart rate.") for i in range(6)] + [(6, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    calls = []
    monkeypatch.setattr(ops, "split_tokens", lambda c, real=ops.split_tokens: calls.append(1) or real(c))
    nodes, edges = queries_text.entity_graph(spark, str(tmp_path))
    assert {"pain relief", "heart rate"} & {r.Label for r in nodes.collect()} and edges.count()
    # The texts, and the phrase list.
    assert len(calls) == 2
    # One call to Python counts a document's tokens, whatever its readers.
    words = spark.createDataFrame([(0, ["a", "b"])], "doc_ord long, tokens array<string>")
    plan = ops.document_vocabulary(words)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("counted(") == 1


def test_annotated_words_are_dealt_as_texts(spark, tmp_path):
    """Documents are shuffled by their key as texts; their token rows are made, collected and joined without another exchange."""
    from linkweave.plans import queries_text as qt

    texts = ["Elephants wandering beside quiet waterfalls make notes", "short words only", None, "lonely elephant walks; mountains rivers"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {(r.doc_id, r.pos, r.surface): r.entity for r in qt.annotation_table(docs).collect()}
    assert rows[0, 0, "elephants"] == rows[0, 1, "wandering"] == 0 and rows[0, 4, "waterfalls"] is None and rows[0, 0, "aaa"] == 1
    assert rows[3, 1, "elephant"] is None and rows[3, 3, "mountains"] is None and len(rows) == 7 + 3 + 5 + 3
    found = qt.q_annotated_words(spark, str(tmp_path))
    words = {}
    for r in sorted(found.collect()):
        words.setdefault(r.doc_id, []).append(r.word)
    assert words[0][-1] == "elephants wandering" and words[3] == ["lonely", "elephant", "walks", "mountain", "river"]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "Window" not in plan
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "surface" not in x]
    assert dealt and all("REPARTITION_BY_NUM" in x for x in dealt)
