"""Fixed values and built-in word tables.

Values in the block marked FIXED VALUES must stay exactly as they are: results
depend on them being equal to the behaviour this library reproduces.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced behaviour; do not edit)
# ---------------------------------------------------------------------------

# Title namespaces that never hold an article (compared lower-case, unaccented).
EXCLUDED_NAMESPACES = (
    "category", "especial", "special", "file", "archivo", "help", "ayuda",
    "template", "plantilla", "user", "usuario", "talk", "discusion",
    "mediawiki", "module", "modulo", "forum", "thread", "comment", "blog",
    "widget",
)

# Lemmas that, tagged as verbs, carry too little information to keep.
LOW_INFORMATION_VERBS = (
    "be", "have", "do", "say", "go", "can", "get", "would", "make", "know",
    "will", "think", "take", "see", "come", "could", "want", "look", "use",
    "find", "give", "tell", "work", "call", "include",
)

# The title of the main page, compared case-insensitively with spaces as "_".
MAIN_PAGE_TITLE = "main_page"

# Default parameters of the networks (see README, "Parameters").
DEFAULT_BASE_URL = "https://en.wikipedia.org"
DEFAULT_MARKER = "/wiki/"
DEFAULT_WINDOW_SIZE = 5
DEFAULT_VOCABULARY_SIZE = 100
DEFAULT_MIN_TOKEN_LENGTH = 3  # keep tokens longer than 2 characters
DEFAULT_TOP_N_BIGRAMS = 150
DEFAULT_EDGE_PRUNE_PERCENTILE = 45
DEFAULT_NODE_PRUNE_PERCENTILE = 15
DEFAULT_MIN_NODE_FREQ = 5
DEFAULT_MIN_EDGE_WEIGHT = 5
DEFAULT_MIN_LINK_FREQ = 3
DEFAULT_MAX_ARTICLES = 100
DEFAULT_MAX_DEPTH = 100
DEFAULT_TOP_COMMUNITIES = 10
DEFAULT_TOP_NODES = 10

# Node groups and edge types of the exported networks.
GROUP_WORD, GROUP_BIGRAM, GROUP_LINK = "word", "bigram", "link"
TYPE_UNDIRECTED, TYPE_CONTAINS, TYPE_COOCCURS, TYPE_DIRECTED = (
    "Undirected", "Contains", "Co-occurs", "Directed",
)

# ---------------------------------------------------------------------------
# End of fixed values
# ---------------------------------------------------------------------------

# Later insertions overwrite earlier ones when two edges join the same pair.
EDGE_PRIORITY = {TYPE_UNDIRECTED: 1, TYPE_CONTAINS: 2, TYPE_COOCCURS: 3}

# Default lexicon: the inflected forms of the low-information verbs, tagged as
# verbs, so that the verb filter works without a language model.  Our own table
# (English morphology), one row per (surface, lemma).
_VERB_FORMS = {
    "be": "am is are was were been being",
    "have": "has had having",
    "do": "does did done doing",
    "say": "says said saying",
    "go": "goes went gone going",
    "can": "",
    "get": "gets got gotten getting",
    "would": "",
    "make": "makes made making",
    "know": "knows knew known knowing",
    "will": "",
    "think": "thinks thought thinking",
    "take": "takes took taken taking",
    "see": "sees saw seen seeing",
    "come": "comes came coming",
    "could": "",
    "want": "wants wanted wanting",
    "look": "looks looked looking",
    "use": "uses used using",
    "find": "finds found finding",
    "give": "gives gave given giving",
    "tell": "tells told telling",
    "work": "works worked working",
    "call": "calls called calling",
    "include": "includes included including",
}


def default_lexicon() -> list[tuple[str, str, str]]:
    """Rows ``(surface, lemma, pos_tag)`` of the default lexicon."""
    rows: list[tuple[str, str, str]] = []
    for lemma in LOW_INFORMATION_VERBS:
        rows.append((lemma, lemma, "VERB"))
        for form in _VERB_FORMS.get(lemma, "").split():
            rows.append((form, lemma, "VERB"))
    return rows


@functools.lru_cache(maxsize=1)
def default_stop_words() -> tuple[str, ...]:
    """Spark ML's English stop-word list, apostrophes removed, de-duplicated.

    Read from the list shipped inside the Spark ML jar, so no JVM is needed
    (the DuckDB oracle uses the same list).  Same content as
    ``StopWordsRemover.loadDefaultStopWords("english")``.
    """
    import pyspark

    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    words: list[str] = []
    for jar in jars:
        with zipfile.ZipFile(jar) as zf:
            try:
                raw = zf.read("org/apache/spark/ml/feature/stopwords/english.txt")
            except KeyError:
                continue
        words = [w.strip() for w in raw.decode("utf-8").splitlines() if w.strip()]
        break
    if not words:  # pragma: no cover - only without the ML jar
        from pyspark.ml.feature import StopWordsRemover

        words = list(StopWordsRemover.loadDefaultStopWords("english"))
    seen: dict[str, None] = {}
    for word in words:
        seen.setdefault(word.replace("'", ""), None)
    return tuple(seen)
