"""Quality rules: a threshold table compiled into one projection of built-in functions.

Counts are array functions inside the document row: no shuffle, no user functions.  For repeated three-word
windows, each window's hash and position are packed into one long, sorted as plain longs, and equal neighbours
are confirmed word by word.  Where neighbours have equal hashes but different words, that text's windows are sorted by
their words instead, so a hash never decides alone.

Defined results: a null text is empty: all counts 0, failed; repeated rows each get their row; an empty table
gives no rows; other columns pass through ``with_counts`` untouched and are ignored by ``score``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import SPACE, SPACE_CHARS, fenced, word_array

SYMBOLS = "#*$%&|<>"
#: Frequent function words of the supported languages (fixed values).
STOP_WORDS = (
    "the of and to in is that for it with as by on be are this was at from or an "
    "le la les de du des et un une que qui en est pour par dans sur pas au avec "
    "el los las del y que un una se por con no su para es lo como "
    "der die das und ist von den mit ein eine zu sich auf im nicht dem als sie er"
).split()


@dataclass(frozen=True)
class Rule:
    """Fails when ``value`` / ``base`` is below ``low`` or above ``high`` (compared as value against bound * base)."""

    name: str
    value: str
    base: str | None = None
    low: float | None = None
    high: float | None = None

    def fails(self) -> Column:
        value, base = F.col(self.value).cast("double"), F.col(self.base).cast("double") if self.base else F.lit(1.0)
        parts = [value < base * self.low] if self.low is not None else []
        parts += [value > base * self.high] if self.high is not None else []
        out = parts[0]
        for p in parts[1:]:
            out = out | p
        return out


#: Rules that decide on their own what fails (counts, exactly as specified).
BASE_RULES = (
    Rule("short", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.5),
)
#: Further rules: wide bounds that ordinary prose of any of the languages stays well inside.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=20.0),
    Rule("symbols", "n_symbols", "n_words", high=0.5),
    Rule("stop_words", "n_stop_words", "n_words", low=0.01),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
)


#: Hash of the window of words {a}, {b}, {c}.
WINDOW_HASH = "xxhash64({a}, {b}, {c})"


def with_counts(docs: DataFrame, text: str = "text", window_hash: str = WINDOW_HASH) -> DataFrame:
    """``docs`` plus ``n_words, n_chars_all, word_chars, n_symbols, n_stop_words, n_lines, n_dup_lines, n_repeat_words``
    (long).  The helper columns ``_q_*`` are staged, so that each is computed once."""
    body = F.coalesce(F.col(text), F.lit(""))
    stops = ",".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    hashed = window_hash.format(a="w", b="get(_q_words, i + 1)", c="get(_q_words, i + 2)")
    windows = "slice(_q_words, 1, greatest(size(_q_words) - 2, 0))"
    staged = (
        docs.withColumn("_q_words", word_array(F.col(text)))
        .withColumn("_q_lines", F.filter(F.split(body, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]")))
        .withColumn("_q_n", F.size("_q_words").cast("long"))
        .withColumn("_q_bits", F.length(F.bin(F.col("_q_n"))))
        .withColumn(
            "_q_windows",
            F.expr(
                f"sort_array(transform({windows}, (w, i) -> shiftleft(shiftright({hashed}, _q_bits), _q_bits) | cast(i as bigint)))"
            ),
        )
        .withColumn("_q_mask", F.expr("shiftleft(1L, _q_bits) - 1"))
    )

    def alike(other: str) -> str:
        return f"shiftright(v, _q_bits) = shiftright({other}, _q_bits)"

    def same_words(other: str) -> str:
        return " and ".join(f"get(_q_words, cast(v & _q_mask as int) + {k}) = get(_q_words, cast({other} & _q_mask as int) + {k})" for k in range(3))

    def neighbour(test: str) -> str:
        return " or ".join("(" + test.format(f"get(_q_sorted, i {d} 1)") + ")" for d in "-+")

    after, before = "get(_q_windows, i + 1)", "get(_q_windows, i - 1)"
    by_hash = f"filter(_q_windows, (v, i) -> ({alike(before)} and {same_words(before)}) or ({alike(after)} and {same_words(after)}))"
    by_words = f"filter(_q_sorted, (x, i) -> {neighbour('x.a = {0}.a and x.b = {0}.b and x.c = {0}.c')})"
    staged = (
        staged.withColumn("_q_mixed", F.expr(f"exists(transform(_q_windows, (v, i) -> {alike(after)} and not ({same_words(after)})), x -> x)"))
        .withColumn(
            "_q_sorted",
            F.expr(f"if(_q_mixed, sort_array(transform({windows}, (w, i) -> named_struct('a', w, 'b', get(_q_words, i + 1), 'c', get(_q_words, i + 2), 'at', cast(i as bigint)))), array())"),
        )
        .withColumn("_q_repeats", F.expr(f"if(_q_mixed, transform({by_words}, x -> x.at), transform({by_hash}, v -> v & _q_mask))"))
    )
    covered = F.expr("size(array_union(array_union(_q_repeats, transform(_q_repeats, p -> p + 1)), transform(_q_repeats, p -> p + 2)))")
    squeezed = F.length(F.translate(body, SPACE_CHARS, ""))
    return staged.withColumns(
        {
            "n_words": F.col("_q_n"),
            "word_chars": squeezed.cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "n_stop_words": F.expr(f"size(filter(_q_words, w -> lower(w) in ({stops})))").cast("long"),
            "n_lines": F.size("_q_lines").cast("long"),
            "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
            "n_repeat_words": F.when(F.size("_q_repeats") > 0, covered).otherwise(0).cast("long"),
        }
    ).drop("_q_words", "_q_lines", "_q_n", "_q_bits", "_q_windows", "_q_mask", "_q_mixed", "_q_sorted", "_q_repeats")


def verdict(rules=RULES) -> tuple[Column, Column]:
    """(base rules fail, kept), compiled from the threshold tables."""

    def any_of(table) -> Column:
        out = F.lit(False)
        for rule in table:
            out = out | rule.fails()
        return out

    failed = any_of(BASE_RULES)
    return failed, ~(failed | any_of(rules))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """``(key, counts, base_failed, kept)`` for every row."""
    failed, kept = verdict(rules)
    counted = with_counts(docs.select(F.col(key).alias("_q_key"), F.col(text).alias("_q_text")), "_q_text")
    return fenced(
        counted,
        F.col("_q_key").alias(key),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines",
        failed.alias("base_failed"),
        kept.alias("kept"),
    )


def passing(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass all rules, with their own columns only."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_q_row"), F.col(text).alias("_q_text"))
    kept = verdict(rules)[1].alias("_q_kept")
    return fenced(with_counts(packed, "_q_text"), F.col("_q_row"), kept).filter("_q_kept").select("_q_row.*")
