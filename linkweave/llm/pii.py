"""Personal data by candidate gradient boosting.

Base kinds are found by pattern and check.  On top, generators of high recall propose further, overlapping spans;
features of their format and of the text around them go through boosted trees, and a threshold calibrated on candidates
the trees have not seen selects, for each generator, the spans that are added.  All candidates of all documents are written
once, with their features.  The trees are trained by Spark ML on a bounded sample of them, by hash with a quota for each
generator and label; the thresholds come from counts over the other half of them, by hash, as a table of generators and bins.
The trees are compiled into one built-in expression, so scoring needs neither user functions nor a shuffle.

There are no labelled spans, so labels come from rules (``_label``): a candidate is private when a base
check confirms what it holds, or when it is assigned to a name such as "token" or "password".

Patterns are written without backtracking over long runs (possessive, and started only where a run starts), with the
same matches as their plain forms.  Offsets are code points: the text is split at the matches, and lengths of gaps and
matches are summed up within the row.

Defined results: a null text is empty and has no spans; repeated rows each get their row; an empty table gives no
rows (and no model); other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import fenced, unit_hash
from linkweave.session import discard, materialize


def _quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A text without this pattern has no match.
    needs: str
    #: SQL test of a match ``m``.
    test: str = "true"


_DIGITS = "regexp_replace(m, '[^0-9]', '')"
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", r"not exists(split(m, '[.]'), p -> not p rlike '^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$')"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", "[0-9]", f"length({_DIGITS}) between 14 and 19 and luhn_check({_DIGITS})"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", f"length({_DIGITS}) between 10 and 15"),
)
#: Generators: what they propose is only kept when the trees say so.
GENERATORS = (
    Kind("secret", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+", "[A-Za-z0-9+/_-]{16}", "m rlike '[0-9]' and m rlike '[A-Za-z]'"),
    Kind("number", r"(?<![0-9])[0-9](?:[\x20./()-]{0,2}+[0-9]){6,}+", "[0-9]", "true"),
    Kind("contact", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)*+", r"@|\(at\)|\[at\]"),
    Kind("address", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}+[0-9A-Fa-f]{1,4}", ":"),
    # What is assigned to a name, where the form of a secret does not show: short, or with signs.
    Kind(
        "password",
        r"(?<=(?:[Tt][Oo][Kk][Ee][Nn]|[Kk][Ee][Yy]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Pp][Ww][Dd]|[Pp][Aa][Ss][Ss][Pp][Hh][Rr][Aa][Ss][Ee])"
        r"[\"']?\x20?[=:]\x20?[\"']?)[^\s\"'<>,;=:]{4,}+",
        r"(?i)(?:token|key|secret|password|passwd|pwd|passphrase)[\"']?\x20?[=:]",
        "not (m rlike '^[A-Za-z0-9+/_-]{16,}$' and m rlike '[0-9]' and m rlike '[A-Za-z]')",
    ),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}\x20[A-Z0-9]{4}(?:\x20(?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}){1,6}(?:\x20(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?+(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}\x20[A-Z0-9]{4}\x20"),
    Kind("short_address", r"(?<![0-9A-Za-z:_.])(?:[0-9A-Fa-f]{1,4}:){1,7}+:(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}+)?+(?![0-9A-Za-z:_])", "[0-9A-Fa-f]::"),
)
#: Candidates that the trees are trained on, at most, about.
TRAIN_CANDIDATES = 20_000
TREES, DEPTH = 8, 3
#: Share of right ones among the candidates above a threshold on calibration rows.
PRECISION = 0.95
#: Words before a span that tell what it is.
CUES = "phone|tel|call|fax|mail|contact|card|visa|iban|account|token|key|secret|password|passwd|pwd|host|addr|ssn|id"
ASSIGNED = "(?i)((token|key|secret|password|passwd|pwd|passphrase|credentials?|api|auth|authorization)[ \"']*[=:][ \"']*|bearer +)$"
PHONE_CUE = "(?i)(^|[^a-z])(phone|telephone|tel|call|mobile|cell|fax)( number| no| us| at| is)*[^A-Za-z0-9]{0,4}$"
ID_CUE = "(?i)(^|[^a-z])(ssn|social security|account|acct|passport|tax id)( number| no| is)*[^A-Za-z0-9]{0,4}$"
#: An IBAN's remainder: letters count as 10 to 35, the first four characters come last.
_PLAIN = "regexp_replace(m, '[^A-Za-z0-9]', '')"
_IBAN = (
    f"coalesce({_PLAIN} rlike '^[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}$' and aggregate(transform(split(concat(substring({_PLAIN}, 5), substring({_PLAIN}, 1, 4)), ''), x -> ascii(x)), "
    "0, (a, o) -> if(o < 48, a, if(o < 58, a * 10 + o - 48, a * 100 + o - 55) % 97)) = 1, false)"
)
FEATURES = {
    "length": "length(m)",
    "digits": "length(m) - length(translate(m, '0123456789', ''))",
    "upper": "length(regexp_replace(m, '[^A-Z]', ''))",
    "lower": "length(regexp_replace(m, '[^a-z]', ''))",
    "separators": "length(regexp_replace(m, '[A-Za-z0-9]', ''))",
    "dots": "length(m) - length(replace(m, '.', ''))",
    "at": "cast(contains(m, '@') as int)",
    "checked": f"cast(coalesce(length({_DIGITS}) between 12 and 19 and luhn_check({_DIGITS}), false) as int)",
    "variety": "size(array_distinct(split(m, '')))",
    "cue": f"cast(before rlike '(?i)({CUES})' as int)",
    "assigned": f"cast(before rlike {_quoted('[=:][ "' + "'" + ']*$')} as int)",
    "named": f"cast(before rlike {_quoted(ASSIGNED)} as int)",
    "phone_cue": f"cast(before rlike {_quoted(PHONE_CUE)} as int)",
    "id_cue": f"cast(before rlike {_quoted(ID_CUE)} as int)",
    "ssn_form": "cast(m rlike '^[0-9]{3}[ -][0-9]{2}[ -][0-9]{4}$' as int)",
    "iban": f"cast({_IBAN} as int)",
    "after_plus": "cast(before rlike '[+]$' as int)",
    "in_word_before": "cast(before rlike '[A-Za-z0-9]$' as int)",
    "in_word_after": "cast(after rlike '^[A-Za-z0-9]' as int)",
}
_BLOCK = 64


def _running(values: str, out: str, step: str = "s + y") -> dict[str, str]:
    """Expressions, in stages, for running sums (each with its own number; or another ``step``) of the array column ``values``:
    inside blocks of 64, after what the blocks before give, so that thousands of matches in one text stay cheap."""
    add = f"0L, (s, y) -> {step}"
    return {
        f"{out}_b": f"transform(sequence(0, greatest(size({values}) - 1, 0) div {_BLOCK}), b -> aggregate(slice({values}, b * {_BLOCK} + 1, {_BLOCK}), {add}))",
        f"{out}_o": f"transform({out}_b, (x, i) -> aggregate(slice({out}_b, 1, i), {add}))",
        out: f"transform({values}, (x, i) -> aggregate(slice({values}, (i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK} + 1), get({out}_o, i div {_BLOCK}), (s, y) -> {step}))",
    }


def _spans(df: DataFrame, kind: Kind, number: int) -> DataFrame:
    """Adds ``_s{number}``: array of (s, k, e, m, before, after) of a kind's matches that pass its test."""
    hits, gaps, lens, at, out = (f"_{x}{number}" for x in ("h", "g", "l", "a", "s"))
    none = F.array().cast("array<string>")
    df = df.withColumn(hits, F.when(F.col("_text").rlike(kind.needs), F.regexp_extract_all("_text", F.lit(kind.pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split("_text", kind.pattern, -1)).otherwise(none))
    df = df.withColumn(lens, F.expr(f"transform({hits}, (m, i) -> cast(length(get({gaps}, i)) + coalesce(length(get({hits}, i - 1)), 0) as bigint))"))
    for name, sql in _running(lens, at).items():
        df = df.withColumn(name, F.expr(sql))
    made = (
        f"transform({hits}, (m, i) -> named_struct('s', get({at}, i), 'k', {number}, 'e', get({at}, i) + length(m), 'm', m, "
        f"'before', right(get({gaps}, i), 24), 'after', left(get({gaps}, i + 1), 1)))"
    )
    test = re.sub(r"\bm\b", "c.m", kind.test)
    return df.withColumn(out, F.expr(f"filter({made}, c -> {test})")).drop(hits, gaps, lens, at, f"{at}_b", f"{at}_o")


def _confirmed(m: str) -> str:
    """SQL: a base kind's whole pattern and test hold for ``m`` (the base spans have it already)."""
    plain = (
        # Possessive: a greedy group takes a level of the stack for each repetition.
        (r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:[.][A-Za-z0-9-]++)++$", BASE[0].test),
        (r"^[0-9]++(?:[.][0-9]++){3}$", BASE[1].test),
        (r"^[0-9](?:[ -]?+[0-9])++$", BASE[2].test),
        (r"^[+][0-9][ ().0-9-]+[0-9]$", BASE[3].test),
    )
    tests = [f"({m} rlike '{p}' and {re.sub(r'\bm\b', m, t)})" for p, t in plain]
    return "coalesce(" + " or ".join(tests) + ", false)"


def _with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``_text``) plus ``_base`` and ``_candidates``, arrays of spans."""
    for n, kind in enumerate((*BASE, *GENERATORS)):
        docs = _spans(docs, kind, n)
    base = [f"_s{n}" for n in range(len(BASE))]
    made = [f"_s{n}" for n in range(len(BASE), len(BASE) + len(GENERATORS))]
    known = _confirmed("c.m")
    return (
        docs.withColumn("_base", F.expr(f"array_sort(transform(concat({', '.join(base)}), c -> named_struct('s', c.s, 'k', c.k, 'e', c.e)))"))
        .withColumn("_candidates", F.expr(f"filter(concat({', '.join(made)}), c -> not {known})"))
        .drop(*base)
        .drop(*made)
    )


def _features(c: str) -> dict[str, str]:
    named = {k: re.sub(r"\b(m|before|after)\b", rf"{c}.\1", v) for k, v in FEATURES.items()}
    return {k: f"cast({v} as double)" for k, v in named.items()} | {f"is_{g.name}": f"cast({c}.k = {len(BASE) + n} as double)" for n, g in enumerate(GENERATORS)}


def _label(c: str) -> str:
    """Label by rule: what the candidate holds passes a base check once separators are unified, or a check of its own (IBAN), or
    its form fits the word before it (phone, account), or it is the whole of what is assigned to a secret's name."""
    number, contact, address, password, iban, short = (f"{c}.k = {len(BASE) + n}" for n in range(1, 7))
    digits, whole = f"regexp_replace({c}.m, '[^0-9]', '')", f"not {c}.after rlike '^[A-Za-z0-9]'"
    rules = (
        f"{number} and length({digits}) between 14 and 19 and luhn_check({digits})",
        f"{number} and length({digits}) between 10 and 15 and {c}.before rlike '[+]$'",
        f"{number} and length({digits}) between 7 and 15 and {c}.before rlike {_quoted(PHONE_CUE)} and {whole}",
        f"{number} and length({digits}) between 8 and 17 and {c}.before rlike {_quoted(ID_CUE)} and {whole}",
        f"{contact} and {c}.m rlike '[.][A-Za-z]+$'",
        address,
        # A word alone, as in "key: remember", is none; a short address has a digit, unlike a name with '::'.
        f"{password} and {c}.m rlike '[0-9]' and {c}.m rlike '[^0-9.()]'",
        f"{short} and {c}.m rlike '[0-9]'",
        re.sub(r"\bm\b", f"{c}.m", _IBAN) + f" and ({iban} or {c}.k = {len(BASE)})",
        f"{c}.k < {len(BASE) + 4} and {c}.before rlike {_quoted(ASSIGNED)} and {whole}",
    )
    return " or ".join(f"({r})" for r in rules)


def tree_sql(debug: str, names: list[str]) -> str:
    """A tree's printed form (If / Else / Predict lines) as nested CASE expressions over the named features."""
    lines = [x.strip() for x in debug.splitlines() if re.match(r"\s*(If|Else|Predict)", x)]

    def node(at: int) -> tuple[str, int]:
        if lines[at].startswith("Predict"):
            return repr(float(lines[at].split(":")[1])) + "D", at + 1
        found = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at])
        yes, at = node(at + 1)
        no, at = node(at + 1)
        return f"CASE WHEN {names[int(found[1])]} <= {float(found[2])!r}D THEN {yes} ELSE {no} END", at

    return node(0)[0]


@dataclass(frozen=True)
class Model:
    #: SQL of the probability over features ``f.<name>``; thresholds by generator (above 1: none is selected).
    probability: str
    thresholds: tuple[float, ...]


def _candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(u, k, label, features)`` of every candidate of every document; ``u`` in (0, 1) by hash of key, start and generator."""
    spans = _with_spans(docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")))
    exploded = fenced(spans, "_key", "_candidates").select("_key", F.explode("_candidates").alias("c"))
    features = [f"{v} as {n}" for n, v in _features("c").items()]
    return exploded.withColumn("u", unit_hash("_key", "c.s", "c.k", seed=1)).selectExpr("u", "c.k as k", f"cast({_label('c')} as double) as label", *features)


def _training_rows(rows: DataFrame, candidates: int) -> DataFrame:
    """About ``candidates`` of ``rows`` at most, by hash from the half that does not calibrate: as many of each generator and label."""
    counts = rows.filter("u < 0.5").groupBy("k", "label").count().collect()
    quota = candidates / (2 * len(GENERATORS))
    rates = [f"WHEN k = {r['k']} AND label = {r['label']} THEN {0.5 * min(1.0, quota / r['count'])!r}D" for r in counts]
    return rows.filter(F.expr(f"u < CASE {' '.join(rates)} ELSE 0D END")) if rates else rows.limit(0)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", candidates: int = TRAIN_CANDIDATES) -> Model | None:
    """Trees from about so many candidates at most, taken by hash with a quota for each generator and label; thresholds from counts
    over the candidates of all documents that are in the calibrating half by hash.  None when no candidate is right."""
    features = _features("c")
    rows = materialize(_candidates(docs, key, text), "pii-candidates")
    # Dealt by hash and sorted, so that a rerun adds up in the same order.
    sample = materialize(_training_rows(rows, candidates).repartition(2, "u").coalesce(2).sortWithinPartitions(*rows.columns), "pii-train")
    seen = {r["label"] for r in sample.select("label").distinct().collect()}
    if len(seen) < 2:
        probability = f"{max(seen, default=0.0)!r}D"
    else:
        fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1, maxBins=32).fit(VectorAssembler(inputCols=list(features), outputCol="features").transform(sample).select("label", "features"))
        names = [f"f.{n}" for n in features]
        total = " + ".join(f"{float(w)!r}D * ({tree_sql(t.toDebugString, names)})" for t, w in zip(fitted.trees, fitted.treeWeights, strict=True))
        probability = f"1D / (1D + exp(-2D * ({total})))"
    scored = rows.filter("u >= 0.5").withColumn("f", F.struct(*features)).withColumn("bin", F.floor(F.expr(probability) * 50))
    bins = [tuple(r) for r in scored.groupBy("k", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("right")).collect()]
    discard(rows, sample)
    return Model(probability, thresholds(bins)) if 1.0 in seen else None


def thresholds(bins: list[tuple[int, int, int, float]]) -> tuple[float, ...]:
    """A threshold for each generator, from (generator, bin, candidates, right ones).  A generator with too few right ones to show
    ``PRECISION`` takes the one of all generators together, or the next step above that its own wrong ones allow."""
    pooled, out = _threshold([b[1:] for b in bins]), []
    for g in range(len(GENERATORS)):
        own = [b[1:] for b in bins if b[0] == len(BASE) + g]
        best = _threshold(own)
        if best > 1 >= pooled:
            above = lambda low: [b for b in own if b[0] >= low]
            steps = [low for low in range(round(pooled * 50), 50) if sum(b[2] for b in above(low)) >= PRECISION * sum(b[1] for b in above(low))]
            best = steps[0] / 50 if steps else best
        out.append(best)
    return tuple(out)


def _threshold(bins: list[tuple[int, int, float]]) -> float:
    """The lowest of 50 steps above which enough candidates are right (one wrong one is added for safety)."""
    best = 2.0
    for low in range(49, -1, -1):
        n, right = sum(b[1] for b in bins if b[0] >= low), sum(b[2] for b in bins if b[0] >= low)
        if n and right / (n + 1) >= PRECISION:
            best = low / 50
    return best


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None, keep_rows: bool = False) -> DataFrame:
    """``(key, base_spans, spans)`` for every row: arrays of (s, k, e) by start and kind, ``k`` into ``BASE + GENERATORS``, end
    exclusive.  ``keep_rows`` adds ``document``, the row as a struct.  Without a model only base spans are found."""
    more = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")] if keep_rows else []
    found = _with_spans(docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"), *more))
    added = F.expr("cast(array() as array<struct<s: bigint, k: int, e: bigint>>)")
    if model:
        features = ", ".join(f"'{n}', {v}" for n, v in _features("c").items())
        bound = f"element_at(array({', '.join(f'{t!r}D' for t in model.thresholds)}), x.c.k - {len(BASE) - 1})"
        found = found.withColumn("_scored", F.expr(f"transform(_candidates, c -> named_struct('c', c, 'f', named_struct({features})))"))
        probability = model.probability.replace("f.", "x.f.")
        added = F.expr(f"transform(filter(_scored, x -> {probability} >= {bound}), x -> named_struct('s', x.c.s, 'k', x.c.k, 'e', x.c.e))")
    found = found.withColumn("_added", added)
    return fenced(
        found,
        F.col("_key").alias(key),
        F.col("_base").alias("base_spans"),
        F.expr("array_sort(array_distinct(concat(_base, _added)))").alias("spans"),
        *(["document"] if keep_rows else []),
    )


def span_list(spans: str) -> Column:
    """``kind:start:end``, comma-joined, of an array of spans."""
    names = ", ".join(f"'{k.name}'" for k in (*BASE, *GENERATORS))
    return F.expr(f"array_join(transform({spans}, c -> concat(element_at(array({names}), c.k + 1), ':', c.s, ':', c.e)), ',')")


def kind_count(spans: str, kind: str) -> Column:
    number = [k.name for k in (*BASE, *GENERATORS)].index(kind)
    return F.expr(f"size(filter({spans}, c -> c.k = {number}))").cast("long")


def with_redacted(df: DataFrame, text: str, spans: str, out: str) -> DataFrame:
    """Adds ``out``: the text with every run of overlapping spans replaced by the kind of its first in angle brackets."""
    names = ", ".join(f"'<{k.name.upper()}>'" for k in (*BASE, *GENERATORS))
    df = df.withColumn("_ends", F.expr(f"transform({spans}, c -> c.e)"))
    for name, sql in _running("_ends", "_reached", "greatest(s, y)").items():
        df = df.withColumn(name, F.expr(sql))
    reached = "coalesce(get(_reached, i - 1), 0L)"
    between = f"if(c.s > {reached}, substring({text}, int({reached}) + 1, int(c.s - {reached})), '')"
    mark = f"if(c.s >= {reached}, element_at(array({names}), c.k + 1), '')"
    pieces = f"array_join(transform({spans}, (c, i) -> concat({between}, {mark})), '')"
    rest = f"substring({text}, int(element_at(_reached, -1)) + 1)"
    df = df.withColumn(out, F.expr(f"if(size({spans}) = 0, {text}, concat({pieces}, {rest}))"))
    return df.drop("_ends", "_reached", "_reached_b", "_reached_o")


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with personal data in ``text`` replaced; a null text stays null; other columns are as they were."""
    found = find(docs, key, text, train(docs, key, text), keep_rows=True).select("spans", "document").withColumn("_body", F.col(f"document.`{text}`"))
    changed = with_redacted(found, "_body", "spans", "_redacted")
    return changed.select(*[F.col("_redacted").alias(c) if c == text else F.col(f"document.`{c}`").alias(c) for c in docs.columns])
