"""URL and title column functions.

All checks are Spark expressions.  Two operations follow the Python URL
library exactly and have a vectorised pandas UDF for the general case:
``urljoin`` (U5) and ``quote`` (U4).  U5 has a JVM fast path for the common
root-relative href, taken by splitting the table (a Python UDF inside a CASE
would still be evaluated for every row).
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkweave.functions.fixed import DEFAULT_MARKER, EXCLUDED_NAMESPACES, MAIN_PAGE_TITLE

# RFC 3986 appendix B split: scheme, authority, path, query, fragment.
_URL_RE = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"
_TRIM_RE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_scheme(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), _URL_RE, 2)


def url_netloc(url: Column | str) -> Column:
    """Authority part, user info and port kept; '' when absent."""
    return F.regexp_extract(_col(url), _URL_RE, 4)


def url_path(url: Column | str) -> Column:
    """Path without ``;params`` of its last segment (as ``urlparse`` splits them)."""
    return F.regexp_replace(F.regexp_extract(_col(url), _URL_RE, 5), r";[^/]*$", "")


def url_query(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), _URL_RE, 7)


def url_fragment(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), _URL_RE, 9)


def url_root(url: Column | str) -> Column:
    """``scheme://netloc`` of a URL (U4/U5 drop any path of the base)."""
    return F.concat(url_scheme(url), F.lit("://"), url_netloc(url))


def article_name(path: Column | str, marker: str = DEFAULT_MARKER) -> Column:
    """Text after the last ``marker`` (found case-insensitively, original
    case kept); null when the marker is absent."""
    p = _col(path)
    pattern = "(?is)^.*" + re.escape(marker) + "(.*)$"
    return F.when(F.instr(F.lower(p), marker.lower()) > 0, F.regexp_extract(p, pattern, 1))


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: Unicode white space at both ends."""
    return F.regexp_replace(_col(c), _TRIM_RE, "")


def is_valid_title(title: Column | str) -> Column:
    """Not empty or blank, not the main page, and no excluded namespace
    before the first ':' (other namespaces pass)."""
    t = _col(title)
    s = strip_ws(t)
    ns = F.lower(strip_ws(F.substring_index(s, ":", 1)))
    return F.coalesce(
        (t != F.lit(""))
        & (s != F.lit(""))
        & (F.lower(F.replace(s, F.lit(" "), F.lit("_"))) != F.lit(MAIN_PAGE_TITLE))
        & ~((F.instr(s, ":") > 0) & ns.isin(list(EXCLUDED_NAMESPACES))),
        F.lit(False),
    )


def decode_title(name: Column | str) -> Column:
    """Percent-decode (UTF-8, '+' kept), then '_' -> ' '.

    Uses the JVM decoder with '+' protected.  A '%' that starts no escape stays as
    it is, and the well-formed escapes beside it are decoded."""
    n = _col(name)
    escaped = F.regexp_replace(n, "%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.when(
        F.instr(n, "%") > 0,
        F.coalesce(F.try_url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B"))), n),
    ).otherwise(n)
    return F.replace(decoded, F.lit("_"), F.lit(" "))


def is_valid_article_url(url: Column | str, base_url: Column | str, marker: str = DEFAULT_MARKER) -> Column:
    """U3 (``base_url`` is a literal URL or a Column): same authority as the base, no query, no fragment, a non-empty
    article name whose decoded title passes U2.  The scheme is not compared."""
    u = _col(url)
    b = F.lit(base_url) if isinstance(base_url, str) else base_url
    name = article_name(url_path(u), marker)
    return F.coalesce(
        (url_netloc(u) == url_netloc(b))
        & (url_query(u) == F.lit(""))
        & (url_fragment(u) == F.lit(""))
        & name.isNotNull()
        & (name != F.lit(""))
        & is_valid_title(decode_title(name)),
        F.lit(False),
    )


def clean_label(label: Column | str, base_url: str | Column, marker: str = DEFAULT_MARKER) -> Column:
    """Remove every '"', then every occurrence of ``base`` + ``marker``
    (literal, not a pattern; trailing '/' of the base dropped first).
    ``base_url`` is a literal URL or a Column (e.g. each label's own site)."""
    if isinstance(base_url, str):
        prefix = F.lit(base_url.rstrip("/") + marker)
    else:
        prefix = F.concat(F.regexp_replace(base_url, "/+$", ""), F.lit(marker))
    no_quotes = F.replace(_col(label), F.lit('"'), F.lit(""))
    return F.replace(no_quotes, prefix, F.lit(""))


# -- Python URL library, vectorised -----------------------------------------

# An href that urljoin puts behind the base's root as it is: segments that are neither empty nor dots, and no query, fragment,
# parameters, white space or control characters.
_ROOTED = re.compile(r"(?:/(?!\.{1,2}(?:/|\Z))[^/?#;\s\x00-\x20\x7f]+)+")


@lru_cache(maxsize=1024)
def _joined_root(base: str) -> str | None:
    """What urljoin puts before a rooted path; null unless ``base`` is an http(s) URL."""
    from urllib.parse import urljoin

    return urljoin(base, "/x")[:-2] if re.match(r"https?://[^/?#\s]", base) else None


def join_url(base: str | None, href: str | None) -> str | None:
    """U5 for one href; null when it cannot be parsed (say, an unclosed IPv6 host)."""
    from urllib.parse import urljoin

    if base is None or href is None:
        return None
    try:
        root = _joined_root(base)
        return root + href if root and _ROOTED.fullmatch(href) else urljoin(base, href)
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def _urljoin_udf(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([join_url(b, h) for b, h in zip(base, href)], dtype=object)


@F.pandas_udf(T.StringType())
def _build_url_udf(root: pd.Series, title: pd.Series) -> pd.Series:
    from urllib.parse import quote

    return pd.Series(
        [None if t is None else f"{r}/wiki/{quote(t.replace(' ', '_'), safe=':()/_-.,' + chr(39) + '%')}"
         for r, t in zip(root, title)]
    )


def build_article_url(base_root: Column | str, title: Column | str) -> Column:
    """U4: ``scheme://netloc`` + ``/wiki/`` + title (space -> '_') quoted,
    keeping ``:()/_-.,'%`` (pandas UDF over ``urllib.parse.quote``)."""
    return _build_url_udf(_col(base_root), _col(title))


# An href that joins to ``root + href`` exactly: starts with one '/', no dot
# segments, no white space or control characters (which urljoin would strip).
_SIMPLE_ROOTED = r"^(?!.*/\.\.?(/|$|[?#]))/(?!/)[^\s\x00-\x1f\x7f]*$"


def resolve_links(df: DataFrame, base_col: str, href_col: str, out_col: str = "target") -> DataFrame:
    """U5 on a table: ``out_col`` = urljoin(base, href).

    Root-relative hrefs (the bulk) are joined in the JVM; the rest go through
    the Python library in a pandas UDF.  Both halves are unioned back."""
    simple = F.coalesce(_col(href_col).rlike(_SIMPLE_ROOTED), F.lit(False))
    fast = df.filter(simple).withColumn(out_col, F.concat(url_root(base_col), _col(href_col)))
    slow = df.filter(~simple).withColumn(out_col, _urljoin_udf(_col(base_col), _col(href_col)))
    return fast.unionByName(slow)


# -- staged forms for tables --------------------------------------------------
# The Column functions above nest: U3 holds U6, which holds U1, which holds the
# URL split, and U2 refers to its input three times.  Over a table, the staged
# forms below compute each part once as its own column (the optimizer keeps
# them apart because each is read more than once), which keeps generated code
# small and evaluates every regular expression once per row.  The verdict comes
# out of a generator: a filter on a plain column would be pushed below the
# stages, with every one written out in its condition, dozens of times over.


def with_title_validity(df: DataFrame, title_col: str, out_col: str = "valid") -> DataFrame:
    """U2 as a column ``out_col`` of ``df``."""
    t = F.col(title_col)
    staged = df.withColumn("_ts", strip_ws(t))
    s = F.col("_ts")
    staged = staged.withColumn("_tns", F.when(F.instr(s, ":") > 0, F.lower(strip_ws(F.substring_index(s, ":", 1)))))
    valid = F.coalesce(
        (t != F.lit(""))
        & (s != F.lit(""))
        & (F.lower(F.replace(s, F.lit(" "), F.lit("_"))) != F.lit(MAIN_PAGE_TITLE))
        & ~F.coalesce(F.col("_tns").isin(list(EXCLUDED_NAMESPACES)), F.lit(False)),
        F.lit(False),
    )
    return _with_verdict(staged, out_col, valid).drop("_ts", "_tns")


def _with_verdict(df: DataFrame, out_col: str, verdict: Column) -> DataFrame:
    """``out_col`` = ``verdict``, made where it is and not where a filter on it could go."""
    kept = [c for c in df.columns if c != out_col]
    return df.select(*kept, F.explode_outer(F.array(verdict)).alias(out_col))


def with_url_validity(
    df: DataFrame, url_col: str, base: str | Column, marker: str = DEFAULT_MARKER, out_col: str = "valid"
) -> DataFrame:
    """U3 as a column ``out_col`` of ``df``; ``base`` is a literal URL or a Column."""
    b = F.lit(base) if isinstance(base, str) else base
    u = F.col(url_col)
    staged = (
        df.withColumn("_net", url_netloc(u))
        .withColumn("_path", url_path(u))
        .withColumn("_qf", (url_query(u) != F.lit("")) | (url_fragment(u) != F.lit("")))
        .withColumn("_name", article_name(F.col("_path"), marker))
        .withColumn("_title", decode_title(F.col("_name")))
    )
    staged = with_title_validity(staged, "_title", "_tvalid")
    ok = F.coalesce(
        (F.col("_net") == url_netloc(b))
        & ~F.col("_qf")
        & F.col("_name").isNotNull()
        & (F.col("_name") != F.lit(""))
        & F.col("_tvalid"),
        F.lit(False),
    )
    return _with_verdict(staged, out_col, ok).drop("_net", "_path", "_qf", "_name", "_title", "_tvalid")
