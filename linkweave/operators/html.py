"""HTML extraction H1 (paragraph text) and H2 (anchor hrefs) over a page table.

Parsing is the one step Spark has no built-in for.  It runs as one Python UDF
(one pass yields text and hrefs, a bounded number of pages at a time) with the
standard library's ``html.parser`` and a small tree-builder state:

* a stack of open tags; void tags never stay open; an end tag closes
  everything opened after its most recent match and is ignored without one;
* every piece of text (entities decoded) goes to each open ``<p>``, so an
  unclosed ``<p>`` nests and its inner text repeats once per open ancestor;
* CDATA sections are text; comment, declaration, script, style, template and ruby-note text is left out;
* a marked section of an unknown kind ends at its ``>`` like a comment, and the page goes on after it;
* each ``<a>`` with an ``href`` attribute (empty value included, the last
  duplicate wins) yields that value.

A ``<p>``'s text is the slice of the document's text stream between its start
and its end, so the cost is linear in the page size.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# Text inside these is not plain text (scripts, styles, templates, ruby notes).
SKIP_TEXT_TAGS = frozenset(("script", "style", "template", "rt", "rp"))

EXTRACTED = T.StructType([T.StructField("text", T.StringType()), T.StructField("hrefs", T.ArrayType(T.StringType()))])
RESOLVED = T.StructType([*EXTRACTED.fields, T.StructField("targets", T.ArrayType(T.StringType()))])


class _PageParser(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[list] = []  # [tag, p_index or -1]
        self.chunks: list[str] = []
        self.size = 0
        self.p_spans: list[list[int]] = []  # [start, end]
        self.hrefs: list[str] = []
        self.skip = 0

    def _open(self, tag: str) -> None:
        idx = -1
        if tag == "p":
            idx = len(self.p_spans)
            self.p_spans.append([self.size, -1])
        if tag in SKIP_TEXT_TAGS:
            self.skip += 1
        self.stack.append([tag, idx])

    def _close(self, tag: str) -> None:
        for pos in range(len(self.stack) - 1, -1, -1):
            if self.stack[pos][0] == tag:
                for t, idx in self.stack[pos:]:
                    if idx >= 0:
                        self.p_spans[idx][1] = self.size
                    if t in SKIP_TEXT_TAGS:
                        self.skip -= 1
                del self.stack[pos:]
                return

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            href = None
            for key, value in attrs:
                if key == "href":
                    href = "" if value is None else value
            if href is not None:
                self.hrefs.append(href)
        if tag not in VOID_TAGS:
            self._open(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close(tag)

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        if not self.skip and data:
            self.chunks.append(data)
            self.size += len(data)

    def unknown_decl(self, data):
        if data[:6].upper() == "CDATA[":
            self.handle_data(data[6:])

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def result(self) -> tuple[str, list[str]]:
        stream = "".join(self.chunks)
        texts = [stream[s : (e if e >= 0 else self.size)] for s, e in self.p_spans]
        return " ".join(texts), self.hrefs


def parse_page(html: str | None) -> tuple[str, list[str]]:
    """Paragraph text and hrefs of one page (the per-row helper)."""
    if not html:
        return "", []
    parser = _PageParser()
    parser.feed(html)
    parser.close()
    return parser.result()


# Pickled UDFs get a hundred pages at a time; an Arrow batch would hold ten thousand, whatever their size.
@F.udf(EXTRACTED, useArrow=False)
def _extracted(html: str | None) -> tuple[str, list[str]]:
    return parse_page(html)


@F.udf(RESOLVED, useArrow=False)
def _resolved(html: str | None, base: str | None) -> tuple[str, list[str], list[str | None]]:
    from linkweave.functions.urls import join_url

    text, hrefs = parse_page(html)
    # RFC join against the site base (not the page URL).
    return text, hrefs, [join_url(base, x) for x in hrefs]


# Nondeterministic only so that no optimizer rule copies the parse into several columns.
_extracted, _resolved = _extracted.asNondeterministic(), _resolved.asNondeterministic()


def extract_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html", base=None) -> DataFrame:
    """H1 + H2 in one pass: ``(url, text, hrefs)``.

    With ``base`` (a Column: the site base of each page), hrefs are also
    resolved (U5) in the same pass and returned as ``targets``."""
    html = F.col(html_col)
    parsed = _extracted(html) if base is None else _resolved(html, base)
    return pages.select(F.col(url_col).alias("url"), parsed.alias("_page")).select("url", "_page.*")


def paragraph_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """H1: ``(url, text)``, the text of every ``<p>`` joined by one space."""
    return extract_pages(pages, url_col, html_col).select("url", "text")


def regex_hrefs(html_col: str = "html"):
    """Fast path for clean markup: double-quoted ``href`` values of ``<a>``
    tags, entities not decoded.  Exact only when the markup is that simple."""
    return F.regexp_extract_all(F.col(html_col), F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1))
