"""Registered Spark queries for API payloads.

The driver has no API responses, so a payload table is derived from ``pages``
by fixed rules: endpoint 1 answers every page with the parse result, except a
page whose url carries a fragment, which gets an error object; endpoint 2
answers with the parse result, except on ``blog.`` hosts, where it returns a
404 HTML page.  The parse result holds the page html as text and one link item
``{"*": title}`` per anchor (title = the href's last segment, '_' as space).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.functions.urls import url_netloc
from linkweave.operators.html import regex_hrefs
from linkweave.operators.links import api_links
from linkweave.sources.api import accept_api_payloads, resolve_content
from linkweave.sources.tables import read_table


def payload_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["url", "html"], spread_rows=True)
    titles = F.transform(regex_hrefs("html"), lambda h: F.replace(F.regexp_extract(h, r"([^/]*)$", 1), F.lit("_"), F.lit(" ")))
    ok_body = F.to_json(
        F.struct(
            F.struct(
                F.col("url").alias("title"),
                F.col("html").alias("text"),
                F.transform(titles, lambda t: F.create_map(F.lit("*"), t)).alias("links"),
            ).alias("parse")
        )
    )
    err_body = F.to_json(F.struct(F.struct(F.lit("missingtitle").alias("code")).alias("error")))
    blog = url_netloc("url").startswith("blog.")
    first = pages.select(
        "url",
        F.lit(1).alias("endpoint_rank"),
        F.lit(200).alias("status"),
        F.lit("application/json; charset=utf-8").alias("content_type"),
        F.when(F.col("url").contains("#"), err_body).otherwise(ok_body).alias("body"),
    )
    second = pages.select(
        "url",
        F.lit(2).alias("endpoint_rank"),
        F.when(blog, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.when(blog, F.lit("text/html")).otherwise(F.lit("application/json")).alias("content_type"),
        F.when(blog, F.lit("<html><body>not found</body></html>")).otherwise(ok_body).alias("body"),
    )
    return first.unionByName(second)


def q_api_accepted(spark, sf_dir):
    return accept_api_payloads(payload_table(spark, sf_dir)).select("url", "endpoint_rank", "html")


def q_api_links(spark, sf_dir):
    return api_links(accept_api_payloads(payload_table(spark, sf_dir)), base_url=None, marker="/wiki/")


def _resolved(spark, sf_dir, mode):
    api = accept_api_payloads(payload_table(spark, sf_dir))
    html = read_table(spark, sf_dir, "pages", ["url", "html"])
    return resolve_content(api, html, mode)


def q_resolved_content(spark, sf_dir):
    return _resolved(spark, sf_dir, "auto").select("url", "via")


def q_resolved_api(spark, sf_dir):
    """S3, API answers only."""
    return _resolved(spark, sf_dir, " API ")


def q_resolved_html(spark, sf_dir):
    """S3, fetched pages only."""
    return _resolved(spark, sf_dir, "html")


QUERIES = {
    "api_accepted": q_api_accepted,
    "api_links": q_api_links,
    "resolved_content": q_resolved_content,
    "resolved_api": q_resolved_api,
    "resolved_html": q_resolved_html,
}
