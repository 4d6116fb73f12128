"""S1 page corpus, S4 graph CSVs, S5 metrics CSV."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE_SCHEMA = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("Label", T.StringType()),
        T.StructField("Group", T.StringType()),
        T.StructField("Attribute", T.LongType()),
    ]
)
EDGE_SCHEMA = T.StructType(
    [
        T.StructField("Source", T.LongType()),
        T.StructField("Target", T.LongType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Weight", T.DoubleType()),
    ]
)
METRICS_REQUIRED = ("modularity_class", "degree", "Id", "Label")


def usable_pages(pages: DataFrame, content_type_col: str | None = None, status_col: str | None = None) -> DataFrame:
    """Pages whose response was OK (status below 400) and whose content
    type contains ``html`` (case-sensitive), when those columns exist."""
    out = pages
    if status_col and status_col in pages.columns:
        out = out.filter(F.col(status_col) < 400)
    if content_type_col and content_type_col in pages.columns:
        out = out.filter(F.coalesce(F.col(content_type_col).contains("html"), F.lit(False)))
    return out


def read_pages(spark: SparkSession, path: str, content_type_col: str | None = None, status_col: str | None = None) -> DataFrame:
    """S1 over a parquet page table ``(url, html[, status, content_type])``."""
    return usable_pages(spark.read.parquet(path), content_type_col, status_col)


def _csv(spark: SparkSession, schema: T.StructType | None = None):
    """Header, ``"`` doubled inside quotes.  No label holds a line break, so files stay splittable."""
    r = spark.read.option("header", True).option("escape", '"')
    return r.schema(schema) if schema is not None else r


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """S4, the node file alone with whatever columns it has, all strings."""
    return _csv(spark).csv(path)


def read_graph(spark: SparkSession, nodes_path: str, edges_path: str) -> tuple[DataFrame, DataFrame]:
    """Node and edge CSVs."""
    return _csv(spark, NODE_SCHEMA).csv(nodes_path), _csv(spark, EDGE_SCHEMA).csv(edges_path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A metrics CSV with at least ``modularity_class, degree, Id, Label``.

    The class is a label (string), the degree a double, the id a long; what is no number is null; other columns are strings.  A row
    with fewer fields than the header has nulls.  A missing or empty file, missing columns, a row with more fields than the
    header or zero rows end with a ``ValueError`` naming the problem.  Rows are checked in one parallel pass."""
    try:
        names = _csv(spark).csv(path).columns
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(f"metrics file not found: {path}") from exc
        raise ValueError(f"metrics file is empty or malformed: {path}: {exc}") from exc
    missing = [c for c in METRICS_REQUIRED if c not in names]
    if missing:
        raise ValueError(f"metrics file must hold the columns {sorted(METRICS_REQUIRED)}; missing {missing}")
    # One column more than the header: what it catches is a field too many.
    wide = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_more"]])
    rows = _csv(spark, wide).option("enforceSchema", True).csv(path)
    n, bad = rows.agg(F.count(F.lit(1)), F.count("_more")).first()
    if bad:
        raise ValueError(f"metrics file is malformed: {path}: {bad} rows have more fields than the header")
    if not n:
        raise ValueError(f"metrics file holds no nodes: {path}")
    return rows.select(
        F.col("Id").try_cast("long").alias("Id"),
        "Label",
        F.col("degree").try_cast("double").alias("degree"),
        "modularity_class",
        *[f"`{c}`" for c in names if c not in METRICS_REQUIRED],
    )
