"""The registered queries against their DuckDB SQL on rows with nulls, blanks, ties, repeats and copies."""

import tempfile

import duckdb
import pytest

from linkweave.llm import queries
from linkweave.llm.licenses import TEMPLATES
from linkweave.llm.oracles import SQL

BASE = " ".join(f"w{i}" for i in range(120))
TEXTS = [
    None,
    "",
    " \t\n\x0b",
    "two words",
    "TWO Words",
    BASE,
    BASE.upper(),
    BASE + " tail",
    "head " + BASE + " tail",
    " ".join(BASE.split()[::-1]),
    "the cat sat on the mat and " * 30,
    "\n".join(["the same line of the text"] * 40 + ["", " ", "another line"]),
    "# $ % & | < > * " * 20 + BASE,
    "the of and " + BASE + " naïve 漢字   𝒳 the the the",
    BASE + ". " + TEMPLATES["mit-header"].upper() + " " + BASE,
    TEMPLATES["gpl-3.0"] + " " + TEMPLATES["apache-2.0-header"],
    " ".join(TEMPLATES["bsd"].split()[:-2]) + " " + " ".join(TEMPLATES["isc"].split()[:8]),
]


@pytest.fixture(scope="module")
def folder(spark):
    rows = [(i, t, "en", None, -1) for i, t in enumerate(TEXTS)] + [(5, BASE, None, "s", None), (40, BASE, "en", "s", 1), (40, None, "en", "s", 1)]
    path = tempfile.mkdtemp(prefix="lw-oracle-", dir="/tmp")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long").coalesce(1).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    told = con.execute(SQL[name])
    columns = [c[0] for c in told.description]
    want = told.fetchall()
    got = queries.queries()[name](spark, folder).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
