import glob
import os
import tempfile

import pytest

from linkweave.sources.api import accept_api_payloads, resolve_content
from linkweave.sources.readers import read_graph, read_metrics
from linkweave.sources.writers import write_graph, write_visited


def _tmp():
    return tempfile.mkdtemp(prefix="lw-test-", dir="/tmp")


def test_graph_csv_round_trip_with_quotes(spark):
    d = _tmp()
    nodes = spark.createDataFrame([(1, 'a"b,c', "word", 3), (2, "beta", "word", 2)], "Id long, Label string, Group string, Attribute long")
    edges = spark.createDataFrame([(1, 2, "Undirected", 4)], "Source long, Target long, Type string, Weight long")
    write_graph(nodes, edges, f"{d}/n", f"{d}/e", single_file=True)
    text = open(glob.glob(f"{d}/n/part-*.csv")[0], newline="", encoding="utf-8").read()
    assert text.startswith("Id,Label,Group,Attribute\r\n") and '"a""b,c"' in text
    n2, e2 = read_graph(spark, f"{d}/n", f"{d}/e")
    assert {r.Label for r in n2.collect()} == {'a"b,c', "beta"}
    assert e2.count() == 1


def test_visited_list_one_url_per_line(spark):
    d = _tmp()
    v = spark.createDataFrame([("https://example.org/b",), ("https://example.org/a",)], "url string")
    write_visited(v, f"{d}/v", single_file=True)
    lines = open(glob.glob(f"{d}/v/part-*")[0], encoding="utf-8").read().splitlines()
    assert lines == ["https://example.org/a", "https://example.org/b"]


def test_metrics_errors(spark):
    d = _tmp()
    with pytest.raises(ValueError, match="not found"):
        read_metrics(spark, f"{d}/missing.csv")
    p = f"{d}/cols.csv"
    open(p, "w").write("Id,Label\n1,a\n")
    with pytest.raises(ValueError, match="columns"):
        read_metrics(spark, p)
    p2 = f"{d}/empty.csv"
    open(p2, "w").write("Id,Label,degree,modularity_class\n")
    with pytest.raises(ValueError):
        read_metrics(spark, p2)
    p3 = f"{d}/ok.csv"
    open(p3, "w").write("Id,Label,degree,modularity_class\n1,alpha,5,0\n")
    assert read_metrics(spark, p3).count() == 1
    p4 = f"{d}/wide.csv"
    open(p4, "w").write("Id,Label,degree,modularity_class\n1,alpha,5,0\n2,beta,5,0,9\n")
    with pytest.raises(ValueError, match="more fields"):
        read_metrics(spark, p4)


def test_metrics_labels_and_fractions(spark):
    p = f"{_tmp()}/m.csv"
    open(p, "w").write('modularity_class,Id,note,Label,degree\nred,1,x,"a,""b",5.5\n,2,,c,none\nblue,3\n')
    got = read_metrics(spark, p).collect()
    assert [(r.Id, r.Label, r.degree, r.modularity_class, r.note) for r in got] == [
        (1, 'a,"b', 5.5, "red", "x"), (2, "c", None, None, None), (3, None, None, "blue", None)
    ]


def test_api_acceptance_and_resolution(spark):
    ok = '{"parse": {"text": "<p>x</p>", "links": [{"*": "A"}, {"*": 5}, "s"]}}'
    rows = [
        ("api", 1, 200, "application/json", ok),
        ("err", 1, 200, "application/json", '{"error": null}'),
        ("err", 2, 200, "text/html", ok),
        ("empty", 1, 200, "Application/JSON", '{"parse": {"links": []}}'),
        ("second", 1, 500, "application/json", ok),
        ("second", 2, 200, "application/json", ok),
    ]
    p = spark.createDataFrame(rows, "url string, endpoint_rank int, status int, content_type string, body string")
    acc = {r.url: r for r in accept_api_payloads(p).collect()}
    assert set(acc) == {"api", "empty", "second"}
    assert acc["api"].html == "<p>x</p>" and list(acc["api"].link_titles) == ["A"]
    assert acc["empty"].html == "" and acc["second"].endpoint_rank == 2
    html = spark.createDataFrame([("err", "<p>h</p>"), ("empty", "<p>h</p>")], "url string, html string")
    via = {r.url: r.via for r in resolve_content(accept_api_payloads(p), html, " AUTO ").collect()}
    assert via == {"api": "api", "empty": "api", "second": "api", "err": "html"}
    assert {r.url for r in resolve_content(accept_api_payloads(p), html, "html").collect()} == {"err", "empty"}
