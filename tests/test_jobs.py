import glob
import json
import os
import tempfile

from linkweave.plans.jobs import NetworkConfig, build_networks, clean_link_labels, communities_job, community_summary, popped_urls


def _read_csv_dir(path):
    rows = []
    for f in sorted(glob.glob(f"{path}/part-*.csv")):
        lines = open(f, encoding="utf-8", newline="").read().split("\r\n")
        rows += [line for line in lines[1:] if line]
    return rows


def test_build_networks_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="lw-j1-", dir="/tmp")
    text = "<p>Pain relief and dose risk. Pain relief with dose control and risk review.</p>"
    pages = spark.createDataFrame(
        [
            ("https://w.test/wiki/A", text + '<a href="/wiki/B">b</a><a href="/wiki/C">c</a><a href="/wiki/Help:X">h</a>'),
            ("https://w.test/wiki/B", text + '<a href="/wiki/C">c</a><a href="/wiki/A">a</a>'),
            ("https://w.test/wiki/D", text + '<a href="/wiki/A">a</a>'),
        ],
        "url string, html string",
    )
    body = json.dumps({"parse": {"text": text, "links": [{"*": "A"}, {"*": "D"}, {"*": "Special:Search"}]}})
    payloads = spark.createDataFrame(
        [("https://w.test/wiki/C", 1, 200, "application/json", body)],
        "url string, endpoint_rank int, status int, content_type string, body string",
    )
    cfg = NetworkConfig(min_link_freq=1, enable_word_pruning=False)
    counts = build_networks(pages, payloads, d, "https://w.test/wiki/A", "https://w.test", cfg)
    assert counts["visited"] == 4
    visited = open(glob.glob(f"{d}/visited/part-*")[0]).read().split()
    assert visited == sorted(f"https://w.test/wiki/{x}" for x in "ABCD")
    assert len(_read_csv_dir(f"{d}/links/nodes")) == 4
    # A->B, A->C (HTML); B->C, B->A (HTML); C->A, C->D (API); D->A (HTML)
    assert len(_read_csv_dir(f"{d}/links/edges")) == 7
    assert len(_read_csv_dir(f"{d}/words/nodes")) > 0
    res = communities_job(spark, f"{d}/words/nodes", f"{d}/words/edges")
    assert "modularity" in res and res["communities"] >= 1
    clean_link_labels(spark, f"{d}/links/nodes", f"{d}/links/clean", "https://w.test")
    labels = {line.split(",")[1] for line in _read_csv_dir(f"{d}/links/clean")}
    assert labels == {"A", "B", "C", "D"}


def test_community_summary(spark):
    d = tempfile.mkdtemp(prefix="lw-j3-", dir="/tmp")
    p = f"{d}/m.csv"
    open(p, "w").write("Id,Label,degree,modularity_class\n1,alpha,5,0\n2,beta,3,0\n3,gamma,7,1\n")
    rows = community_summary(spark, p, top_n=2).collect()
    assert [(r["rank"], r.modularity_class, r.Label) for r in rows] == [(1, "0", "alpha"), (1, "0", "beta"), (2, "1", "gamma")]


def test_build_networks_with_no_content_still_exports(spark):
    d = tempfile.mkdtemp(prefix="lw-j1e-", dir="/tmp")
    pages = spark.createDataFrame([("https://w.test/wiki/Other", "<p>x</p>")], "url string, html string")
    counts = build_networks(pages, None, d, "https://w.test/wiki/Missing", "https://w.test")
    assert counts == {"visited": 0, "word_nodes": 0, "bigram_nodes": 0, "link_nodes": 0, "unprocessed_hosts": 1}
    assert open(glob.glob(f"{d}/unprocessed_hosts/part-*.txt")[0]).read() == "w.test\n"
    for sub in ("words/nodes", "words/edges", "links/nodes", "links/edges"):
        assert glob.glob(f"{d}/{sub}/_SUCCESS")


def test_last_row_of_a_repeated_edge_counts_over_files_of_any_size(spark):
    d = tempfile.mkdtemp(prefix="lw-j2-", dir="/tmp")
    os.makedirs(f"{d}/n"), os.makedirs(f"{d}/e")
    with open(f"{d}/n/part-0.csv", "w") as f:
        f.write("Id,Label,Group,Attribute\n" + "".join(f"{i},n{i},link,0\n" for i in range(1, 5)))
    head = "Source,Target,Type,Weight\n"
    # The later file is the smaller one, so that reading by size would meet it last.
    for name, weights in (("part-0.csv", range(40, 0, -1)), ("part-1.csv", (7, 3))):
        with open(f"{d}/e/{name}", "w") as f:
            f.write(head + "".join(f"1,2,Undirected,{w}\n" for w in weights))
    with open(f"{d}/e/part-2.csv", "w") as f:
        f.write(head + "2,1,Undirected,5\n3,4,Undirected,15\n" + "3,4,Undirected,5\n" * 3)
    got = communities_job(spark, f"{d}/n", f"{d}/e")
    # Two edges of weight 5, each a community: 1 - 2 * (1/2)^2.
    assert got["communities"] == 2 and abs(got["modularity"] - 0.5) < 1e-9


def test_urls_taken_up_stop_after_the_last_visited_page(spark):
    links = spark.createDataFrame(
        [("s", "a"), ("s", "gone1"), ("s", "m"), ("s", "z"), ("a", "gone0"), ("a", "n"), ("n", "s")], "source string, target string"
    )

    def told(pages, depth, cap):
        visited = spark.createDataFrame(pages, "url string, depth int, ord long")
        return sorted(r.url for r in popped_urls(links, visited, "s", depth, cap).distinct().collect())

    # Queue: s, then its links a, gone1, m, z, then a's links gone0, n, then n's.
    assert told([("s", 0, 0)], 9, 1) == ["s"]
    assert told([("s", 0, 0), ("a", 1, 1)], 9, 2) == ["a", "s"]
    assert told([("s", 0, 0), ("a", 1, 1), ("m", 1, 2)], 9, 3) == ["a", "gone1", "m", "s"]
    every = [("s", 0, 0), ("a", 1, 1), ("m", 1, 2), ("z", 1, 3), ("n", 2, 4)]
    assert told(every[:4], 1, 99) == ["a", "gone1", "m", "s", "z"]
    assert told(every, None, None) == ["a", "gone0", "gone1", "m", "n", "s", "z"]
    assert told([], 9, 9) == ["s"]


def test_communities_read_their_edges_once(spark, tmp_path, monkeypatch):
    """J2 aggregates the file's edges once; communities, score and sizes read what it wrote."""
    from pyspark.sql import functions as F

    from linkweave.plans import jobs

    nodes = spark.createDataFrame([(k, f"w{k}", "Word", 1) for k in range(1, 7)], "Id long, Label string, Group string, Attribute long")
    pairs = [(1, 2), (2, 3), (1, 3), (4, 5), (5, 6), (4, 6), (3, 4)]
    edges = spark.createDataFrame([(a, b, "Undirected", 1) for a, b in pairs], "Source long, Target long, Type string, Weight long")
    nodes.write.parquet(f"{tmp_path}/nodes")
    edges.write.parquet(f"{tmp_path}/edges")
    read = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda w: read.add(1) or w, "bigint")
    found = spark.read.parquet(f"{tmp_path}/edges").withColumn("Weight", counted("Weight"))
    monkeypatch.setattr(jobs, "read_graph", lambda *_: (spark.read.parquet(f"{tmp_path}/nodes"), found))
    result = jobs.communities_job(spark, "", "")
    assert result["communities"] == 2 and abs(result["modularity"] - 5 / 14) < 1e-9
    assert read.value == len(pairs)
