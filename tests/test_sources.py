import json
import os

import pytest

from wordtrawl.plans import build, search
from wordtrawl.sources import crawl
from wordtrawl.sources.result_pages import result_pages, write_result_pages

PAGES = {
    "a.example/p1": ("http://a.example/1", "<p>Alpha beta</p><p>gamma</p>"),
    "a.example/p2": ("http://a.example/1#again", "<p>other words entirely</p>"),
    "b.example/p3": ("http://b.example/2", "<p>Alpha beta</p><p>gamma</p>"),
    "b.example/p4": ("http://b.example/3", "<html>alpha\nalpha  delta, the end</html>"),
}


@pytest.fixture
def tree(tmp_path):
    for name, (url, content) in PAGES.items():
        path = tmp_path / "crawl" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps({"url": url, "content": content, "encoding": "utf-8"}, indent=1))
    return str(tmp_path / "crawl")


def test_read_pages(spark, tree):
    rows = crawl.read_pages(spark, tree).orderBy("seq").collect()
    assert [(r.url, r.content) for r in rows] == list(PAGES.values())
    assert [r.subdomain for r in rows] == ["a.example", "a.example", "b.example", "b.example"]
    assert all(r.disk_loc == r.seq and r.seq.endswith(name) for r, name in zip(rows, PAGES))


def test_missing_or_broken_input_is_an_error(spark, tree, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        crawl.read_pages(spark, str(tmp_path / "nowhere"))
    with open(os.path.join(tree, "a.example", "p9"), "w") as f:
        f.write("{not json")
    with pytest.raises(Exception):
        crawl.read_pages(spark, tree).collect()


def test_snapshot_keeps_the_last_content_and_is_reused(spark, tmp_path):
    schema = "seq bigint, url string, content string"
    path = str(tmp_path / "snapshot")
    first = crawl.snapshot_pages(spark.createDataFrame([(0, "u", "old"), (2, "u", "new"), (1, "v", "x")], schema), path)
    assert {(r.url, r.content, r.seq) for r in first.collect()} == {("u", "new", 0), ("v", "x", 1)}
    again = crawl.snapshot_pages(spark.createDataFrame([(0, "w", "y")], schema), path)
    assert {r.url for r in again.collect()} == {"u", "v"}


def test_interrupted_snapshot_is_written_again(spark, tmp_path):
    schema = "seq bigint, url string, content string"
    path = tmp_path / "snapshot"
    path.mkdir()
    again = crawl.snapshot_pages(spark.createDataFrame([(0, "w", "y")], schema), str(path))
    assert [r.url for r in again.collect()] == ["w"]


def test_crawl_to_result_files(spark, tree, tmp_path):
    """From JSON files to highlighted HTML: page 2 repeats a URL, page 3 a text."""
    pages = crawl.read_pages(spark, tree)
    index = build.build_index(build.tokenize_pages(pages, sep=" "), str(tmp_path / "index"))
    assert [r.url for r in index.docs.orderBy("doc_id").collect()] == ["http://a.example/1", "http://b.example/3"]
    queries = spark.createDataFrame([(0, "ALPHA")], "qid bigint, query string")
    listed, rendered = search.search(queries, index, pages)
    rows = listed.orderBy("rank").collect()
    assert {r.url for r in rows} == {"http://a.example/1", "http://b.example/3"} and rows[0].query == "ALPHA"

    paths = write_result_pages(rendered, str(tmp_path / "pages"))
    assert sorted(r.rel_path for r in paths.collect()) == [r.rel_path for r in rows]
    texts = {r.html for r in rendered.collect()}
    assert "<p><mark>Alpha</mark> beta</p><p>gamma</p>" in texts

    plain = result_pages(search.retrieve(queries, index, with_seq=True), pages, None)
    assert {r.html for r in plain.collect()} == {PAGES["a.example/p1"][1], PAGES["b.example/p4"][1]}


def test_queries_of_a_batch_have_paths_of_their_own(spark, tree, tmp_path):
    pages = crawl.read_pages(spark, tree)
    index = build.build_index(build.tokenize_pages(pages, sep=" "), str(tmp_path / "index"))
    queries = spark.createDataFrame([(0, "beta"), (1, "delta")], "qid bigint, query string")
    listed, rendered = search.search(queries, index, pages)
    paths = {r.rel_path: r.url for r in listed.collect()}
    assert paths == {
        "generated_results/0/result_00.html": "http://a.example/1",
        "generated_results/1/result_00.html": "http://b.example/3",
    }
    html = {r.rel_path: r.html for r in rendered.collect()}
    assert "<mark>beta</mark>" in html["generated_results/0/result_00.html"]
    assert "<mark>delta</mark>" in html["generated_results/1/result_00.html"]
