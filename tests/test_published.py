"""Runs published whole, numbers over runs, counts of the run itself."""

import pytest
from pyspark.sql import functions as F

from pressmill.__main__ import main
from pressmill.plans import formatting
from pressmill.plans.formatting import publish_articles, run_published
from pressmill.sources.published import OUTPUTS, Published
from tests.test_jobs import article, articles, text_of  # noqa: F401

COLUMNS = "url string, source string, title string, date string, content string, query string, pos long"
S = "This sentence is surely long enough."


def table(spark, rows):
    """``rows``: url, source, content."""
    made = [(u, s, f"title {u}", "20140601", c, "talks", k) for k, (u, s, c) in enumerate(rows)]
    return spark.createDataFrame(made, COLUMNS)


def index(store, runs=None):
    return sorted(r.value for r in store.records("index", runs).collect())


def line(number, url, source="AP"):
    return f"20140601 {source}-{number:07d}-1 'title {url}' {url}"


def test_numbers_go_on_and_counts_add_up(spark, tmp_path):
    store = Published(spark, str(tmp_path))
    assert store.records("index").count() == 0
    one = publish_articles(table(spark, [("a", "AP", S), ("b", "AP", S), ("c", "UPI", S)]), store, "one")
    rows = [("d", "AP", S), ("e", "AP", None), ("f", "UPI", "An NBA game. " + S), ("g", "VOA", S), ("h", "AP", " ")]
    two = publish_articles(table(spark, rows), store, "two")
    assert index(store) == sorted(
        [line(1, "a"), line(2, "b"), line(3, "d"), line(1, "c", "UPI"), line(1, "g", "VOA")]
    )
    assert index(store, ["two"]) == sorted([line(3, "d"), line(1, "g", "VOA")])
    assert (one["read"], one["kept"], one["numbered"]) == (3, 3, 3)
    assert {k: two[k] for k in ("read", "unusable", "dropped", "kept", "numbered")} == {
        "read": 5, "unusable": 1, "dropped": 1, "kept": 3, "numbered": 2,
    }
    assert (two["read AP"], two["unusable AP"], two["kept AP"], two["dropped UPI"]) == (3, 1, 2, 1)
    # Another application sees the same, and a batch that was not in the second run goes on.
    again = Published(spark, str(tmp_path))
    assert again.runs == ["one", "two"] and again.counts("two") == two
    publish_articles(table(spark, [("i", "UPI", S)]), again, "three")
    assert index(again, ["three"]) == [line(2, "i", "UPI")]


def test_a_failed_run_leaves_no_trace(spark, tmp_path, monkeypatch):
    """It stops between its outputs, after them and before it is published; readers see the run
    before, and the numbers of the failed run are given out again."""
    store = Published(spark, str(tmp_path))
    publish_articles(table(spark, [("a", "AP", S)]), store, "one")

    def stop(*_):
        raise OSError("stopped")

    for place, name in ((formatting, "sentence_records"), (Published, "write_ledger"), (Published, "publish")):
        with monkeypatch.context() as m:
            m.setattr(place, name, stop)
            with pytest.raises(OSError):
                publish_articles(table(spark, [("x", "AP", S), ("y", "AP", S)]), store, "two")
        for reader in (store, Published(spark, str(tmp_path))):
            assert reader.runs == ["one"]
            assert all(reader.records(output).count() for output in OUTPUTS)
            assert index(reader) == [line(1, "a")]
            with pytest.raises(ValueError):
                reader.records("index", ["two"])
    publish_articles(table(spark, [("b", "AP", S)]), store, "two")
    assert index(store) == [line(1, "a"), line(2, "b")]


def test_a_finished_run_done_again_changes_nothing(spark, tmp_path):
    store = Published(spark, str(tmp_path))
    first = publish_articles(table(spark, [("a", "AP", S)]), store, "one")
    assert publish_articles(table(spark, [("b", "AP", S)]), Published(spark, str(tmp_path)), "one") == first
    assert index(store) == [line(1, "a")]


def test_of_two_at_once_one_is_refused(spark, tmp_path):
    store, other = Published(spark, str(tmp_path)), Published(spark, str(tmp_path))
    store.publish("one", {})
    with pytest.raises(RuntimeError):
        other.publish("two", {})
    assert Published(spark, str(tmp_path)).runs == ["one"]
    with pytest.raises(ValueError):
        store.folder("a/b")


def test_a_run_that_loses_rows_is_not_published(spark, tmp_path, monkeypatch):
    real = formatting.index_records
    monkeypatch.setattr(formatting, "index_records", lambda rows: real(rows).where(F.col("article_no") > 1))
    store = Published(spark, str(tmp_path))
    with pytest.raises(RuntimeError, match="lost rows"):
        publish_articles(table(spark, [("a", "AP", S), ("b", "AP", S)]), store, "one")
    assert store.runs == [] and store.ledger() is None


def test_empty_run_and_a_hot_source(spark, tmp_path):
    store = Published(spark, str(tmp_path))
    assert publish_articles(table(spark, []), store, "none")["read"] == 0
    for run in ("one", "two"):
        rows = table(spark, [(f"{run}{k}", "AP", S) for k in range(200)]).repartition(8)
        publish_articles(rows, store, run)
    numbers = [int(v.split("-")[1]) for v in index(store)]
    assert sorted(numbers) == list(range(1, 401))


def test_files_equal_those_of_the_plain_formatter(spark, articles):  # noqa: F811
    plain, runs = str(articles / "out"), str(articles / "runs")
    formatting.run_formatter(spark, str(articles / "in"), plain)
    counts = run_published(spark, str(articles / "in"), runs, "one")
    for output in (*OUTPUTS, "rejects"):
        assert text_of(f"{runs}/runs/one/{output}") == text_of(f"{plain}/{output}")
    assert counts["unusable"] == 2 and counts["read"] == counts["unusable"] + counts["dropped"] + counts["kept"]
    main(["format", str(articles / "in"), runs, "--run", "two"])
    assert Published(spark, runs).runs == ["one", "two"]
