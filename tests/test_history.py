"""Links given out once: over runs, over failures, on streams."""

import glob
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from pressmill.config import JobConfig
from pressmill.operators.history import HistoryShape, LinkHistory
from pressmill.plans.crawling import pages_to_links
from pressmill.streaming.ingest import history_stream, link_stream, stream_pages


def links(spark, *urls):
    return spark.createDataFrame([("s", u) for u in urls], "source string, url string")


def given(df):
    rows = [r.url for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def many(spark, a, b):
    return spark.range(a, b).select(F.lit("s").alias("source"), F.concat(F.lit("u"), "id").alias("url"))


@pytest.fixture
def history(spark, tmp_path):
    return LinkHistory(spark, str(tmp_path / "history"), HistoryShape(8, 1 << 18))


def test_runs_give_links_once(spark, history):
    assert given(history.admit(links(spark, "a", "b", "a"), "r1")) == {"a", "b"}
    assert given(history.admit(links(spark, "b", "c"), "r2")) == {"c"}
    other = links(spark, "a").withColumn("source", F.lit("t"))
    assert given(history.admit(other, "r3")) == {"a"}
    assert given(history.admit(links(spark, "a", "c", None), "r4")) == set()
    assert given(history.admit(links(spark, "d").limit(0), "r5")) == set()
    assert given(history.admit(links(spark, "d", "a"), "r6")) == {"d"}
    assert history.runs() == ["r1", "r2", "r3", "r4", "r5", "r6"]
    with pytest.raises(ValueError):
        history.admit(links(spark, "d"), "../x")


def test_a_full_bitmap_is_as_right(spark, tmp_path):
    """More links than bits: nearly all are looked up, and the result is the same."""
    history = LinkHistory(spark, str(tmp_path / "h"), HistoryShape(1, 1 << 15))
    assert len(given(history.admit(many(spark, 0, 60_000), "a"))) == 60_000
    told = history.maybe_seen(many(spark, 60_000, 61_000), history.runs())
    assert told.where("maybe").count() > 700
    assert len(given(history.admit(many(spark, 59_000, 61_000), "b"))) == 1000


def test_a_finished_run_gives_its_result_again(spark, history):
    history.admit(links(spark, "a"), "r1")
    history.admit(links(spark, "a", "b"), "r2")
    history.admit(links(spark, "c"), "r3")
    assert given(history.admit(links(spark, "x", "y"), "r2")) == {"b"}
    assert given(history.admit(links(spark, "x"), "r4")) == {"x"}


@pytest.mark.parametrize("left", ["runs", "bits"])
def test_a_run_that_failed_is_not_remembered(spark, history, left):
    history.admit(links(spark, "a"), "r1")
    history.admit(links(spark, "b", "c"), "r2")
    os.remove(f"{history.path}/runs/r2")  # it ended before its last step
    if left == "bits":
        shutil.rmtree(f"{history.path}/bits/run=r2")
    assert given(history.admit(links(spark, "b", "d"), "r3")) == {"b", "d"}
    assert given(history.admit(links(spark, "b", "c", "a"), "r2")) == {"c"}


def test_only_buckets_that_may_answer_are_read(spark, history):
    history.admit(many(spark, 0, 200), "r1")
    told = history.maybe_seen(links(spark, "u7", "new"), ["r1"]).collect()
    assert {r.url: r.maybe for r in told} == {"u7": True, "new": False}
    (bucket,) = {r.bucket for r in told if r.maybe}
    old = history.links(["r1"]).where(F.col("bucket").isin([bucket]))
    plan = old._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and f"= {bucket}" in plan.split("PartitionFilters")[-1]
    read = {r.file.split("bucket=")[1].split("/")[0] for r in old.select(F.input_file_name().alias("file")).collect()}
    assert read == {str(bucket)}


# -- streams ---------------------------------------------------------------------

CFG = JobConfig(start="2014-01-01", end="2014-12-31")


def page(k, *slugs):
    items = "".join(f'<p class="hl"><a href="/News/2014/05/0{1 + s % 9}/s{s}">x</a></p>' for s in slugs)
    return (f"http://www.upi.com/list/{k}", f"<body>{items}</body>", f"2014-06-0{1 + k} 10:00:00")


BATCHES = [
    [page(0, 1, 2, 2), page(0, 3)],
    [page(1, 3, 4), page(1, 1, 5)],
    [page(2, 5, 6, 1), page(2, 2)],
]


def put(spark, folder, k):
    rows = spark.createDataFrame(BATCHES[k], "url string, html string, fetched string")
    rows = rows.withColumn("fetched", F.col("fetched").cast("timestamp")).coalesce(1)
    hidden = f"{folder}-{k}"
    rows.write.parquet(hidden)
    (part,) = glob.glob(f"{hidden}/part-*.parquet")
    os.makedirs(folder, exist_ok=True)
    shutil.copy(part, f"{folder}/{k}.parquet")
    os.utime(f"{folder}/{k}.parquet", (time.time() + k, time.time() + k))


def all_at_once(spark):
    pages = spark.createDataFrame([r[:2] for b in BATCHES for r in b], "url string, html string")
    return sorted((r.source, r.url) for r in pages_to_links(pages, CFG).collect())


def run(writer):
    query = writer.trigger(availableNow=True).start()
    try:
        query.awaitTermination(120)
        assert query.exception() is None
    finally:
        query.stop()


def streamed(spark, tmp_path, start, read):
    """Each file in a start of its own, the last start with nothing to do."""
    folder = str(tmp_path / "in")
    for k in range(len(BATCHES)):
        put(spark, folder, k)
        run(start(stream_pages(spark, folder, fetched=True)))
    run(start(stream_pages(spark, folder, fetched=True)))
    return sorted((r.source, r.url) for r in read().collect())


def test_links_on_a_stream_equal_the_batch(spark, tmp_path):
    out, at = str(tmp_path / "out"), str(tmp_path / "at")
    got = streamed(spark, tmp_path, lambda p: link_stream(p, out, at, CFG), lambda: spark.read.parquet(out))
    assert got == all_at_once(spark) and len(got) == 6


def test_links_are_forgotten_after_their_time(spark, tmp_path):
    out, at = str(tmp_path / "out"), str(tmp_path / "at")

    def start(pages):
        return link_stream(pages, out, at, CFG, remember="2 hours")

    got = streamed(spark, tmp_path, start, lambda: spark.read.parquet(out))
    assert set(got) == set(all_at_once(spark)) and len(got) > 6  # a day later they come again


def test_history_on_a_stream_equals_the_batch(spark, tmp_path, history):
    out, at = str(tmp_path / "out"), str(tmp_path / "at")

    def start(pages):
        return history_stream(pages, history, out, at, CFG)

    got = streamed(spark, tmp_path, start, lambda: spark.read.parquet(f"{out}/*"))
    assert got == all_at_once(spark)
    # A batch whose end was not noted is done again and gives the same.
    commits = sorted(glob.glob(f"{at}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for path in (commits[-1], f"{at}/commits/.{os.path.basename(commits[-1])}.crc"):
        os.remove(path)
    run(start(stream_pages(spark, str(tmp_path / "in"), fetched=True)))
    assert sorted((r.source, r.url) for r in spark.read.parquet(f"{out}/*").collect()) == got
