"""Whole jobs: files in, files out."""

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from pressmill.__main__ import main
from pressmill.config import JobConfig
from pressmill.operators.numbering import number_articles, number_ordered, order_articles
from pressmill.plans.crawling import run_extraction
from pressmill.plans.formatting import format_articles, numbered_articles, run_formatter
from pressmill.sources.articles import read_articles, write_articles
from pressmill.sources.records import write_text
from pressmill.streaming.ingest import article_stream, stream_pages
from tests.test_pages import PAGES, WANT

S1 = "The first sentence is long enough."
S2 = "The second sentence is long\nenough too."


def article(**over):
    base = {
        "url": "http://u", "source": "AP", "title": "t", "date": "20140601",
        "dateScraped": "2014-06-02 00:00:00", "content": f"{S1} {S2}",
    }
    return {**base, **over}


def text_of(folder):
    """Part files below ``folder`` in name order, as one text per sub-folder."""
    out = {}
    for sub, _, names in sorted(os.walk(folder)):
        parts = sorted(n for n in names if n.startswith("part-"))
        if parts:
            out[os.path.relpath(sub, folder)] = "".join(
                open(os.path.join(sub, n), encoding="utf-8").read() for n in parts
            )
    return out


@pytest.fixture
def articles(tmp_path):
    rows = [
        article(date="20140602", url="http://a", title="A"),
        article(url="http://b", title="China's talks - Xinhua | Énglish"),
        article(url="http://c", title="same day, later in the file"),
        article(url="http://d", content='"Quoted" is this whole article.'),
        article(url="http://e", content="NEW YORK (Hollywood Reporter) - x and y."),
        article(url="http://f", content="   "),
        article(url="http://g", content=None),
        article(url="http://h", content="PARIS Reuters - The story goes on here. " + S1, date="20140603"),
    ]
    del rows[6]["content"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "AP_talks.json").write_text(json.dumps(rows))
    (tmp_path / "in" / "UPI_talks.json").write_text(
        json.dumps([article(source="UPI", title="NBA scores"), article(source="UPI", url="http://x")])
    )
    (tmp_path / "in" / "broken.json").write_text('[{"url": "http://z", ')
    return tmp_path


def test_formatter_writes_exact_files(spark, articles):
    out = str(articles / "out")
    run_formatter(spark, str(articles / "in"), out)
    two = S2.replace("\n", "")
    assert text_of(f"{out}/lead") == {
        "source=AP/query=AP_talks": (
            f"20140601 AP-0000001-1\n{S1}\n\n20140601 AP-0000002-1\n{S1}\n\n"
            f"20140602 AP-0000003-1\n{S1}\n\n20140603 AP-0000004-1\nThe story goes on here.\n\n"
        ),
        "source=UPI/query=UPI_talks": f"20140601 UPI-0000001-1\n{S1}\n\n",
    }
    both = "20140601 {0}-{1}-1\n" + S1 + "\n\n20140601 {0}-{1}-2\n" + two + "\n\n"
    assert text_of(f"{out}/sentences") == {
        "source=AP/query=AP_talks": (
            both.format("AP", "0000001")
            + both.format("AP", "0000002")
            + both.format("AP", "0000003").replace("20140601", "20140602")
            + f"20140603 AP-0000004-1\n The story goes on here.\n\n20140603 AP-0000004-2\n{S1}\n\n"
        ),
        "source=UPI/query=UPI_talks": both.format("UPI", "0000001"),
    }
    assert text_of(f"{out}/index") == {
        "source=AP/query=AP_talks": (
            "20140601 AP-0000001-1 'China\\'s talks | English' http://b\n"
            "20140601 AP-0000002-1 'same day, later in the file' http://c\n"
            "20140602 AP-0000003-1 'A' http://a\n"
            "20140603 AP-0000004-1 't' http://h\n"
        ),
        "source=UPI/query=UPI_talks": "20140601 UPI-0000001-1 't' http://x\n",
    }
    rejects = sorted(text_of(f"{out}/rejects")["."].splitlines())
    assert [r.split("\t")[:2] for r in rejects] == [["read", "no content"], ["read", "not JSON"]]


def test_command_line(spark, articles):
    main(["format", str(articles / "in" / "UPI_talks.json"), str(articles / "cli")])
    assert list(text_of(str(articles / "cli" / "lead"))) == ["source=UPI/query=UPI_talks"]


def test_numbers_restart_per_file_in_input_order(spark, articles):
    got = format_articles(read_articles(spark, str(articles / "in"))).numbered
    rows = got.orderBy("query", "article_no").select("query", "article_no", "url").collect()
    assert [tuple(r) for r in rows] == [
        ("AP_talks", 1, "http://b"), ("AP_talks", 2, "http://c"),
        ("AP_talks", 3, "http://a"), ("AP_talks", 4, "http://h"), ("UPI_talks", 1, "http://x"),
    ]


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_numbering_on_a_hot_day(spark, parts):
    """Two thirds of the rows share one key; the numbers are those of a plain sort."""
    rng = random.Random(7)
    rows = [
        ("AP", None if i % 50 == 0 else "q", "20140601" if i % 3 else f"201406{i % 28 + 1:02d}", i)
        for i in range(3000)
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "source string, query string, date string, pos int").repartition(parts)
    want, count = {}, {}
    for source, query, date, pos in sorted(rows, key=lambda r: (r[1] or "", r[2], r[3])):
        count[query] = count.get(query, 0) + 1
        want[pos] = count[query]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_articles(df)
        got = {r.pos: r.article_no for r in numbered.collect()}
        sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == want
    if parts > 1:
        assert max(sizes) < 3 * 3000 / parts


def test_record_order_when_the_counts_are_not_sent_to_every_task(spark, tmp_path):
    rows = [("AP", f"q{i % 40}", f"201406{i * 7 % 28 + 1:02d}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "source string, query string, date string, pos int").repartition(9)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = []
        for name, limit in (("sent", 10**6), ("shuffled", 0)):
            numbered = number_ordered(order_articles(df), broadcast_rows=limit)
            line = numbered.withColumn("value", F.concat_ws(" ", "query", "article_no", "pos"))
            write_text(line, str(tmp_path / name))
            found.append(text_of(str(tmp_path / name)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found[0] == found[1] and len(found[0]) == 40
    for text in found[0].values():
        assert [int(x.split()[1]) for x in text.splitlines()] == list(range(1, 51))


def test_input_order_does_not_depend_on_splits(spark, tmp_path):
    for name, n in (("a", 300), ("b", 900)):
        lines = [json.dumps(article(url=f"http://{name}{i}")) for i in range(n)]
        (tmp_path / f"{name}.json").write_text("\n".join(lines))
    key, seen = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(key)
    try:
        for size in ("64k", "128m"):
            spark.conf.set(key, size)
            rows = read_articles(spark, str(tmp_path), lines=True).withColumn("query", F.lit("q"))
            got = number_articles(rows).select("url", "article_no").collect()
            seen.append({r.url: r.article_no for r in got})
    finally:
        spark.conf.set(key, before)
    assert seen[0] == seen[1]
    assert seen[0]["http://a0"] == 1 and seen[0]["http://b0"] == 301 and seen[0]["http://b899"] == 1200


def test_rejects_of_a_second_run_replace_the_first(spark, articles):
    out = str(articles / "out")
    for _ in range(2):
        run_formatter(spark, str(articles / "in"), out)
    rejects = sorted(text_of(f"{out}/rejects")["."].splitlines())
    assert [r.split("\t")[1] for r in rejects] == ["no content", "not JSON"]
    assert "AP_talks.json:0:" in rejects[0]


def test_result_does_not_depend_on_partitions(spark):
    rows = [
        (f"http://{i}", "UPI" if i % 3 else "AP", "q", f"t{i}", f"2014060{i % 9 + 1}", i,
         f"Sentence number {i} is long enough. " * (i % 5 + 1))
        for i in range(300)
    ]
    schema = "url string, source string, query string, title string, date string, pos int, content string"
    seen = []
    for parts in (1, 4, 200):
        df = spark.createDataFrame(rows, schema).repartition(parts)
        got = numbered_articles(df).select("source", "article_no", "url", "sentences").collect()
        seen.append(sorted((r.source, r.article_no, r.url, tuple(r.sentences)) for r in got))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 300
    numbers = {}
    for source, no, *_ in seen[0]:
        numbers.setdefault(source, []).append(no)
    assert all(n == list(range(1, len(n) + 1)) for n in numbers.values())


def test_extraction_round_trip(spark, tmp_path):
    """Pages to article files, and those read back as formatter input."""
    cfg = JobConfig(keywords=("War",))
    spark.createDataFrame(list(PAGES.items()), "url string, html string").write.parquet(
        str(tmp_path / "pages")
    )
    run_extraction(spark, str(tmp_path / "pages"), str(tmp_path / "out"), cfg)
    back = read_articles(spark, str(tmp_path / "out" / "articles"), lines=True)
    got = {r.url: (r.source, r.title, r.date, r.content) for r in back.collect()}
    assert got == WANT
    assert {r.query for r in back.select("query").collect()} == {""}
    assert len(text_of(str(tmp_path / "out" / "rejects"))["."].splitlines()) == 4
    assert format_articles(back).numbered.count() > 0


def test_search_folders_stay_text(spark, tmp_path):
    rows = [(f"http://{q}", "AP", "t", "20140601", "x", S1, q) for q in ("007", "7", "a b/c")]
    df = spark.createDataFrame(
        rows,
        "url string, source string, title string, date string, dateScraped string, content string, query string",
    )
    write_articles(df, str(tmp_path / "a"))
    back = read_articles(spark, str(tmp_path / "a"), lines=True)
    assert {(r.url, r.query) for r in back.collect()} == {(r[0], r[6]) for r in rows}


def test_stream_gives_the_batch_result(spark, tmp_path):
    pages = spark.createDataFrame(list(PAGES.items()), "url string, html string")
    pages.limit(8).write.parquet(str(tmp_path / "pages"))
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        stream = article_stream(stream_pages(spark, str(tmp_path / "pages")), out, mark, JobConfig(keywords=("War",)))
        stream.trigger(availableNow=True).start().awaitTermination(120)

    run()
    first = len(spark.read.json(out).collect())
    pages.subtract(pages.limit(8)).write.mode("append").parquet(str(tmp_path / "pages"))
    run()
    rows = spark.read.json(out).select("url", "title").collect()
    assert 0 < first < len(rows)
    assert {r.url: r.title for r in rows} == {u: w[1] for u, w in WANT.items()}
    assert glob.glob(f"{out}/source=AP/query=*/*.json")
