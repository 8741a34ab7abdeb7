"""The registered queries: every operator over whole driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import views as V
from pressmill.config import JobConfig
from pressmill.functions import datelines, dates, text
from pressmill.functions.sentences import lead_sentence, split_sentences
from pressmill.functions.text import to_ascii
from pressmill.functions.urls import host_in, host_of, url_date
from pressmill.operators import extraction, filters, following, keywords, links, numbering, sites
from pressmill.operators.history import HistoryShape, LinkHistory
from pressmill.plans.crawling import pages_to_articles, pages_to_links
from pressmill.plans.formatting import numbered_articles, publish_articles
from pressmill.session import computed_once, ensure_checkpoint_dir, prepare_workers
from pressmill.sources.articles import read_articles, rejects_of, write_articles
from pressmill.sources.published import OUTPUTS, Published
from pressmill.sources.records import (
    index_records,
    lead_records,
    sentence_records,
    write_rejects,
    write_text,
)
from pressmill.sources.tables import read_table

DOMAINS = ("example.com", "blog.ththan.example.net")
WINDOW = JobConfig(start="2014-05-05", end="2014-05-20")


def article_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.keep_articles(V.documents_as_articles(spark, sf_dir)).select(
        "doc_id", "source", "url", "title"
    )


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.rejection_counts(V.documents_as_articles(spark, sf_dir))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.clean_articles(V.documents_as_articles(spark, sf_dir)).select(
        "doc_id", "title", "content"
    )


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.table(spark, sf_dir, "documents")
    split = docs.select("doc_id", split_sentences(to_ascii(F.col("text"))).alias("sentences"))
    return numbering.explode_sentences(computed_once(split))


def _split_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.split_articles(filters.clean_articles(V.documents_as_articles(spark, sf_dir)))


def sentence_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.explode_sentences(_split_articles(spark, sf_dir).select("doc_id", "sentences"))


def lead_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_articles(spark, sf_dir).select(
        "doc_id", lead_sentence(F.col("sentences")).alias("sentence")
    )


def article_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = V.documents_as_articles(spark, sf_dir, "doc_id", "source", "query", "date", "pos")
    return numbering.number_articles(articles).select("doc_id", "source", "date", "article_no")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_articles(V.documents_as_articles(spark, sf_dir))


def sentence_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_records(_numbered(spark, sf_dir)).drop("query")


def lead_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lead_records(_numbered(spark, sf_dir)).drop("query")


def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_records(_numbered(spark, sf_dir)).drop("query")


def _shared_folder(spark: SparkSession) -> str:
    """A new folder on the storage all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4()}"


def stored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 then S1: all articles written as JSON and read back."""
    folder = _shared_folder(spark)
    articles = V.documents_as_articles(spark, sf_dir)
    write_articles(articles.withColumn("dateScraped", F.lit("2014-07-01 00:00:00")), folder)
    return read_articles(spark, folder, lines=True).select(
        "url", "source", "query", "title", "date", "dateScraped", "content", "reason"
    )


def array_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 on JSON arrays: a few hundred articles in each, read back in input order."""
    folder = _shared_folder(spark)
    articles = V.documents_as_articles(spark, sf_dir).withColumn(
        "query", F.concat("source", F.lit("-"), F.floor(F.col("doc_id") / 500))
    )
    one = F.struct("doc_id", "url", "source", "title", "date", "content")
    arrays = articles.groupBy("query").agg(F.to_json(F.sort_array(F.collect_list(one))).alias("value"))
    # One array a file: a file of several would be read as its first.
    arrays.write.option("maxRecordsPerFile", 1).partitionBy("query").text(folder)
    back = read_articles(spark, folder).where(F.col("reason").isNull())
    place = Window.partitionBy("query").orderBy("pos")
    return back.select(
        "url", "source", "query", "title", "date", "content",
        F.row_number().over(place).cast("bigint").alias("place"),
    )


def reject_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of rejects, written twice and read back."""
    folder = _shared_folder(spark)
    rejects = rejected_articles(spark, sf_dir)
    for _ in range(2):
        write_rejects(rejects, folder)
    return spark.read.schema(rejects.schema).option("sep", "\t").csv(folder)


def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all three record files."""
    folder = _shared_folder(spark)
    numbered = _numbered(spark, sf_dir)
    found = []
    for name, make in (
        ("lead", lead_records),
        ("sentences", sentence_records),
        ("index", index_records),
    ):
        write_text(make(numbered), f"{folder}/{name}")
        lines = spark.read.option("lineSep", "\n").text(f"{folder}/{name}")
        found.append(lines.select(F.lit(name).alias("file"), "source", "query", "value"))
    return found[0].union(found[1]).union(found[2])


def published_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4-S6, S8 and O2 over runs: two months published one after the other, the second of them
    twice; all published lines."""
    store = Published(spark, _shared_folder(spark))
    articles = V.documents_as_articles(spark, sf_dir)
    june = F.col("date") >= "20140601"
    for run, month in (("may", articles.where(~june)), ("june", articles.where(june)), ("june", articles)):
        publish_articles(month, store, run)
    found = [store.records(f).select(F.lit(f).alias("file"), "*") for f in OUTPUTS]
    return found[0].union(found[1]).union(found[2])


def rejected_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a required field, one in four each without another."""
    doc_id = F.col("doc_id")
    articles = V.documents_as_articles(spark, sf_dir)
    for i, name in enumerate(("url", "title", "content")):
        articles = articles.withColumn(name, F.when(doc_id % 4 != i + 1, F.col(name)))
    return rejects_of(articles, "read")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.all_links(V.table(spark, sf_dir, "pages"))


def link_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.all_links(V.table(spark, sf_dir, "pages"))
    allowed = found.where(host_in(host_of(F.col("url")), DOMAINS))
    return links.new_links(allowed.withColumn("source", F.lit("web"))).select("url")


def fresh_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10 on a later run: links of all pages that are not pages already fetched."""
    pages = V.table(spark, sf_dir, "pages")
    found = links.all_links(pages).withColumn("source", F.lit("web"))
    seen = pages.select(
        F.lit("web").alias("source"),
        F.concat(F.regexp_extract("url", r"^(https?://[^/]*)", 1), F.lit("/the")).alias("url"),
    )
    return links.new_links(found, seen).select("url")


def remembered_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10 over two runs that share a history: an earlier crawl of about half of the pages, by
    a hash of their URLs, then a crawl of all of them."""
    history = LinkHistory(spark, _shared_folder(spark), HistoryShape(buckets=64, bits=1 << 24))
    pages = V.table(spark, sf_dir, "pages")
    earlier = F.md5("url") < "8"
    found = []
    for run, some in (("first", pages.where(earlier)), ("second", pages)):
        fresh = history.admit(links.all_links(some).withColumn("source", F.lit("web")), run)
        found.append(fresh.select(F.lit(run).alias("run"), "url"))
    return found[0].unionByName(found[1])


def url_date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    found = V.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        V.pick(V.LIST_SOURCES, key).alias("source"),
        F.lit("article").alias("link_kind"),
        F.concat(
            V.pick(V.LIST_HOSTS, key),
            F.lit("/"),
            V.pick(V.SECTIONS, key),
            F.lit("/"),
            F.when(key % 9 == 0, F.lit("undated")).otherwise(F.date_format("o_orderdate", "yyyy/MM/dd")),
            F.lit("/id"),
            key,
        ).alias("url"),
    )
    kept = links.within_dates(links.exclude_sections(found), "1995-03-10", "1996-10-20")
    return links.within_years(kept, 1996, 1997).select("o_orderkey", "url", "link_date")


def result_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    found = links.extract_links(V.pages_as_results(spark, sf_dir))
    return found.select("source", "page_url", "link_kind", F.col("pos").cast("bigint").alias("pos"), "url")


def links_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    return pages_to_links(V.pages_as_results(spark, sf_dir), WINDOW)


def reachable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 to the end: stored pages that some start pages lead to by follow-up links."""
    prepare_workers(spark)
    pages = V.pages_as_archive(spark, sf_dir)
    found = links.extract_links(pages).where(F.col("link_kind") == "follow")
    return following.reachable_pages(pages, found, V.archive_starts(pages))


def simple_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.simple_articles(V.table(spark, sf_dir, "pages"))


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    found = pages_to_articles(V.documents_as_pages(spark, sf_dir), JobConfig(keywords=V.KEYWORDS))
    return found.articles.select("url", "source", "title", "date", "content")


def page_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    found = pages_to_articles(V.documents_as_pages(spark, sf_dir), JobConfig(keywords=V.KEYWORDS))
    return found.rejects.select("stage", "reason", "source", "url")


def site_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E12 from whole sites: what is left of every page without its site's template. Pages of sites
    with too few pages say so."""
    found = sites.site_articles(V.documents_as_site(spark, sf_dir))
    return found.select("url", "by_site", F.when(F.col("by_site"), F.col("story")).alias("story"))


def raw_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    moment = F.col("o_orderdate") + F.make_dt_interval(
        hours=(key % 24).cast("int"), mins=(key % 60).cast("int")
    )
    forms = []
    for style, (pattern, _) in V.DATE_STYLES.items():
        raw = F.date_format(moment, pattern)
        if style == "UPI short":
            raw = F.replace(raw, F.lit("Sep."), F.lit("Sept."))
        source = {"BBC inner": "BBC", "UPI short": "UPI"}.get(style, style)
        parsed = dates.parse_date(dates.clean_date_text(raw, source), source)
        forms.append(F.struct(F.lit(style).alias("style"), raw.alias("raw"), parsed.alias("published")))
    return (
        V.table(spark, sf_dir, "orders")
        .select("o_orderkey", F.inline(F.array(*forms)))
        .select(
            "o_orderkey",
            "style",
            "raw",
            dates.render_date(F.col("published"), "yyyyMMdd").alias("date"),
            F.date_format("published", "HH:mm:ss").alias("time"),
        )
    )


def scrape_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8 from a stored fetch time."""
    key = F.col("o_orderkey")
    fetched = F.col("o_orderdate") + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))
    return V.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.scraped_at(fetched).alias("scraped")
    )


def dateline_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.col("content")
    return V.documents_as_articles(spark, sf_dir).select(
        "doc_id",
        datelines.cut_upi(content).alias("upi"),
        datelines.cut_xna(content).alias("xna"),
        datelines.cut_reuters(content).alias("reuters"),
    )


def keyword_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        V.table(spark, sf_dir, "documents")
        .where(datelines.has_keyword(F.col("text"), V.KEYWORDS))
        .select("doc_id")
    )


def keyword_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E19 for a list of some ten thousand keywords in a table."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    return keywords.keyword_hits(docs, V.keyword_table(spark, sf_dir), "doc_id")


def whitespace_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.col("content")
    return V.documents_as_articles(spark, sf_dir).select(
        "doc_id",
        text.squeeze_ws(content).alias("squeezed"),
        text.space_out(content).alias("spaced"),
        text.squeeze_marks(content).alias("unmarked"),
        text.space_out_lines(content).alias("unlined"),
    )


def complete_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    drafts = extraction.simple_articles(V.table(spark, sf_dir, "pages")).select(
        "url",
        "title",
        "content",
        url_date(F.col("url")).alias("date"),
        F.coalesce(
            *[
                F.when(host_in(host_of(F.col("url")), (d,)), F.lit(d))
                for d in ("example.com", "example.net")
            ],
            F.lit("other"),
        ).alias("source"),
    )
    dated = drafts.withColumn("date", F.coalesce("date", F.lit("2014-05-01").cast("date")))
    return extraction.complete(dated).select("url", "source", "title")


def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E21 with its reason: articles of which a third each lacks one field."""
    doc_id = F.col("doc_id")
    drafts = V.documents_as_articles(spark, sf_dir).select(
        "doc_id",
        "source",
        F.when(doc_id % 4 != 1, F.col("title")).alias("title"),
        F.when(doc_id % 4 != 2, F.col("date")).alias("date"),
        F.when(doc_id % 4 != 3, F.col("content")).otherwise(F.lit("")).alias("content"),
    )
    return drafts.select("doc_id", extraction.missing_field().alias("reason"))


def caption_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = V.documents_as_pages(spark, sf_dir)
    return extraction.with_origin(pages).select(
        "url", extraction.drop_captions(F.col("origin"), F.col("html")).alias("html")
    )


ALL = (
    article_filter,
    reject_reasons,
    clean_text,
    split_documents,
    sentence_filters,
    lead_sentences,
    article_numbers,
    sentence_lines,
    lead_lines,
    index_lines,
    stored_articles,
    array_articles,
    reject_files,
    record_files,
    published_records,
    rejected_articles,
    page_links,
    link_domains,
    fresh_links,
    remembered_links,
    url_date_window,
    result_links,
    links_to_fetch,
    reachable_pages,
    simple_pages,
    page_articles,
    page_rejects,
    site_stories,
    raw_dates,
    scrape_times,
    dateline_cut,
    keyword_match,
    keyword_index,
    whitespace_rules,
    complete_articles,
    missing_fields,
    caption_cut,
)
QUERIES = {f.__name__: f for f in ALL}
