"""Keywords by the index, against a search for every one."""

import random

import pytest

from pressmill.operators import keywords
from pressmill.operators.keywords import keep_with_keywords, keyword_hits


def made(seed):
    rng = random.Random(seed)
    letters = "abcd éß\n👍İ"
    texts = [(k, "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 5, 60, 300])))) for k in range(60)]
    texts += [(100, None), (None, "abcabc"), (7, "a second text of id seven, dd\ndd"), (200, "x" * 9), (200, "x" * 9)]
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(300)}
    return texts, [*words, None, "xxx", "never there", "ty se"]


def plain(texts, words):
    return {(k, w) for k, t in texts if t is not None for w in words if w is not None and w in t}


def frames(spark, texts, words):
    return (
        spark.createDataFrame(texts, "doc_id long, text string").repartition(4),
        spark.createDataFrame([(w, "x") for w in words], "keyword string, text string"),
    )


@pytest.mark.parametrize("most_sent", [10_000, 5])
@pytest.mark.parametrize("seed, empty", [(1, False), (2, True)])
def test_hits_equal_a_plain_search(spark, seed, empty, most_sent):
    texts, words = made(seed)
    words += [""] * empty
    rows = keyword_hits(*frames(spark, texts, words), "doc_id", most_sent=most_sent).collect()
    found = [tuple(r) for r in rows]
    assert len(found) == len(set(found)) and set(found) == plain(texts, words)


@pytest.mark.parametrize("most_sent", [1000, 0])
def test_pieces_of_long_texts(spark, monkeypatch, most_sent):
    """Keywords across the border of two pieces, and after many of them."""
    monkeypatch.setattr(keywords, "PIECE", 10)
    texts = [(k, "-" * k + "needle" + "=" * 25 + "pin") for k in range(30)]
    words = ["needle", "dle", "=pin", "pin", "n", "le", "pins"]
    rows = keyword_hits(*frames(spark, texts, words), "doc_id", most_sent=most_sent).collect()
    assert {tuple(r) for r in rows} == plain(texts, words)


def test_empty_tables(spark):
    docs, words = frames(spark, *made(3))
    assert keyword_hits(docs, words.limit(0), "doc_id").count() == 0
    assert keyword_hits(docs.limit(0), words, "doc_id").count() == 0
    assert keyword_hits(docs, words.where("keyword is null"), "doc_id").count() == 0


def test_texts_stay_where_they_are(spark):
    """The only thing that is exchanged are hits."""
    docs, words = frames(spark, *made(4))
    plan = keyword_hits(docs, words, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.split("MapInArrow")[0].count("Exchange") == 1


def test_articles_with_any_keyword(spark):
    rows = [("u1", "peace talks"), ("u2", "Talks"), ("u3", None), ("u4", "a cease-fire")]
    articles = spark.createDataFrame(rows, "url string, content string")
    listed = spark.createDataFrame([("talks",), ("cease-fire",)], "keyword string")
    assert sorted(r.url for r in keep_with_keywords(articles, listed, "url").collect()) == ["u1", "u4"]
