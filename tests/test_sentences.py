"""Hand-traced sentence cases and properties of the splitter."""

import re

import pytest
from pyspark.sql import functions as F

from pressmill.functions import sentences as S
from pressmill.functions.text import to_ascii

CASES = [
    ("Mr. Smith said hello to the crowd today. He left.", ["Smith said hello to the crowd today."]),
    (
        "The delegation met Mr. Jones in Geneva on Monday. Talks will resume next week.",
        ["The delegation met Mr. Jones in Geneva on Monday.", "Talks will resume next week."],
    ),
    (
        'He said "Stop. Go now." Then the crowd left the square. Police stayed overnight in town.',
        [
            'He said "Stop. Go now." Then the crowd left the square.',
            "Police stayed overnight in town.",
        ],
    ),
    (
        "The treaty (signed in 1999. It was never ratified by either side.",
        ["The treaty (signed in 1999. It was never ratified by either side."],
    ),
    ("Short one.", ["Short one."]),
    ("Short one. Tiny.", ["Tiny."]),
    (
        "The envoy met A. Brown of the U.S. State Department. It was brief and cordial.",
        ["The envoy met A. Brown of the U.S. State Department.", "It was brief and cordial."],
    ),
    (
        "The rally ended in may. Thousands went home afterwards.",
        ["The rally ended in may. Thousands went home afterwards."],
    ),
    (
        "prices rose today. analysts were not surprised by the move.",
        ["prices rose today. analysts were not surprised by the move."],
    ),
    ("a" * 20 + ". " + "B" * 24 + ".", ["B" * 24 + "."]),
    ("a" * 21 + ". " + "B" * 24 + ".", ["a" * 21 + ".", "B" * 24 + "."]),
    ("x" * 600, ["x" * 600]),
    ("", [""]),
    # A space at index 0 does not protect an abbreviation, one further on does.
    (" Mr. Smith said hello to the crowd today", ["Smith said hello to the crowd today"]),
    # A newline before the abbreviation is not a space.
    (
        "The party was then joined by\nMr. Smith and the other guests of honour",
        ["The party was then joined by\nMr.", "Smith and the other guests of honour"],
    ),
    # Too long a sentence is lost, the next one is kept.
    ("Y" * 512 + ". This one is of the right length.", ["This one is of the right length."]),
    ("Y" * 511 + ". This one is of the right length.", ["Y" * 511 + ".", "This one is of the right length."]),
    # Length is counted without the terminator; trailing space counts for the tail.
    ("Abcdefghijklmnopqrst   ", ["Abcdefghijklmnopqrst"]),
    # Long open run, nothing emitted: the whole remainder comes back.
    (
        "He spoke (at length. " + "It went on. " * 60 + "The end.",
        ["He spoke (at length. " + "It went on. " * 60 + "The end."],
    ),
    # Stray closing bracket: unequal from then on.
    (
        "The first sentence is long enough. A stray) here. Then more text follows.",
        ["The first sentence is long enough.", "A stray) here. Then more text follows."],
    ),
    # The brackets even out again later.
    (
        "The first one (still open. Now closed) ends here. Then more text follows.",
        ["The first one (still open. Now closed) ends here.", "Then more text follows."],
    ),
    ("Is it really over now? 42 people asked that! (Nobody knew.) It was late.", [
        "Is it really over now?", "(Nobody knew.) It was late."]),
]


@pytest.mark.parametrize("parts", [1, 7])
def test_golden_splits(spark, parts):
    df = spark.createDataFrame(
        [(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string"
    ).repartition(parts)
    got = {r.i: r.s for r in df.select("i", S.split_sentences(F.col("t")).alias("s")).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, CASES[i]


def test_null_text_gives_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(S.split_sentences(F.col("t")).alias("s")).first().s is None


def test_many_sentences_cross_block_borders(spark):
    want = [f"This is sentence number {i} of many." for i in range(1000)]
    df = spark.createDataFrame([(" ".join(want),)], "t string")
    assert df.select(S.split_sentences(F.col("t")).alias("s")).first().s == want


def test_sentences_are_ordered_parts_of_the_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(to_ascii(F.col("text")).alias("t"))
    rows = docs.select("t", S.split_sentences(F.col("t")).alias("s")).collect()
    assert rows
    for r in rows:
        at = 0
        for s in r.s:
            at = r.t.index(s, at) + len(s)
        assert r.s and not any(re.match(r"\s|.*\s\Z", s, re.S) for s in r.s)


def test_sentence_rules(spark):
    given = [
        "'Yes,' he said", '"Go" now', "'Tis the season", 'He said "x"', "View the slide show here",
        "",
    ]
    df = spark.createDataFrame([(given,)], "s array<string>")
    got = df.select(S.keep_sentences(F.col("s")).alias("s")).first().s
    assert got == ["'Tis the season", 'He said "x"']


@pytest.mark.parametrize(
    "first, want",
    [
        ("PARIS Reuters - The a Reuters - end", " end"),
        ("PARIS (Reuters) - The", "PARIS (Reuters) - The"),
        ("One\nPARIS Reuters - two", "One\nPARIS Reuters - two"),
        ("A Reuters - one\nB Reuters - two", " one\n two"),
    ],
)
def test_lead_dateline(spark, first, want):
    df = spark.createDataFrame([([first, "B Reuters - stays"],)], "s array<string>")
    row = df.select(S.strip_lead_dateline(F.col("s")).alias("s")).first()
    assert row.s == [want, "B Reuters - stays"]


def test_lead_sentence_is_one_trimmed_line(spark):
    df = spark.createDataFrame([([" a\nb\r c ", "d"],)], "s array<string>")
    assert df.select(S.lead_sentence(F.col("s")).alias("s")).first().s == "ab c"
