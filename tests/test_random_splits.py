"""Random texts full of sentence traps: the splitter and its SQL must agree."""

import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from checks.oracle import _split
from pressmill.functions.sentences import split_sentences

PARTS = (
    "Mr. ", "mr.", "A. ", " B.", "U.S. ", "in. ", "The end", "he went on and on", "X", "7", "+1",
    "(", ")", '"', "'", " ", "  ", "\n", "\t", ". ", ".", "? ", "! ", ".\n", ". \n ", "Dr.\n", "é",
    "Some words of a fair length here", "W" * 60, "long " * 30,
)


def texts(n: int) -> list[str]:
    """Half of them with few brackets and quotes, which otherwise stay open for long."""
    rng = random.Random(11)
    rare = [0.1 if p in '()"' else 1 for p in PARTS]
    return [
        "".join(rng.choices(PARTS, rare if i % 2 else None, k=rng.randint(1, 60))) for i in range(n)
    ]


def test_splitter_equals_sql(spark):
    docs = pd.DataFrame({"doc_id": range(3000), "text": texts(3000)})
    con = duckdb.connect()
    con.register("docs", docs)
    rows = con.sql(
        f"WITH RECURSIVE {_split('docs', 'text')} "
        "SELECT doc_id, list(sentence ORDER BY place) FROM sentences GROUP BY doc_id"
    ).fetchall()
    want = dict(rows)
    df = spark.createDataFrame(docs).repartition(8)
    got = {r.doc_id: r.s for r in df.select("doc_id", split_sentences(F.col("text")).alias("s")).collect()}
    assert len(want) == len(got) == 3000
    wrong = [(docs.text[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not wrong, (len(wrong), wrong[0])
    assert sum(len(s) > 1 for s in got.values()) > 500
