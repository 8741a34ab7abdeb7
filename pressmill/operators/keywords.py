"""Long keyword lists: E19 by an inverted index.

A keyword can only stand in a text that has all its pieces, so each keyword waits under one of
them, its anchor: the rarest of eight characters, of three if it is shorter than eight. (Three
alone are too few: a text of some length has most trigrams of its language.) Texts say which pieces
they have, each once; where an anchor is among them, the keyword is looked for itself. A text is
read once however long the list is, and little is looked for in it that is not there.

* The index travels to the texts if its size, which is counted, allows it. Texts don't move: an
  Arrow task looks up a text's pieces and tries the keywords they lead to.
* A longer list is joined by shuffle: only numbers and pieces that are anchors travel, then
  pairs of text and keyword, and the texts are read once more for the proof.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.session import prepare_workers, stored

#: Keywords that are sent to every task at most.
MOST_SENT = 200_000
#: Characters of an anchor, of keywords that have as many; shorter ones wait under all of theirs.
LONG, SHORT = 8, 3
#: Characters of a text that are cut into anchors at once.
PIECE = 1 << 16
#: Texts that tell which pieces are common. Any choice of anchors gives the same result.
SAMPLE = 500


def _grams(text: Column, size: int) -> Column:
    """All substrings of ``size`` characters, each once."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def _pieces(text: Column) -> Column:
    """The text in pieces of bounded length that share with the next what an anchor may need."""
    count = F.floor(F.char_length(text) / PIECE).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count), lambda i: F.substring(text, i * F.lit(PIECE) + 1, F.lit(PIECE + LONG - 1))
    )


def _text_grams(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """``texts`` with ``gram``, a row for each distinct one in each piece."""
    cut = texts.withColumn("piece", F.explode(_pieces(F.col("text"))))
    return cut.withColumn("gram", F.explode(F.concat(*[_grams(F.col("piece"), n) for n in sizes]))).drop("piece")


def anchors(keywords: DataFrame, texts: DataFrame) -> DataFrame:
    """``keyword, gram``: each keyword under its anchor, one with fewer than three characters under
    itself. Empty keywords and null are left out."""
    known = keywords.where(F.length("keyword") > 0).select("keyword").distinct()
    size = F.char_length("keyword")
    grams = (
        F.when(size < SHORT, F.array("keyword"))
        .when(size < LONG, _grams(F.col("keyword"), SHORT))
        .otherwise(_grams(F.col("keyword"), LONG))
    )
    told = known.select("keyword", F.explode(grams).alias("gram"))
    # The search by places can begin inside a character of two units; such are no anchors.
    told = told.where(F.contains(F.col("keyword"), F.col("gram")))
    shared = told.groupBy("gram").agg(F.count("*").alias("shared"))
    common = _text_grams(texts.select("text").limit(SAMPLE), [SHORT, LONG]).groupBy("gram").agg(F.count("*").alias("common"))
    weighed = told.join(shared, "gram").join(common, "gram", "left")
    cost = F.struct(F.coalesce("common", F.lit(0)).alias("common"), "shared", "gram")
    return weighed.groupBy("keyword").agg(F.min(cost)["gram"].alias("gram"))


def _codes(text: str, size: int) -> np.ndarray:
    """A number for the substring of ``size`` characters at each place."""
    units = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    out = np.full(max(0, len(units) - size + 1), size, dtype=np.uint64)
    for k in range(size):
        out = (out ^ units[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class _Numbers:
    """A set of numbers: a table of their first bits turns most others away."""

    def __init__(self, numbers: Iterable[int]) -> None:
        self._sorted = np.sort(np.fromiter(numbers, np.uint64))
        bits = max(16, (32 * len(self._sorted)).bit_length())
        self._shift = np.uint64(64 - bits)
        self._some = np.zeros(1 << bits, dtype=bool)
        self._some[self._sorted >> self._shift] = True

    def met(self, codes: np.ndarray) -> tuple[list[int], list[int]]:
        """Places of those of ``codes`` that are in the set, and what they are."""
        places = np.flatnonzero(self._some[codes >> self._shift])
        codes = codes[places]
        near = np.minimum(np.searchsorted(self._sorted, codes), len(self._sorted) - 1)
        same = self._sorted[near] == codes
        return places[same].tolist(), codes[same].tolist()


def _sent(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Hits by an index that every task has."""
    spark = rows.sparkSession
    prepare_workers(spark)
    # Anchors are looked up by number, many at once; what two of them share is only work. A keyword
    # says where in it the anchor stands, so it is compared at that place alone.
    listed: dict[int, dict[int, list[tuple[int, str]]]] = {}
    for row in index.toLocalIterator():
        size = len(row.gram)
        waiting = listed.setdefault(size, {}).setdefault(int(_codes(row.gram, size)[0]), [])
        waiting.append((row.keyword.find(row.gram), row.keyword))
    shared = spark.sparkContext.broadcast(listed)
    schema = T.StructType([rows.schema["key"], T.StructField("keyword", T.StringType())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        known = {size: _Numbers(codes) for size, codes in index.items()}
        for batch in batches:
            at, found = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                hits: set[str] = set()
                for size, anchors in known.items():
                    waiting = index[size]
                    for start in range(0, len(text), PIECE):
                        places, codes = anchors.met(_codes(text[start : start + PIECE + size - 1], size))
                        for place, code in zip(places, codes):
                            for before, word in waiting[code]:
                                first = start + place - before
                                if word not in hits and first >= 0 and text.startswith(word, first):
                                    hits.add(word)
                at += [k] * len(hits)
                found += hits
            keys = batch.column("key").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(found, pa.string())], ["key", "keyword"])

    return rows.mapInArrow(look, schema)


def _met(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Hits by an index that is joined by shuffle."""
    sizes = [r.size for r in index.select(F.char_length("gram").alias("size")).distinct().collect()]
    by_gram = index.groupBy("gram").agg(F.collect_list("keyword").alias("keywords"))
    # Rows are told apart by key and text, which is all that the proof depends on.
    named = rows.withColumn("row", F.xxhash64("key", "text"))
    grams = _text_grams(named.select("row", "text"), sizes).select("row", "gram")
    pairs = grams.join(by_gram, "gram").select("row", F.explode("keywords").alias("keyword")).distinct()
    found = named.join(pairs, "row").where(F.contains(F.col("text"), F.col("keyword")))
    return found.select("key", "keyword")


def keyword_hits(texts: DataFrame, keywords: DataFrame, key: str, most_sent: int = MOST_SENT) -> DataFrame:
    """``key, keyword`` of all keywords that stand in a row's ``text``, case-sensitive, each pair
    once.

    ``keywords`` has a column ``keyword``. A null text holds nothing; the empty keyword stands in
    every other text; a null keyword nowhere. Rows with the same key count as one text each.
    """
    rows = texts.select(F.col(key).alias("key"), "text").where(F.col("text").isNotNull())
    index = stored(anchors(keywords, rows))
    hits = _sent(rows, index) if index.count() <= most_sent else _met(rows, index)
    if not keywords.where(F.col("keyword") == "").isEmpty():
        hits = hits.unionByName(rows.select("key", F.lit("").alias("keyword")))
    return hits.distinct().withColumnRenamed("key", key)


def keep_with_keywords(articles: DataFrame, keywords: DataFrame, key: str, text: str = "content") -> DataFrame:
    """E19 for a list in a table: articles in whose text any keyword stands. ``key`` tells
    articles apart."""
    hits = keyword_hits(articles.select(key, F.col(text).alias("text")), keywords, key)
    return articles.join(hits.select(key).distinct(), key, "left_semi")
