"""Phrases whose words keep company, by best-first branch and bound over prefix counts.

A phrase is as good as its weakest cut: ``floor(2000000 a / (l + r))`` with the counts of
the phrase, its first and its last part. A phrase is found no more often than any part of
it, so a part with count A says what the phrases grown from it can reach at most:

* growing to the right, ``floor(2000000 A / (f(start) + A))`` for every start of the part,
* growing to the left, ``floor(2000000 A / (f(end) + A))`` for every end of the part.

Words and pairs are counted everywhere. Then the frontier is taken best first: every language
has a threshold, at first the score of its ``AHEAD * top``-th pair, and only pairs, then
triples, whose bound reaches it are grown. So every phrase at or above the threshold is known
with its score. So is whether it is dropped: a longer phrase that is frequent enough to drop
it contains one longer by a single word that is as frequent, and that one grew from it. With
``top`` survivors at or above the threshold a language is settled, ties included; the others
go on with a lower threshold, at last without one.

Each growth is one pass over the texts. A task counts in blocks and tells sums; which parts
may grow it sees in bitmaps of hashes with at most ``MAX_BITS`` bits. A part that is marked
by chance costs rows and never changes a count, so beyond that size a pass is dearer and as
right. Nothing else is sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm.common import shuffle_parts, stage
from pressmill.llm.shingles import hashes_of, mixed
from pressmill.session import prepare_workers

LONGEST, LEAST, TOP = 4, 30, 2000
#: The first threshold is the score of this many times ``top`` pairs; ``STEP`` times as many in
#: every further round.
AHEAD, STEP = 4, 8
#: Bytes of one language's texts counted together; a longer text is counted by itself.
BLOCK = 2_000_000
MAX_BITS = 1 << 29
UNKNOWN = "und"

#: A-Z to a-z, ends of pieces to a line feed, tabs to blanks.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)
)
_END = b"\n"

#: What a bitmap tells about parts of so many words: ("may grow", 1), ("right", 2), ...
Role = tuple[str, int]


def _hashes(lang: str, words: np.ndarray) -> np.ndarray:
    """A number for each row of word hashes, under a language."""
    out = np.full(len(words), xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")), dtype=np.uint64)
    for column in words.T:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


class Sieve:
    """Bitmaps of the parts that may grow, by role. No bitmap lets everything through."""

    def __init__(self, maps: dict[Role, np.ndarray]) -> None:
        self.maps = maps

    def has(self, role: Role, lang: str, words: np.ndarray) -> np.ndarray:
        bits = self.maps.get(role)
        if bits is None:
            return np.ones(len(words), dtype=bool)
        at = _hashes(lang, words) & np.uint64(8 * len(bits) - 1)
        return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def count_block(lang: str, texts: list[bytes], size: int, sieve: Sieve) -> tuple[list[bytes], np.ndarray]:
    """Phrases of ``size`` words and their counts in ``texts`` of one language."""
    text = (b" \n ").join(t.translate(_FOLD).replace(_END, b" \n ") for t in texts)
    tokens = list(filter(None, text.split(b" ")))
    names = list(dict.fromkeys([_END, *tokens]))
    number = {w: k for k, w in enumerate(names)}
    ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
    del tokens, text
    if size == 1:
        counts = np.bincount(ids, minlength=len(names))
        return names[1:], counts[1:]
    told = hashes_of(names)
    gram = np.where(ids > 0, ids, -1)  # the phrase that begins at a place, if any
    members = np.arange(len(names))[:, None]
    counts = np.zeros(0, dtype=np.int64)
    for k in range(1, size):
        words = told[members]
        frequent = sieve.has(("frequent", k), lang, words)
        left, right = gram[:-1], gram[1:]
        at = np.flatnonzero((left >= 0) & (right >= 0))
        at = at[frequent[left[at]] & frequent[right[at]]]
        if ("right", k) in sieve.maps:
            grows = sieve.has(("right", k), lang, words)[left[at]]
            at = at[grows | sieve.has(("left", k), lang, words)[right[at]]]
        key = left[at] * len(names) + ids[at + k]
        found, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        members = np.concatenate([members[found // len(names)], (found % len(names))[:, None]], axis=1)
        gram = np.full(len(left), -1)
        gram[at] = inverse
    return [b" ".join([names[i] for i in row]) for row in members.tolist()], counts


def _by_language(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text"))


def counts_of(texts: DataFrame, size: int, maps: dict[Role, np.ndarray], least: int) -> DataFrame:
    """``lang, phrase, f`` of all phrases of ``size`` words that the bitmaps let through and
    that occur ``least`` times. With single words, the empty phrase counts all of them."""
    shared = texts.sparkSession.sparkContext.broadcast(maps)

    def block(lang: str, part: list[bytes], sieve: Sieve) -> pa.RecordBatch:
        phrases, counts = count_block(lang, part, size, sieve)
        if size == 1:
            phrases, counts = [*phrases, b""], np.append(counts, counts.sum())
        langs = pa.repeat(pa.scalar(lang, pa.string()), len(phrases))
        columns = [langs, pa.array(phrases, pa.binary()), pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = Sieve(shared.value)
        for batch in batches:
            waiting: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                mine = waiting.setdefault(lang, [0])
                mine.append(text.as_py() or b"")
                mine[0] += len(mine[-1])
                if mine[0] >= BLOCK:
                    yield block(lang, waiting.pop(lang)[1:], sieve)
            for lang, mine in waiting.items():
                yield block(lang, mine[1:], sieve)

    return (
        texts.mapInArrow(run, "lang string, phrase binary, f long")
        .groupBy("lang", "phrase")
        .agg(F.sum("f").alias("f"))
        .where((F.col("f") >= least) | (F.length("phrase") == 0))
        .withColumn("phrase", F.col("phrase").cast("string"))
    )


def bitmap(parts: DataFrame, max_bits: int = MAX_BITS) -> np.ndarray:
    """One bit for each of the ``parts`` (lang, phrase), 16 bits for each part or as many as
    there may be. The bits are set on the cluster; the driver gets blocks of 4096 bytes."""
    bits = min(max_bits, max(1 << 15, 1 << (16 * parts.count()).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
            told = [_hashes(a, hashes_of(p.split(b" "))[None, :])[0] for a, p in zip(langs, phrases, strict=True)]
            at = np.array(told, dtype=np.uint64) & np.uint64(bits - 1)
            # Spark's bitmaps count positions from 1.
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64) + 1)], ["at"])

    blocks = (
        parts.select("lang", F.col("phrase").cast("binary").alias("phrase"))
        .mapInArrow(places, "at long")
        .groupBy(F.bitmap_bucket_number("at").alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        .collect()
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in blocks:
        start = (row["block"] - 1) * 4096
        out[start : start + 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def share(a: Column, whole: Column) -> Column:
    """floor(2000000 a / whole), exactly: the product may pass 64 bits."""
    top = F.lit(2_000_000).cast("decimal(7,0)") * a.cast("decimal(20,0)")
    return F.call_function("div", top, whole.cast("decimal(20,0)"))


def scored(found: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """``found`` (lang, phrase, f) with ``l``, ``r`` and ``score`` of the lowest-scoring cut and
    the bounds ``to_right`` and ``to_left`` of what grows from it. A phrase with a part that
    ``counts`` does not have gets no score."""
    words = F.split("phrase", " ")
    cut = F.col("cut")
    sides = F.array(
        F.struct(F.lit("l").alias("side"), F.array_join(F.slice(words, F.lit(1), cut), " ").alias("part")),
        F.struct(
            F.lit("r").alias("side"),
            F.array_join(F.slice(words, cut + 1, F.size(words) - cut), " ").alias("part"),
        ),
    )
    parts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size(words) - 1))).select(
        "lang", "phrase", "f", "cut", F.inline(sides)
    )
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("times"))
    cuts = range(1, longest)
    count = {(s, k): f"{s}{k}" for s in "lr" for k in cuts}
    out = (
        parts.join(known, ["lang", "part"], "left")
        .groupBy("lang", "phrase", "f")
        .agg(
            F.count(F.when(F.col("times").isNull(), 1)).alias("unknown"),
            *(F.max(F.when((F.col("side") == s) & (cut == k), F.col("times"))).alias(c) for (s, k), c in count.items()),
        )
    )
    a = F.col("f")
    each = [
        F.struct(share(a, F.col(f"l{k}") + F.col(f"r{k}")).alias("score"), F.lit(k).alias("cut"), f"l{k}", f"r{k}")
        .cast("struct<score: bigint, cut: int, l: bigint, r: bigint>")
        for k in cuts
    ]
    worst = F.array_min(F.array(*(F.when(F.col(f"l{k}").isNotNull(), e) for k, e in zip(cuts, each, strict=True))))
    out = out.withColumn("worst", F.when(F.col("unknown") == 0, worst))

    def bound(side: str) -> Column:
        return F.array_min(F.array(*(share(a, F.col(f"{side}{k}") + a) for k in cuts)))

    return out.select(
        "lang", "phrase", "f", "worst.l", "worst.r", "worst.score",
        bound("l").alias("to_right"), bound("r").alias("to_left"),
    )


def _thresholds(pairs: DataFrame, wanted: int) -> DataFrame:
    """``lang, threshold``: the score that ``wanted`` pairs of a language reach, or 0. There
    are a million scores at most, so a language's histogram is small."""
    counts = pairs.groupBy("lang", "score").agg(F.count("*").alias("times"))
    above = Window.partitionBy("lang").orderBy(F.desc("score"))
    return (
        counts.withColumn("above", F.sum("times").over(above))
        .groupBy("lang")
        .agg(F.coalesce(F.max(F.when(F.col("above") >= wanted, F.col("score"))), F.lit(0)).alias("threshold"))
    )


def _survivors(phrases: DataFrame, longer: DataFrame) -> DataFrame:
    """``phrases`` that no longer one with four fifths of their count contains. One longer by a
    word is enough to look at: it is as frequent as anything longer around it."""
    words = F.split("phrase", " ")
    inner = F.array(
        F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.size(words) - 1), " "),
    )
    around = (
        longer.select("lang", F.explode(inner).alias("phrase"), F.col("f").alias("outer"))
        .groupBy("lang", "phrase")
        .agg(F.max("outer").alias("outer"))
    )
    big = "decimal(20,0)"
    whole = F.lit(100).cast(big) * F.coalesce("outer", F.lit(0)).cast(big) < F.lit(80).cast(big) * F.col("f").cast(big)
    return phrases.join(around, ["lang", "phrase"], "left").where(whole).drop("outer")


def _first(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language. The rows are cut into salts, so what one
    task sorts last is ``top`` rows a salt, however many tie."""
    salts = 4 * shuffle_parts(phrases.sparkSession)
    order = [F.desc("score"), F.desc("f"), F.asc("phrase")]
    salted = phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    best = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return best.where(F.col("rank") <= top).withColumn("rank", rank).where(F.col("rank") <= top).drop("salt")


def mine_phrases(
    docs: DataFrame,
    top: int = TOP,
    least: int = LEAST,
    longest: int = LONGEST,
    ahead: int = AHEAD,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The first ``top`` phrases of two to ``longest`` words of each language, with ``a, l, r``,
    the language's word count ``n``, ``score`` and ``rank``.

    A null text is empty, a null language is ``und``; an empty table gives no rows. Repeated rows
    count as often as they stand there, ties are ordered by count and phrase. Only ``lang`` and
    ``text`` are read, whatever else the table has; a long text is counted whole.
    """
    prepare_workers(docs.sparkSession)
    texts = _by_language(docs)
    words = stage(counts_of(texts, 1, {}, least))
    totals = words.where(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    singles = words.where((F.col("phrase") != "") & (F.col("f") >= least))
    maps = {("frequent", 1): bitmap(singles, max_bits)}
    counted = stage(counts_of(texts, 2, maps, least))
    pairs = stage(scored(counted, singles, 2))
    maps["frequent", 2] = bitmap(pairs, max_bits)
    results, pending, wanted = [], pairs.select("lang").distinct(), ahead * top
    while True:
        limits = stage(_thresholds(pairs.join(pending, "lang", "left_semi"), wanted))
        if limits.isEmpty():
            break
        # In later rounds only the languages that are not settled are read again.
        mine = texts.join(limits.select("lang"), "lang", "left_semi") if results else texts
        level = pairs.join(limits, "lang")
        phrases, counts = [level.drop("threshold")], singles.select("lang", "phrase", "f")
        longer = None
        for size in range(3, longest + 1):
            counts = counts.unionByName(phrases[-1].select("lang", "phrase", "f"))
            level = phrases[-1].join(limits, "lang")
            grown = {
                **maps,
                ("right", size - 1): bitmap(level.where(F.col("to_right") >= F.col("threshold")), max_bits),
                ("left", size - 1): bitmap(level.where(F.col("to_left") >= F.col("threshold")), max_bits),
            }
            found = stage(counts_of(mine, size, grown, least))
            longer = found if longer is None else longer.unionByName(found)
            phrases.append(stage(scored(found, counts, size)))
        known = phrases[0]
        for more in phrases[1:]:
            known = known.unionByName(more)
        sure = known.join(limits, "lang").where(F.col("score") >= F.col("threshold"))
        left = stage(_survivors(sure, longer) if longer is not None else sure)
        enough = left.groupBy("lang").agg(F.count("*").alias("left"))
        state = limits.join(enough, "lang", "left")
        done = (F.col("threshold") == 0) | (F.coalesce("left", F.lit(0)) >= top)
        settled = state.where(done).select("lang")
        results.append(stage(_first(left.join(settled, "lang", "left_semi"), top)))
        pending = stage(state.where(~done).select("lang"))
        wanted *= STEP
    if not results:
        results.append(_first(pairs, top))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.join(totals, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
