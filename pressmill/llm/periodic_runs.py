"""Stretches of words that repeat with a period, found in an enhanced suffix array.

Inside a batch every word is numbered by its text and word, and every text ends in a mark of
its own, so one suffix array serves all texts of the batch and nothing is shared between them.

1. Prefix doubling sorts the suffixes; only groups that still agree are sorted again.
2. A wanted run makes two suffixes of its text agree in ``shared`` words (16 for runs of 24
   words and 3 periods). Texts without such a pair are done after a few rounds.
3. Neighbours' common prefixes, read off the ranks of the rounds, give the LCP intervals.
   For an interval of depth d, every suffix i outside its largest child asks whether i + d
   and i - d rank inside the interval too. If so and the next words differ, a square of
   period d ends there that cannot be rotated to the right: each run has exactly one such
   square for its period, at its end.
4. Squares are rotated to the left as far as words agree: that is the run. Of squares with
   the same end, one whose period is a multiple of that of a run covering it is that run.

Nothing is compared between texts, so work is spread by rows. One text is one task's work;
its memory is some 4 bytes for each word and round of doubling (log2 of its longest repeat).
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.session import prepare_workers

#: Words of the texts that share one suffix array; a longer text has one of its own.
BLOCK = 400_000
RUN = "struct<start: bigint, length: bigint, period: bigint>"


class Wanted(NamedTuple):
    """Runs of at least ``words`` words and ``periods`` periods."""

    words: int = 24
    periods: int = 3

    @property
    def shared(self) -> int:
        """Words in which a run's first suffix and the one a period later agree at least:
        the least of max(words, periods * q) - q over all periods q."""
        q = max(1, self.words // self.periods)
        return max(1, min(max(self.words, self.periods * k) - k for k in (q, q + 1)))


class _Suffixes(NamedTuple):
    order: np.ndarray  # suffixes in order
    ranks: list[np.ndarray]  # place of the group of equal prefixes of 1, 2, 4, ... words


def _refined(order: np.ndarray, key: np.ndarray, slots: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Sort the suffixes at ``slots`` by ``key``, set the ranks of the groups this makes, and
    return the slots of groups with several members."""
    by = np.argsort(key, kind="stable")
    order[slots] = order[slots][by]
    key = key[by]
    first = np.append(True, key[1:] != key[:-1])
    starts = np.flatnonzero(first)
    size = np.diff(np.append(starts, len(key)))
    rank[order[slots]] = np.repeat(slots[starts], size)
    return slots[np.repeat(size > 1, size)]


def _sorted_suffixes(symbols: np.ndarray) -> _Suffixes:
    n = len(symbols)
    order = np.arange(n)
    rank = np.empty(n, dtype=np.int32)
    open_slots = _refined(order, symbols, np.arange(n), rank)
    ranks, width = [rank], 1
    while len(open_slots):
        members = order[open_slots]
        key = ranks[-1][members].astype(np.int64) * n + ranks[-1][np.minimum(members + width, n - 1)]
        rank = ranks[-1].copy()
        open_slots = _refined(order, key, open_slots, rank)
        ranks.append(rank)
        width *= 2
    return _Suffixes(order, ranks)


def _common_prefixes(found: _Suffixes) -> np.ndarray:
    """Words in which each suffix agrees with the one before it in order."""
    order, ranks = found
    n = len(order)
    top = np.full(n, -1, dtype=np.int8)  # largest power of two words in which both agree
    pairs = np.arange(1, n)
    for k, rank in enumerate(ranks):
        pairs = pairs[rank[order[pairs]] == rank[order[pairs - 1]]]
        top[pairs] = k
        if not len(pairs):
            break
    lcp = np.zeros(n, dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        lcp[top == k] += 1 << k
        more = np.flatnonzero(top > k)
        a = np.minimum(order[more] + lcp[more], n - 1)
        b = np.minimum(order[more - 1] + lcp[more], n - 1)
        same = (ranks[k][a] == ranks[k][b]) & (a != b)
        lcp[more[same]] += 1 << k
    return lcp


def _intervals(lcp: np.ndarray) -> np.ndarray:
    """Rows of depth, first and last place, first and last place of the largest child."""
    out, stack = array("q"), [[0, 0, 0, 0]]
    values = lcp.tolist()
    values.append(0)
    for i in range(1, len(values)):
        depth, left = values[i], i - 1
        child = (left, left)
        while stack[-1][0] > depth:
            d, left, a, b = stack.pop()
            if i - 1 - child[0] > b - a:
                a, b = child[0], i - 1
            out.extend((d, left, i - 1, a, b))
            child = (left, i - 1)
        if stack[-1][0] == depth:
            top = stack[-1]
            if child[1] - child[0] > top[3] - top[2]:
                top[2], top[3] = child
        else:
            stack.append([depth, child[0], *child])
    return np.frombuffer(out, dtype=np.int64).reshape(-1, 5)


def _branching_squares(symbols: np.ndarray, found: _Suffixes, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """End and period of every square that cannot be rotated to the right."""
    order = found.order
    n = len(order)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    depth, left, right, a, b = _intervals(lcp).T
    # Places of an interval outside its largest child: those before it, then those after it.
    lows, highs = np.concatenate([left, b + 1]), np.concatenate([a, right + 1])
    which = np.concatenate([np.arange(len(depth))] * 2)
    size = np.maximum(0, highs - lows)
    which = np.repeat(which, size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lows, size)
    i, d = order[at], depth[which]
    ends, periods = [], []
    for start in (i, i - d):  # i holds the square's first half, or its second
        inside = (start >= 0) & (start + d < n)
        other = place[np.where(start is i, i + d, start).clip(0, n - 1)]
        inside &= (left[which] <= other) & (other <= right[which])
        s, p = start[inside], d[inside]
        branch = symbols[s + p] != symbols[np.minimum(s + 2 * p, n - 1)]
        ends.append((s + 2 * p)[branch])
        periods.append(p[branch])
    both = np.unique(np.concatenate(ends) * n + np.concatenate(periods))
    return both // n, both % n


def _agree_before(symbols: np.ndarray, at: int, period: int, floor: int) -> int:
    """The least place from which words up to ``at`` agree with those a period later."""
    step = 16
    while at > floor:
        low = max(floor, at - step)
        differ = np.flatnonzero(symbols[low:at] != symbols[low + period : at + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        at, step = low, step * 2
    return at


def runs_of(texts: list[list], wanted: Wanted = Wanted()) -> list[list[tuple[int, int, int]]]:
    """Start, length and period of every wanted run of every text, given as lists of words;
    by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    parts, starts, kept, at = [], [], [], 0
    for k, words in enumerate(texts):
        if len(words) < wanted.words:
            continue
        last = dict(zip(words, range(at, at + len(words)), strict=True))
        parts.append(np.fromiter(map(last.__getitem__, words), np.int64, len(words)))
        parts.append(np.array([at + len(words)]))
        starts.append(at)
        kept.append(k)
        at += len(words) + 1
    if not parts:
        return out
    symbols, begin = np.concatenate(parts), np.array(starts)
    text_of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, at)))
    # Only texts with a repeat of `shared` words can hold a run; the others leave here.
    repeating = _texts_repeating(symbols, text_of, wanted.shared)
    if not repeating.all():
        if repeating.any():
            some = [kept[k] for k in np.flatnonzero(repeating)]
            for k, runs in zip(some, runs_of([texts[k] for k in some], wanted), strict=True):
                out[k] = runs
        return out
    found = _sorted_suffixes(symbols)
    end, period = _branching_squares(symbols, found, _common_prefixes(found))
    # The run holds the square and what it takes to be long enough.
    before = np.maximum(wanted.words, wanted.periods * period) - 2 * period
    first = end - 2 * period - np.maximum(0, before)
    possible = first >= 0
    possible[possible] = symbols[first[possible]] == symbols[(first + period)[possible]]
    last_run: list[tuple[int, int, int]] = []
    for e, p in zip(end[possible].tolist(), period[possible].tolist(), strict=True):
        if last_run and last_run[0][1] != e:
            last_run = []
        if any(p % q == 0 and s <= e - 2 * p for s, _, q in last_run):
            continue  # the same run, its period taken several times
        text = int(text_of[e - 1])
        s = _agree_before(symbols, e - 2 * p, p, int(begin[text]))
        if e - s >= max(wanted.words, wanted.periods * p):
            last_run.append((s, e, p))
            out[kept[text]].append((s - int(begin[text]), e - s, p))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _texts_repeating(symbols: np.ndarray, text_of: np.ndarray, shared: int) -> np.ndarray:
    """Whether each text has two places from which ``shared`` words agree."""
    n, rank, width = len(symbols), symbols, 1
    places = np.arange(n)
    while True:
        seen = np.bincount(rank[places], minlength=n)
        places = places[seen[rank[places]] > 1]
        if width == shared or not len(places):
            break
        # Prefixes of twice the words, or of just as many as are asked for.
        step = min(width, shared - width)
        key = rank[places] * n + rank[np.minimum(places + step, n - 1)]
        _, rank_of = np.unique(key, return_inverse=True)
        rank = np.full(n, n - 1)
        rank[places] = rank_of
        # A place that agrees with no other keeps a number that no group has.
        alone = np.ones(n, dtype=bool)
        alone[places] = False
        rank[alone] = len(places) + np.arange(n - len(places))
        width += step
    out = np.zeros(int(text_of[-1]) + 1, dtype=bool)
    out[text_of[places]] = True
    return out


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that repeat a run's first period."""
    if not runs:
        return words
    gone = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [words[i] for i in np.flatnonzero(~gone).tolist()]


def collapse_runs(
    docs: DataFrame,
    wanted: Wanted = Wanted(),
    changed: Callable[[int | None, list], list] | None = None,
    kept: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``kept`` columns of ``docs`` and ``n_words``, ``runs`` (start, length and period, by
    start, then period) and ``collapsed``, the words that stay, joined by a space.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; a run is a longest stretch of words
    whose smallest period is ``period``. ``changed`` may replace a row's words first; it gets
    the ``doc_id``. A null or empty text has no words, no runs and an empty ``collapsed``.
    Rows are taken one by one, so null ids, repeated rows and ties need no rule; a very long
    text is one task's work. Other columns of ``docs`` are not read, whatever their names.
    """
    prepare_workers(docs.sparkSession)
    fields = [docs.schema[c] for c in kept]
    added = T._parse_datatype_string(f"n_words long, runs array<{RUN}>, collapsed binary")
    inputs = [F.col(c).alias(f"k{i}") for i, c in enumerate(kept)]
    read = docs.select(*inputs, F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("words"))
    schema = T.StructType([*(T.StructField(f"k{i}", f.dataType) for i, f in enumerate(fields)), *added])
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    names = [f.name for f in schema.fields]

    def block(rows: pa.RecordBatch, texts: list[list]) -> pa.RecordBatch:
        runs = runs_of(texts, wanted)
        rests = [b" ".join(collapsed(w, r)) for w, r in zip(texts, runs, strict=True)]
        as_rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs]
        return pa.RecordBatch.from_arrays(
            [
                *(rows.column(f"k{i}") for i in range(len(fields))),
                pa.array(map(len, texts), pa.int64()),
                pa.array(as_rows, run_type),
                pa.array(rests, pa.binary()),
            ],
            names,
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("words")
            first, words, size = 0, [], 0
            for k in range(batch.num_rows):
                found = (texts[k].as_py() or b"").split()
                if changed is not None:
                    found = changed(ids[k].as_py(), found)
                words.append(found)
                size += len(found)
                if size >= BLOCK or k + 1 == batch.num_rows:
                    yield block(batch.slice(first, k + 1 - first), words)
                    first, words, size = k + 1, [], 0

    found = read.mapInArrow(work, schema)
    renamed = [F.col(f"k{i}").alias(f.name) for i, f in enumerate(fields)]
    return found.select(*renamed, "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def planted(doc_id: int | None, words: list) -> list:
    """Fixed rule of the query: in a tenth of all documents the words from some place on
    repeat with some period, both given by the id."""
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def _longest_first() -> Column:
    """Runs by falling length / period, compared exactly, then start, then period."""

    def compare(x: Column, y: Column) -> Column:
        # decimal products: two 64-bit numbers may be too much for one
        a, b = (
            u["length"].cast("decimal(19,0)") * v["period"].cast("decimal(19,0)") for u, v in ((x, y), (y, x))
        )
        return (
            F.when(a > b, -1)
            .when(a < b, 1)
            .when(x["start"] < y["start"], -1)
            .when(x["start"] > y["start"], 1)
            .when(x["period"] < y["period"], -1)
            .when(x["period"] > y["period"], 1)
            .otherwise(0)
        )

    return F.get(F.array_sort("runs", compare), F.lit(0))


def run_digests(docs: DataFrame) -> DataFrame:
    """One row a document: how many runs, the one with the greatest exponent, and digests of
    all runs and of the words that stay. The repeats of :func:`planted` are put in first."""
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = collapse_runs(docs, changed=planted).withColumn("best", _longest_first())
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000L * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(line, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )
