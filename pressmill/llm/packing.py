"""Best-fit packing with large-item matching.

Documents above a third of the capacity go at most two to a sequence. They are matched
greedily: the longest with the longest that still fits beside it. The others then fill
gaps from the longest down, each in the tightest gap that takes it.

All pieces of one length are alike, so the whole plan is made of counts: a histogram with
at most ``capacity`` rows goes in, and runs of equal moves come out ("so many pieces of
this length, so many to a sequence, from this sequence on"). Each run halves at least the
gaps it fills, so there are at most about ``capacity * log2(capacity)`` of them, whatever
the corpus holds. Pieces are numbered within their length and look up their run.

Cases: a null text counts as empty and gives one piece, the end mark. Longer documents are
cut into full pieces; the first may be shorter. Equal lengths are numbered by doc_id, so
the result does not depend on the partitioning. Repeated rows are documents of their own.
An empty table gives an empty result. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.bpe import BYTE_BPE, text_encoder
from pressmill.llm.common import numbered, stage
from pressmill.session import prepare_workers

CAPACITY = 2048
END = 0


class Run(NamedTuple):
    """Pieces ``low`` to ``high - 1`` of a length, ``each`` to a sequence."""

    length: int
    low: int
    high: int
    each: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs that place ``counts[length]`` pieces of every length."""
    left = {n: c for n, c in counts.items() if c}
    used: dict[int, int] = defaultdict(int)
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> first sequence, how many
    sequences = 0

    def put(length: int, pieces: int, each: int, sequence: int, offset: int) -> None:
        runs.append(Run(length, used[length], used[length] + pieces, each, sequence, offset))
        used[length] += pieces
        left[length] -= pieces

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for a in large:
        for b in (n for n in large if n <= min(a, capacity - a)):
            pairs = left[a] // 2 if a == b else min(left[a], left[b])
            if not pairs:
                continue
            if a == b:
                put(a, 2 * pairs, 2, sequences, 0)
            else:
                put(a, pairs, 1, sequences, 0)
                put(b, pairs, 1, sequences, a)
            gaps[capacity - a - b].append((sequences, pairs))
            sequences += pairs
        if alone := left[a]:
            put(a, alone, 1, sequences, 0)
            gaps[capacity - a].append((sequences, alone))
            sequences += alone

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = min((g for g, held in gaps.items() if g >= n and held), default=None)
            if gap is None:
                many = -(-left[n] // (capacity // n))
                gaps[capacity].append((sequences, many))
                sequences += many
                continue
            first, many = gaps[gap].pop()
            each = min(gap // n, left[n])
            full = min(many, left[n] // each)
            put(n, full * each, each, first, capacity - gap)
            gaps[gap - each * n].append((first, full))
            if full < many:
                gaps[gap].append((first + full, many - full))
    return runs


def _pieces(path: str, capacity: int):
    """Documents to pieces with their ids, in slices that bound a batch."""
    end = array("I", [END]).tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(path, by_ranks=True).encode
        for batch in batches:
            rows = []
            texts = batch.column("text")
            for k, row in enumerate(batch.column("row").to_pylist()):
                ids = encode(texts[k].as_py() or "") + end
                at = (len(ids) % width) or min(width, len(ids))
                bounds = [0, *range(at, len(ids) + 1, width)]
                rows += [
                    (k, row, p, a // 4, (b - a) // 4, ids[a:b])
                    for p, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
                ]
                if len(rows) >= 2048:
                    yield _batch(batch, rows)
                    rows = []
            if rows:
                yield _batch(batch, rows)

    return run


def _batch(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    k, row, piece, start, length, ids = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(pa.array(k)),
            pa.array(row, pa.int64()),
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int64()),
            pa.array(ids, pa.binary()),
        ],
        ["doc_id", "row", "piece", "start", "length", "ids"],
    )


def tokenized_pieces(docs: DataFrame, path: str = BYTE_BPE, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document: its ids and the end mark, cut where longer than a sequence."""
    prepare_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(
        _pieces(path, capacity),
        f"doc_id {kind}, row long, piece int, start long, length long, ids binary",
    )


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (staged, with doc_id, row, piece, length) with sequence and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    moves = pa.Table.from_pylist(
        [r._asdict() for r in plan(counts, capacity)], pa.schema([(c, pa.int64()) for c in Run._fields])
    )
    # Bounded by the capacity, see above; an Arrow table starts no Python workers of its own.
    runs = F.broadcast(spark.createDataFrame(moves).withColumnRenamed("offset", "offset0"))
    order = [F.col("doc_id"), F.col("row"), F.col("piece")]
    ranked = numbered(pieces, ["length"], order, "_rank")
    past = F.col("_rank") - F.col("low")
    here = (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    same = F.col("length") == F.col("_length")
    return (
        ranked.join(runs.withColumnRenamed("length", "_length"), same & here)
        .withColumn("sequence_id", F.col("sequence") + F.floor(past / F.col("each")))
        .withColumn("offset", F.col("offset0") + past % F.col("each") * F.col("length"))
        .drop("_rank", "_length", "low", "high", "each", "sequence", "offset0")
    )


def pack_documents(docs: DataFrame, path: str = BYTE_BPE, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with the sequence and the place it goes to."""
    cut = tokenized_pieces(docs, path, capacity)
    narrow = cut.select(
        "doc_id", "row", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return place(stage(narrow), capacity).drop("row")
