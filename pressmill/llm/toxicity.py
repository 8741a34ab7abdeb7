"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of hash buckets of its words, pairs of neighbours and pairs with one word
between them. Every bucket has its own learning rate, which falls with the gradients it has
seen, and L1 keeps buckets of little use at exactly zero, so the weights are small and can
be sent to every task.

Training takes a bounded sample of labelled rows, dealt out to shards, each of which is packed
into one row of a staged table. In a round every shard starts from the common state, learns
from its rows and tells how the state of the buckets it touched has moved; a bucket's moves are
averaged over the shards that have it. State and weights have ``BUCKETS`` places and there are
four shards at most, whatever the corpus. The state is a staged table of its slices, which
meets the shards in their tasks; the driver gets the weights that are not zero, once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.llm.common import drop_stage, stage, text_or_empty
from pressmill.llm.shingles import hashes_of, mixed
from pressmill.session import prepare_workers

BITS = 20
BUCKETS = 1 << BITS
#: The sample a model is fitted on: at most so many labelled documents, by a hash of their ids,
#: of which those with longer texts than TRAIN_CHARS are left out.
TRAIN_ROWS, TRAIN_CHARS = 16_000, 50_000
#: Places of the state in a row of its table.
SLICE = 1 << 14
#: Rows that a shard should have; there are no more than TRAIN_ROWS / SHARD_ROWS shards.
SHARD_ROWS, ROUNDS = 4_000, 4
#: Bytes of the texts that are scored together; a longer text is scored by itself.
BLOCK = 2_000_000
#: Samples that a task hands on together.
_ROWS = 500

_PAIR = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: A-Z to a-z; punctuation to blanks, so that a word counts as the same before a comma.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() and c != 39 else c for c in range(256)
)


class Rates(NamedTuple):
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1


class Model(NamedTuple):
    """Buckets with a weight, in order, their weights, and the weight of every text."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of everything that occurs in ``texts``; repeats stay."""
    words = [t.translate(_FOLD).split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    h = hashes_of([w for ws in words for w in ws])
    text = np.repeat(np.arange(len(texts)), sizes)
    found, owner = [mixed(h)], [text]
    for gap, salt in enumerate(_PAIR, start=1):
        same = text[gap:] == text[:-gap]
        pair = mixed(h[:-gap] * salt + np.uint64(gap)) + h[gap:]
        found.append(mixed(pair)[same])
        owner.append(text[gap:][same])
    bucket = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)
    return np.concatenate(owner), bucket


def weights_of(z: np.ndarray, n: np.ndarray, rates: Rates) -> np.ndarray:
    step = (rates.beta + np.sqrt(n)) / rates.alpha + rates.l2
    return np.where(np.abs(z) <= rates.l1, 0.0, (np.sign(z) * rates.l1 - z) / step)


def learn(rows: list[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray, rates: Rates) -> None:
    """One pass over ``rows`` of distinct buckets and label; changes the state ``z, n``.
    The last place of the state is the bias, which has no L1."""
    for at, label in rows:
        at = np.append(at, BUCKETS)
        w = weights_of(z[at], n[at], rates)
        w[-1] = -z[-1] / ((rates.beta + np.sqrt(n[-1])) / rates.alpha + rates.l2)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        seen = n[at]
        z[at] += g - (np.sqrt(seen + g * g) - np.sqrt(seen)) / rates.alpha * w
        n[at] = seen + g * g


def held_out(column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is a multiple of five."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def _samples(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``place, label, buckets`` of at most ``rows`` documents, one text for each id. A document
    with several labels is toxic if one of them says so."""
    marks = (
        labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
        .withColumn("place", F.xxhash64("doc_id"))
    )
    bounded = marks.orderBy("place", "doc_id").limit(rows)
    # Of several texts under one id the one with the least hash is taken, before any shuffle.
    found = (
        docs.where(F.length("text") <= TRAIN_CHARS)
        .select("doc_id", F.encode("text", "UTF-8").alias("text"))
        .join(F.broadcast(bounded), "doc_id")
        .groupBy("doc_id", "label", "place")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, _ROWS) for b in batches for k in range(0, b.num_rows, _ROWS)):
            sets = []
            for text in batch.column("text"):
                _, bucket = features([text.as_py()])
                sets.append(np.unique(bucket).astype(np.int32).tobytes())
            columns = [batch.column("place"), batch.column("label"), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["place", "label", "buckets"])

    return found.mapInArrow(cut, "place long, label int, buckets binary")


def _packed(samples: DataFrame, shards: int) -> DataFrame:
    """One row a shard: labels, sizes and buckets of its samples, by place."""

    def pack(key: tuple, mine: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values(["place", "buckets"])
        labels, sizes = mine["label"].to_numpy(np.int32), mine["buckets"].map(len).to_numpy(np.int32)
        one = {"shard": key[0], "labels": labels.tobytes(), "sizes": sizes.tobytes()}
        return pd.DataFrame([one | {"buckets": b"".join(mine["buckets"])}])

    shard = F.pmod("place", F.lit(shards)).alias("shard")
    return samples.groupBy(shard).applyInPandas(pack, "shard long, labels binary, sizes binary, buckets binary")


#: Places ``SLICE * part`` to ``SLICE * (part + 1) - 1`` of the state; a part that is not there is zero.
_STATE = "part int, z binary, n binary"
_MOVES = "part int, shard long, at binary, dz binary, dn binary"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.table([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names))


def _numbers(row: dict, *columns: str) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(row[c], np.float64) for c in columns)


def _moves(packed: DataFrame, state: DataFrame, shards: int, rates: Rates) -> DataFrame:
    """How the state moves in the shards, each of which begins with all of it."""

    def run(mine: pa.Table, parts: pa.Table) -> pa.Table:
        z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
        for row in parts.to_pylist():
            for whole, some in zip((z, n), _numbers(row, "z", "n"), strict=True):
                whole[SLICE * row["part"] :][: len(some)] = some
        before, out = (z.copy(), n.copy()), []
        for row in mine.to_pylist():
            labels, sizes, buckets = (np.frombuffer(row[c], np.int32) for c in ("labels", "sizes", "buckets"))
            sets = np.split(buckets, np.cumsum(sizes // 4)[:-1])
            learn(list(zip(sets, labels.tolist(), strict=True)), z, n, rates)
            at = np.flatnonzero(n != before[1]).astype(np.int32)
            dz, dn = ((x - old)[at].astype(np.float32) for x, old in zip((z, n), before, strict=True))
            for part in np.unique(at // SLICE).tolist():
                a, b = np.searchsorted(at, [SLICE * part, SLICE * (part + 1)])
                out.append((part, row["shard"], *(x[a:b].tobytes() for x in (at, dz, dn))))
        return _table(out, _MOVES)

    everywhere = state.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))
    return packed.groupBy("shard").cogroup(everywhere.groupBy("shard")).applyInArrow(run, _MOVES)


def _moved(state: DataFrame, moves: DataFrame) -> DataFrame:
    """The state after a round: a place moves by the mean over the shards that touched it."""

    def run(key: tuple, old: pa.Table, told: pa.Table) -> pa.Table:
        part = key[0].as_py()
        first = SLICE * part
        size = min(SLICE, BUCKETS + 1 - first)
        z, n = [x.copy() for row in old.to_pylist() for x in _numbers(row, "z", "n")] or [np.zeros(size), np.zeros(size)]
        dz, dn, touched = np.zeros(size), np.zeros(size), np.zeros(size, dtype=np.int64)
        for row in sorted(told.to_pylist(), key=lambda r: r["shard"]):  # in an order that is always the same
            at = np.frombuffer(row["at"], np.int32) - first
            dz[at] += np.frombuffer(row["dz"], np.float32)
            dn[at] += np.frombuffer(row["dn"], np.float32)
            touched[at] += 1
        z += dz / np.maximum(1, touched)
        n += dn / np.maximum(1, touched)
        return _table([(part, z.tobytes(), n.tobytes())], _STATE)

    return state.groupBy("part").cogroup(moves.groupBy("part")).applyInArrow(run, _STATE)


def _weights(state: DataFrame, rates: Rates) -> DataFrame:
    """``at, w`` of the places with a weight, the bias among them, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            z, n = _numbers(row, "z", "n")
            w, first = weights_of(z, n, rates), SLICE * row["part"]
            if first + len(z) > BUCKETS:
                w[-1] = -z[-1] / ((rates.beta + np.sqrt(n[-1])) / rates.alpha + rates.l2)
            at = np.flatnonzero(w)
            found = (at + first).tobytes(), w[at].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in found], ["at", "w"])

    return state.mapInArrow(run, "at binary, w binary")


def train(
    docs: DataFrame,
    labels: DataFrame,
    rates: Rates = Rates(),
    rows: int = TRAIN_ROWS,
    shard_rows: int = SHARD_ROWS,
    rounds: int = ROUNDS,
) -> Model:
    """A model of ``labels.toxic``, from documents that are not :func:`held_out`. Without
    labels it says 0.5 to everything."""
    spark = docs.sparkSession
    prepare_workers(spark)
    samples = _samples(docs, labels, rows)
    known = labels.where(F.col("toxic").isNotNull()).select("doc_id").distinct().limit(rows).count()
    shards = max(1, known // shard_rows)
    packed = stage(_packed(samples, shards))
    state, staged = spark.createDataFrame([], _STATE), []
    for _ in range(rounds):
        state = stage(_moved(state, _moves(packed, state, shards, rates)))
        staged.append(state)
    told = _weights(state, rates).collect()
    for done in (packed, *staged):
        drop_stage(done)
    at, w = (np.frombuffer(b"".join(bytes(r[c]) for r in told), t) for c, t in (("at", np.int64), ("w", np.float64)))
    at, w = at[np.argsort(at)], w[np.argsort(at)]
    bias = w[at == BUCKETS]
    return Model(at[at < BUCKETS], w[at < BUCKETS].astype(np.float32), float(bias[0]) if len(bias) else 0.0)


def scores_of(texts: list[bytes], dense: np.ndarray, bias: float) -> np.ndarray:
    owner, bucket = features(texts)
    told = dense[bucket] != 0
    both = np.unique(owner[told] * BUCKETS + bucket[told])
    sums = np.bincount(both // BUCKETS, dense[both % BUCKETS], minlength=len(texts))
    return 1.0 / (1.0 + np.exp(-np.clip(sums + bias, -35, 35)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``toxicity``, from 0 to 1, from the whole text alone.

    A null text is an empty one, and all texts without words have the same score. Rows are
    scored one by one: repeated rows, ties and null ids need no rule. Other columns are
    carried along, but for one named ``toxicity``, which is replaced.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    kept = [f for f in docs.schema.fields if f.name != "toxicity"]
    names = [f"k{i}" for i in range(len(kept))]
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, kept, strict=True)]
    schema = T.StructType([*fields, T.StructField("toxicity", T.DoubleType())])
    shared = spark.sparkContext.broadcast(model)
    columns = [F.col(f"`{f.name}`").alias(n) for n, f in zip(names, kept, strict=True)]
    read = docs.select(*columns, F.encode(text_or_empty(), "UTF-8").alias("scored"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        dense = np.zeros(BUCKETS, dtype=np.float32)
        dense[model.buckets] = model.weights
        for batch in batches:
            found, texts, size = [], [], 0
            for text in batch.column("scored"):
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= BLOCK:
                    found.append(scores_of(texts, dense, model.bias))
                    texts, size = [], 0
            found.append(scores_of(texts, dense, model.bias))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(np.concatenate(found))], [*names, "toxicity"]
            )

    renamed = [F.col(n).alias(f.name) for n, f in zip(names, kept, strict=True)]
    return read.mapInArrow(run, schema).select(*renamed, "toxicity")


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's toxicity, learned from the labels of four fifths of all ids."""
    found = score(docs.select("doc_id", "text"), train(docs, labels))
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )
