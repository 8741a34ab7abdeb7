"""Toxicity: the update rule, held-out accuracy, odd tables."""

import random
import zlib

import numpy as np
import pytest

from pressmill.llm import toxicity
from tests.llm.conftest import prose

BAD = "brute clod dolt".split()


@pytest.fixture(scope="module")
def rows():
    rng, out = random.Random(2), []
    for k in range(900):
        words, bad = prose(k, rng.randint(8, 120)).split(), rng.random() < 0.25
        if bad:
            words[rng.randrange(len(words))] = rng.choice(BAD).title() + rng.choice(["", "!", ","])
        out.append((k, " ".join(words), int(bad)))
    return out


def marks(spark, rows):
    data = [(d, 0, y, "x") for d, _, y in rows]
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int, text string")


def test_held_out_documents(spark, frame, rows):
    docs, labels = frame([r[:2] for r in rows]), marks(spark, rows[:700])
    found = {r.doc_id: r for r in toxicity.predict(docs, labels).collect()}
    assert len(found) == len(rows)
    told = {d: y for d, _, y in rows}
    unseen = [r for r in found.values() if r.held_out or r.doc_id >= 700]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.values())
    assert all(r.predicted == int(r.score >= 0.5) for r in found.values())
    right = np.mean([r.predicted == told[r.doc_id] for r in unseen])
    false = [r for r in unseen if r.predicted and not told[r.doc_id]]
    assert right > 0.97 and len(false) <= 0.01 * len(unseen)
    again = toxicity.predict(docs.repartition(7), labels.repartition(5)).collect()
    assert {r.doc_id: r.score for r in again} == {d: r.score for d, r in found.items()}


def test_held_out_labels_teach_nothing(spark, frame, rows):
    docs = frame([r[:2] for r in rows[:200]])
    turned = [(d, t, 1 - y if zlib.crc32(str(d).encode()) % 5 == 0 else y) for d, t, y in rows[:200]]
    a, b = (toxicity.train(docs, marks(spark, r)) for r in (rows[:200], turned))
    assert np.array_equal(a.buckets, b.buckets) and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_sparse_weights_and_shards(spark, frame, rows):
    docs, labels = frame([r[:2] for r in rows]), marks(spark, rows)
    model = toxicity.train(docs, labels, shard_rows=150)
    assert 0 < len(model.buckets) < 0.05 * len(rows) * 300
    found = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    assert np.mean([(found[d] >= 0.5) == bool(y) for d, _, y in rows if zlib.crc32(str(d).encode()) % 5 == 0]) > 0.95


def test_state_moves_by_the_written_rule():
    """Two rows, the rule applied coordinate by coordinate."""
    rates = toxicity.Rates(0.5, 1.0, 0.2, 0.1)
    z, n = np.zeros(toxicity.BUCKETS + 1), np.zeros(toxicity.BUCKETS + 1)
    rows = [(np.array([3, 9], np.int32), 1), (np.array([9], np.int32), 0)]
    toxicity.learn(rows, z, n, rates)
    zs, ns, bias = {}, {}, toxicity.BUCKETS
    for at, y in rows:
        ws = {}
        for i in [*at.tolist(), bias]:
            zi, ni, l1 = zs.get(i, 0.0), ns.get(i, 0.0), 0.0 if i == bias else rates.l1
            rate = (rates.beta + ni**0.5) / rates.alpha + rates.l2
            ws[i] = 0.0 if abs(zi) <= l1 and i != bias else -(zi - l1 * np.sign(zi)) / rate
        g = 1 / (1 + np.exp(-sum(ws.values()))) - y
        for i, w in ws.items():
            ni = ns.get(i, 0.0)
            zs[i] = zs.get(i, 0.0) + g - (((ni + g * g) ** 0.5 - ni**0.5) / rates.alpha) * w
            ns[i] = ni + g * g
    assert all(abs(z[i] - x) < 1e-12 for i, x in zs.items())
    assert all(abs(n[i] - x) < 1e-12 for i, x in ns.items())


def test_odd_tables(spark, frame, odd_rows, rows):
    docs = frame(odd_rows).withColumnsRenamed({"label": "toxicity", "key": "scored", "ids": "k0", "part": "bucket"})
    labels = marks(spark, [(4, "", 1), (4, "", 0), (5, "", None), (None, "", 1), (6, "", 0), (99, "", 1)])
    found = toxicity.predict(docs, labels).collect()
    assert len(found) == len(odd_rows)
    blank = {r.score for r in found if r.doc_id in (1, 2, 3, 12)}
    assert len(blank) == 1 and 0 <= blank.pop() <= 1
    assert toxicity.predict(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.predict(docs, labels.limit(0)).collect()} == {0.5}
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    assert [c for c in scored.columns if c != "toxicity"] == [c for c in docs.columns if c != "toxicity"]


def test_the_state_stays_off_the_driver(spark, frame, rows, monkeypatch):
    """Whatever the shards move, the driver gets the weights that are not zero and broadcasts nothing."""
    from pyspark import SparkContext
    from pyspark.sql.classic.dataframe import DataFrame

    got, sent = [], []
    collect, broadcast = DataFrame.collect, SparkContext.broadcast

    def counted(self):
        out = collect(self)
        got.append(sum(len(x) for r in out for x in r if isinstance(x, (bytes, bytearray))))
        return out

    monkeypatch.setattr(DataFrame, "collect", counted)
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, x: sent.append(x) or broadcast(self, x))
    model = toxicity.train(frame([r[:2] for r in rows]), marks(spark, rows), shard_rows=150)
    assert len(model.buckets) and sum(got) <= 16 * (len(model.buckets) + 1) and not sent
