"""Sharding, fingerprints and language ID."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmill.llm import fingerprints, language_id, sharding
from tests.llm.conftest import prose

# -- shards -----------------------------------------------------------------------


def check_shards(rows, found):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    slots, of_text, text = defaultdict(list), defaultdict(set), {d: t or "" for d, t in rows}
    for r in found:
        slots[r.shard].append(r.slot)
        of_text[text[r.doc_id]].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())
    return Counter({k: sum(r.size for r in found if r.shard == k) for k in range(16)})


def test_shards_are_even(frame):
    rows = [(k, prose(k // 2, 20 + k % 90)) for k in range(600)]
    loads = check_shards(rows, sharding.shard_documents(frame(rows)).collect())
    assert max(loads.values()) - min(loads.values()) < 0.01 * max(loads.values())


def test_shards_through_bundles(frame):
    small = sharding.Limits(giants=2, part_items=80, bundles=30, singles=10, heap_items=200)
    rows = [(k, prose(k, 20 + k % 90)) for k in range(500)] + [(1000 + k, "hot text " * 200) for k in range(20)]
    loads = check_shards(rows, sharding.shard_documents(frame(rows), limits=small).collect())
    rest = sorted(loads.values())[:-1]
    assert rest[-1] - rest[0] < 0.2 * rest[-1]


def test_shards_of_odd_rows(frame, odd_rows):
    check_shards(odd_rows, sharding.shard_documents(frame(odd_rows)).collect())
    assert sharding.shard_documents(frame([(1, "a")]).limit(0)).count() == 0


def test_longest_first_is_the_heap_rule():
    sizes = sorted(np.random.default_rng(1).integers(1, 1000, 300).tolist(), reverse=True)
    loads = [0] * 7
    for size, k in zip(sizes, sharding.longest_first(sizes, 7), strict=True):
        assert loads[k] == min(loads)
        loads[k] += size


# -- fingerprints -------------------------------------------------------------------


def bag(text):
    return Counter(re.findall("[^\x20\x09-\x0d]+", text or "")) or Counter({"": 1})


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))


def test_collisions_estimate_generalised_jaccard(frame):
    rows = [(k, prose(k % 7, 80) + " " + prose(k, 60)) for k in range(40)]
    found = {r.doc_id: r for r in fingerprints.compare_edits(frame(rows), samples=256).collect()}
    errors = []
    for (d, t), (_, n) in zip(in_order(rows), in_order(rows)[1:] + in_order(rows)[:1], strict=True):
        k = len(t) // 3
        changed = t[: len(t) - k] + n[:k]
        assert found[d].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        errors.append(found[d].near_edited - jaccard(bag(t), bag(changed)))
        errors.append(found[d].near_next - jaccard(bag(t), bag(n)))
    assert max(map(abs, errors)) < 0.15 and abs(np.mean(errors)) < 0.015


def test_prints_of_odd_rows(frame, odd_rows):
    rows = [(k if k is not None else None, t) for k, t in odd_rows]
    found = fingerprints.compare_edits(frame(rows)).collect()
    assert Counter((r.doc_id, r.n_chars) for r in found) == Counter((d, len(t or "")) for d, t in rows)
    of = defaultdict(set)
    text = {d: t for d, t in rows}
    for r in found:
        of[text[r.doc_id] or ""].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(x) == 1 for x in of.values())
    assert of[""] == of[" \t\n"]
    order = in_order(rows)
    following = {d: n for (d, _), (_, n) in zip(order, order[1:] + order[:1], strict=True)}
    for r in found:
        if r.doc_id != 5:
            t, n = text[r.doc_id] or "", following[r.doc_id] or ""
            changed = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
            assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()


def test_few_prints(frame):
    assert fingerprints.compare_edits(frame([(1, "a")]).limit(0)).count() == 0
    (alone,) = fingerprints.compare_edits(frame([(1, "one two three four")])).collect()
    assert alone.near_next == 1.0
    assert fingerprints.compare_edits(frame([(None, "a b c"), (None, "d e f")])).count() == 2


def test_no_python_in_the_plan(frame):
    df = fingerprints.compare_edits(frame([(1, "a b"), (2, "c")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- languages ------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 7, 20])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    assert len(code) == n and len({tuple(c) for c in code}) == n
    if n > 2:
        assert (np.abs(code.sum(axis=0)) < n).all() and language_id._distance(code) >= 2
    if n == 4:
        assert language_id._distance(code) == 4


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    joined = language_id.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in joined if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in joined)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in joined)


def test_flipped_bits_are_mended_or_flagged():
    code = language_id.codewords(4)
    model = language_id.Model(list("abcd"), code, np.zeros((1, 7)), np.ones(7), 4.0)
    found = code.astype(float)
    found[0, 0] *= -1  # one wrong bit can be mended
    found[1, :2] *= -1  # two can't
    best, score, unsure = language_id.decode(found, model)
    assert best[0] == 0 and best[2:].tolist() == [2, 3] and unsure.tolist()[1:] == [True, False, False]
    assert not unsure[0] and (score > 0).all()


def test_odd_texts_and_labels(frame, odd_rows):
    rows = [(d, t, "en" if k % 2 else None, None) for k, (d, t) in enumerate(odd_rows)]
    found = {r.doc_id: r for r in language_id.predict(frame(rows)).collect()}
    for d in (1, 2, 3, 12):
        assert (found[d].lang_pred, found[d].score) == ("und", 0.0)
    assert found[6].lang_pred == found[11].lang_pred == "en"
    nothing = [(d, t, None, None) for d, t in odd_rows]
    assert {r.lang_pred for r in language_id.predict(frame(nothing)).collect()} == {"und"}
    assert language_id.predict(frame([(1, "a")]).limit(0)).count() == 0


def test_whole_texts_decide(frame):
    """What stands far behind counts as much as the front."""
    en, de = "the thing with that other " * 40, "der zug nach dem und eine schule " * 40
    rows = [(k, (en, de)[k % 2] + str(k), ("en", "de")[k % 2], "s") for k in range(60)]
    model = language_id.train(frame(rows), F.lit(True))
    mixed = frame([(1, en + de * 2_000, None, None), (2, de + en * 2_000, None, None)])
    found = {r.doc_id: r for r in language_id.identify(mixed, model).collect()}
    assert (found[1].lang_pred, found[2].lang_pred) == ("de", "en") and found[1].key == "k"
