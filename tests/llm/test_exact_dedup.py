import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmill.llm.common import stage
from pressmill.llm.exact_dedup import (
    PRIME,
    build_index,
    digests,
    exact_dedup,
    grouped,
    look_up,
    perfect_hash,
)


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        key = hashlib.sha256(re.sub("[\x20\x09-\x0d]", "", text or "").encode()).hexdigest()
        groups.setdefault(key, []).append((doc_id, len(text or "")))
    out = []
    for key, members in groups.items():
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        out += [(doc_id, best, len(members), key) for doc_id, _ in members]
    return sorted(out, key=str)


def got(df):
    rows = df.collect()
    return rows, sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=str)


@pytest.mark.parametrize("m", [1, 2, 5, 300, 4096])
def test_hash_is_minimal_and_perfect(m):
    rng = np.random.default_rng(m)
    b, x, y = (rng.integers(0, PRIME, m) for _ in range(3))
    pilots, slots = perfect_hash(b, x, y)
    assert sorted(slots) == list(range(m))
    pilot = pilots[b % m].astype(np.int64)
    assert (np.where(pilot < 0, -pilot - 1, (x + pilot * y) % PRIME % m) == slots).all()


@pytest.mark.parametrize("is_old", [None, "true", "false", "doc_id > 100"])
def test_groups_whatever_is_history(frame, odd_rows, is_old):
    rng = random.Random(3)
    rows = odd_rows + [(i, rng.choice("abc") * 3 + " " * rng.randint(0, 3)) for i in range(100, 160)]
    found, told = got(exact_dedup(frame(rows), is_old and F.expr(is_old)))
    assert told == expected(rows)
    kept = {}
    for r in found:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_lookup_tells_members_from_others_by_their_bytes(frame):
    both = stage(digests(frame([(i, f"text {i}") for i in range(400)]), F.col("doc_id") < 300))
    index, parts = build_index(grouped(both.where("old")))
    looked = look_up(grouped(both), index, parts)
    assert looked.where("slot IS NOT NULL").count() == 300 and looked.count() == 400
    there = index.select("part", F.col("at").cast("long").alias("slot"), F.col("digest").alias("held"))
    assert looked.join(there, ["part", "slot"]).where("digest = held").count() == 300


def test_empty(frame):
    assert exact_dedup(frame([(1, "a")]).limit(0)).count() == 0
