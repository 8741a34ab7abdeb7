"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from pressmill.llm import periodic_runs
from pressmill.llm.periodic_runs import Wanted, runs_of


def brute(words, least=24, periods=3):
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, periods * q):
                # a multiple of the smallest period gives the same stretch once more
                if not any(q % p == 0 and s <= i and j + q <= s + size for s, size, p in out):
                    out.append((i, j + q - i, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng, n):
    k = rng.choice([1, 2, 3, 5, 50])
    words = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n:
            a, p = rng.randrange(n), 1 + rng.randrange(max(1, n // 3))
            for i in range(a, rng.randrange(a, n) + 1):
                words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("least, periods", [(24, 3), (6, 2), (4, 3), (1, 2), (10, 4)])
def test_runs_equal_brute_force(least, periods):
    rng = random.Random(least)
    for _ in range(150):
        texts = [random_words(rng, rng.choice([0, 1, 3, 10, 30, 80, 150])) for _ in range(rng.randint(1, 6))]
        assert runs_of(texts, Wanted(least, periods)) == [brute(t, least, periods) for t in texts]


def test_texts_share_nothing():
    one = list(range(12))
    assert runs_of([one, one, one]) == [[], [], []]
    assert runs_of([one * 3, one, []]) == [[(0, 36, 12)], [], []]


def test_long_texts():
    rng = random.Random(1)
    piece = [rng.randrange(100) for _ in range(9_000)]
    assert runs_of([["a"] * 60_000, piece * 4 + ["end"]]) == [[(0, 60_000, 1)], [(0, 36_000, 9_000)]]


def expected(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words) if len(set(words)) < n else []
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (
        doc_id, len(runs), *best, None if not runs else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def test_query_equals_brute_force(frame, odd_rows):
    rng = random.Random(3)
    rows = [r for r in odd_rows if len(r[1] or "") < 100_000]
    for k in range(20, 320):
        words = [f"w{x}" for x in random_words(rng, rng.choice([5, 40, 200]))]
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(words)))
    found = periodic_runs.run_digests(frame(rows)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr(expected(*r)) for r in rows)
    assert sum(r.n_runs for r in found) > 20


def test_long_and_odd_rows_with_other_columns(frame, odd_rows):
    docs = frame(odd_rows).withColumnsRenamed({"label": "runs", "key": "best", "part": "collapsed", "ids": "k0"})
    found = periodic_runs.collapse_runs(docs, kept=("doc_id", "n_chars")).collect()
    assert len(found) == len(odd_rows) and found[0].__fields__ == ["doc_id", "n_chars", "n_words", "runs", "collapsed"]
    by_id = {r.doc_id: r for r in found}
    assert by_id[13].collapsed == "in" and by_id[13].runs[0].asDict() == {"start": 0, "length": 500, "period": 1}
    assert by_id[1].n_words == 0 and by_id[1].collapsed == ""
    assert periodic_runs.run_digests(docs).count() == len(odd_rows)
    assert periodic_runs.run_digests(docs.limit(0)).count() == 0


def test_blocks_do_not_change_runs(frame, monkeypatch):
    rng = random.Random(8)
    rows = [(k, " ".join(f"w{x}" for x in random_words(rng, 120))) for k in range(40)]
    whole = sorted(periodic_runs.run_digests(frame(rows)).collect(), key=repr)
    assert [r.n_runs for r in whole].count(0) < 40
    assert whole == sorted(periodic_runs.run_digests(frame(rows).repartition(11)).collect(), key=repr)
