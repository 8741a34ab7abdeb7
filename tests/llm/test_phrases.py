"""Phrase mining against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pressmill.llm import collocations as C


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, top, least, longest=4):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", fold(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        outer = Counter()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    outer[p[i : i + size]] = max(outer[p[i : i + size]], a)
        kept = []
        for p, a in found.items():
            score, _, le, r = min(
                (2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]])
                for k in range(1, len(p))
            )
            if 100 * outer[p] < 80 * a:
                kept.append((-score, -a, " ".join(p).encode(), le, r))
        for rank, (score, a, p, le, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, le, r, n[lang], -score))
    return sorted(out)


def speech(rng, words, stock):
    out = []
    while len(out) < words:
        if rng.random() < 0.4:
            out += rng.choice(stock)
        else:
            out.append(rng.choice("the of und it Ä x1 go no on at is".split()))
        if rng.random() < 0.15:
            out[-1] += rng.choice([".", ",", ";", "!\n", ":", "\x0b", "?"])
    return rng.choice([" ", "  ", "\t"]).join(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    stock = [[rng.choice("Red blue tall house tree run far sea".split()) for _ in range(rng.randint(2, 6))] for _ in range(25)]
    return [
        *((speech(rng, 60, stock), rng.choice(["en", "en", "en", "de", None, "und"])) for _ in range(90)),
        (None, "en"), ("", "fr"), ("a a a a a a", "fr"), (None, None), ("a,b", "xx"),
    ]


def mined(frame, rows, **kw):
    docs = frame([(k, t, la, "s") for k, (t, la) in enumerate(rows)])
    return sorted(map(tuple, C.mine_phrases(docs, **kw).collect()))


@pytest.mark.parametrize("top, least, ahead", [(2000, 3, 4), (5, 2, 1), (12, 4, 1)])
def test_phrases_equal_brute_force(frame, rows, top, least, ahead):
    found = mined(frame, rows, top=top, least=least, ahead=ahead)
    assert found == brute(rows, top, least)
    assert any(len(r[2].split()) > 2 for r in found)


def test_longer_phrases_and_full_bitmaps(frame, rows, monkeypatch):
    """Parts marked by chance cost rows and change nothing."""
    assert mined(frame, rows, top=30, least=3, longest=5, ahead=1) == brute(rows, 30, 3, 5)
    full = lambda parts, most=0: np.full(4096, 255, dtype=np.uint8)
    monkeypatch.setattr(C, "bitmap", full)
    assert mined(frame, rows, top=30, least=3, ahead=1) == brute(rows, 30, 3)


def test_thresholds_fall_until_enough_survive(frame, monkeypatch):
    """The best pairs are all dropped for longer phrases, so several rounds are needed."""
    rows = [(" ".join(f"a{k} b{k} c{k} d{k}." for k in range(40)), "en")] * 5
    rows += [(" ".join(f"e{k} f{k}. e{k}. f{k}." for k in range(6)), "en")] * 5
    thresholds = []
    plain = C._thresholds
    monkeypatch.setattr(C, "_thresholds", lambda p, w: (thresholds.append(w), plain(p, w))[1])
    assert mined(frame, rows, top=45, least=4, ahead=1) == brute(rows, 45, 4)
    assert len(thresholds) > 1


def test_blocks_do_not_change_counts(frame, rows, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 200)
    assert mined(frame, rows, top=40, least=3) == brute(rows, 40, 3)


def test_odd_tables(frame, odd_rows):
    docs = frame(odd_rows).withColumnsRenamed({"label": "phrase", "key": "f", "part": "threshold", "ids": "salt"})
    found = sorted(map(tuple, C.mine_phrases(docs, least=2).collect()))
    assert found == brute([(r[1], "en") for r in odd_rows], 2000, 2)
    assert C.mine_phrases(docs.limit(0)).count() == 0
    assert C.mine_phrases(docs.where("doc_id = 6")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    found = spark.createDataFrame([("en", "a b", 6 * 10**15)], "lang string, phrase string, f long")
    words = [("en", "a", 7 * 10**15 + 1), ("en", "b", 9 * 10**15)]
    counts = spark.createDataFrame(words, "lang string, phrase string, f long")
    (row,) = C.scored(found, counts, 4).collect()
    assert row.score == 2_000_000 * 6 * 10**15 // (16 * 10**15 + 1)
    assert (row.l, row.r) == (7 * 10**15 + 1, 9 * 10**15)
