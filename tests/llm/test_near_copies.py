"""N-gram join, substring dedup and line dedup against brute force."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressmill.llm import components as rounds
from pressmill.llm import line_dedup, ngram_join, substring_dedup
from pressmill.llm.components import components
from pressmill.llm.shingles import shingle_set
from tests.llm.conftest import prose


def shingles(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (i, (_, a)), (j, (_, b)) in combinations(enumerate(sets), 2):
        both = len(a & b)
        if both and 100 * both >= 80 * len(a | b):
            parent[root(i)] = root(j)
    least = {}
    for k, (d, _) in enumerate(sets):
        if d is not None:
            least[root(k)] = min(least.get(root(k), d), d)
    return sorted(((d, len(s), least.get(root(k)) if s else d) for k, (d, s) in enumerate(sets)), key=str)


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def near_copies(seed):
    """Chains and stars of copies with more and more edits, passages in common, and others."""
    rng = random.Random(seed)
    rows, base = [], prose(seed, 120)
    for _ in range(60):
        rows.append(edited(base, rng, rng.randint(0, 4)))
    chain = prose(seed + 1, 150)
    for _ in range(15):
        chain = edited(chain, rng, 2)
        rows.append(chain)
    passage = prose(seed + 2, 60)
    rows += [f"{prose(seed + 10 + k, 30)} {passage} {prose(seed + 50 + k, 20)}" for k in range(20)]
    rows += [prose(seed + 100 + k, rng.randint(1, 60)) for k in range(40)]
    rows += [rows[3].upper().replace(" ", "\n"), "in " * 40, "in " * 41]
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(frame, seed):
    rows = near_copies(seed)
    found = ngram_join.ngram_components(frame(rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute_components(rows)


def test_components_without_hub_rounds(frame, monkeypatch):
    """The block step alone loses nothing."""
    monkeypatch.setattr(ngram_join, "HUB_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rows = near_copies(5)
    found = ngram_join.ngram_components(frame(rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute_components(rows)


def test_odd_rows(frame, odd_rows):
    found = ngram_join.ngram_components(frame(odd_rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute_components(odd_rows)
    assert ngram_join.ngram_components(frame([(1, "a")]).limit(0)).count() == 0
    assert [tuple(r) for r in ngram_join.ngram_components(frame([(3, None)])).collect()] == [(3, 0, 3)]


def test_shingle_counts_reach_the_driver_packed(frame, monkeypatch):
    """In few rows, with the number of sets that each bucket's shingles are in."""
    from pyspark.sql.classic.dataframe import DataFrame

    texts, got, collect = [prose(k, 100) for k in range(50)] + [None, ""], [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: got.append(collect(self)) or got[-1])
    monkeypatch.setattr(DataFrame, "toPandas", None)
    found = ngram_join.shingle_counts(frame(list(enumerate(texts))))
    want = np.zeros(ngram_join.BUCKETS, np.int64)
    for t in texts:
        np.add.at(want, (shingle_set(t) >> np.uint64(46)).astype(np.int64), 1)
    assert (found == want).all() and want.sum() > 4000 and len(got[0]) <= 64
    empty = ngram_join.shingle_counts(frame([(1, "a")]).limit(0))
    assert len(empty) == ngram_join.BUCKETS and not empty.any()


def test_texts_of_rows_without_ids_are_fetched_once(frame, monkeypatch):
    """Not once for each other row without an id, and one for rows that repeat."""
    base = prose(7, 60).split()
    texts = [" ".join([*base, f"own{k}"]) for k in range(40)]
    rows = [(None, x) for x in texts] + [(None, texts[0])] * 5 + [(3, texts[1] + " b"), (3, texts[2] + " c")]
    fetched = []
    real = ngram_join._texts_of

    def counted(*args):
        found = real(*args)
        fetched.append((found.count(), found.select("cls").distinct().count()))
        return found

    monkeypatch.setattr(ngram_join, "_texts_of", counted)
    found = ngram_join.ngram_components(frame(rows)).collect()
    assert {r["component_id"] for r in found} == {3} and len(found) == len(rows)
    rows_fetched, classes = fetched[0]
    assert classes == 42 and rows_fetched <= 42 + 5


@given(st.integers(1, 300), st.integers(0, 300), st.integers(0, 300), st.integers(0, 2**32))
@settings(max_examples=200, deadline=None)
def test_signatures_bound_the_overlap(common, only_a, only_b, seed):
    x = np.unique(np.random.default_rng(seed).integers(0, 2**63, common + only_a + only_b).astype(np.uint64))
    rng = np.random.default_rng(seed + 1)
    rng.shuffle(x)
    a, b = np.sort(x[: common + only_a]), np.sort(np.concatenate([x[:common], x[common + only_a :]]))
    u, v = ngram_join.folded([ngram_join.signature(a), ngram_join.signature(b)])
    bits = int(np.bitwise_count(u ^ v).sum())
    assert bits <= only_a + only_b
    if ngram_join.agree(a, b):
        assert ngram_join.may_agree(np.array([bits]), np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(ngram_join.band(len(a)) - ngram_join.band(len(b))) <= 1


def test_shingles_are_those_of_the_words():
    for text in ("", None, "a", "A b", "one two three four five", "x y " * 9, prose(1, 300)):
        assert len(shingle_set(text)) == len(shingles(text))


def test_stars_find_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(500 + k, 501 + k) for k in range(60)]
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    want = {k: root(k) for k in list(parent) if root(k) != k}
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.vertex: r.component for r in found} == want and len(found) == len(want)


def test_stars_need_no_round_and_none_is_made_to_see_that_it_is_over(spark, monkeypatch):
    made = []
    monkeypatch.setattr(rounds, "stage", lambda df, stage=rounds.stage: made.append(df) or stage(df))
    star = [(k, 1) for k in range(2, 40)] + [(50, 49), (3, 1)]
    for edges, most in ((star, 1), (star[:0], 1), ([(3, 2), (2, 1)], 2)):
        made.clear()
        found = components(spark.createDataFrame(edges, "u long, v long")).collect()
        assert {(r.vertex, r.component) for r in found} == ({(3, 1), (2, 1)} if most == 2 else set(edges))
        assert len(made) == most


# -- passages -------------------------------------------------------------------


def test_bands_reach_the_recall():
    bands, rows = substring_dedup.tune_bands()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.95 and bands <= 4


def test_bands_are_strict():
    """One-row bands fill buckets with paragraphs that share one frequent shingle."""
    assert substring_dedup.tune_bands() == (3, 2)


def test_planted_passages_go_and_clean_documents_stay(frame):
    rows = []
    for k in range(30):
        passage = prose(1000 + k % 10, 55 + 5 * (k % 10))
        rows.append((k, f"{prose(k, 40)} {passage.replace(' ', chr(10) if k % 3 else ' ')} {prose(200 + k, 50)}"))
    common = "This line of thirteen words stands in very many of the documents here."
    clean = [(100 + k, f"{prose(400 + k, 60)}\n{common}\n{prose(500 + k, 60)}") for k in range(30)]
    cut = {r.doc_id: r for r in substring_dedup.cut_repeats(frame(rows + clean)).collect()}
    for k, text in rows:
        r = cut[k]
        if k < 10:
            assert r.text == text and not r.spans
        else:
            # At its ends a passage may have a paragraph that only two of the copies share.
            assert r.removed_words >= 25 and all({*s.kept_in} <= {k % 10, k % 10 + 10} for s in r.spans)
            for s in r.spans:
                assert text[s.start : s.stop] == s.passage and len(s.passage.split()) == s.words
            assert len(r.text) == len(text) - sum(len(s.passage) for s in r.spans)
    for k, text in clean:
        assert cut[k].text == text
    assert cut[0].key == "k" and cut[0].doc == "y"


def test_paragraphs_do_not_depend_on_what_is_around():
    passage = prose(7, 120)
    whole = set(substring_dedup.paragraphs(passage).ids)
    inside = set(substring_dedup.paragraphs(f"{prose(8, 77)} {passage} {prose(9, 50)}").ids)
    assert len(whole & inside) >= len(whole) - 4


def test_a_paragraph_with_other_ends_is_linked(frame):
    """Different classes meet in a band and are told alike by their sets."""
    found = substring_dedup.cut_repeats(frame([(1, "go " * 300), (2, "go " * 200)])).collect()
    assert {r.doc_id: r.removed_words for r in found} == {1: 0, 2: 200}


def test_odd_documents_keep_their_text(frame, odd_rows):
    cut = substring_dedup.cut_repeats(frame(odd_rows))
    found = sorted(((r.doc_id, r.text, r.removed_words) for r in cut.collect()), key=str)
    want = [(d, t, 0) for d, t in odd_rows if d != 5]
    assert [f for f in found if f[0] != 5] == sorted(want, key=str)
    assert all(f[2] > 50_000 for f in found if f[0] == 5)
    assert substring_dedup.removed_passages(frame([(1, "a")]).limit(0)).count() == 0


def test_passages_go_whole(frame):
    """Pasted into running text, of any length from 16 words on, also where a third text has
    parts of them."""
    rows, planted = [], {}
    for k in range(40):
        passage = prose(3000 + k, 16 + 2 * k)
        head = " ".join(passage.split()[: 8 + k])
        rows.append((k, f"{prose(4000 + k, 30)} first{k} {head} cut{k} {prose(5000 + k, 30)}"))
        rows.append((100 + k, f"{prose(6000 + k, 40)} second{k} {passage} to{k} {prose(7000 + k, 20)}"))
        rows.append((200 + k, f"{prose(8000 + k, 25)} third{k} {passage} on{k} {prose(9000 + k, 45)}"))
        planted[200 + k] = passage
    cut = {r.doc_id: r for r in substring_dedup.cut_repeats(frame(rows)).collect()}
    for doc, passage in planted.items():
        assert [s.passage for s in cut[doc].spans] == [passage]
    assert all(cut[k].removed_words == 0 for k in range(40))


def test_passages_under_one_id_and_without_ids_go(frame):
    a, b = prose(71, 60), prose(72, 60)
    rows = [(1, f"x1 {a} y1"), (1, f"x2 {b} {a} y2"), (None, f"x3 {b} y3"), (None, f"x4 {prose(73, 60)} y4"),
            (None, f"x5 {prose(73, 60)} y5")]
    cut = [(r.doc_id, r.text, [s.kept_in for s in r.spans]) for r in substring_dedup.cut_repeats(frame(rows)).collect()]
    assert sum(a in t for _, t, _ in cut) == sum(b in t for _, t, _ in cut) == 1
    assert sum(prose(73, 60) in t for _, t, _ in cut) == 1
    assert sorted((k for _, _, k in cut if k), key=str) == [[[1]], [[1]], [[None]]]


def test_texts_are_read_together(monkeypatch):
    """Many texts take no more steps than one, and none sees its neighbours' words."""
    texts = [prose(k, 3 + 7 * (k % 20)) + "\n" * (k % 3) + prose(5 + k % 9, 20) for k in range(200)]
    texts += [None, "", "\n", texts[3], "é " * 40]
    calls, real = [], substring_dedup.mixed
    monkeypatch.setattr(substring_dedup, "mixed", lambda x: calls.append(1) or real(x))

    def met(some, first):
        columns = [pa.array(some, pa.string()), pa.array(np.arange(first, first + len(some)))]
        batch = pa.RecordBatch.from_arrays(columns, ["text", "owner"])
        (found,) = list(substring_dedup._meeting_keys(*substring_dedup.tune_bands(), 1)([batch])) or [None]
        if found is None:
            return set()
        told = [np.frombuffer(x, np.int64).reshape(2, -1).T for c in ("packed", "met") for x in found.column(c).to_pylist()]
        return {tuple(x) for rows in told for x in rows.tolist()}

    together = met(texts, 0)
    steps = len(calls)
    alone = [met([t], k) for k, t in enumerate(texts)]
    assert together == set().union(*alone) and len(together) > 2000
    assert steps <= 2 * max(1, (len(calls) - steps) // len(texts))


@pytest.mark.parametrize("hubs", [0, 2])
def test_families_of_paragraphs_are_linked(frame, monkeypatch, hubs):
    """Of many variants of a line only one stays whole for each component of all pairs."""
    monkeypatch.setattr(ngram_join, "HUB_ROUNDS", hubs)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng, rows = random.Random(3), []
    for family in range(5):
        base = f"one and the same five words {prose(40 + family, 130)}"
        rows += [edited(base, rng, 1 + (k % 3 == 0)) for k in range(36)]
    rows = list(enumerate(rows))
    least = {d: c for d, _, c in brute_components(rows)}
    texts = [(d, f"{prose(20_000 + d, 12)}\n{t}\n{prose(30_000 + d, 12)}") for d, t in rows]
    cut = {r.doc_id: r for r in substring_dedup.cut_repeats(frame(texts)).collect()}
    whole = {d for d, t in rows if any(t in s.passage for s in cut[d].spans)}
    want = {d for d in least if least[d] != d}
    assert len(want) > 100 and whole <= want and len(want - whole) <= 0.05 * len(want)


# -- lines ----------------------------------------------------------------------


def test_lines_of_many_sites_go(frame):
    rows = []
    for k in range(60):
        text = f"own {k}\n  wide line \n\nnear {k % 5}"
        rows.append((k, text + ("\nlocal" if k % 20 < 9 else ""), "en", f"s{k % 20}"))
    rows += [(100, None, "en", "s1"), (101, "", None, None), (102, "wide line", "en", None)]
    rows += [(200 + k, "nowhere", "en", None) for k in range(50)]
    found = {r.doc_id: r for r in line_dedup.remove_wide_lines(frame(rows)).collect()}
    assert found[0].text == "own 0\n\nnear 0\nlocal" and (found[0].n_lines, found[0].n_removed) == (5, 1)
    assert found[100].text is None and found[100].n_lines == 0
    assert found[101].text == "" and found[102].text == "" and found[102].n_removed == 1
    assert found[200].text == "nowhere" and found[0].key == "k" and len(found) == len(rows)
    assert line_dedup.remove_wide_lines(frame([(1, "a")]).limit(0)).count() == 0


@pytest.mark.parametrize("sites", [9, 10, 11])
def test_lines_at_the_threshold_are_counted_exactly(frame, sites):
    rows = [(k, f"line\nown {k}", "en", f"s{k}") for k in range(sites)]
    gone = line_dedup.remove_wide_lines(frame(rows)).where("n_removed = 1").count()
    assert gone == (sites if sites >= 10 else 0)


def test_line_keys_are_two_hashes(frame):
    """The second is no function of the first."""
    k1, k2 = line_dedup._keys(F.col("text"))
    chained = F.xxhash64("text", F.lit("line"))
    rows = frame([(k, f"line {k}") for k in range(20)]).select(k1, k2, chained.alias("chained")).collect()
    assert all(len({r.k1, r.k2, r.chained}) == 3 for r in rows)


def test_line_dedup_odd_rows_and_names(frame):
    """Very long texts, repeated rows and null ids; columns may have the names used on the way."""
    text = "wide\n" + "\n".join(f"own {k}" for k in range(20_000))
    rows = [(k, f"wide\nmine {k}", "en", f"s{k}") for k in range(12)]
    rows += [(None, "wide\nno id", "en", "s1"), (None, "wide\nnor this", "en", "s2"), (50, text, "en", "s3")] * 2
    names = ("_id", "_text", "_drops", "_at", "id", "hash", "drops", "line", "k1", "k2", "at", "doc", "gone")
    docs = frame(rows)
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    found = line_dedup.remove_wide_lines(docs).collect()
    assert len(found) == len(rows) and all(r[name] == name for r in found for name in names)
    assert all(r.n_removed == 1 and not r.text.startswith("wide") for r in found)
    assert sorted(r.text for r in found if r.doc_id is None) == ["no id"] * 2 + ["nor this"] * 2
    assert {len(r.text) for r in found if r.doc_id == 50} == {len(text) - 5}


def test_passages_are_cut_from_few_documents_at_once():
    rows, passage = 3 * substring_dedup.CUT_DOCUMENTS + 5, prose(5, 40)
    pieces, _ = substring_dedup.Block([passage.encode()]).windows()
    drops = [{"piece": int(p), "keeper": 7} for p in pieces]
    own = [prose(100 + k, 5) for k in range(rows)]
    kind = pa.list_(pa.struct([("piece", pa.int64()), ("keeper", pa.int64())]))
    columns = [
        pa.array(range(rows)),
        pa.array([None if k % 5 == 0 else f"{t} {passage}" for k, t in enumerate(own)]),
        pa.array([drops if k % 3 else None for k in range(rows)], kind),
    ]
    batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "_drops"])
    made = list(substring_dedup._without_drops(["doc_id", "text"])([batch]))
    assert max(x.num_rows for x in made) <= substring_dedup.CUT_DOCUMENTS
    cut = pa.Table.from_batches(made).to_pylist()
    assert [r["doc_id"] for r in cut] == list(range(rows))
    for k, r in enumerate(cut):
        if k % 5 == 0:
            assert (r["text"], r["removed_words"], r["spans"]) == (None, 0, [])
        elif k % 3 == 0:
            assert (r["text"], r["removed_words"], r["spans"]) == (f"{own[k]} {passage}", 0, [])
        else:
            (span,) = r["spans"]
            assert (r["text"], r["removed_words"], span["passage"]) == (f"{own[k]} ", 40, passage)
            assert (span["start"], span["kept_in"]) == (len(own[k]) + 1, [7])
