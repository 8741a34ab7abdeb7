"""The pipeline, stage by stage."""

import re

from pyspark import SparkContext

import corpus_pipeline
from pressmill.llm import ngram_join, packing, substring_dedup
from pressmill.llm.common import stage
from tests.llm.conftest import prose
from tests.llm.test_near_copies import brute_components


def squeezed(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def test_stages_against_brute_force(spark, sf_dir):
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs.collect()]
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, sf_dir))
        kept.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    read, known, exact, near, cut, packed = kept
    letters = {r.doc_id for r in read if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in known} <= letters and len(known) >= 0.99 * len(letters)
    groups = {}
    for r in known:
        groups.setdefault(squeezed(r.text), []).append((-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in exact) == sorted(min(g)[1] for g in groups.values())
    linked = brute_components([(r.doc_id, r.text) for r in exact])
    assert sorted(r.doc_id for r in near) == sorted(d for d, _, c in linked if d == c)
    assert sorted(r.doc_id for r in cut) == sorted(r.doc_id for r in near)
    before = {r.doc_id: r.text for r in near}
    assert all(len(r.text) == r.n_chars <= len(before[r.doc_id]) for r in cut)
    assert {r.doc_id for r in packed} == {r.doc_id for r in cut}


def test_odd_and_empty_tables(spark, frame, odd_rows, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = [*odd_rows, *((100 + k, prose(k, 30)) for k in range(5))]
    for df in (frame(rows), frame(rows).limit(0)):
        docs = df.select(*columns)
        for _, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, ""))
        assert docs.count() >= 0


def test_run_is_registered(spark, sf_dir):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert len([q for q in __spark_entry__.queries() if re.match(r"op\d+_", q)]) == 10


def test_copies_under_one_id_go(spark, frame):
    """Repeated rows, null ids, and one id with several texts: the rows that stay, not their ids."""
    base = prose(1, 80)
    near, other = f"{base} one more word", f"near {base}"
    rows = [
        (1, base), (1, base), (1, prose(2, 50)), (1, prose(2, 50).replace(" ", "  ")), (2, near), (None, base),
        (None, prose(3, 60)), (None, prose(3, 60)), (None, prose(4, 60)), (None, f"{prose(4, 60)} end"),
        (None, other), (3, None), (None, ""),
    ]
    docs = stage(frame(rows).select("doc_id", "text", "lang", "source", "n_chars"))
    exact = stage(corpus_pipeline.drop_exact_copies(spark, docs, ""))
    want = [
        (1, base), (1, prose(2, 50).replace(" ", "  ")), (2, near), (None, prose(3, 60)), (None, prose(4, 60)),
        (None, f"{prose(4, 60)} end"), (None, other), (3, None),
    ]
    assert sorted(((r.doc_id, r.text) for r in exact.collect()), key=str) == sorted(want, key=str)
    for df in (docs, exact):
        found = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()]
        with_words = [t for _, t in found if t]
        assert [t for t in with_words if t in (base, near, other)] == [base]
        assert sum(t.split() == prose(2, 50).split() for t in with_words) == 1
        assert with_words.count(prose(3, 60)) == 1 and sum(t.startswith(prose(4, 60)) for t in with_words) == 1
        assert len(with_words) == 4 and len(found) - 4 == (2 if df is docs else 1)


def test_no_rows_of_the_driver_start_workers_of_their_own(spark, frame, monkeypatch):
    """Workers for local rows would stay beside those that the stages use."""
    base = prose(1, 80)
    docs = stage(frame([(1, base), (2, f"{base} end"), (3, f"{prose(2, 30)} {base}"), (4, None), (5, prose(3, 60))]))

    def refused(*_):
        raise AssertionError("local rows go through Python workers")

    monkeypatch.setattr(SparkContext, "parallelize", refused)
    linked = {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs).collect()}
    assert linked == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    removed = {r.doc_id: r.removed_words for r in substring_dedup.cut_repeats(docs).collect()}
    assert removed[1] == removed[4] == removed[5] == 0 and removed[2] >= 80 and removed[3] == 80
    for df in (docs, docs.limit(0)):
        assert packing.pack_documents(df).count() == df.count()
