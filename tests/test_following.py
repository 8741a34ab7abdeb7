"""Follow-up links to the end, against a plain search."""

import random

import pytest

from pressmill.operators.following import page_graph, reachable_pages


def reach(stored, edges, starts):
    stored, seen = set(stored), set()
    todo = [s for s in starts if s in stored]
    while todo:
        at = todo.pop()
        if at not in seen:
            seen.add(at)
            todo += [b for a, b in edges if a == at and b in stored]
    return seen


def found(spark, stored, edges, starts):
    pages = spark.createDataFrame([(u, "x") for u in stored], "url string, html string")
    links = spark.createDataFrame(list(edges), "page_url string, url string")
    begin = spark.createDataFrame([(u,) for u in starts], "url string")
    rows = [r.url for r in reachable_pages(pages, links, begin).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_a_long_chain_takes_few_rounds(spark):
    """3,000 pages in a row, one start in the middle of another chain, pages that lead nowhere."""
    stored = [f"p{k}" for k in range(3000)] + [f"q{k}" for k in range(50)]
    edges = [(f"p{k}", f"p{k + 1}") for k in range(3000)] + [(f"q{k}", f"q{k + 1}") for k in range(49)]
    assert found(spark, stored, edges, ["p0", "q20", "unknown"]) == {
        *(f"p{k}" for k in range(3000)), *(f"q{k}" for k in range(20, 50)),
    }


def test_rings_and_hubs(spark):
    ring = [(f"r{k}", f"r{(k + 1) % 9}") for k in range(9)]  # nothing leads in
    entered = [(f"s{k}", f"s{(k + 1) % 9}") for k in range(9)] + [("a", "s4")]
    hub = [("a", f"h{k}") for k in range(300)] + [(f"h{k}", "a") for k in range(300)]
    hub += [(f"h{k}", f"t{k}") for k in range(0, 300, 3)]
    edges = ring + entered + hub + [("a", "a"), ("t0", "b"), ("t0", "b"), ("b", "r_out")]
    stored = sorted({x for e in edges for x in e} - {"r_out"})
    assert found(spark, stored, edges, ["a"]) == reach(stored, edges, ["a"])
    assert found(spark, stored, edges, ["r3"]) == {f"r{k}" for k in range(9)}


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    names = [f"n{k}" for k in range(60)]
    edges = [(rng.choice(names), rng.choice(names)) for _ in range(rng.choice([30, 60, 90]))]
    stored, starts = rng.sample(names, 50), rng.sample(names, 3)
    assert found(spark, stored, edges, starts) == reach(stored, edges, starts)


def test_fragments_nulls_and_repeats(spark):
    pages = spark.createDataFrame([("u1#a",), ("u1",), ("u2",), (None,), ("u3",)], "url string")
    links = spark.createDataFrame(
        [("u1#a", "u2#x"), ("u1", "u2"), (None, "u3"), ("u2", None)], "page_url string, url string"
    )
    starts = spark.createDataFrame([("u1#top",), (None,)], "url string")
    assert sorted(r.url for r in reachable_pages(pages, links, starts).collect()) == ["u1", "u2"]
    assert [tuple(r) for r in page_graph(pages, links).collect()] == [("u1", "u2")]
    assert reachable_pages(pages.limit(0), links, starts).count() == 0
    assert reachable_pages(pages, links.limit(0), starts).count() == 1
