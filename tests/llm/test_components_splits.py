"""Union-find, splits and issuers."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components, union_find
from tidemark.llm.splits import assign_splits, example_issuers, issuers, quotas, ranked, symbol_key, water_fill


def plain_components(edges):
    return union_find((a, b) for a, b in edges if a is not None and b is not None)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_components_merged_or_contracted(spark, limit):
    r = random.Random(limit)
    edges = [(f"n{r.randrange(60)}", f"n{r.randrange(60)}") for _ in range(35)] + [("c0", f"c{i}") for i in range(1, 30)] + [(f"p{i}", f"p{i + 1}") for i in range(25)] + [("loop", "loop"), (None, "x"), ("y", None), ("c0", "c1")]
    df = spark.createDataFrame(edges, "a string, b string").repartition(5)
    got = {x["node"]: x["root"] for x in connected_components(df, max_merge_rows=limit).collect()}
    assert got == plain_components(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def one_by_one(deficits, size, count):
    left, given = list(deficits), [0] * len(deficits)
    for _ in range(count):
        at = max(range(len(left)), key=lambda i: (left[i], -i))
        given[at] += 1
        left[at] -= size
    return given, left


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-500, 2000), min_size=2, max_size=4), st.integers(1, 40), st.integers(0, 200))
def test_water_fill_ends_like_the_greedy(deficits, size, count):
    given_, want = water_fill([float(d) for d in deficits], size, count), one_by_one(deficits, size, count)
    assert sum(given_) == count
    assert sorted(d - g * size for d, g in zip(deficits, given_, strict=True)) == sorted(want[1])


def test_quotas_keep_every_group():
    q = quotas([(100, 1), (10, 7), (1, 55)], [0.8, 0.1, 0.1])
    assert [(s, sum(g)) for s, g in q] == [(100, 1), (10, 7), (1, 55)]
    assert q[0][1] == [1, 0, 0]


def test_assign_splits_whole_groups_near_targets(spark):
    sizes = [(f"g{i}", 1 + (i % 7) * (i % 3)) for i in range(500)] + [(None, 300)]
    total = sum(s for _, s in sizes)
    out = assign_splits(spark.createDataFrame(sizes, "g string, n long"), "g", "n", {"train": 0.8, "validation": 0.1, "test": 0.1}).collect()
    assert sorted((r["g"] or "") for r in out) == sorted((g or "") for g, _ in sizes)
    got = Counter()
    for r in out:
        got[r["split"]] += dict(sizes)[r["g"]]
    for s, share in (("train", 0.8), ("validation", 0.1), ("test", 0.1)):
        assert abs(got[s] - share * total) <= 15
    assert assign_splits(spark.createDataFrame([], "g string, n long"), "g", "n", {"a": 1.0}).count() == 0


def test_ranked_is_a_permutation(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("k"), "id")
    out = ranked(df, ["k"], ["id"], "r", buckets=8).collect()
    for k in range(3):
        assert sorted(x["r"] for x in out if x["k"] == k) == list(range(100))


def test_issuers_and_examples(spark):
    t = spark.createDataFrame([(1, "AAAA", "Acme Foods"), (2, "AAAA.B", "ACME  foods - Class B"), (3, "BBBB", "Bcme Foods."), (4, "CCCC", None), (5, "DDDD-B", "Acme Foods Cl. B")], "ticker_id int, symbol string, company_name string")
    assert {r["ticker_id"]: r["issuer"] for r in issuers(t).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1}
    msg = lambda c: [{"role": "system", "content": "x"}, {"role": "user", "content": c}]
    rows = [
        (1, msg("Review: ZZZZ (none)"), {"ticker": " nyse:bbbb "}), (2, msg("INVESTMENT REVIEW: aaaa.b (Acme)\n"), {"ticker": None}), (3, msg("Brief: DDDD-B.US / Acme Foods\n"), None),
        (4, msg("Brief: QQQQ (Bcme Foods)\n"), {"ticker": "$none"}), (5, None, None), (6, [], {"ticker": "$aaaa-B.US"}),
    ]
    ex = spark.createDataFrame(rows, "example_id long, messages array<struct<role:string,content:string>>, metadata struct<ticker:string>")
    assert {r["example_id"]: r["ticker_id"] for r in example_issuers(ex, t).collect()} == {1: 3, 2: 1, 3: 1, 4: 3, 5: None, 6: 1}
    assert example_issuers(ex.where("false"), t).count() == 0
    assert spark.range(1).select(symbol_key(F.lit("")).alias("s")).first()["s"] is None
