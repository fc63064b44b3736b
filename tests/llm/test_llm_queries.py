"""The queries of this package on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from tidemark.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
FOUND = {
    "p2_found": ["name_field", "ticker_id", "name_a", "name_b"], "p4_found": ["id_a", "id_b"], "p6_found": ["example_id", "ticker_id"], "p7_found": ["result_id", "defect_type"], "p8_ids": ["doc_id", "ids"],
    "p10_found": ["doc_id", "doc_kind"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, name):
    out = queries.QUERIES[name](spark, FOLDER)
    rows = out.collect()
    assert rows
    if name in FOUND:
        assert out.columns == FOUND[name]
        assert len({str(r) for r in rows}) == len(rows)


def test_every_example_has_its_group_and_split(spark):
    grouped = queries.p6_splits(spark, FOLDER).collect()
    assert len(grouped) == spark.read.parquet(f"{FOLDER}/rlvr_examples.parquet").count()
    by: dict = {}
    for r in grouped:
        by.setdefault(r["ticker_id"], set()).add(r["new_split"])
    assert all(len(v) == 1 for k, v in by.items() if k is not None)


def test_coverage_of_every_record_and_on_average(spark):
    rows = queries.p4_coverage(spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/rlvr_examples.parquet").where("dataset_split <> 'train'").count()
    assert all((r["coverage"] > 0) == (r["partners"] > 0) and r["coverage"] <= 1 for r in rows) and any(r["partners"] for r in rows)
    by: dict = {}
    for r in rows:
        by.setdefault((r["dataset_split"], r["source"]), []).append(r["coverage"])
    got = {(r["dataset_split"], r["source"]): r["mean_coverage"] for r in queries.p4_report(spark, FOLDER).collect()}
    assert got == {k: pytest.approx(sum(v) / len(v), abs=1e-5) for k, v in by.items()}


def test_shares_and_repeats_of_the_mix(spark):
    folder = FOLDER.replace("sf0.001", "sf0.01")
    mix, shares = queries.p9_mix(spark, folder).collect(), queries.p9_shares(spark, folder).collect()
    docs = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert all(docs[r["doc_id"]] == r["source"] for r in mix)
    assert len({(r["doc_id"], r["copy"]) for r in mix}) == len(mix)
    caps = {r["source"]: r["max_repeats"] for r in shares}
    assert all(1 <= r["copy"] <= caps[r["source"]] for r in mix)
    assert sum(r["tokens"] for r in shares) == sum(r["n_tokens"] for r in mix)
    # the smallest sources are about ten texts here
    assert all(abs(r["actual_share"] / r["target_share"] - 1) < 0.05 for r in shares)
