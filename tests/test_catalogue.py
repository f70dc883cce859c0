"""A few catalogue queries against DuckDB on the smallest tables; the driver compares them all."""

from pathlib import Path

import duckdb
import pytest

from kinweave.plans import catalogue
from kinweave.sources.steps import finish, materialize, shared_dir

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
@pytest.mark.parametrize("name", ["normalize_text", "retrieve_name_word_topk", "threshold_sweep", "matching_results", "recall_incremental"])
def test_same_rows(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cur = con.execute(catalogue.ORACLES[name])
    cols = [c[0] for c in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    got = catalogue.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(repr(tuple(r[c] for c in cols)) for r in got.collect()) == want


def test_entry_point():
    import __spark_entry__ as e

    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES) and set(e.oracle_sql()) <= set(e.queries())


#: Queries over the candidates: they failed by disk at 1 GB.
OVER_CANDIDATES = ("error_groups", "candidate_union", "graph_support_max", "reference_context_similarity", "pair_advanced_features", "threshold_sweep", "error_examples", "graph_context", "candidate_labels", "entity_f05", "metric_summary", "recall_by_bucket", "recall_by_source", "recall_overall", "worst_entities", "bootstrap_interval", "matching_results", "pair_retrieval_features", "recall_by_country", "recall_incremental")


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    rows = [(i, f"{'red blue green grey'.split()[i % 4]} fox club {i % 7}. {i % 5} main street. And more words {i % 3}.", "en", f"src{i % 3}", 40 + i) for i in range(40)]
    folder = tmp_path_factory.mktemp("few")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.mark.parametrize("name", OVER_CANDIDATES)
def test_candidates_are_found_once_and_leave_no_steps(spark, few, monkeypatch, name):
    """However often a query reads them; of what the search wrote only the candidates stay."""
    calls, real = [], catalogue.tfidf.retrieve
    monkeypatch.setattr(catalogue.tfidf, "retrieve", lambda *a, **b: calls.append(a) or real(*a, **b))
    folder = Path(shared_dir(spark).removeprefix("file:"), "kinweave")
    before = set(folder.glob("*"))
    catalogue.QUERIES[name](spark, few)
    assert len(calls) == 1
    assert [p.name.rpartition("-")[0] for p in set(folder.glob("*")) - before] == ["candidates"]


def test_finish_deletes_its_steps_also_after_errors(spark):
    folder = Path(shared_dir(spark).removeprefix("file:"), "kinweave")
    before = set(folder.glob("*"))

    def build(fails):
        step = materialize(spark.range(3), "step")
        if fails:
            raise KeyError("planted")
        return finish(lambda: materialize(step, "inner").union(step), "half")

    with pytest.raises(KeyError):
        finish(lambda: build(True), "none")
    assert set(folder.glob("*")) == before
    assert finish(lambda: build(False), "whole").count() == 6
    assert [p.name.rpartition("-")[0] for p in set(folder.glob("*")) - before] == ["whole"]


def test_recall_by_source_counts_every_equal_target(spark, tmp_path):
    """Links behind an anchor's first three equal names too; the search finds none, as the names' words are too frequent."""
    row = lambda i, source: (i, f"Acme stores. {i} main road in a small town far away. {'and so on ' * 12}", "en", source, 40)
    rows = [(i, "Acme stores. 1 main road. " + "and so on " * 12, "en", f"src{0 if i == 1 else 1 + i % 2}", 40) for i in range(1, 22)] + [row(100 + i, "src1") for i in range(5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = {(2, 10, 10), (3, 10, 10)}
    assert {tuple(r) for r in catalogue.QUERIES["recall_by_source"](spark, str(tmp_path)).collect()} == want == set(con.execute(catalogue.ORACLES["recall_by_source"]).fetchall())
