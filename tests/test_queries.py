"""Every registered query against its SQL on the smallest test tables."""

import importlib
import os
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from glossmill.plans.oracles import ORACLES
from glossmill.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in ("customer", "orders", "events", "documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys() <= entry_module.oracle_sql().keys()
    others = entry_module.queries().keys() - QUERIES.keys()
    assert all(name == "pipeline" or name.startswith("op") for name in others)


def test_entry_works_without_the_training_data_operators(monkeypatch):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("glossmill.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    alone = importlib.import_module("__spark_entry__")
    assert alone.queries().keys() == alone.oracle_sql().keys() == QUERIES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    result = sql.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(result.fetchall(), key=repr)
    assert expected
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == expected


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    documents = [(i, "One line here.\nAnother, of 5 words." * (i % 3), "en", f"src{i % 2}", 0) for i in range(60)]
    turns = [(i, 0, "user", "Some words for a lexicon.") for i in range(9)]
    for name, rows, schema in (
        ("documents", documents, "doc_id long, text string, lang string, source string, n_chars long"),
        ("conversations", turns, "conv_id long, turn long, role string, text string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("ingest") or n in ("json_round_trip", "read_back")])
def test_nested_json_of_a_query_is_compressed(spark, tables, name):
    """Plain, it has six times the bytes of its texts."""
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {*shared.rglob("part-*.json*")}
    assert QUERIES[name](spark, tables).collect()
    written = {*shared.rglob("part-*.json*")} - before
    assert written and all(p.name.endswith(".json.gz") for p in written)
