import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, compare
from workload.oracles import ORACLES
from workload.queries import REGISTRY

LEARNERS = {"train_boosted", "train_forest", "train_multiclass", "feature_importance", "cascade_models", "train_and_judge"}


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_every_query_but_the_learners_has_sql():
    assert set(REGISTRY) - set(ORACLES) == LEARNERS
    assert set(ORACLES) <= set(REGISTRY) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert {r.split for r in rows} == {"train", "val", "test"}
    train = [r for r in rows if r.split == "train"]
    assert sum(r.benign for r in train) == sum(r.attack for r in train)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - LEARNERS))
def test_query_matches_sql(spark, sf, db, name):
    df = contract.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython") if op in plan]
    ours = df.toPandas()
    assert compare(ours, db.execute(contract.oracle_sql()[name]).df()) == ""
