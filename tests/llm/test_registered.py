import duckdb

import __spark_entry__ as contract
from check import TABLES, compare
from flowloom.llm import queries


def test_operators_and_the_pipeline_are_registered():
    names = sorted(n for n in contract.queries() if n.startswith("op") and n[2].isdigit())
    assert [int(n[2:].split("_")[0]) for n in sorted(names, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(queries.ORACLES) <= set(contract.oracle_sql())


def test_queries_with_sql(spark, sf):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in queries.ORACLES.items():
        assert compare(queries.REGISTRY[name](spark, sf).toPandas(), db.execute(sql).df()) == "", name
