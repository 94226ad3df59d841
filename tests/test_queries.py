"""The registered queries of the engine's own operators against their SQL, on the smallest tables."""

import importlib

import duckdb
import pytest

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"
MODULES = ("histories", "review", "provider", "exchange", "adapting", "runs")


@pytest.fixture(scope="module")
def tables():
    found = duckdb.connect()
    for name in TABLES:
        found.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return found


def registered():
    modules = [importlib.import_module(f"marlstone.plans.{name}") for name in MODULES]
    queries, oracles = modules[0].QUERIES, modules[0].ORACLES
    return [name for name, query in queries.items() if query.__module__.rpartition(".")[2] in MODULES and name in oracles]


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, list):
        return tuple(map(plain, value))
    return value if isinstance(value, int | str | bool | None) else str(value)


@pytest.mark.parametrize("name", registered())
def test_query_equals_its_sql(spark, tables, name):
    module = importlib.import_module("marlstone.plans.histories")
    rows = module.QUERIES[name](spark, DATA)
    want = tables.execute(module.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(rows.columns) == sorted(names)
    order = [names.index(c) for c in rows.columns]
    left = sorted((tuple(map(plain, r)) for r in rows.collect()), key=repr)
    right = sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=repr)
    assert left == right and left
