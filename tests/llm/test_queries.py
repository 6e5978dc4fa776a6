"""The registered queries: names, SQL where it can express them, components."""

import glob
import os
import random

import duckdb
import pytest

import __spark_entry__ as contract
from punctual.llm import common, queries


def test_one_query_for_each_operator():
    names = set(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert names | {"pipeline"} <= set(contract.queries())
    assert set(queries.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    df = queries.queries()[name](spark, sf_dir)
    wanted = duck.sql(queries.oracle_sql()[name])
    order = [wanted.columns.index(c) for c in df.columns]
    rows = [tuple(row[i] for i in order) for row in wanted.fetchall()]
    assert sorted(map(tuple, df.collect())) == sorted(rows)


def brute_components(edges):
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    edges = {
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
        "chain": [(i, i + 1) for i in rng.sample(range(60), 60)],
        "star": [(77, i) for i in range(-40, 40)],
        "none": [(3, 3)],
    }[shape]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in common.components(df).collect()}
    wanted = brute_components([e for e in edges if e[0] != e[1]])
    assert got == wanted
