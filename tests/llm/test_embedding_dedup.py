import math

import numpy as np
import pytest

from punctual.llm import embedding_dedup as ed


def brute(rows, threshold=0.98):
    ok = []
    for _, v, label in rows:
        good = label is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
        ok.append(bool(good and any(v)))
    links = [0] * len(rows)
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if k else None for (_, v, _), k in zip(rows, ok, strict=True)]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                group[top(i)] = top(j)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((vec, links[i], low, vec == low))
    return out


SCHEMA = "vec_id bigint, embedding array<float>, label int"


def cloud(n, width=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=width) * rng.choice([0.0, 0.05, 0.15, 0.3])
        rows.append((i, (v * rng.choice([1.0, 7.5])).astype(np.float32).tolist(), int(rng.integers(2))))
    return rows


@pytest.mark.parametrize(("tile", "width"), [(2048, 3), (25, 16), (2048, 40)])
def test_matches_brute_force(spark, tile, width):
    rows = cloud(300, width)
    df = spark.createDataFrame(rows, SCHEMA)
    got = ed.near_vectors(df, tile_rows=tile).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_bound_drops_no_pair(monkeypatch):
    monkeypatch.setattr(ed, "PAIRS", 100)
    rng = np.random.default_rng(4)
    a, b = (ed._unit(rng.normal(size=(200, 24)) * np.linspace(4, 0.1, 24)) for _ in range(2))
    for t in (0.98, 0.7, 0.1):
        i, j = ed.close_pairs(a, b, t)
        found = set(zip(i.tolist(), j.tolist(), strict=True))
        assert set(zip(*map(np.ndarray.tolist, np.nonzero(a @ b.T >= t)), strict=True)) <= found


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1),
        (7, [1.0, None, 3.0], 1), (8, [nan, 2.0, 3.0], 1), (9, [inf, 2.0, 3.0], 1), (None, v, 1),
        (None, [3.0, -1.0, 0.0], 5), (11, [], 1), (12, [1.0, 2.0], 1), (13, [2.0, 4.0, 6.0], 1),
        (14, [1e-30, 2e-30, 3e-30], 1), (15, [1.0], 3), (16, [2.0], 3), (17, [-2.0], 3),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", size string")
    got = ed.near_vectors(df)
    assert "size" in got.columns
    found = sorted(map(repr, map(tuple, ed.op4_embedding_dedup(df).collect())))
    assert found == sorted(map(repr, brute(rows)))
    assert ed.op4_embedding_dedup(df.where("false")).collect() == []
    assert ed.op4_embedding_dedup(df.where("vec_id = 5")).count() == 1


def test_query_on_a_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [tuple(r) for r in vectors.select("vec_id", "embedding", "label").orderBy("vec_id").collect()]
    got = sorted(map(tuple, ed.op4_embedding_dedup(vectors).collect()))
    assert got == brute(rows)
