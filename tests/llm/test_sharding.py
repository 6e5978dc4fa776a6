import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from punctual.llm import sharding


def bits(doc):
    text = "null" if doc is None else str(doc)
    return f"{int(hashlib.md5(text.encode()).hexdigest()[:15], 16):060b}"


def brute(rows, limit):
    """Split from the root on; one bit at a time."""
    shards, work = {}, [("", rows)]
    while work:
        path, mine = work.pop()
        total = sum(len((t or "").encode()) for _, t in mine)
        if total <= limit or len({bits(d) for d, _ in mine}) == 1:
            for d, t in mine:
                shards.setdefault((d, t), []).append(
                    (d, path, len(path), len((t or "").encode()), total)
                )
            continue
        halves = defaultdict(list)
        for d, t in mine:
            halves[bits(d)[len(path)]].append((d, t))
        work += [(path + b, half) for b, half in halves.items()]
    return sorted((x for s in shards.values() for x in s), key=repr)


ROWS = [(i, "é" * (i * 37 % 900)) for i in range(300)] + [
    (None, "x" * 50), (None, None), (7, "again"), (7, "again"), (1000, "big " * 5000), (1001, ""),
]


@pytest.mark.parametrize("limit", [10**9, 40_000, 3_000, 100, 1])
def test_matches_brute_force(spark, limit):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    done = sharding.assign_shards(df, limit=limit)
    got = done.select("doc_id", "shard", "depth", "n_bytes", "shard_bytes").collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS, limit)


def test_directory_goes_deeper_where_a_cell_is_too_large(spark):
    """Nearly all bytes in few documents: cells of the first round don't suffice."""
    rows = [(i, "x" * (2000 if i < 40 else 1)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    done = sharding.assign_shards(df, limit=2000)
    got = done.select("doc_id", "shard", "depth", "n_bytes", "shard_bytes").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 2000)


def test_written_shards_and_edges(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumn("SHARD", F.lit("x"))
    done = sharding.assign_shards(df, limit=3000)
    assert done.columns == ["doc_id", "text", "n_bytes", "depth", "shard_bytes", "shard"]
    sharding.write_shards(done, f"{tmp_path}/shards")
    folders = list((tmp_path / "shards").glob("shard=*"))
    assert len(folders) == done.select("shard").distinct().count()
    assert spark.read.parquet(f"{tmp_path}/shards").count() == len(ROWS)
    assert sharding.op2_sharding(df.where("false")).collect() == []
