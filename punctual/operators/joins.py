"""Joins that survive a hot key."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.session import MAX_SHUFFLE_PARTITIONS

AQE_FACTOR = 5  # a key is hot where it outweighs this many average shuffle partitions
HOT_ROWS = 1_000_000
SKETCH_ITEMS = 8  # items a sketch tracks for each key that can be hot


def _most(partitions: int) -> tuple[int, int]:
    """How many keys can be hot at most, and how many a sketch tracks to find them."""
    most = math.ceil(partitions / AQE_FACTOR) + 1
    return most, max(10_000, SKETCH_ITEMS * most)


def key_sketch(key: str, partitions: int = MAX_SHUFFLE_PARTITIONS) -> list[Column]:
    """Aggregates that find the hot values of ``key`` for up to so many partitions."""
    most, tracked = _most(partitions)
    return [
        F.count(key).alias("rows"),
        F.expr(f"approx_top_k({key}, {most}, {tracked})").alias("top"),
    ]


def hot_in(sketches: list[dict], partitions: int, min_rows: int = HOT_ROWS) -> list:
    """The keys that would each overload one of ``partitions``, by their sketches."""
    return sorted(
        {
            entry["item"]
            for sketch in sketches
            for entry in sketch["top"] or []
            if entry["item"] is not None
            and entry["count"] > max(min_rows, AQE_FACTOR * sketch["rows"] / partitions)
        }
    )


def heavy_keys(key: str, *frames: DataFrame, min_rows: int = HOT_ROWS) -> list:
    """The values of ``key`` that would each overload a shuffle partition of a frame.

    A job of its own: one pass over the key columns with a bounded sketch; only sketches
    are shuffled, only one row per frame is collected. A key of more than ``AQE_FACTOR``
    average partitions can occur ``partitions / AQE_FACTOR`` times at most, and that is how
    many the sketch is asked for, so no hot key is left out for want of room. The answer
    steers the plan and never the result, so an estimate is enough.
    """
    partitions = int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketch = key_sketch(key, partitions)
    found = reduce(
        DataFrame.unionByName, (df.where(F.col(key).isNotNull()).agg(*sketch) for df in frames)
    )
    return hot_in([row.asDict() for row in found.collect()], partitions, min_rows)


def join_rollup(
    rows: DataFrame, cold: DataFrame, spread: DataFrame, key: str, hot: list
) -> DataFrame:
    """Inner join of ``rows`` with a rollup that has one row per ``key``.

    ``cold`` and ``spread`` are the same rollup, computed two ways: the first brings
    all rows of a key to one task, the second combines them before any shuffle. ``hot``
    keys go the second way and are joined by broadcast, one row per hot key; there are
    fewer of them than shuffle partitions (see ``heavy_keys``). Every row takes exactly
    one way.
    """
    if not hot:
        return rows.join(cold, key)
    kind = rows.schema[key].dataType.simpleString()
    keys = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in hot], f"{key} {kind}"))
    few = spread.join(keys, key, "left_semi")
    return (
        rows.join(keys, key, "left_anti")
        .join(cold.join(keys, key, "left_anti"), key)
        .unionByName(rows.join(keys, key, "left_semi").join(F.broadcast(few), key))
    )
