"""Sharding by extendible hashing: oversized buckets split on one more bit of the hash."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import cut, fresh

SHARD_BYTES = 64 * 1024 * 1024
BITS = 60
SPARE = 4  # a directory cell holds about 1/16 of a shard


def assign_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` plus ``shard``, ``depth``, ``n_bytes`` and ``shard_bytes``.

    The hash is the first 60 bits of the MD5 of the id as text. The directory starts with
    one bucket for all; a bucket of more than ``limit`` text bytes is split on its next bit,
    others stay. ``shard`` is the bucket's bits as text (empty for the root), ``depth`` how
    many they are, ``shard_bytes`` its total.

    Sizes are summed once, per cell of a prefix about 16 times finer than the shards, and
    bucket sizes follow from the cells. Only where a cell is itself oversized do its
    documents go on to a finer prefix, in as many rounds as that takes. Nothing is
    collected but totals; a directory has about 16 rows a shard.

    No bit separates rows of one hash, i.e. of one id. A bucket whose rows all have the
    same hash is final however large it is, and shows that by ``shard_bytes``. A null id
    hashes as the text ``null``; a null or empty text has 0 bytes. An empty table gives an
    empty table. Columns named like the results are replaced, all other columns are kept.
    """
    docs = fresh(docs, "shard", "depth", "n_bytes", "shard_bytes")
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary"))
    rows = docs.withColumns(
        {
            "__h": F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long"),
            "n_bytes": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"),
        }
    )
    slim = rows.select("__h", "n_bytes")
    total = slim.agg(F.sum("n_bytes")).first()[0] or 0
    fine = min(BITS, math.ceil(math.log2(max(1, total / limit))) + SPARE)
    placed, known = rows, []
    at, bits, left = 0, fine, slim
    while True:
        cells = (
            left.groupBy(_prefix("__h", bits).alias("__cell"))
            .agg(
                F.sum("n_bytes").alias("bytes"), F.min("__h").alias("lo"), F.max("__h").alias("hi")
            )
            .withColumn("__d", F.explode(F.sequence(F.lit(at), F.lit(bits))))
            .withColumn("__p", F.expr(f"shiftright(__cell, cast({bits} - __d as int))"))
        )
        final = (
            cells.groupBy("__d", "__p")
            .agg(F.sum("bytes").alias("bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .where((F.col("bytes") <= limit) | (F.col("lo") == F.col("hi")) | (F.col("__d") == BITS))
            .select("__d", "__p", F.col("bytes").alias("__total"))
        )
        found = cut(
            cells.join(final, ["__d", "__p"], "left")
            .groupBy("__cell")
            .agg(
                F.min(F.when(F.col("__total").isNotNull(), F.struct("__d", "__total"))).alias(
                    "__bucket"
                )
            ),
            "directory",
        )
        name = f"__bucket{len(known)}"
        known.append(name)
        placed = (
            placed.withColumn("__cell", _prefix("__h", bits))
            .join(found.withColumnRenamed("__bucket", name), "__cell", "left")
            .drop("__cell")
        )
        open_cells = found.where("__bucket IS NULL").select("__cell")
        if bits == BITS or open_cells.isEmpty():
            break
        left = left.withColumn("__cell", _prefix("__h", bits)).join(
            open_cells, "__cell", "left_semi"
        )
        at, bits = bits + 1, min(BITS, bits + 2 * SPARE)
    bucket = F.coalesce(*known)
    placed = placed.withColumns(
        {"depth": bucket["__d"], "shard_bytes": bucket["__total"]}
    )
    path = F.expr(f"lpad(bin(shiftright(__h, cast({BITS} - depth as int))), depth, '0')")
    return placed.withColumn("shard", F.when(F.col("depth") == 0, "").otherwise(path)).drop(
        "__h", *known
    )


def _prefix(h: str, bits: int) -> Column:
    return F.shiftright(h, BITS - bits)


def write_shards(assigned: DataFrame, path: str) -> None:
    """Write one folder per shard under ``path`` and one file in each."""
    assigned.repartition("shard").write.partitionBy("shard").parquet(path)


def op2_sharding(docs: DataFrame) -> DataFrame:
    """One row per document: its shard, with the bits that name it."""
    done = assign_shards(docs.select("doc_id", "text"))
    return done.select("doc_id", "shard", "depth", "n_bytes", "shard_bytes")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h
  FROM documents),
n AS (
  SELECT depth, h >> ({BITS} - depth) AS p, sum(n_bytes) AS bytes, min(h) = max(h) AS same
  FROM d, (SELECT unnest(range(0, 25)) AS depth) GROUP BY ALL),
b AS (
  SELECT d.doc_id, d.h, d.n_bytes, min(depth) AS depth
  FROM d JOIN n ON (d.h >> ({BITS} - n.depth)) = n.p
  WHERE bytes <= {SHARD_BYTES} OR same GROUP BY ALL)
SELECT doc_id, CASE WHEN b.depth = 0 THEN '' ELSE
         right(lpad(bin(h), {BITS}, '0')[1:b.depth], b.depth) END AS shard,
       CAST(b.depth AS INTEGER) AS depth, n_bytes, CAST(n.bytes AS BIGINT) AS shard_bytes
FROM b JOIN n ON n.depth = b.depth AND n.p = (b.h >> ({BITS} - b.depth))
"""
