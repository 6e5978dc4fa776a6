"""What several operators share: folds, intermediate tables, Arrow columns, components."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from punctual.session import scratch_dir
from punctual.sources import files

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to write."""
    return df.drop(*names)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Ends the lineage: what follows survives lost executors without recomputing ``df``.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a table that ``cut`` wrote and nothing reads any more."""
    spark = df.sparkSession
    scratch = urlsplit(scratch_dir(spark)).path + "/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if urlsplit(folder).path.startswith(scratch):
            files.delete(spark, folder)


def extended(schema: StructType, added: str) -> StructType:
    """``schema`` with the columns of the DDL text ``added`` behind it."""
    return StructType([*schema.fields, *StructType.fromDDL(added).fields])


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def appended(batch: pa.RecordBatch, names: list[str], arrays: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])


def slices(batch: pa.RecordBatch, sizes: list[int], limit: int):
    """Cut a batch into runs of rows of about ``limit`` bytes; a larger row stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: bigint) as (node, component), by smallest node.

    Alternates the two star operations of Kiveris et al. (2014), "Connected components in
    MapReduce and beyond", until the edge set stands still, which takes a number of rounds
    logarithmic in the nodes. Each round is two aggregations and two joins, and its edges
    are written to the shared scratch folder; the driver sees a count and a checksum.
    Nodes without an edge are left out. Null ends and loops are ignored.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    stars = cut(pairs.where("a < b").distinct(), "edges")
    seen = _print(stars)
    while seen[0]:
        ends = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = ends.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = ends.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").distinct()
        # after the large star each edge points from its larger end b to a smaller a
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = large.join(low, "b").select(
            F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b")
        )
        # an edge (a, b) with a smaller neighbour m of b becomes (m, a); (m, b) is there already
        new = cut(moved.where("a < b").distinct(), "edges")
        now = _print(new)
        forget(stars)
        stars = new
        if now == seen:
            break
        seen = now
    spread = stars.select(F.col("b").alias("node"), F.col("a").alias("component"))
    centres = stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return spread.unionByName(centres)


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr("bit_xor(xxhash64(a, b))").alias("x"),
        F.sum(F.xxhash64("b", "a").cast("decimal(20,0)")).alias("s"),
    ).first()
    return (row["n"], row["x"], row["s"])
