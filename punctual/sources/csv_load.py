"""Bulk load of the raw CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from punctual.contracts import RAW_TABLES
from punctual.operators.joins import key_sketch
from punctual.sources import files
from punctual.sources.warehouse import Warehouse

DEFAULT_NAMING = "{table}.csv"


class MissingInputs(Exception):
    """Some source files are absent; ``paths`` names all of them."""

    def __init__(self, paths: list[str]):
        self.paths = paths
        super().__init__("missing source files:\n  " + "\n  ".join(paths))


def source_paths(source_dir: str, naming: str = DEFAULT_NAMING) -> dict[str, str]:
    folder = source_dir.rstrip("/")
    return {table: f"{folder}/{naming.format(table=table)}" for table in RAW_TABLES}


def preflight(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail before any table is touched, naming every missing file at once."""
    missing = [path for path in paths.values() if not files.exists(spark, path)]
    if missing:
        raise MissingInputs(missing)


def _observed(rows: DataFrame) -> list[Column] | None:
    """A sketch of hot orders, where the table has orders whose ids survive as JSON."""
    kinds = {f.name: f.dataType for f in rows.schema}
    plain = isinstance(kinds.get("order_id"), (T.StringType, T.IntegralType))
    return key_sketch("order_id") if plain else None


def load(
    warehouse: Warehouse,
    source_dir: str,
    naming: str = DEFAULT_NAMING,
    schemas: dict[str, T.StructType] | None = None,
) -> None:
    """Replace the raw tables by the CSV files, as they are, in one commit.

    All files are read and staged before that, so a reader sees either the tables of this
    load or those before it, never some of each. Names come from the header. Types are inferred, which reads each file twice; a
    declared schema in ``schemas`` saves that pass. A malformed row fails the load:
    the write parses every column, so no bad row is pruned away unseen.
    """
    spark = warehouse.spark
    paths = source_paths(source_dir, naming)
    preflight(spark, paths)
    warehouse.ensure()
    staged = {}
    for table, path in paths.items():
        reader = spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"')
        schema = (schemas or {}).get(table)
        if schema is None:
            reader = reader.option("inferSchema", True)
        else:
            # With a declared schema, a header that disagrees is an error too.
            reader = reader.schema(schema).option("enforceSchema", False)
        rows = reader.csv(path)
        # the write sees every row anyway: what the marts ask about hot orders costs no scan
        staged[table] = warehouse.stage(table, rows, observe=_observed(rows))
    warehouse.commit_all(staged)
