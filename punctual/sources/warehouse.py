"""A folder of Parquet tables: raw tables as loaded, and the marts built from them."""

from __future__ import annotations

import json
import re
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from punctual.contracts import (
    DIM_SELLER,
    FACT,
    FACT_COLUMNS,
    FACT_OPT,
    PARTITION_KEY,
    RAW_TABLES,
)
from punctual.sources import files
from punctual.sources.commits import CommitLog, Conflict, Snapshot

MART_TABLES = (FACT, DIM_SELLER, FACT_OPT)
COMMITS = "_commits"
STATS = "_stats"  # what was observed while a version was written
ABANDONED = 7 * 24 * 3600  # seconds after which a version nobody committed may go


class Warehouse:
    """Tables under ``root``; every write replaces whole tables, or nothing.

    A table is a folder of versions, each a folder of Parquet files. Which of them are
    current is stated by the latest commit for all tables at once (see ``CommitLog``), so
    a reader that is ``pinned`` sees tables that belong together, whatever is committed
    meanwhile. The version before the current one stays for those who still read it.
    """

    def __init__(self, spark: SparkSession, root: str, at: Snapshot | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/{COMMITS}")
        self._at = at

    def ensure(self) -> None:
        """Create the namespace if it is absent."""
        for layer in ("raw", "marts"):
            files.make_dir(self.spark, f"{self.root}/{layer}")

    # -- reading

    def snapshot(self) -> Snapshot:
        return self._at or self.log.latest()

    def pinned(self) -> Warehouse:
        """A reader that keeps to what is current now, for all tables."""
        return Warehouse(self.spark, self.root, self.snapshot())

    def _home(self, table: str) -> str:
        layer = "raw" if table in RAW_TABLES else "marts"
        return f"{self.root}/{layer}/{table}"

    def _versions(self) -> dict[str, list[str]]:
        """Per table its current version, and the one before if there is one."""
        return self.snapshot().state.get("tables", {})

    def path(self, table: str) -> str:
        """The folder of the table's current version."""
        versions = self._versions().get(table)
        if not versions:
            raise FileNotFoundError(f"no table {table} under {self.root}")
        return f"{self._home(table)}/{versions[0]}"

    def exists(self, table: str) -> bool:
        return table in self._versions()

    def size_bytes(self, table: str) -> int:
        return files.size_bytes(self.spark, self.path(table))

    def stats(self, table: str) -> dict:
        """What was observed while the current version was written; nothing if not asked for."""
        path = f"{self.path(table)}/{STATS}"
        return json.loads(files.read_text(self.spark, path)) if files.exists(self.spark, path) else {}

    def read(self, table: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(table))
        if table == FACT_OPT:
            # The partition key is no column of the files: it comes last, and its type is
            # guessed from the folder names. The contract decides both.
            df = df.withColumn(PARTITION_KEY, F.col(PARTITION_KEY).cast("bigint"))
            df = df.select(*FACT_COLUMNS)
        return df

    # -- writing

    def stage(
        self,
        table: str,
        df: DataFrame,
        partition_by: tuple[str, ...] = (),
        records_per_file: int = 0,
        options: dict[str, str] | None = None,
        observe: list[Column] | None = None,
    ) -> str:
        """Write a new version of ``table`` that nobody reads yet; its name.

        ``observe`` are aggregates that the write computes along the way; they are stored
        with the version (see ``stats``).
        """
        version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        if observe:
            df = df.observe(seen, *observe)
        writer = df.write.options(**(options or {})).partitionBy(*partition_by)
        if records_per_file:
            writer = writer.option("maxRecordsPerFile", records_per_file)
        writer.parquet(f"{self._home(table)}/{version}")
        if observe:
            text = json.dumps(_plain(seen.get))
            files.write_text(self.spark, f"{self._home(table)}/{version}/{STATS}", text)
        return version

    def commit_all(self, staged: dict[str, str | None], since: Snapshot | None = None) -> None:
        """Make staged versions of some tables current, all at once; None drops a table.

        A table's last commit decides, however old the version is that it names. With
        ``since`` the commit is refused if somebody changed one of the tables after it.
        """

        def change(state: dict) -> dict:
            tables = state.setdefault("tables", {})
            for table, version in staged.items():
                versions = tables.pop(table, [])
                if since and versions != since.state.get("tables", {}).get(table, []):
                    raise Conflict(f"{table} was changed since commit {since.number}")
                if version:
                    tables[table] = [version, *(v for v in versions if v != version)][:2]
            return state

        before, after = self.log.append(change)
        # Only the writer of this commit takes these versions out, so nobody else needs them.
        for table in staged:
            out = set(before.state.get("tables", {}).get(table, []))
            for version in out - set(after.state["tables"].get(table, [])):
                files.delete(self.spark, f"{self._home(table)}/{version}")
        self._follow()

    def commit(self, table: str, version: str) -> DataFrame:
        """Make a staged version the current one, and return it.

        There is no moment without a table, nothing is renamed, and two jobs at once don't
        touch each other's files. Readers of the version before can finish.
        """
        self.commit_all({table: version})
        return self.read(table)

    def replace(
        self,
        table: str,
        df: DataFrame,
        partition_by: tuple[str, ...] = (),
        records_per_file: int = 0,
        options: dict[str, str] | None = None,
        observe: list[Column] | None = None,
    ) -> DataFrame:
        """Create or replace ``table`` as ``df`` and return the written table.

        A job that fails half way leaves the old table, and readers never see a part of
        the new one.
        """
        return self.commit(
            table, self.stage(table, df, partition_by, records_per_file, options, observe)
        )

    def drop(self, table: str) -> None:
        """Drop a table if it exists, with its versions."""
        if self.exists(table):
            self.commit_all({table: None})

    def clean(self, older_than: float = ABANDONED) -> list[str]:
        """Delete versions that a job staged ``older_than`` seconds ago and never committed.

        Only folders that are older than that and in no commit go, so jobs that still run
        keep theirs. Returns the paths.
        """
        known = self.log.latest().state.get("tables", {})
        limit = time.time_ns() - int(older_than * 1e9)
        gone = []
        for table in (*RAW_TABLES, *MART_TABLES):
            home = self._home(table)
            for version in files.children(self.spark, home):
                staged = re.fullmatch(r"v(\d{20})-[0-9a-f]{8}", version)
                if staged and int(staged[1]) < limit and version not in known.get(table, []):
                    files.delete(self.spark, f"{home}/{version}")
                    gone.append(f"{home}/{version}")
        return gone

    def draft(self) -> Draft:
        """Tables to be built and looked at before anybody else sees them."""
        return Draft(self)

    # -- the catalog

    def publish(self, database: str) -> None:
        """Register the tables in the catalog, so that SQL can name them.

        The database is noted in the commit log, and from now on each commit points the
        catalog to what it made current: no table is dropped, and none names a folder that
        was deleted. The partitioned copy gets the contract's types; the catalog puts its
        partition key last, and views over it put it back in place.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        self.log.append(lambda state: {**state, "database": database})
        self._follow()

    def _follow(self) -> None:
        """Point the catalog to the latest commit.

        Writers that commit close together each do so until nothing newer has appeared, so
        the last of them leaves the latest state. A session whose catalog hasn't the
        database leaves it alone.
        """
        while True:
            now = self.log.latest()
            database = now.state.get("database")
            if not database or not self.spark.catalog.databaseExists(database):
                return
            current = Warehouse(self.spark, self.root, now)
            for table in now.state.get("tables", {}):
                current._register(f"{database}.{table}", table)
            if self.log.latest().number == now.number:
                return

    def _register(self, name: str, table: str) -> None:
        """Point the catalog's ``name`` to the version, in one step if it has its columns."""
        path, columns = self.path(table), self.read(table).schema
        kinds = {f.name: f.dataType for f in columns}
        if self.spark.catalog.tableExists(name):
            if {f.name: f.dataType for f in self.spark.table(name).schema} == kinds:
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
                self.spark.catalog.refreshTable(name)
                return
            self.spark.sql(f"DROP TABLE {name}")  # its files stay
        text = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        by = f"PARTITIONED BY (`{PARTITION_KEY}`)" if table == FACT_OPT else ""
        # Partitions are those of the folder. Listed in the catalog each would have a
        # location of its own, and a new version could not become current in one step.
        before = self.spark.conf.get(LISTED)
        self.spark.conf.set(LISTED, "false")
        try:
            self.spark.sql(f"CREATE TABLE {name} ({text}) USING parquet {by} LOCATION '{path}'")
        finally:
            self.spark.conf.set(LISTED, before)


LISTED = "spark.sql.hive.manageFilesourcePartitions"


class Draft(Warehouse):
    """A warehouse whose commits nobody else sees before ``finish``.

    Reads see the draft's own versions first and else what was current when it began.
    """

    def __init__(self, warehouse: Warehouse):
        super().__init__(warehouse.spark, warehouse.root, warehouse.snapshot())
        self._base, self.staged = self._at, {}

    def commit_all(self, staged: dict[str, str | None], since: Snapshot | None = None) -> None:
        self.staged |= staged
        tables = dict(self._base.state.get("tables", {}))
        for table, version in self.staged.items():
            tables[table] = [version]
        kept = {table: versions for table, versions in tables.items() if versions[0]}
        self._at = Snapshot(self._base.number, {**self._base.state, "tables": kept})

    def finish(self) -> None:
        """Commit everything at once; refused if somebody else changed one of the tables."""
        target = Warehouse(self.spark, self.root)
        target.commit_all(self.staged, since=self._base)

    def publish(self, database: str) -> None:
        raise RuntimeError("finish the draft, then publish the warehouse")


def _plain(value):
    """Observed values as JSON has them."""
    if isinstance(value, Row):
        return _plain(value.asDict())
    if isinstance(value, dict):
        return {key: _plain(v) for key, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def contents(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count plus an order-independent fingerprint of every table's rows.

    The fingerprint is a sum of row hashes, so two equal multisets of rows agree
    whatever files or partitions hold them. A hash skips NULLs, so where they are is hashed
    as well.
    """
    prints = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(_row_hash(df).cast("decimal(38,0)")).alias("fingerprint"),
        ).select(F.lit(name).alias("table_name"), "row_count", "fingerprint")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, prints).orderBy("table_name")


def _row_hash(df: DataFrame) -> Column:
    columns = sorted(df.columns)
    return F.xxhash64(*(x for c in columns for x in (F.col(c).isNull(), F.col(c))))
