"""Parquet tables of the warehouse.

A table is a list of directories named by the newest commit file. A run writes new
directories and then publishes one commit file for all its tables, so that dimensions
and facts of a run appear together or not at all, and a failed run leaves nothing
visible. Nothing is ever overwritten in place. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from boxlake.schemas import TABLES
from boxlake.sources.files import file_system


def _part_of(folder: str) -> str:
    """Value of the column that a table is split by."""
    return folder.rpartition("=")[2]


@dataclass(frozen=True)
class Append:
    """Rows whose keys the table does not hold yet."""

    rows: DataFrame


@dataclass(frozen=True)
class Replace:
    """New content of a table, or only of some parts (seasons, say) of a split table."""

    rows: DataFrame
    parts: tuple[str, ...] | None = None


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.commits = f"{self.root}/_commits"
        #: Rows that the last commit wrote, by table and counted group.
        self.counts: dict[str, dict[str, int]] = {}

    def create_tables(self) -> None:
        """Create all tables at once; a warehouse that exists is left alone."""
        if self._version() is None:
            self._publish(0, {name: [] for name in TABLES})

    def read(self, name: str, parts: list[str] | None = None) -> DataFrame:
        """A table; ``parts`` leaves the folders of other parts (seasons, say) unread."""
        spec = TABLES[name]
        folders = self._tables()[name]
        if parts is not None:
            folders = [f for f in folders if _part_of(f) in parts]
        if not folders:
            return self.spark.createDataFrame([], spec.schema)
        base = f"{self.root}/{name}"
        return (
            self.spark.read.schema(spec.schema)
            .option("basePath", base)
            .parquet(*[f"{base}/{f}" for f in folders])
            .select(*spec.columns)
        )

    def commit(self, changes: dict[str, Append | Replace], count: dict[str, tuple[str, list[str]]] | None = None) -> int:
        """Write all changes, then publish them together; returns the new version.

        ``count`` names a column and its values for some tables; the rows of each value are
        counted by the writing job itself and stand in ``counts`` afterwards.
        """
        version = self._version() + 1
        tables, self.counts = dict(self._tables()), {}
        for name, change in changes.items():
            batch = f"batch={version:08d}-{uuid.uuid4().hex[:8]}"
            folders = self._write(name, batch, change.rows, *(count or {}).get(name, (None, ())))
            if isinstance(change, Append):
                kept = tables[name]
            elif change.parts is None:
                kept = []
            else:
                kept = [f for f in tables[name] if _part_of(f) not in change.parts]
            tables[name] = [*kept, *folders]
        self._publish(version, tables)
        return version

    def truncate(self) -> None:
        """Empty every table."""
        self._publish(self._version() + 1, {name: [] for name in TABLES})

    def _write(self, name: str, batch: str, rows: DataFrame, counted: str | None = None, values: list[str] = ()) -> list[str]:
        spec, path = TABLES[name], f"{self.root}/{name}/{batch}"
        rows = rows.select(*spec.columns, *[c for c in (counted,) if c and c not in spec.columns])
        if spec.partition_by:
            # Even files whatever the season sizes: a rebalance splits a large season
            # and joins small ones, and sorted files let scans skip by key.
            rows = rows.hint("rebalance", *spec.partition_by).sortWithinPartitions(
                *dict.fromkeys([*spec.partition_by, *spec.key])
            )
        seen = Observation()
        if values:
            # On top of the plan, where it also counts no rows at all.
            rows = rows.observe(seen, *[F.count_if(F.col(counted) == v).alias(f"n{i}") for i, v in enumerate(values)])
        rows.select(*spec.columns).write.partitionBy(*spec.partition_by).parquet(path)
        if values:
            self.counts[name] = {v: seen.get[f"n{i}"] for i, v in enumerate(values)}
        if not spec.partition_by:
            return [batch]
        fs, where = file_system(self.spark, path)
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return [f"{batch}/{n}" for n in sorted(names) if "=" in n]

    def _version(self) -> int | None:
        fs, where = file_system(self.spark, self.commits)
        if not fs.exists(where):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        versions = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()]
        return max(versions, default=None)

    def _tables(self) -> dict[str, list[str]]:
        fs, where = file_system(self.spark, f"{self.commits}/{self._version():08d}.json")
        stream = fs.open(where)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: int, tables: dict[str, list[str]]) -> None:
        fs, final = file_system(self.spark, f"{self.commits}/{version:08d}.json")
        _, draft = file_system(self.spark, f"{self.commits}/_{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(tables), "utf-8"))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"version {version} of {self.root} was published by another writer")
