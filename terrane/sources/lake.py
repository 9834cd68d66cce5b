"""Catalog tables of the three layers.

In the session catalog, which has no transactional table format, a table is an external table over
a folder. Three ways of writing cover all jobs:

* ``append`` adds rows by column name;
* ``publish`` writes a complete new version into a folder of its own and then points the table at
  it. Readers, the job's own plan included, keep the old version until the switch.
* ``overwrite_parts`` replaces the partitions of a partitioned table for which it gets rows, and no others.

With another catalog (a lakehouse format behind the DataSource V2 API) the same methods go
through ``DataFrame.writeTo``.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence
from copy import copy

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_IDS, PARTITIONS, TABLES
from .scratch import stage

log = logging.getLogger(__name__)


class Lake:
    """Tables named ``<layer>.<table>`` below ``root``, in one catalog and file format.

    With ``buckets`` the event tables are bucketed by their id, so that the search for new rows
    compares two layers bucket by bucket, without a shuffle of either table. Choose it so that a
    bucket fits a task at the expected size; it is fixed when a table is created.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        fmt: str = "orc",
        catalog: str | None = None,
        tables: Mapping[str, str] = TABLES,
        buckets: int = 0,
    ):
        self.spark, self.root, self.fmt, self.tables = spark, root.rstrip("/"), fmt, tables
        self.v2 = catalog not in (None, "spark_catalog")
        self.prefix = f"{catalog}." if self.v2 else ""
        self.buckets = 0 if self.v2 else buckets

    def name(self, table: str) -> str:
        return self.prefix + table

    def on(self, spark: SparkSession) -> Lake:
        """The same lake in another session, such as the one of a micro-batch."""
        other = copy(self)
        other.spark = spark
        return other

    def create(self, table: str | None = None, columns: str | None = None) -> None:
        """Create one table, or all declared ones; existing tables and their rows stay."""
        for each in [table] if table else self.tables:
            layer = each.split(".")[0]
            self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self.prefix}{layer}")
            place = "" if self.v2 else f" LOCATION '{self._new_folder(each)}'"
            declared = self.tables.get(each, columns)
            parted = f" PARTITIONED BY ({PARTITIONS[each]})" if self._parted(each) else ""
            bucketed = f" CLUSTERED BY ({EVENT_IDS[each]}) INTO {self.buckets} BUCKETS" if self._bucketed(each) else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(each)} ({declared}) USING {self.fmt}{parted}{bucketed}{place}"
            )

    def drop(self, table: str) -> None:
        """Remove a table from the catalog; only ever called by name, never as part of set-up."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def load(self, table: str) -> DataFrame | None:
        """The table, or None (logged) when it does not exist."""
        if self.exists(table):
            return self._table(table)
        log.warning("table %s does not exist", self.name(table))
        return None

    def load_or_empty(self, table: str) -> DataFrame:
        """The table, or an empty frame with its declared schema."""
        if self.exists(table):
            return self._table(table)
        return self.spark.createDataFrame([], self.tables[table])

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows, matched by column name and cast to the table's types; missing columns are NULL."""
        rows = self._shaped(table, df, existing=True)
        self.create(table, _ddl(rows))
        if self.v2:
            rows.writeTo(self.name(table)).append()
        else:
            if self._bucketed(table):
                # One file per bucket and append, instead of one per bucket and task.
                rows = rows.repartition(self.buckets, EVENT_IDS[table])
            self._positioned(table, rows).write.insertInto(self.name(table))

    def publish(self, table: str, df: DataFrame) -> None:
        """Replace the whole table by ``df``, which may read the table itself."""
        rows = self._shaped(table, df)
        if self.v2:
            rows.writeTo(self.name(table)).using(self.fmt).createOrReplace()
            return
        self.create(table, _ddl(rows))
        folder = self._new_folder(table)
        by = [PARTITIONS[table]] if self._parted(table) else []
        rows.write.format(self.fmt).partitionBy(*by).save(folder)
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{folder}'")
        if by:
            # The catalog still has the old version's partitions; their files stay.
            old = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()]
            if old:
                specs = ", ".join(f"PARTITION ({_spec(x)})" for x in old)
                self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {specs}")
            self.spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.name(table))

    def load_parts(self, table: str, values: Sequence) -> DataFrame:
        """The rows in the partitions of these values, None among them or not; no other file is opened."""
        part, some = F.col(PARTITIONS[table]), [v for v in values if v is not None]
        wanted = part.isin(*some) if some else F.lit(False)
        return self.load_or_empty(table).where(wanted | part.isNull() if None in values else wanted)

    def overwrite_parts(self, table: str, df: DataFrame) -> None:
        """Replace the partitions that ``df`` has rows of; the others keep their files.

        ``df`` must not read the table: stage it. A repeated call with the same rows gives the same table.
        """
        rows = self._shaped(table, df)
        self.create(table)
        if self.v2:
            rows.writeTo(self.name(table)).overwritePartitions()
            return
        if self._bucketed(table):
            rows = rows.repartition(self.buckets, EVENT_IDS[table])
        # insertInto takes this mode from the session only.
        mode, conf = "spark.sql.sources.partitionOverwriteMode", self.spark.conf
        usual = conf.get(mode)
        conf.set(mode, "dynamic")
        try:
            self._positioned(table, rows).write.mode("overwrite").insertInto(self.name(table))
        finally:
            conf.set(mode, usual)
        self.spark.catalog.refreshTable(self.name(table))

    def replace_rows(self, table: str, updates: DataFrame, keys: Sequence[str]) -> list:
        """Put ``updates`` in place of the rows of equal ``keys``; only their partitions are read and written.

        A row must stay in its partition. Returns the values of the partitions, which are as many as
        the dates that changed; none are touched if there is no update.
        """
        part = PARTITIONS[table]
        updates = stage(self._shaped(table, updates))
        touched = [r[0] for r in updates.select(part).distinct().collect()]
        if touched:
            there = self.load_parts(table, touched)
            kept = there.join(updates.select(*keys), on=list(keys), how="left_anti").select(*there.columns)
            self.overwrite_parts(table, stage(kept.unionByName(updates)))
        return touched

    def preview(self, table: str, n: int = 10) -> DataFrame:
        """The first ``n`` rows that a scan finds."""
        return self.spark.table(self.name(table)).limit(n)

    def describe(self, table: str) -> DataFrame:
        """Column names and types."""
        return self.spark.sql(f"DESCRIBE TABLE {self.name(table)}")

    def _bucketed(self, table: str) -> bool:
        return self.buckets > 0 and table in EVENT_IDS

    def _parted(self, table: str) -> bool:
        return table in PARTITIONS and table in self.tables

    def _positioned(self, table: str, rows: DataFrame) -> DataFrame:
        """The columns in the catalog's order, which has the partition column last."""
        if not self._parted(table):
            return rows
        return rows.select(*[c for c in rows.columns if c != PARTITIONS[table]], PARTITIONS[table])

    def _table(self, table: str) -> DataFrame:
        if not self.v2:
            # A session remembers the files of a table; streams append to it from sessions of their own.
            self.spark.catalog.refreshTable(self.name(table))
        found = self.spark.table(self.name(table))
        if not self._parted(table):
            return found
        declared = [f.name for f in self.spark.createDataFrame([], self.tables[table]).schema]
        return found.select(*[c for c in declared if c in found.columns])

    def _new_folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}/{uuid.uuid4().hex}"

    def _shaped(self, table: str, df: DataFrame, existing: bool = False) -> DataFrame:
        """``df`` in the declared columns, or with ``existing`` in those of an undeclared table that is there."""
        if table not in self.tables:
            return df.to(self._table(table).schema) if existing and self.exists(table) else df
        return df.to(self.spark.createDataFrame([], self.tables[table]).schema)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema)


def _spec(partition: str) -> str:
    """``column=value`` of SHOW PARTITIONS as a partition spec."""
    name, value = partition.split("=", 1)
    return f"{name}=null" if value in ("null", "__HIVE_DEFAULT_PARTITION__") else f"{name}='{value}'"
