"""Staged export to a relational table: load beside it, check, then swap in one transaction.

The rows go to a staging table first, by all tasks in parallel.  A task that fails leaves the
mart as it was.  The loaded rows are counted against what was sent (a retried task can commit
its rows twice).  Then one connection deletes the rows that the load replaces and copies the
staged ones over, both in one transaction, so that readers see the old mart or the new one.
With a day column only the days of the load are replaced, and earlier dates stay."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class ExportMismatch(RuntimeError):
    """The staging table does not hold the rows that were sent."""


class _Connection:
    """A JDBC connection of the driver process, closed at the end, rolled back on an error."""

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str]):
        self.jvm, self.url = spark._jvm, url
        self.properties = self.jvm.java.util.Properties()
        for k, v in properties.items():
            self.properties.setProperty(k, v)
        if "driver" in properties:
            self.jvm.java.lang.Class.forName(properties["driver"], True, self.jvm.java.lang.Thread.currentThread().getContextClassLoader())

    def __enter__(self) -> "_Connection":
        self.raw = self.jvm.java.sql.DriverManager.getConnection(self.url, self.properties)
        self.raw.setAutoCommit(False)
        return self

    def __exit__(self, kind, value, trace) -> None:
        try:
            if kind is None:
                self.raw.commit()
            else:
                self.raw.rollback()
        finally:
            self.raw.close()

    def run(self, sql: str) -> int:
        statement = self.raw.createStatement()
        try:
            return statement.executeUpdate(sql)
        finally:
            statement.close()

    def number(self, sql: str) -> int:
        statement = self.raw.createStatement()
        try:
            rows = statement.executeQuery(sql)
            rows.next()
            return rows.getLong(1)
        finally:
            statement.close()

    def exists(self, table: str) -> bool:
        found = self.raw.getMetaData().getTables(None, None, "%", None)
        names = set()
        while found.next():
            names.add(found.getString(3).upper())
        return table.split(".")[-1].strip('"`').upper() in names


def export_staged(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, day_col: str | None = None,
                  num_partitions: int | None = 8) -> int:
    """Put ``df`` into ``table`` in one transaction and return the number of rows loaded.

    With ``day_col`` the days that ``df`` holds are replaced and all others stay; without it the
    whole table is replaced.  The first export creates the table with the types of ``df``."""
    spark, properties = df.sparkSession, dict(properties or {})
    staging = f"{table}_STG_{uuid.uuid4().hex[:8].upper()}"
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    columns = ", ".join(quote(c) for c in df.columns)
    # As VARCHAR the day can be compared; some databases hold Spark's strings as large objects, which cannot.
    types = {"createTableColumnTypes": f"`{day_col}` VARCHAR(32)"} if day_col else {}
    sent = Observation()
    out = (df.repartition(num_partitions) if num_partitions else df).observe(sent, F.count(F.lit(1)).alias("n"))
    try:
        out.write.mode("errorifexists").options(**types).jdbc(url, staging, properties=properties)
        with _Connection(spark, url, properties) as db:
            loaded = db.number(f"SELECT count(*) FROM {staging}")
            if loaded != sent.get["n"]:
                raise ExportMismatch(f"{loaded} rows in {staging}, {sent.get['n']} sent")
            there = db.exists(table)
        if not there:  # an empty table with the same columns; the rows come with the transaction below
            df.limit(0).write.mode("ignore").options(**types).jdbc(url, table, properties=properties)
        with _Connection(spark, url, properties) as db:
            where = f" WHERE {quote(day_col)} IN (SELECT {quote(day_col)} FROM {staging})" if day_col else ""
            db.run(f"DELETE FROM {table}{where}")
            db.run(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}")
        return loaded
    finally:
        with _Connection(spark, url, properties) as db:
            if db.exists(staging):
                db.run(f"DROP TABLE {staging}")
