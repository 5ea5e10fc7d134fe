"""SQLite files as a Python data source: one partition a file, each read by its own query (read only)."""

from __future__ import annotations

import sqlite3

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Database(InputPartition):
    def __init__(self, path: str):
        self.path = path


class Reader(DataSourceReader):
    def __init__(self, paths: list[str], query: str, tables: list[str], width: int):
        self.paths, self.query, self.tables, self.width = paths, query, tables, width

    def partitions(self):
        return [Database(p) for p in self.paths]

    def read(self, partition):
        conn = sqlite3.connect(f"file:{partition.path}?mode=ro", uri=True)
        try:
            have = {r[0] for r in conn.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}
            if not set(self.tables) <= have:
                return
            for row in conn.execute(self.query):
                yield (partition.path, *[bytes(x) if isinstance(x, memoryview) else x for x in row])
        except sqlite3.DatabaseError:  # not a database, or damaged: no rows, as for a missing table
            return
        finally:
            conn.close()


class SqliteSource(DataSource):
    """Options: paths (separated by newlines), query, tables (that must exist, separated by commas). The first column is the file's path."""

    @classmethod
    def name(cls):
        return "sqlite_files"

    def schema(self):
        raise ValueError("give a schema")

    def reader(self, schema):
        tables = [t for t in self.options.get("tables", "").split(",") if t]
        return Reader([p for p in self.options["paths"].split("\n") if p], self.options["query"], tables, len(schema.fields))


def read_sqlite(spark: SparkSession, paths: list[str], query: str, schema: str, tables: tuple[str, ...] = ()) -> DataFrame:
    """source_path and the query's columns from every file; the files must be reachable by the executors."""
    spark.dataSource.register(SqliteSource)
    options = {"paths": "\n".join(paths), "query": query, "tables": ",".join(tables)}
    return spark.read.format("sqlite_files").options(**options).schema(f"source_path string, {schema}").load()
