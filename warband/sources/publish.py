"""Replacing stored tables so that a failed write leaves the old one readable.

New rows are written beside the old ones first. Only when that has ended are the names swapped: the old table is
renamed away, the new one takes its name, and the old one is deleted. Should a process end between the two renames,
the next publication finds the old table under its set-aside name and puts it back first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class _Folders:
    """Folder operations of whatever file system the paths name."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.at(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self.at(path), True)

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self.at(old), self.at(new)):
            raise OSError(f"{old} could not be renamed to {new}")


def publish_path(df: DataFrame, path: str) -> None:
    """Replace the parquet folder ``path`` by ``df``, which may read the folder itself."""
    path = path.rstrip("/")
    parent, name = path.rsplit("/", 1) if "/" in path else (".", path)
    old, new = f"{parent}/_old_{name}", f"{parent}/_new_{name}_{uuid.uuid4().hex}"    # readers skip names like these
    folders = _Folders(df.sparkSession, path)
    if folders.exists(old) and not folders.exists(path):
        folders.rename(old, path)
    try:
        df.write.parquet(new)
    except BaseException:
        folders.delete(new)
        raise
    folders.delete(old)
    if folders.exists(path):
        folders.rename(path, old)
    folders.rename(new, path)
    folders.delete(old)


def publish_table(df: DataFrame, table: str, bucket_by: tuple[int, tuple[str, ...]] | None = None) -> None:
    """Replace the catalog table ``table`` by ``df``, whatever the old table's columns; its database is created if need be.
    ``bucket_by`` (number, columns) buckets and sorts the table."""
    spark = df.sparkSession
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    old, new, exists = f"{table}__old", f"{table}__new", spark.catalog.tableExists
    if exists(old) and not exists(table):
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    writer = df.write.mode("overwrite")
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    writer.saveAsTable(new)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    if exists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
