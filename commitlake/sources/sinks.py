"""Table sinks: full-refresh tables, views, and persisted table/column comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commitlake.operators.incremental import VersionedTable


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def point_table_at(spark: SparkSession, table: str, location: str) -> DataFrame:
    """Make ``database.table`` an external parquet table over ``location``.

    An existing table with the same columns is switched by its location alone, one catalog change: readers see the old
    or the new version, never a mixture or a gap. The old version's files stay until they are removed on purpose.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    schema = spark.read.parquet(location).schema
    same = spark.catalog.tableExists(table) and [(f.name, f.dataType) for f in spark.table(table).schema.fields] == [
        (f.name, f.dataType) for f in schema.fields]
    if same:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_quote(location)}")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, location, "parquet")
    return spark.table(table)


def publish(df: DataFrame, table: str, path: str, database: str = "marts") -> DataFrame:
    """Full-refresh table (``materialized='table'``): a new version of ``df`` under ``path``, then the switch.

    ``path`` is a folder of the warehouse that the caller names; nothing is published into scratch folders.
    """
    spark = df.sparkSession
    versions = VersionedTable(spark, path)
    versions.write(df)
    return point_table_at(spark, f"{database}.{table}", versions.folder())


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """View materialisation: a temp view over the plan (recomputed on every read)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def apply_comments(spark: SparkSession, table: str, description: str | None = None,
                   columns: dict[str, str] | None = None) -> None:
    """Persist a table description and column descriptions in the catalog."""
    if description:
        spark.sql(f"COMMENT ON TABLE {table} IS {_quote(description)}")
    existing = set(spark.table(table).columns)
    for col, text in (columns or {}).items():
        if col in existing:
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN {col} COMMENT {_quote(text)}")
