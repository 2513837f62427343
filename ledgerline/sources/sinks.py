"""Table-writing statements of the reference, as DataFrame writes.

Parquet tables cannot be updated in place, so ``UPDATE`` becomes a rewritten
column and ``CREATE OR REPLACE`` an overwrite.  All writers go through the
DataFrameWriter (no driver-side rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def create_table_if_absent(spark: SparkSession, name: str, schema) -> None:
    """``CREATE TABLE IF NOT EXISTS name (cols)``: no-op when present."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """``INSERT INTO name SELECT ...``: appends (each re-run adds rows, as in SQL).

    Columns are matched by position, like INSERT without a column list."""
    df.write.insertInto(name, overwrite=False)


def write_if_absent(df: DataFrame, name: str) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS name AS SELECT``: the first result is kept."""
    df.write.mode("ignore").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE TABLE name AS SELECT``."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def update_where(df: DataFrame, column: str, value, predicate: Column) -> DataFrame:
    """``UPDATE t SET column = value WHERE predicate`` as a new DataFrame.

    A NULL predicate leaves the row unchanged, as in SQL."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(predicate, v).otherwise(F.col(column)))
