"""File readers: strict fixed-schema CSV, inferred CSV, and the table loader."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.schemas import SCHEMAS


def read_csv_strict(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with a header and a declared schema; a bad value or a header that
    does not match the declared columns is an error, never a silent NULL.

    ``enforceSchema=False`` makes Spark check the header against the schema and
    ``FAILFAST`` turns unparsable cells into a job failure (the default
    PERMISSIVE mode would load them as NULL)."""
    if isinstance(schema, str):
        schema = SCHEMAS[schema]
    return (spark.read
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .schema(schema)
            .csv(path))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """``pd.read_csv`` equivalent: header plus type inference (one extra pass);
    prefer :func:`read_csv_strict` for production loads."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def load_tables(spark: SparkSession, paths: dict[str, str], out_dir: str | None = None,
                ) -> dict[str, DataFrame]:
    """Read each named table with its fixed schema; optionally persist each one
    once as Parquet (overwrite, so a re-run replaces rather than appends) and
    return readers over the written copies."""
    frames = {name: read_csv_strict(spark, p, SCHEMAS[name]) for name, p in paths.items()}
    if out_dir is None:
        return frames
    out = {}
    for name, df in frames.items():
        target = os.path.join(out_dir, name)
        df.write.mode("overwrite").parquet(target)
        out[name] = spark.read.parquet(target)
    return out
