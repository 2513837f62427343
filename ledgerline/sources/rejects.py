"""Strict loads that name every bad row before they fail (S1, C23).

:func:`~ledgerline.sources.files.read_csv_strict` stops at the first bad cell.  :func:`load_checked` reads the files once,
keeps rows that do not fit the schema apart, and says of each in which file and row it stands, what its text is and
which columns did not parse.  Only then does the load fail, and the target is left as it was.

The files are scanned once, into a layout in the checkpoint folder; everything else reads that.  A row's number
follows from its place in its split and the rows of the file's earlier splits, so large files are still
read by many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.session import freeze
from ledgerline.sources.schemas import SCHEMAS

NAMED = 20                      # bad rows in the error's message; all are in the report
_BAD, _FILE, _SPLIT, _AT = "_lr_bad", "_lr_file", "_lr_split", "_lr_at"


class RejectedRows(ValueError):
    """Some rows do not fit the schema; ``report`` has them all."""

    def __init__(self, count: int, report: DataFrame, shown: list):
        self.count, self.report = count, report
        lines = [f"{r.file} row {r.row}: {r.text!r} ({', '.join(r.columns) or 'number of cells'})" for r in shown]
        more = [f"and {count - len(shown)} more"] if count > len(shown) else []
        super().__init__("\n".join([f"{count} rows do not fit the schema", *lines, *more]))


def read_checked(spark: SparkSession, path: str | list[str], schema) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, report of the others) of CSV files with a header and a declared schema.

    The report has ``file``, ``row`` (from 1, without the header and empty lines), ``text`` and ``columns`` (those whose
    cell did not parse; empty where the number of cells is wrong).  A header that does not match the schema is an
    error.  Files without rows give two empty tables."""
    schema = SCHEMAS[schema] if isinstance(schema, str) else schema
    names = schema.names
    raw = (spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _BAD).schema(StructType([*schema.fields, StructField(_BAD, StringType())]))
           .csv(path))
    laid = freeze(raw.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_SPLIT))
                  .withColumn(_AT, F.monotonically_increasing_id()), "load")
    good = laid.filter(F.col(_BAD).isNull()).select(*[F.col(f"`{n}`") for n in names])
    # rows of the earlier splits of a file; one row per split
    before = Window.partitionBy(_FILE).orderBy(_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    splits = (laid.groupBy(_FILE, _SPLIT).agg(F.count(F.lit(1)).alias("_n"), F.min(_AT).alias("_first"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    typed = StructType([StructField(n, StringType()) for n in names])
    cells = F.from_csv(F.col(_BAD), typed.simpleString()[7:-1].replace(":", " "))
    bad = laid.filter(F.col(_BAD).isNotNull()).withColumn("_cells", cells)
    failed = F.array_compact(F.array(*[F.when(F.col("_cells")[n].isNotNull() & F.col(f"`{n}`").isNull(), F.lit(n)) for n in names]))
    report = bad.join(splits, [_FILE, _SPLIT]).select(
        F.col(_FILE).alias("file"), (F.col("_before") + F.col(_AT) - F.col("_first") + 1).alias("row"),
        F.col(_BAD).alias("text"), failed.alias("columns"))
    return good, report


def load_checked(spark: SparkSession, path: str | list[str], schema, target: str | None = None,
                 report_to: str | None = None) -> DataFrame:
    """The rows of the files, written to the Parquet folder ``target`` if one is given (overwritten, so that a load may
    be repeated).  Where rows do not fit, nothing is written but their report, to ``report_to`` if given, and
    :class:`RejectedRows` is raised."""
    good, report = read_checked(spark, path, schema)
    report = freeze(report, "rejects")
    count = report.count()
    if count:
        if report_to:
            report.write.mode("overwrite").parquet(report_to)
        raise RejectedRows(count, report, report.orderBy("file", "row").limit(NAMED).collect())
    if target is None:
        return good
    good.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
