"""A script of several statements, the last result of which is the answer (S9).

Statements are run by Spark's own SQL scripting, in order; tables that one writes are there for the next.  Nothing
is parsed here.  A failing statement ends the script: what earlier ones have written stays, as in the reference."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


class ScriptError(RuntimeError):
    """A statement of a script failed; the message names its line."""


def run_script(spark: SparkSession, script: str, args: dict | None = None) -> DataFrame:
    """Run the statements of ``script``, ended by semicolons, and return the result of the last one.  ``args`` are
    values for ``:name`` markers; ``IDENTIFIER(:name)`` takes a table's name from one."""
    body = script.strip().rstrip(";")
    try:
        return spark.sql(f"BEGIN\n{body};\nEND", args) if args else spark.sql(f"BEGIN\n{body};\nEND")
    except PySparkException as e:
        raise ScriptError(_place(body, e)) from e


def _place(body: str, error: PySparkException) -> str:
    """The line that Spark's error points at, and the error."""
    text, lines = str(error), body.splitlines()
    at = re.search(r"[Ll]ine:? (\d+)", text)
    number = int(at.group(1)) - 1 if at else 0        # BEGIN is line 1
    reason = text.split("\n", 1)[0]
    if 1 <= number <= len(lines):
        return f"statement at line {number}, {lines[number - 1].strip()!r}: {reason}"
    return reason
