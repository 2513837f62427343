"""Query catalog (Spark plans + equivalent DuckDB SQL)."""

from ledgerline.plans.catalog import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
