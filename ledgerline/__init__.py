"""ledgerline: consumer-lending analytics as Spark DataFrame operators.

Every operator takes and returns a ``pyspark.sql.DataFrame``; no table is
collected to the driver; operators that number rows write a frozen copy when called.  Sub-packages:

* ``sources``   – fixed-schema readers, role views over parquet tables, sinks
* ``functions`` – column-level helpers (safe casts, rounding, category maps)
* ``operators`` – the lending operators (summaries, calendars, ranking, loans)
* ``plans``     – named query catalog with the equivalent DuckDB SQL
"""

from ledgerline.session import cluster_conf, ensure_checkpoint_dir, freeze, get_session, release_frozen

__all__ = ["get_session", "ensure_checkpoint_dir", "cluster_conf", "freeze", "release_frozen"]
