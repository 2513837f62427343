"""Zero-filled entity x period calendars and their pivots (C10-C12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.casts import try_double
from ledgerline.functions.ordering import asc
from ledgerline.functions.time import month_periods, to_zone
from ledgerline.sources.sinks import write_if_absent


def dense_calendar(entities: DataFrame, facts: DataFrame, periods=None, *,
                   key: str = "CustomerID", ts: str = "RepaymentDate",
                   amount: str = "Amount", period_of=F.month, hours=(6, 18),
                   zone_col: str | None = None, target_zone: str = "Europe/London",
                   period_name: str = "MonthName", count_name: str = "NumberOfRepayments",
                   total_name: str = "AmountTotal", sort: bool = False) -> DataFrame:
    """One row per entity row and period with the count and sum of its facts.

    Semantics of the reference ``timeline``: facts keep hours ``lo..hi``
    inclusive by hour number (so ``18:59`` is in), the count counts rows whose
    amount is NULL, periods of different years merge (month number only),
    missing cells are 0, and a duplicated entity repeats its rows.
    ``zone_col`` converts each wall-clock time from its own zone to
    ``target_zone`` before the hour and period are taken; ``hours=None`` keeps
    every hour.

    Plan: facts are reduced to one wide row per entity (a partial/final hash
    aggregate with one conditional count and sum per period), joined to the
    entities on the key alone, and only then expanded to the period rows with
    ``inline`` -- the join moves one row per entity instead of one per cell and
    there is no cross join.  ``periods`` is the small fixed dimension
    ``[(id, name), ...]`` (12 months by default) or a two-column DataFrame such
    as the ``months`` table; a table of any length is joined as (entity, period)
    cells, without a column per period.  The result is a table (the
    reference stores it and reads it back without ORDER BY), so it is not
    globally sorted; ``sort=True`` adds the (entity, period) order."""
    t = F.col(ts)
    if zone_col:
        t = to_zone(t, F.col(zone_col), target_zone)
    cleaned = facts.select(F.col(key).alias("_k"), period_of(t).alias("_p"),
                           try_double(amount).alias("_a"), F.hour(t).alias("_h"))
    if hours is not None:
        cleaned = cleaned.filter(F.col("_h").between(hours[0], hours[1]))
    if isinstance(periods, DataFrame):
        return _calendar_by_cell(entities, cleaned, periods, key, period_name, count_name, total_name, sort)
    periods = _period_list(periods)
    # The per-period aggregates and the cell array are generated; each is one
    # SQL expression (one JVM call) rather than a tree of Column objects.
    aggs = []
    for i, (pid, _) in enumerate(periods):
        aggs += [F.expr(f"sum(CASE WHEN _p = {int(pid)} THEN 1 ELSE 0 END) AS _n{i}"),
                 F.expr(f"sum(CASE WHEN _p = {int(pid)} THEN _a END) AS _s{i}")]
    wide = cleaned.groupBy("_k").agg(*aggs)
    joined = entities.select(F.col(key).alias("_k")).join(wide, "_k", "left")
    cells = ", ".join(
        f"named_struct('_pid', {int(pid)}, {_q(period_name)}, {_q(name)}, "
        f"{_q(count_name)}, coalesce(_n{i}, CAST(0 AS BIGINT)), "
        f"{_q(total_name)}, coalesce(_s{i}, CAST(0 AS DOUBLE)))"
        for i, (pid, name) in enumerate(periods))
    out = joined.select(F.col("_k").alias(key), F.expr(f"inline(array({cells}))"))
    if sort:
        out = out.orderBy(asc(key), asc("_pid"))
    return out.select(key, period_name, count_name, total_name)


def _calendar_by_cell(entities, cleaned, periods, key, period_name, count_name, total_name, sort) -> DataFrame:
    """The calendar over a period table: facts are reduced to one row per (entity,
    period); the period table rides along as one array, expanded per entity."""
    pid, name = (F.col(c) for c in periods.columns[:2])
    spine = periods.agg(F.sort_array(F.collect_list(F.struct(
        pid.cast("int").alias("_pid"), name.cast("string").alias(period_name)))).alias("_all")).scalar()
    cells = cleaned.groupBy(F.col("_k").alias("_ck"), "_p").agg(F.count(F.lit(1)).alias("_n"), F.sum("_a").alias("_s"))
    slots = entities.select(F.col(key), F.explode(spine).alias("_e")).select(key, "_e.*")
    out = slots.join(cells, (F.col(key) == F.col("_ck")) & (F.col("_pid") == F.col("_p")), "left").select(
        key, "_pid", period_name, F.coalesce("_n", F.lit(0).cast("bigint")).alias(count_name),
        F.coalesce("_s", F.lit(0.0)).alias(total_name))
    if sort:
        out = out.orderBy(asc(key), asc("_pid"))
    return out.select(key, period_name, count_name, total_name)


def _period_list(periods) -> list[tuple[int, str]]:
    """(id, name) of each period; each becomes columns of the result."""
    if periods is None:
        return month_periods()
    if isinstance(periods, DataFrame):
        return sorted((int(r[0]), str(r[1])) for r in periods.collect())
    return list(periods)


def _q(text: str) -> str:
    """SQL string literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def pivot_calendar(timeline: DataFrame, periods=None, key: str = "CustomerID",
                   period_name: str = "MonthName", count_col: str = "NumberOfRepayments",
                   total_col: str = "AmountTotal", method: str = "conditional") -> DataFrame:
    """``PIVOT (SUM(CAST(n AS INTEGER)) AS Repayments, SUM(CAST(total AS INTEGER))
    AS Total FOR MonthName IN (...))``: one row per entity, columns
    ``January_Repayments``, ``January_Total``, ...

    ``Total`` sums per-row integer-rounded amounts (half to even, as the
    reference's cast), so it can differ from the rounded sum.  Repayments are
    INT, Totals BIGINT; a month with no row is NULL.

    Written as one conditional sum per (month, measure) -- the plan Spark's
    ``pivot()`` itself falls back to -- so it is a single aggregate keyed by
    the entity: ``pivot()`` with two measures first groups by (entity, month),
    which costs an extra shuffle.  ``method="pivot"`` uses ``pivot()`` itself
    (same result)."""
    names = [n for _, n in _period_list(periods)]
    if method == "pivot":
        pv = (timeline.groupBy(key).pivot(period_name, names)
              .agg(F.sum(F.col(count_col).cast("int")).alias("Repayments"),
                   F.sum(F.rint(F.col(total_col)).cast("bigint")).alias("Total")))
        cols = [F.col(key)]
        for n in names:
            cols += [F.col(f"{n}_Repayments").cast("int").alias(f"{n}_Repayments"),
                     F.col(f"{n}_Total").cast("bigint").alias(f"{n}_Total")]
        return pv.select(*cols).orderBy(asc(key))
    if method != "conditional":
        raise ValueError(f"unknown method {method!r}")
    p, c, t = _ident(period_name), _ident(count_col), _ident(total_col)
    aggs = []
    for n in names:
        aggs += [F.expr(f"CAST(sum(CASE WHEN {p} = {_q(n)} THEN CAST({c} AS INT) END) AS INT)"
                        f" AS {_ident(n + '_Repayments')}"),
                 F.expr(f"CAST(sum(CASE WHEN {p} = {_q(n)} THEN CAST(rint({t}) AS BIGINT) END)"
                        f" AS BIGINT) AS {_ident(n + '_Total')}")]
    return timeline.groupBy(key).agg(*aggs).orderBy(asc(key))


def conditional_pivot(timeline: DataFrame, periods=None, key: str = "CustomerID",
                      period_name: str = "MonthName", count_col: str = "NumberOfRepayments",
                      total_col: str = "AmountTotal") -> DataFrame:
    """The pivot written as conditional aggregation, with the column names the
    task text asks for: ``JanuaryRepayments`` (INT), ``JanuaryTotal`` (DOUBLE)."""
    names = [n for _, n in _period_list(periods)]
    p, c, t = _ident(period_name), _ident(count_col), _ident(total_col)
    aggs = []
    for n in names:
        aggs += [F.expr(f"CAST(sum(CASE WHEN {p} = {_q(n)} THEN {c} END) AS INT)"
                        f" AS {_ident(n + 'Repayments')}"),
                 F.expr(f"sum(CASE WHEN {p} = {_q(n)} THEN {t} END) AS {_ident(n + 'Total')}")]
    return timeline.groupBy(key).agg(*aggs).orderBy(asc(key))


def save_timeline(entities: DataFrame, facts: DataFrame, name: str = "timeline",
                  **options) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS timeline AS ...``: write the dense calendar
    once; later calls return the stored table unchanged (as in the
    reference, a stale table is kept).  ``options`` go to :func:`dense_calendar`."""
    return write_if_absent(dense_calendar(entities, facts, **options), name)
