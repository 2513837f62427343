"""Operator 2: URL rules by a sort-merge range join.

Every host becomes a reversed-label key (``blog.example.org`` ->
``org.example.blog.``), so a rule's host and all its subdomains are one key
interval.  Urls and rules are dealt to key ranges, sorted together inside each
range, and one sweep per range keeps a stack of the rules whose interval is open
(intervals nest or are disjoint, so a stack is enough).

Skew: a url's sort key ends with a hash of its id, and range bounds come from a
deterministic sample of such keys, so the urls of one host, or copies of one url,
spread over as many ranges as their share needs.  A rule is sent to every range
its interval touches.  The sweep streams Arrow batches; a task holds the open
rules and one batch.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys sampled for each range; bounds only balance the ranges.
SAMPLE_PER_RANGE = 64
SCHEMA = "id {id}, host string, path string, rule string, verdict string"


def host_of(url) -> F.Column:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for NULL or no ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url) -> F.Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host) -> F.Column:
    """Labels reversed, each ended by a dot; empty for an empty host."""
    return F.when(host == "", "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, "\\.", -1)), "."), F.lit(".")))


class OpenRules:
    """Stack of the rules whose key interval holds the sweep's position."""

    def __init__(self):
        self.stack: list[tuple[str, str, dict[str, str], list[int]]] = []

    def advance(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def add(self, key: str, host: str, path: str, verdict: str) -> None:
        self.advance(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, host, {}, []))
        _, _, paths, lengths = self.stack[-1]
        if paths.get(path) != "block":  # of equal rules a block holds
            paths[path] = verdict
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def best(self, path: str) -> tuple[str, str] | None:
        """The longest rule (host and path together; ties: the longer host)."""
        found, longest = None, -1
        for _, host, paths, lengths in reversed(self.stack):
            for n in lengths:
                if n <= len(path) and (verdict := paths.get(path[:n])) is not None:
                    if len(host) + n > longest:
                        found, longest = (host + path[:n], verdict), len(host) + n
                    break
        return found


def judge_urls(df: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", ranges: int | None = None) -> DataFrame:
    """``<id_col>, host, path, rule, verdict`` for every row of ``df``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``).  A
    rule fits its host and all subdomains if the url's path starts with the
    rule's; the longest wins; without a rule ``rule`` is NULL and the verdict is
    ``default``.  NULL urls and urls without ``://`` have empty host and path and
    fit no rule; rules with a NULL or empty host are void, a NULL path is empty;
    repeated rows are judged one by one; no rules or no urls are fine."""
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = df.schema[id_col].dataType.simpleString()
    url = F.col(url_col).cast("string")
    urls = (df.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
                      F.xxhash64(F.col(id_col), url).alias("_salt"))
            .withColumn("key", host_key(F.col("host")))
            .withColumn("sort", F.concat("key", F.lit("\0"), F.lpad(F.hex("_salt"), 16, "0"))))
    sample = [r[0] for r in urls.select("sort").orderBy(F.xxhash64("sort")).limit(n * SAMPLE_PER_RANGE).collect()]
    sample.sort()
    bounds = [sample[len(sample) * i // n] for i in range(1, n)] if sample else []

    @F.pandas_udf("int")
    def range_of(sort: pd.Series) -> pd.Series:
        return sort.map(lambda s: bisect_right(bounds, s)).astype("int32")

    @F.pandas_udf("array<int>")
    def ranges_of(key: pd.Series) -> pd.Series:
        return key.map(lambda k: list(range(bisect_right(bounds, k), bisect_right(bounds, k + "\U0010ffff") + 1)))

    events = urls.select(range_of("sort").alias("range"), "sort", F.lit(1).alias("kind"), "id", "key", "host", "path",
                         F.lit(None).cast("string").alias("verdict"))
    host = F.translate(F.col("host").cast("string"), UPPER, LOWER)
    opened = (rules.select(host.alias("host"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                           F.col("verdict").cast("string").alias("verdict"))
              .filter("host <> ''").withColumn("key", host_key(F.col("host")))
              .withColumn("range", F.explode(ranges_of("key")))
              .select("range", F.col("key").alias("sort"), F.lit(0).alias("kind"),
                      F.lit(None).cast(id_type).alias("id"), "key", "host", "path", "verdict"))

    def sweep(batches):
        at, active = None, OpenRules()
        for b in batches:
            ranges_, kinds, ids, keys, hosts, paths, verdicts = (b.column(i) for i in (0, 2, 3, 4, 5, 6, 7))
            rule, verdict, keep = [], [], []
            rows = zip(ranges_.to_pylist(), kinds.to_pylist(), keys.to_pylist(), hosts.to_pylist(),
                       paths.to_pylist(), verdicts.to_pylist())
            for i, (where, kind, key, host, path, said) in enumerate(rows):
                if where != at:
                    at, active = where, OpenRules()
                if kind == 0:
                    active.add(key, host, path, said)
                    continue
                active.advance(key)
                best = active.best(path)
                keep.append(i)
                rule.append(best and best[0])
                verdict.append(best[1] if best else default)
            take = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), hosts.take(take), paths.take(take), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string())], ["id", "host", "path", "rule", "verdict"])

    out = (events.unionByName(opened).repartitionById(n, "range").sortWithinPartitions("range", "sort", "kind")
           .mapInArrow(sweep, SCHEMA.format(id=id_type)))
    return out.withColumnRenamed("id", id_col)
