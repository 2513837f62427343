"""Operator 6: approximate nearest neighbours over balanced posting lists.

* Centroids are fitted by a balanced k-means on a bounded sample; a neighbour graph over
  them, held in memory, is searched best-first.
* Every vector is indexed.  It joins the list of its nearest centroid and, near a boundary,
  those of up to ``COPIES - 1`` more (a centroid much nearer to one already taken than to the
  vector is passed over).
* A query reads the lists whose centroid is at most ``ratio`` times as far as the nearest;
  it walks the graph for them, wider until a centroid beyond that is found.  Of up to
  ``4 * WIDTH`` centroids, and for a query that needs more than that many, all are scanned.
  The ratio is the smallest that finds ``TARGET`` of the true neighbours inside the sample,
  so it follows the data: few lists where clusters are clear, many where they aren't.
* Distances are computed in double precision on the original vectors.

Equal vectors are one point that keeps its smallest ``k + 1`` ids, all that any answer can hold,
so a vector that stands in a third of all rows makes no large list.  Lists are split into parts,
and the queries of a list into blocks, of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import freeze

#: Most vectors that centroids and ratio are fitted on; most centroids.
SAMPLE_ROWS, MAX_CENTROIDS = 20_000, 4096
#: Vectors to a list on average, most vectors of a part of a list, most queries of a block.
LIST_ROWS, PART_ROWS, BLOCK_QUERIES = 400, 4096, 4096
#: Lists that a vector may join, how much farther the later ones may be than the first.
COPIES, BOUNDARY = 4, 1.1
#: A further list's centroid must be at least so far, relative to the vector's distance, from
#: those of the lists already joined.
APART = 0.5
#: Share of the true neighbours that the ratio must find inside the sample.
TARGET = 0.97
#: Neighbours of a centroid in the graph, centroids kept during a search for lists to join.
DEGREE, WIDTH = 16, 32
PROBES_TRIED = 400


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows (to rank centroids; not for results)."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0.0)


def balanced_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids whose lists are of similar size: a list over the average size is charged
    for it in the next assignment."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    charge = np.zeros(k)
    for _ in range(rounds):
        d = squared(x, c)
        unit = float(d.min(1).mean())
        nearest = np.argmin(d + charge, axis=1)
        size = np.bincount(nearest, minlength=k)
        charge = np.clip(charge + 0.1 * unit * (size * k / len(x) - 1), 0, unit)
        total = np.zeros_like(c)
        np.add.at(total, nearest, x)
        some = size > 0
        c[some] = total[some] / size[some, None]
        if not some.all():  # an empty list starts anew
            c[~some] = x[rng.choice(len(x), (~some).sum(), replace=False)]
    # a centroid of hardly any vectors (an outlier) would hide the rest from a query that lies on it
    size = np.bincount(np.argmin(squared(x, c), axis=1), minlength=k)
    return c[size >= min(0.1 * len(x) / k, size.max())]


class CentroidGraph:
    """Centroids and, for each, its nearest neighbours (both directions) and a few far ones."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.c = centroids
        k = len(centroids)
        self.norm = (centroids * centroids).sum(1)
        near = min(degree, k - 1)
        rows = [set() for _ in range(k)]
        for at in range(0, k, 512):
            d = squared(centroids[at:at + 512], centroids)
            d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
            for i, nn in enumerate(np.argpartition(d, near - 1, axis=1)[:, :near] if near else []):
                rows[at + i].update(nn.tolist())
                for j in nn.tolist():
                    if len(rows[j]) < 2 * degree:
                        rows[j].add(at + i)
        rng = np.random.default_rng(11)
        most = max((len(r) for r in rows), default=0) + 2
        self.next = np.array([(list(r) + rng.integers(0, k, most - len(r)).tolist()) for r in rows], np.int64).reshape(k, most)
        self.entry = np.unique(rng.integers(0, k, min(k, 8)))

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(distances, centroids) of about the ``width`` nearest centroids of every row,
        nearest first: best-first search, all rows step by step together."""
        k, n = len(self.c), len(x)
        width = min(width, k)
        if width * 4 >= k:  # the graph would visit them all
            d = squared(x, self.c)
            ids = np.argsort(d, axis=1, kind="stable")[:, :width]
            return np.sqrt(np.take_along_axis(d, ids, 1)), ids
        x_norm = (x * x).sum(1)[:, None]

        def far(ids):
            return np.maximum(x_norm + self.norm[ids] - 2 * np.einsum("nij,nj->ni", self.c[ids], x), 0.0)
        ids = np.tile(self.entry, (n, 1))
        d = far(ids)
        done = np.zeros(ids.shape, bool)
        while True:
            open_d = np.where(done, np.inf, d)
            best = np.argmin(open_d, axis=1)
            live = np.flatnonzero(np.isfinite(open_d[np.arange(n), best]))
            if not len(live):
                break
            done[live, best[live]] = True
            new = np.full((n, self.next.shape[1]), -1)
            new[live] = self.next[ids[live, best[live]]]
            fresh_d = np.where(new >= 0, far(np.maximum(new, 0)), np.inf)
            known = (new[:, :, None] == ids[:, None, :]).any(2)
            first = np.argsort(new, axis=1, kind="stable")
            in_order = np.take_along_axis(new, first, 1)
            again = np.zeros_like(known)
            np.put_along_axis(again, first, np.concatenate([np.zeros((n, 1), bool), in_order[:, 1:] == in_order[:, :-1]], 1), 1)
            fresh_d[known | again] = np.inf
            ids, d = np.concatenate([ids, new], 1), np.concatenate([d, fresh_d], 1)
            done = np.concatenate([done, ~np.isfinite(fresh_d)], 1)
            if ids.shape[1] > width:
                keep = np.argsort(d, axis=1, kind="stable")[:, :width]
                ids, d, done = (np.take_along_axis(a, keep, 1) for a in (ids, d, done))
        order = np.argsort(d, axis=1, kind="stable")
        return np.sqrt(np.take_along_axis(d, order, 1)), np.take_along_axis(ids, order, 1)

    def lists_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists that each row joins."""
        d, ids = self.search(x, WIDTH)
        take = np.zeros(ids.shape, bool)
        take[:, 0] = True
        count = np.ones(len(x), np.int64)
        for j in range(1, min(ids.shape[1], 2 * COPIES)):
            ok = (d[:, j] <= BOUNDARY * d[:, 0]) & (count < COPIES) & (ids[:, j] >= 0) & np.isfinite(d[:, j])
            for i in range(j):
                between = ((self.c[ids[:, j]] - self.c[ids[:, i]]) ** 2).sum(1)
                ok &= ~take[:, i] | (between >= (APART * d[:, j]) ** 2)
            take[:, j] = ok
            count += ok
        rows, at = np.nonzero(take)
        return rows, ids[rows, at]

    def lists_to_read(self, x: np.ndarray, ratio: float, floor: float, size: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists that each query reads: those within ``ratio``, and the nearest
        until they hold ``enough`` vectors (``size``: vectors of each list)."""
        out, left = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], np.arange(len(x))
        for width in (WIDTH, 4 * WIDTH, len(self.c)):
            d, ids = self.search(x[left], width)
            held = np.where(np.isfinite(d), size[ids], 0)
            near = (d <= ratio * np.maximum(d[:, :1], floor)) | (np.cumsum(held, 1) - held < enough)
            near &= np.isfinite(d)
            # the last one found is too far, so all others are; or there are no others
            done = (~near[:, -1] & np.isfinite(d[:, -1])) | (width >= len(self.c))
            rows, where = np.nonzero(near & done[:, None])
            out.append((left[rows], ids[rows, where]))
            left = left[~done]
            if not len(left):
                break
        rows, lists = (np.concatenate(c) for c in zip(*out))
        return rows, lists


def fit_ratio(x: np.ndarray, graph: CentroidGraph, k: int) -> tuple[float, float]:
    """(ratio, floor): the smallest ratio that finds ``TARGET`` of the ``k`` nearest inside
    the sample; distances to the nearest centroid below ``floor`` (their median) count as
    that, or a query that happens to lie on a centroid would read its list alone."""
    tried = np.linspace(0, len(x) - 1, min(PROBES_TRIED, len(x))).astype(np.int64)
    rows, lists = graph.lists_of(x)
    start = np.searchsorted(rows, np.arange(len(x) + 1))
    to_lists = np.sqrt(squared(x[tried], graph.c))
    floor = float(np.median(to_lists.min(1)))
    needed = []
    for q, own in zip(tried, to_lists):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        for j in np.argsort(d, kind="stable")[:k]:
            if np.isfinite(d[j]):
                needed.append(own[lists[start[j]:start[j + 1]]].min() / max(own.min(), floor, 1e-12))
    return float(np.quantile(needed, TARGET)) * (1 + 1e-9) if needed else 1.0, floor


def _valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.transform(F.col(vector_col), lambda e: e.cast("double"))
    ok = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))) & F.exists("v", lambda e: e != 0)
    return df.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null").filter(ok)


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a list<double> column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10,
            sample_rows: int = SAMPLE_ROWS, list_rows: int = LIST_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` the ``k``
    nearest found among all other rows (all, if fewer), by Euclidean distance in double
    precision, ties to the smaller id.

    Rows without an id and vectors that are NULL, empty, zero or hold NULL, NaN or infinite
    components take no part, nor do vectors whose length is not the most frequent one (of equally
    frequent the smallest).  Rows that repeat id and vector are one; of rows that share only
    the id none is a neighbour of another."""
    spark = df.sparkSession
    valid = _valid(df, id_col, vector_col)
    dims = valid.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if dims is None:
        return spark.createDataFrame([], schema)
    dim = dims["dim"]
    valid = valid.filter(F.size("v") == dim).distinct()
    # equal vectors: one point with the k + 1 smallest ids
    some = valid.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    points = freeze(some.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("pid", F.element_at("ids", 1)), "points")
    asked = valid.filter(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "v")
    pid_of = points.select("v", "pid")
    asked = freeze(asked.join(pid_of, "v").select("query_id", "pid"), "asked")

    n = points.count()
    # the sample: points with the least hashes, at most sample_rows of them
    sample = points.select("pid", "v").orderBy(F.xxhash64("pid"), "pid").limit(sample_rows).toArrow()
    x = _matrix(sample["v"], dim)
    lists = int(min(MAX_CENTROIDS, max(1, n // list_rows), max(1, len(x) // 4)))
    graph = CentroidGraph(balanced_kmeans(x, lists))
    lists = len(graph.c)
    ratio, floor = fit_ratio(x, graph, k)
    shared = spark.sparkContext.broadcast(graph)  # at most MAX_CENTROIDS vectors

    def join_lists(batches):
        for b in batches:
            if b.num_rows:
                rows, of = shared.value.lists_of(_matrix(b.column(1), dim))
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), *(b.column(i).take(take) for i in range(3))],
                                                 ["list", "pid", "v", "ids"])

    postings = freeze(points.select("pid", "v", "ids").mapInArrow(join_lists, "list int, pid bigint, v array<double>, ids array<bigint>"), "postings")
    size = np.zeros(lists, np.int64)  # one number a list, at most MAX_CENTROIDS
    for r in postings.groupBy("list").count().collect():
        size[r["list"]] = r["count"]

    def choose_lists(batches):
        for b in batches:
            if b.num_rows:
                vectors = _matrix(b.column(1), dim)
                for at in range(0, len(vectors), 1024):
                    # enough lists for k + 1 points at least
                    rows, of = shared.value.lists_to_read(vectors[at:at + 1024], ratio, floor, size, COPIES * (k + 1))
                    take = pa.array(rows + at)
                    yield pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), b.column(0).take(take), b.column(1).take(take)],
                                                     ["list", "qid", "q"])
    queries = points.join(asked.select("pid").distinct(), "pid").select("pid", "v")
    probes = freeze(queries.mapInArrow(choose_lists, "list int, qid bigint, q array<double>"), "probes")
    # parts of lists and blocks of their queries; both tables have at most one row a list
    parts = postings.groupBy("list").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    blocks = probes.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks"))
    plan = F.broadcast(parts.join(blocks, "list"))
    rows = (postings.join(plan, "list").withColumn("part", F.pmod(F.xxhash64("pid"), F.col("parts")))
            .withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select("list", "part", "block", "v", "ids"))
    asks = (probes.join(plan, "list").withColumn("block", F.pmod(F.xxhash64("qid"), F.col("blocks")).cast("int"))
            .withColumn("part", F.explode(F.expr("sequence(0L, parts - 1L)"))).select("list", "part", "block", "qid", "q"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = [[], [], []]
        if left.num_rows and right.num_rows:
            v, ids = _matrix(left["v"], dim), left["ids"].combine_chunks()
            offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy()
            for qid, q in zip(right["qid"].to_pylist(), _matrix(right["q"], dim)):
                score = np.sqrt(((v - q) ** 2).sum(1))
                at = np.flatnonzero(score <= np.partition(score, k)[k]) if len(score) > k + 1 else np.arange(len(score))
                own = np.concatenate([values[offsets[i]:offsets[i + 1]] for i in at])
                far = np.repeat(score[at], (offsets[1:] - offsets[:-1])[at])
                best = np.lexsort((own, far))[:k + 1]
                out[0].append(np.full(len(best), qid))
                out[1].append(own[best])
                out[2].append(far[best])
        return pa.table({c: np.concatenate(x) if x else np.zeros(0, t) for c, x, t in
                         zip(("qid", "vec_id", "score"), out, (np.int64, np.int64, np.float64))})
    key = ["list", "part", "block"]
    found = (rows.groupBy(*key).cogroup(asks.groupBy(*key)).applyInArrow(compare, "qid bigint, vec_id bigint, score double")
             .groupBy("qid", "vec_id").agg(F.min("score").alias("score")))
    order = [F.col("score"), F.col("vec_id")]
    top = (found.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(*order))).filter(F.col("r") <= k + 1)
           .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found")))
    # each asking row gets its point's list without itself
    mine = asked.join(top, asked.pid == top.qid).select("query_id", F.slice(F.expr("filter(found, f -> f.vec_id <> query_id)"), 1, k).alias("found"))
    return (mine.select("query_id", F.posexplode("found").alias("p", "f"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "f.vec_id", "f.score"))
