"""Operator 1: quality classifier by co-training.

Two classifiers see one document each in their own way: the text view its words, the
three-byte runs in it and the shape of its characters, words and lines; the metadata view its
language, source and length.  No measure is in both.  Both start from the labelled sample.
In every round each view looks at a further part of the unlabelled documents and labels
those that it is sure of; these labels join the *other* view's training set and the
documents leave the giving view's pool.  How sure a view must be is measured, class by
class, on labelled rows that neither view is fitted on: the lowest cut above which its
labels are right often enough.  At the end each view is calibrated on those rows, and the
calibrated views are combined.

Every unlabelled document is in the pool: it is scored in Spark, from a table of feature
numbers in the checkpoint folder, and only the rows that are passed on reach the driver.
Of the labelled sample the driver gets labels, shapes, metadata, the counts of the words and
runs and each text's numbers among those that are kept; all others stay in Spark.
Fitting uses at most ``LABELLED_ROWS`` given labels and ``EXCHANGED`` pseudo-labels a view,
round and class (those with the least hash).  Scoring covers all whole texts."""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.linear import Rows, fit, fit_scale, sigmoid
from ledgerline.llm.text import LOWER, slices, text_bytes
from ledgerline.session import freeze

#: Most labelled rows that the views are fitted on.
LABELLED_ROWS = 20_000
#: Rounds of exchange, most pseudo-labels that a view passes on in one round and class.
ROUNDS, EXCHANGED = 4, 500
#: How often a view's labels above its cut must be right on the kept rows, and how many of
#: these must lie above the cut for it to count.
PRECISION, WITNESSES = 0.9, 10
#: Weight of a pseudo-label beside a given label.
PSEUDO_WEIGHT = 0.3
#: Penalty on squared weights; steps of a view's first fit and of those that go on from it.
L2, FIRST_STEPS, LATER_STEPS = 8.0, 150, 60
BINS = 16
SOURCE_BUCKETS = 256
#: Bits of the number of a word and of a three-byte run.
CONTENT_BITS = 16
#: A word or run is kept if its rates differ between classes by so many standard errors.
KEEP_Z = 4.0
#: Most words and runs that are kept: those that differ most.  The size of the model, whatever the corpus.
KEPT = 1024
CLASSES = bytes((ord("u") if 65 <= c <= 90 else ord("l") if 97 <= c <= 122 else ord("d") if 48 <= c <= 57
                 else ord(" ") if c == 32 else ord("n") if c in (10, 13) else ord("x") if c > 127
                 else ord("p") if c in b".,;:'\"-()" else ord("s")) for c in range(256))
SPACES = bytes(int(c == 32 or 9 <= c <= 13) for c in range(256))
TEXT_FEATURES = ("upper", "digit", "sign", "symbol", "high", "word length", "distinct words",
                 "repeated neighbours", "most frequent word", "distinct lines", "line length", "capital starts",
                 "sign ends", "all capitals")


def text_shape(data: bytes, low: list[bytes] | None = None) -> list[float]:
    """The text view's measures; all 0 for an empty text.  ``low``: its lower-cased words."""
    low = data.translate(LOWER).split() if low is None else low
    if not low:
        return [0.0] * len(TEXT_FEATURES)
    n, nw = len(data), len(low)
    kinds = data.translate(CLASSES)
    lines = [x for x in data.split(b"\n") if x]
    counts = Counter(low)
    space = np.frombuffer(data.translate(SPACES), np.bool_)
    kind = np.frombuffer(kinds, np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
    first, last = kind[edge[::2]], kind[edge[1::2] - 1]  # of each word
    second = kind[np.minimum(edge[::2] + 1, edge[1::2] - 1)]
    capital = first == 117
    return [
        kinds.count(b"u") / n, kinds.count(b"d") / n, kinds.count(b"p") / n,
        kinds.count(b"s") / n, kinds.count(b"x") / n, n / nw, len(counts) / nw,
        sum(map(bytes.__eq__, low, low[1:])) / nw, max(counts.values()) / nw, len(set(lines)) / max(1, len(lines)),
        math.log1p(n / max(1, len(lines))), float(capital.mean()), float((last == 115).mean()),
        float((capital & (second == 117) & (edge[1::2] - edge[::2] > 1)).mean()),
    ]


def text_content(lowered: bytes, low: list[bytes]) -> np.ndarray:
    """Which numbers of words and of three-byte runs a lower-cased text holds."""
    mask = (1 << CONTENT_BITS) - 1
    seen = np.zeros(2 << CONTENT_BITS, bool)
    seen[[zlib.crc32(w) & mask for w in set(low)]] = True
    b = np.frombuffer(lowered, np.uint8)
    runs = seen[1 << CONTENT_BITS:]
    for at in range(0, max(0, len(b) - 2), 1 << 20):  # long texts in parts
        part = b[at:at + (1 << 20) + 2].astype(np.uint32)
        runs[((part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(32 - CONTENT_BITS)] = True
    return seen


def meta_features(lang, source, length) -> list[int]:
    """The metadata view's features: numbers of its values and of language with length."""
    lang_no = 0 if lang is None else 1 + zlib.crc32(lang.encode()) % 63
    source_no = 0 if source is None else 1 + zlib.crc32(source.encode()) % (SOURCE_BUCKETS - 1)
    length_no = 0 if length is None or length < 0 else 1 + min(30, int(2 * math.log2(1 + length)))
    return [lang_no, 64 + source_no, 64 + SOURCE_BUCKETS + length_no, 96 + SOURCE_BUCKETS + lang_no * 32 + length_no]


META_WIDTH = 96 + SOURCE_BUCKETS + 64 * 32


class View:
    """A classifier over rows of feature numbers."""

    def __init__(self, rows: list, width: int):
        self.rows, self.width = list(rows), width
        self.w, self.bias, self.fresh = np.zeros(width), 0.0, True

    def fit(self, at: list[int], labels: list[int], weights: list[float]) -> None:
        self.w, self.bias = fit(Rows([self.rows[i] for i in at], self.width), np.array(labels, float),
                                np.array(weights, float), l2=L2, steps=FIRST_STEPS if self.fresh else LATER_STEPS,
                                start=None if self.fresh else (self.w, self.bias))
        self.fresh = False

    def log_odds(self, at: list[int]) -> np.ndarray:
        return Rows([self.rows[i] for i in at], self.width).dot(self.w) + self.bias


def sure_cut(log_odds: np.ndarray, labels: np.ndarray, label: int, precision: float = PRECISION,
             witnesses: int = WITNESSES) -> float:
    """The lowest cut such that of the rows at or beyond it (``label`` 1: above, 0: below) at
    least ``precision`` have ``label`` and, of them, the view is surer than the share of
    ``label`` among all rows.  Infinite if there is none with enough rows beyond it."""
    side = log_odds if label else -log_odds
    order = np.argsort(-side, kind="stable")
    z, right = side[order], np.cumsum(labels[order] == label)
    n = np.arange(1, len(z) + 1)
    last = np.append(z[1:] != z[:-1], True) if len(z) else np.zeros(0, bool)  # ties pass together
    base = float(np.mean(labels == label)) if len(z) else 1.0
    fits = np.flatnonzero(last & (right >= precision * n) & (right > base * n) & (n >= witnesses))
    cut = float(z[fits[-1]]) if len(fits) else float("inf")
    return cut if label else -cut


#: (round, both views' weights and biases, both views' cuts for classes 0 and 1) -> rows
#: (view, label, key, text features, metadata features) that the views pass on.
Offer = Callable[[int, list, list], list]


def co_train(text_rows: list, text_width: int, meta_rows: list, labels: list, offer: Offer | None,
             rounds: int = ROUNDS) -> tuple:
    """Fit both views on rows with ``labels`` 0 or 1, exchange labels of unlabelled rows that
    ``offer`` finds, and combine the views.

    Returns the two views, their scales, the combination's coefficients (text, metadata,
    bias) and the counts passed on: (round, giving view, label, rows).  Every fifth labelled
    row is kept for the cuts and the calibration."""
    train, check = [i for i in range(len(labels)) if i % 5], list(range(0, len(labels), 5))
    views = (View(text_rows, text_width), View(meta_rows, META_WIDTH))
    given: tuple[dict, dict] = ({}, {})  # pseudo-labels that each view was given, by place
    passed: set = set()  # (giving view, key)
    counts = []
    y_check = np.array([labels[i] for i in check], float)
    for turn in range(rounds + 1):
        for view, extra in zip(views, given):
            view.fit([*train, *extra], [*(labels[i] for i in train), *extra.values()],
                     [1.0] * len(train) + [PSEUDO_WEIGHT] * len(extra))
        if turn == rounds or offer is None:
            break
        cuts = [[sure_cut(v.log_odds(check), y_check, label) for label in (0, 1)] for v in views]
        tally: dict = {}
        for giver, label, key, text_row, meta_row in offer(turn, [(v.w, v.bias) for v in views], cuts):
            if (giver, key) in passed:
                continue  # repeated rows count once
            passed.add((giver, key))
            given[1 - giver][len(views[0].rows)] = label
            views[0].rows.append(text_row)
            views[1].rows.append(meta_row)
            tally[giver, label] = tally.get((giver, label), 0) + 1
        counts += [(turn, g, label, n) for (g, label), n in sorted(tally.items())]
    scales = [fit_scale(v.log_odds(check)[:, None], y_check) for v in views]
    calibrated = np.column_stack([a * v.log_odds(check) + b for v, (a, b) in zip(views, scales)])
    # the views share the base rate, so the second starts from nothing beyond it
    joint = fit_scale(calibrated - [0.0, float(np.log((y_check.sum() + 0.5) / (len(check) - y_check.sum() + 0.5)))], y_check)
    return views, scales, joint, counts


class Features:
    """Feature numbers of both views: cuts of the shape measures, places of the kept content."""

    def __init__(self, shape_cuts: np.ndarray, kept: np.ndarray):
        self.cut_lists, self.kept = shape_cuts.tolist(), kept
        self.width = len(TEXT_FEATURES) * BINS + len(kept)

    def text(self, shape, held: np.ndarray) -> np.ndarray:
        """``held``: which of the kept words and runs the text holds."""
        bins = [bisect_right(cuts, x) + f * BINS for f, (cuts, x) in enumerate(zip(self.cut_lists, shape))]
        return np.concatenate([bins, len(TEXT_FEATURES) * BINS + np.flatnonzero(held)]).astype(np.int32)

    def of(self, data: bytes) -> np.ndarray:
        lowered = data.translate(LOWER)
        low = lowered.split()
        return self.text(text_shape(data, low), text_content(lowered, low)[self.kept])


class Combined:
    """The fitted pair of views; plain numbers, as large as the feature space."""

    def __init__(self, features: Features, views, scales, joint, base: float, counts: list):
        self.features, self.base, self.counts = features, base, counts
        self.weights = [(v.w, v.bias) for v in views]
        self.scales, self.joint = scales, joint

    def scores(self, text_rows: list, meta_rows: list) -> np.ndarray:
        """Columns: text view, metadata view, combined."""
        z = np.column_stack([a * (Rows(rows, len(w)).dot(w) + bias) + b
                             for rows, (w, bias), (a, b) in zip((text_rows, meta_rows), self.weights, self.scales)])
        return np.column_stack([sigmoid(z), sigmoid((z - [0.0, self.base]) @ self.joint[:2] + self.joint[2])])


def _numbers(column: pa.Array) -> list:
    return [np.frombuffer(x, "<i4").astype(np.int64) for x in column.to_pylist()]


def featured(rows: DataFrame, features: Features) -> DataFrame:
    """``doc_id, text_row, meta_row`` (feature numbers as bytes) of ``doc_id, text, lang, source, length``."""
    def task(batches):
        for b in slices(batches):
            text_row = [features.of(t).astype("<i4").tobytes() for t in text_bytes(b.column(1))]
            meta_row = [np.array(meta_features(*m), "<i4").tobytes() for m in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text_row, pa.binary()), pa.array(meta_row, pa.binary())],
                                             ["doc_id", "text_row", "meta_row"])
    return rows.select("doc_id", "text", "lang", "source", "length").mapInArrow(task, "doc_id bigint, text_row binary, meta_row binary")


def pool_offer(pool: DataFrame, rounds: int, exchanged: int) -> Offer:
    """Offers from ``pool`` (``key, text_row, meta_row``): round r looks at the first r + 1 of
    ``rounds`` parts, by hash, so that every round has documents not seen before."""
    passed: tuple[list, list] = ([], [])  # keys that left a view's pool; at most 2 * exchanged a round

    def offer(turn: int, weights: list, cuts: list) -> list:
        gone = [np.sort(np.array(p, np.int64)) for p in passed]
        part = pool.filter(F.pmod("key", F.lit(rounds)) <= turn)

        def task(batches):
            for b in slices(batches):
                keys = b.column(0).to_numpy(zero_copy_only=False)
                out = []
                for giver, (w, bias) in enumerate(weights):
                    z = Rows(_numbers(b.column(1 + giver)), len(w)).dot(w) + bias
                    label = np.where(z >= cuts[giver][1], 1, np.where(z <= cuts[giver][0], 0, -1))
                    at = np.flatnonzero((label >= 0) & ~np.isin(keys, gone[giver]))
                    out.append(pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), giver), pa.int32()), pa.array(label[at], pa.int32()), *(b.column(i).take(pa.array(at)) for i in range(3))],
                        ["giver", "label", "key", "text_row", "meta_row"]))
                yield from out
        sure = part.select("key", "text_row", "meta_row").mapInArrow(
            task, "giver int, label int, key bigint, text_row binary, meta_row binary")
        rows = []
        for giver in (0, 1):
            for label in (0, 1):
                if math.isfinite(cuts[giver][label]):
                    rows += sure.filter((F.col("giver") == giver) & (F.col("label") == label)).orderBy(F.xxhash64("key"), "key").limit(exchanged).collect()
        found = [(r["giver"], r["label"], r["key"], *(np.frombuffer(bytes(r[c]), "<i4").astype(np.int64) for c in ("text_row", "meta_row"))) for r in rows]
        for giver, _, key, _, _ in found:
            passed[giver].append(key)
        return found
    return offer


def _views(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, length_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"),
                       F.col(length_col).cast("bigint").alias("length"))


class Sample:
    """The labelled sample, every row at its place in a fixed order.  Labels, shapes and metadata
    are on the driver, two hundred bytes a row; the words and runs of its texts (``row, y, shape,
    content`` of ``table``) stay in Spark, which counts them and numbers those that are kept."""

    def __init__(self, table: DataFrame, rows: np.ndarray, labels: list, shapes: np.ndarray, meta: list):
        self.table, self.labels, self.shapes, self.meta = table, labels, shapes, meta
        self.at = np.argsort(rows)  # places by ascending row
        self.rows = rows[self.at]

    def _map(self, fn: Callable, schema: str) -> DataFrame:
        """``fn`` over iterators of (place, label, shape, content) of the sample's rows in a task."""
        rows, at = self.rows, self.at

        def task(batches):
            def members():
                for b in slices(batches):
                    own = b.column(0).to_numpy()
                    found = np.minimum(np.searchsorted(rows, own), len(rows) - 1)
                    for i in np.flatnonzero(rows[found] == own).tolist():
                        yield (int(at[found[i]]), b.column(1)[i].as_py(), np.frombuffer(b.column(2)[i].as_py()),
                               np.frombuffer(b.column(3)[i].as_py(), "<i4"))
            yield from fn(members())
        return self.table.select("row", "y", "shape", "content").mapInArrow(task, schema)

    def counts(self) -> np.ndarray:
        """How many rows of each class hold each word and run.  Rows kept for the cuts and the
        calibration are not counted."""
        def count(members):
            counts = np.zeros((2, 2 << CONTENT_BITS), np.int64)
            for place, y, _, content in members:
                if place % 5:
                    counts[y][content] += 1
            held = np.flatnonzero(counts.any(0))
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), *(pa.array(c[held]) for c in counts)], ["number", "n0", "n1"])
        found = self._map(count, "number int, n0 bigint, n1 bigint").groupBy("number").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
        counts = np.zeros((2, 2 << CONTENT_BITS))
        for y in (0, 1):
            counts[y][found["number"].to_numpy()] = found[f"n{y}"].to_numpy()
        return counts

    def text_rows(self, features: Features) -> list:
        """The text view's feature numbers of every row."""
        def number(members):
            for place, _, shape, content in members:
                yield place, features.text(shape, np.isin(features.kept, content)).astype("<i4").tobytes()

        def batches(members):
            numbered = number(members)
            while part := list(islice(numbered, 1000)):
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in part], pa.int32()), pa.array([x[1] for x in part], pa.binary())], ["place", "text_row"])
        out: list = [None] * len(self.labels)
        for b in self._map(batches, "place int, text_row binary").toArrow().to_batches():
            for place, numbers in zip(b.column(0).to_pylist(), b.column(1)):
                out[place] = np.frombuffer(numbers.as_buffer(), "<i4")
        return out


def _sample(docs: DataFrame, labels: DataFrame, labelled_rows: int) -> Sample:
    """The labelled sample of ``docs``."""
    order = F.xxhash64("doc_id")
    known = labels.filter("doc_id is not null and y in (0, 1)").orderBy(order, "doc_id", "y").limit(labelled_rows)

    def task(batches):
        for b in slices(batches):
            texts = text_bytes(b.column(2))
            lowered = [t.translate(LOWER) for t in texts]
            content = [np.flatnonzero(text_content(t, t.split())).astype("<i4").tobytes() for t in lowered]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([np.array(text_shape(t)).tobytes() for t in texts], pa.binary()),
                 pa.array(content, pa.binary()),
                 pa.array([meta_features(*m) for m in zip(*(b.column(i).to_pylist() for i in (3, 4, 5)))], pa.list_(pa.int32()))],
                ["doc_id", "y", "shape", "content", "meta"])
    # at most labelled_rows rows of two numbers: the broadcast is bounded; texts are measured where
    # they are, and the limit (repeated ids) sees all but the content
    table = freeze(docs.join(F.broadcast(known), "doc_id").select("doc_id", "y", "text", "lang", "source", "length")
                   .mapInArrow(task, "doc_id bigint, y int, shape binary, content binary, meta array<int>")
                   .withColumn("row", F.monotonically_increasing_id()), "sample")
    found = (table.select("row", "doc_id", "y", "shape", "meta", F.xxhash64("shape", "content", "meta").alias("hash"))
             .orderBy(order, "doc_id", "y", "hash").limit(labelled_rows).drop("hash").toArrow())
    ids, y, shapes, meta = (found[c].to_pylist() for c in ("doc_id", "y", "shape", "meta"))
    at = sorted(range(len(ids)), key=lambda i: (zlib.crc32(str(ids[i]).encode()), ids[i], y[i], shapes[i]))
    return Sample(table, found["row"].to_numpy()[at], [y[i] for i in at],
                  np.frombuffer(b"".join(shapes[i] for i in at)).reshape(-1, len(TEXT_FEATURES)), [np.array(meta[i]) for i in at])


def choose_features(sample: Sample, keep_z: float = KEEP_Z) -> Features:
    """Cuts at the sample's quantiles; content whose rates differ between the classes."""
    counts = sample.counts()
    n = np.array([max(1, sum(i % 5 > 0 and x == y for i, x in enumerate(sample.labels))) for y in (0, 1)])
    rate = (counts.sum(0) + 1) / (n.sum() + 2)
    z = (counts[1] / n[1] - counts[0] / n[0]) / np.sqrt(rate * (1 - rate) * (1 / n).sum())
    z[counts.sum(0) < 5] = 0
    kept = np.sort(np.argsort(-np.abs(z), kind="stable")[:KEPT])
    kept = kept[np.abs(z[kept]) >= keep_z]
    return Features(np.quantile(sample.shapes, np.arange(1, BINS) / BINS, axis=0).T, kept)


def train(docs: DataFrame, labels: DataFrame, label_id_col: str, label_col: str, labelled_rows: int,
          exchanged: int, rounds: int) -> tuple[Combined, DataFrame] | None:
    """The fitted model and the frozen feature rows of all ``docs``; None without labelled
    rows of both classes."""
    known = labels.select(F.col(label_id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    sample = _sample(docs, known, labelled_rows)
    if {0, 1} - {y for i, y in enumerate(sample.labels) if i % 5}:
        return None
    features = choose_features(sample)
    rows = freeze(featured(docs, features), "features")
    # narrow rows, one id each: nothing hot is shuffled but NULL ids, which are never labelled
    pool = freeze(rows.filter("doc_id is not null").join(known.select("doc_id").distinct(), "doc_id", "left_anti")
                  .select(F.xxhash64("doc_id", "text_row", "meta_row").alias("key"), "text_row", "meta_row"), "pool")
    views, scales, joint, counts = co_train(sample.text_rows(features), features.width, sample.meta, sample.labels,
                                            pool_offer(pool, rounds, exchanged), rounds)
    seen = sample.labels[::5]
    base = float(np.log((sum(seen) + 0.5) / (len(seen) - sum(seen) + 0.5)))
    return Combined(features, views, scales, joint, base, counts), rows


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", source_col: str = "source", length_col: str = "n_chars",
                  label_id_col: str = "doc_id", label_col: str = "quality", labelled_rows: int = LABELLED_ROWS,
                  exchanged: int = EXCHANGED, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, text_score, meta_score, score, keep`` of every row of ``docs``.

    Scores are probabilities of quality 1; ``keep`` is ``score >= 0.5``.  NULL and empty
    texts are scored like any other; NULL metadata is a value of its own; labels that
    are NULL or not 0/1 are passed over, and their documents are not in the pool.
    Without labelled rows of both classes all scores are 0.5 and every document is kept."""
    views = _views(docs, id_col, text_col, lang_col, source_col, length_col)
    fitted = train(views, labels, label_id_col, label_col, labelled_rows, exchanged, rounds)
    if fitted is None:
        half = F.lit(0.5)
        return views.select("doc_id", half.alias("text_score"), half.alias("meta_score"), half.alias("score"), F.lit(True).alias("keep"))
    model, rows = fitted

    def task(batches):
        for b in slices(batches):
            s = model.scores(_numbers(b.column(1)), _numbers(b.column(2)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(s[:, i]) for i in range(3)), pa.array(s[:, 2] >= 0.5)],
                ["doc_id", "text_score", "meta_score", "score", "keep"])
    return rows.mapInArrow(task, "doc_id bigint, text_score double, meta_score double, score double, keep boolean")


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang", source_col: str = "source", length_col: str = "n_chars", **fitted) -> DataFrame:
    """``docs``, its columns unchanged, without the rows that the classifier rejects."""
    options = {"label_id_col": "doc_id", "label_col": "quality", "labelled_rows": LABELLED_ROWS,
               "exchanged": EXCHANGED, "rounds": ROUNDS} | fitted
    found = train(_views(docs, id_col, text_col, lang_col, source_col, length_col), labels, **options)
    if found is None:
        return docs
    model = found[0]
    at = [docs.columns.index(c) for c in (text_col, lang_col, source_col, length_col)]

    def task(batches):
        for b in slices(batches):
            texts = [model.features.of(t) for t in text_bytes(b.column(at[0]))]
            meta = [np.array(meta_features(*m)) for m in zip(*(b.column(i).to_pylist() for i in at[1:]))]
            yield b.filter(pa.array(model.scores(texts, meta)[:, 2] >= 0.5))
    return docs.mapInArrow(task, docs.schema)
