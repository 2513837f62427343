"""Operator 12: how the order of a set of filters decides what each of them removes.

A document's failed filters are a row of a mask matrix M (0 where it fails, else infinite); an order of
the filters is a column of the position matrix P (the inverse permutation: the step at which each filter
stands).  Their min-plus product, min over filters of M + P, is the step that removes the document under that
order, or infinite if it is kept.  All counts of the audit are scatters over removal steps, weighted by the documents.

Texts are read once, in tasks, down to a digest and a mask; the filter for repeats compares a document with the
least id that has its digest (SHA-256).  Documents with the same mask are alike under every order, so the
product's rows are the masks of each part, at most 32 with the number of documents, good and toxic ones as weights.
A third of all documents in one part, or as copies of one text, is one partly summed row per task for the counts;
the join that finds each text's first document is by digest and id, so copies are spread by their ids.

Odd rows: NULL text is empty (no words: only the filter for few words fails, and that for repeats); NULL
lang is the part ''.  A NULL id is no smaller and no larger than any id; rows of one id don't make one
another repeats.  A document's label holds if any row of its id in ``labels`` has it.  An empty table gives an
empty result."""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import blocks, text_bytes
from ledgerline.session import freeze

# The filters, their bounds and what they look for.
FILTERS = "ABCDE"
FEW_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 3
CAPITALS, SIGNS = bytes(range(ord("A"), ord("Z") + 1)), b"#$%&*|"
#: Bytes of UTF-8 that don't begin a code point.
INNER = bytes(range(0x80, 0xC0))
REPEAT = 1 << FILTERS.index("E")
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)


def text_mask(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()  # at [\x20\x09-\x0D]
    capitals, points = len(text) - len(text.translate(None, CAPITALS)), len(text.translate(None, INNER))
    return ((len(words) < FEW_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > CAPITALS_PERCENT * points) << 2
            | (len(text.translate(None, SIGNS)) < len(text)) << 3)


def judged(df: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``doc_id, part, digest, mask`` of every row; the mask without the filter for repeats."""
    held = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                     F.col(text_col).cast("string").cast("binary").alias("text"))

    def task(batches):
        for b in blocks(batches):
            texts = text_bytes(b.column(2))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([text_mask(t) for t in texts], pa.int32())], ["doc_id", "part", "digest", "mask"])
    return held.mapInArrow(task, "doc_id bigint, part string, digest binary, mask int")


def orders() -> tuple[list[str], np.ndarray]:
    """All orders of the filters, and the step (from 1) of each filter in each order: filters x orders."""
    names = ["".join(p) for p in permutations(FILTERS)]
    return names, np.array([[o.index(f) + 1 for o in names] for f in FILTERS])


def audit_part(masks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Counts of every order and step, ``orders x steps x COUNTS``, from distinct masks and their
    weights (documents, good, toxic: masks x 3)."""
    _, position = orders()
    n_filters, n_orders = position.shape
    fails = (masks[:, None] >> np.arange(n_filters) & 1).astype(bool)          # masks x filters
    never = n_filters + 1
    # min-plus product; a filter that a document passes adds infinity
    rank = np.where(fails[:, :, None], position[None], never).min(axis=1)      # masks x orders
    removed = np.zeros((n_orders, never + 1, 3), np.int64)                     # scatter by removal step
    for w in range(3):
        np.add.at(removed[:, :, w], (np.arange(n_orders)[None], rank), weights[:, w, None])
    total = weights[:, 0].sum()
    kept = total - np.cumsum(removed[:, 1:never, 0], axis=1)
    at_step = np.argsort(position, axis=0).T                                   # orders x steps: the filter that stands there
    failing = (fails * weights[:, :1]).sum(axis=0)                             # documents that fail each filter
    only = (fails * (fails.sum(axis=1) == 1)[:, None] * weights[:, :1]).sum(axis=0)
    here = removed[:, 1:never, 0]
    shapley = np.zeros(n_filters, np.int64)
    np.add.at(shapley, at_step, here)
    return np.stack([kept, here, failing[at_step] - here, only[at_step], removed[:, 1:never, 1], removed[:, 1:never, 2],
                     shapley[at_step]], axis=2)


def filter_audit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """``part, filter_order, step`` and ``COUNTS`` for every part, order and step.

    kept: documents left after the step; removed: those that it removes; redundant: those that fail its
    filter and are gone already; unique_fails: those that fail it alone; good_lost, toxic_lost: those
    removed with ``quality`` or ``toxic`` 1; shapley: what its filter removes, summed over all orders."""
    docs = freeze(judged(df, id_col, text_col, part_col), "judged")
    first = docs.groupBy("digest").agg(F.min("doc_id").alias("least"))
    own = labels.groupBy(F.col("doc_id").cast("bigint").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # by digest and id: copies of one text spread by their ids
    original = docs.join(first.withColumnRenamed("digest", "text"), (F.col("digest") == F.col("text")) & (F.col("doc_id") == F.col("least")), "left")
    repeat = F.when(F.col("doc_id").isNotNull() & F.col("least").isNull(), REPEAT).otherwise(0)
    marked = (original.select("doc_id", "part", F.col("mask").bitwiseOR(repeat).alias("mask"))
              .join(own, F.col("doc_id") == F.col("labelled"), "left"))
    alike = marked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
                                              F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    # a part has at most 32 masks
    parts = alike.groupBy("part").agg(*[F.collect_list(F.struct("mask", c)).alias(c) for c in ("docs", "good", "toxic")])
    names, _ = orders()

    def task(batches):
        for b in batches:
            for row in b.to_pylist():
                masks = sorted(x["mask"] for x in row["docs"])
                weights = np.array([[dict((x["mask"], x[c]) for x in row[c])[m] for c in ("docs", "good", "toxic")] for m in masks])
                counts = audit_part(np.array(masks), weights).reshape(-1, len(COUNTS))
                steps = len(FILTERS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(counts), pa.string()), pa.array([o for o in names for _ in range(steps)], pa.string()),
                     pa.array([*range(1, steps + 1)] * len(names), pa.int32()), *[pa.array(c) for c in counts.T]],
                    ["part", "filter_order", "step", *COUNTS])
    return parts.mapInArrow(task, SCHEMA)
