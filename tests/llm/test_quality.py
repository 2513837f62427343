"""The labelled sample of the quality classifier: what its driver gets, and sums in parts."""

import random
import tracemalloc
import zlib

import numpy as np
from pyspark.sql import DataFrame

from ledgerline.llm import linear, quality
from ledgerline.llm.text import LOWER


def labelled_texts(spark, n, words):
    """Texts of many distinct words, of which one tells the class; some ids and texts come twice."""
    rng = random.Random(3)
    rows = [(i, f"{'good' if i % 2 else 'poor'} " + " ".join(f"{rng.getrandbits(40):x}" for _ in range(words)), "en", "s", i) for i in range(n)]
    rows += [rows[3], (5, "good other text", None, None, None), (n, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, length bigint").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(n + 1)], "doc_id bigint, y int")
    return rows, docs, labels


def test_content_of_the_sample_stays_in_spark(spark, monkeypatch):
    rows, docs, labels = labelled_texts(spark, 500, 800)
    content = sum(4 * int(quality.text_content(t := (r[1] or "").encode(), t.split()).sum()) for r in rows)
    got = []

    def size(value):
        return len(value) if isinstance(value, (bytes, bytearray)) else sum(map(size, value)) if isinstance(value, (list, tuple)) else 8
    for owner in {DataFrame, type(docs)}:
        collect, to_arrow = owner.collect, owner.toArrow
        monkeypatch.setattr(owner, "collect", lambda df, f=collect: got.append(size(r := f(df))) or r)
        monkeypatch.setattr(owner, "toArrow", lambda df, f=to_arrow: got.append((r := f(df)).nbytes) or r)
    features = quality.choose_features(quality._sample(docs, labels, 20_000))
    assert 0 < len(features.kept) and 0 < sum(got)
    # the sums of all words and runs are three numbers each, whatever the number of rows
    assert sum(got) < 24 * (2 << quality.CONTENT_BITS) < content / 2


def test_sample_counts_and_rows_equal_brute_force(spark):
    rows, docs, labels = labelled_texts(spark, 60, 30)
    sample = quality._sample(docs, labels, 20_000)
    want = []
    for i, text, lang, source, length in rows:
        data = (text or "").encode()
        want.append((zlib.crc32(str(i).encode()), i, i % 2, np.array(quality.text_shape(data)).tobytes(), data, quality.meta_features(lang, source, length)))
    want.sort()
    counts = np.zeros((2, 2 << quality.CONTENT_BITS))
    for place, (_, _, y, _, data, _) in enumerate(want):
        if place % 5:
            low = data.translate(LOWER)
            counts[y] += quality.text_content(low, low.split())
    assert sample.labels == [w[2] for w in want]
    assert (sample.counts() == counts).all() and counts.any()
    assert [m.tolist() for m in sample.meta] == [w[5] for w in want]
    features = quality.choose_features(sample, keep_z=1.0)
    assert len(features.kept)
    for got, w in zip(sample.text_rows(features), want, strict=True):
        assert got.tolist() == features.of(w[4]).tolist()
    assert len(quality._sample(docs, labels, 7).labels) == 7


def test_rows_take_sums_in_small_parts():
    rng = np.random.default_rng(1)
    lengths = [0, *rng.integers(0, 500, 6_000), 300_000, 0, 0]
    rows = [rng.integers(0, 1000, n).astype(np.int32) for n in lengths]
    entries = sum(lengths)
    w, v = rng.normal(size=1000), rng.normal(size=len(rows))
    tracemalloc.start()
    try:
        made = linear.Rows(rows, 1000)
        dot, back = made.dot(w), made.back(v)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    index, row = np.concatenate(rows).astype(np.int64), np.repeat(np.arange(len(rows)), lengths)
    assert (dot == np.bincount(row, w[index], len(rows))).all()
    assert (back == np.bincount(index, v[row], 1000)).all()
    assert peak < 16 * entries  # bytes; whole arrays of places, rows and values take 32
    assert (linear.Rows([], 5).dot(w[:5]) == np.zeros(0)).all() and not linear.Rows([np.zeros(0, int)] * 2, 5).back(v[:2]).any()
