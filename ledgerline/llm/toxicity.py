"""Operator 10: toxicity by a counterfactually regularised classifier.

A logistic regression over the words of a text (and the beginnings of its longer
words) is fitted on a bounded sample of labelled rows.  Each labelled sentence that
holds an identity term is paired with a copy in which that term is swapped for its
counterpart, one term at a time, and the fit is penalised for the change of score between
the two, so that a neutral mention of a group does not by itself raise the score.

Terms are a fixed list of group names, each swapped for another of its kind, and terms found in
the sample: words that stand in toxic texts more often than chance has it although at least
half of their texts are not toxic.  Such a word is swapped for the word without a leaning
that stands in the nearest number of clean texts.

The sample is at most ``SAMPLE_ROWS`` rows (of those with the least hash of their
id); scoring is one map-only pass over all whole texts with the few weights that
were kept."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.linear import Rows, fit, sigmoid
from ledgerline.llm.text import map_texts, slices, text_bytes, words
from ledgerline.session import freeze

#: Most labelled rows that the classifier is fitted on.
SAMPLE_ROWS = 20_000
#: Bits of a feature's number, bytes of a word's beginning that is a feature too.
FEATURE_BITS, BEGINNING = 20, 5
#: A feature is kept if its rates differ between classes by so many standard errors.
KEEP_Z = 5.0
#: Weight of the squared score change under swapped identity terms.
SWAP_PENALTY = 1.0
#: A found term leans to toxic texts by so many standard errors (as a word that is kept does), its
#: counterpart by at most so many, and it stands in so many texts of the sample; most terms that are
#: found (the surest ones).
TERM_Z, NEUTRAL_Z, TERM_TEXTS, FOUND_TERMS = KEEP_Z, 1.0, 5, 500
SENTENCE_END = re.compile(rb"[.!?\n]+")
#: Fixed values.  Terms of one line are of one kind; each is swapped for the next of its line.
IDENTITY_TERMS = """
women men
woman man
girls boys
girl boy
christian muslim jewish hindu buddhist atheist
christians muslims jews hindus buddhists atheists
black white asian latino african european
gay straight lesbian bisexual transgender
immigrant refugee native foreigner
immigrants refugees natives foreigners
old young
disabled deaf blind
frauen männer
mujeres hombres
femmes hommes
"""


def swap_table(lines: str = IDENTITY_TERMS) -> dict[bytes, bytes]:
    table: dict[bytes, bytes] = {}
    for line in lines.strip().splitlines():
        kind = [t.encode() for t in line.split()]
        table.update(zip(kind, kind[1:] + kind[:1]))
    return table


SWAPS = swap_table()


def word_features(word: bytes) -> tuple[int, ...]:
    """Numbers of the features of one word: itself and its beginning, if longer."""
    mask = (1 << FEATURE_BITS) - 1
    own = zlib.crc32(word) & mask
    return (own, zlib.crc32(b"^" + word[:BEGINNING]) & mask) if len(word) >= BEGINNING else (own,)


def text_features(distinct: set[bytes]) -> np.ndarray:
    return np.unique(np.fromiter((f for w in distinct for f in word_features(w)), np.int64))


class Weights:
    """Scores sets of words with the kept features; remembers words' features."""

    def __init__(self, kept: dict[int, float], bias: float, limit: int = 500_000):
        self.kept, self.bias, self.limit = kept, bias, limit
        self.seen: dict[bytes, tuple[int, ...]] = {}

    def _of(self, word: bytes) -> tuple[int, ...]:
        found = tuple(f for f in word_features(word) if f in self.kept)
        if len(self.seen) >= self.limit:
            self.seen.clear()
        if len(word) <= 64:
            self.seen[word] = found
        return found

    def score(self, data: bytes) -> float:
        seen, of = self.seen, self._of
        features: set[int] = set()
        for w in set(words(data)):
            f = seen.get(w)
            if f is None:
                f = of(w)
            if f:
                features.update(f)
        return float(sigmoid(self.bias + sum(self.kept[f] for f in features)))


def sentence_pairs(data: bytes, swaps: dict[bytes, bytes]) -> Counter:
    """(features that a swap takes away, features that it brings) of every sentence and term
    in it, and how often; pairs whose features are equal are left out."""
    found: Counter = Counter()
    if swaps.keys().isdisjoint(words(data)):
        return found
    for sentence in SENTENCE_END.split(data):
        held = set(words(sentence))
        for term in held & swaps.keys():
            own, swapped = (set(text_features(w).tolist()) for w in (held, held - {term} | {swaps[term]}))
            if own != swapped:
                found[tuple(sorted(own - swapped)), tuple(sorted(swapped - own))] += 1
    return found


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id_col: str,
                   label_col: str, sample_rows: int) -> DataFrame:
    """``doc_id, text, label`` of the rows that may be learnt from."""
    sample = (labels.select(F.col(label_id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
              .filter("doc_id is not null and label in (0, 1)")
              .filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0)
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # the sample has at most sample_rows rows of two numbers: its broadcast is bounded
    return texts.join(F.broadcast(sample), "doc_id")


def found_terms(joined: DataFrame) -> dict[bytes, bytes]:
    """Terms of the sample and their counterparts.  Words are counted in Spark; the driver
    sees at most ``FOUND_TERMS`` words and one counterpart for each number of clean texts."""
    def task(batches):
        for b in slices(batches):
            held = [(w, y) for t, y in zip(text_bytes(b.column(1)), b.column(2).to_pylist()) for w in set(words(t)) if len(w) <= 64]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in held], pa.binary()), pa.array([y for _, y in held], pa.int32())], ["word", "label"])
    n = {r["label"]: r["count"] for r in joined.groupBy("label").count().collect()}
    if len(n) < 2:
        return {}
    n1, n0 = float(n[1]), float(n[0])
    rate = (F.col("a") + F.col("b") + 1) / (n1 + n0 + 2)
    counted = (joined.mapInArrow(task, "word binary, label int").groupBy("word")
               .agg(F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b"))
               .filter(F.col("a") + F.col("b") >= TERM_TEXTS)
               .withColumn("z", (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0))))
    counted = freeze(counted, "words")
    terms = counted.filter((F.col("z") >= TERM_Z) & (F.col("a") <= F.col("b"))).orderBy(F.desc("z"), "word").limit(FOUND_TERMS).collect()
    neutral = {r["b"]: bytes(r["word"]) for r in counted.filter(F.abs("z") <= NEUTRAL_Z).groupBy("b").agg(F.min("word").alias("word")).collect()}
    return {bytes(r["word"]): neutral[min(neutral, key=lambda b: (abs(b - r["b"]), b))] for r in terms} if neutral else {}


def training_rows(joined: DataFrame, swaps: dict[bytes, bytes], sample_rows: int) -> list:
    """(label, features, pairs under ``swaps``) of the sample, in a fixed order."""
    def task(batches):
        for b in slices(batches):
            features, taken, brought, times = [], [], [], []
            for t in text_bytes(b.column(1)):
                features.append(text_features(set(words(t))).astype("<i4").tobytes())
                pairs = sorted(sentence_pairs(t, swaps).items())
                taken.append([x for (x, _), _ in pairs])
                brought.append([x for (_, x), _ in pairs])
                times.append([n for _, n in pairs])
            kind = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(features, pa.binary()), pa.array(taken, kind), pa.array(brought, kind),
                                              pa.array(times, pa.list_(pa.int64()))], ["doc_id", "label", "features", "taken", "brought", "times"])
    found = (joined.mapInArrow(task, "doc_id bigint, label int, features binary, taken array<array<int>>, brought array<array<int>>, times array<bigint>")
             .orderBy(F.xxhash64("doc_id"), "doc_id", "label", F.xxhash64("features", "times")).limit(sample_rows).collect())
    found.sort(key=lambda r: (r["doc_id"], r["label"], bytes(r["features"]), r["times"]))
    return [(r["label"], np.frombuffer(bytes(r["features"]), "<i4").astype(np.int64),
             {(tuple(x), tuple(y)): n for x, y, n in zip(r["taken"], r["brought"], r["times"])}) for r in found]


def fit_weights(rows: list, swap_penalty: float = SWAP_PENALTY, keep_z: float = KEEP_Z) -> tuple[dict[int, float], float, int]:
    """(kept feature -> weight, bias, sentence pairs whose kept features differ); without both
    classes a constant score."""
    labels = np.array([r[0] for r in rows], float)
    ones = labels.sum()
    if not 0 < ones < len(labels):
        return {}, 0.0 if not len(labels) else float(np.log((ones + 0.5) / (len(labels) - ones + 0.5))), 0
    width = 1 << FEATURE_BITS
    n1, n0 = ones, len(labels) - ones
    of = Rows([r[1] for r in rows], width)
    d1, d0 = of.back(labels), of.back(1 - labels)
    p = (d1 + d0 + 1) / (len(labels) + 2)
    z = (d1 / n1 - d0 / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    kept = np.flatnonzero((np.abs(z) >= keep_z) & (d1 + d0 >= 5))
    place = np.full(width, -1)
    place[kept] = np.arange(len(kept))

    def narrow(features):
        at = place[np.array(features, np.int64)]
        return at[at >= 0]
    pairs: Counter = Counter()
    for r in rows:
        for (taken, brought), times in r[2].items():
            a, b = tuple(narrow(taken).tolist()), tuple(narrow(brought).tolist())
            if a or b:
                pairs[a, b] += times
    bound = sorted(pairs.items())
    swaps = (Rows([np.array(a, np.int64) for (a, _), _ in bound], len(kept)), Rows([np.array(b, np.int64) for (_, b), _ in bound], len(kept)),
             np.array([n for _, n in bound], float)) if bound else None
    w, bias = fit(Rows([narrow(r[1]) for r in rows], len(kept)), labels, swaps=swaps, swap_penalty=swap_penalty)
    return {int(f): float(x) for f, x in zip(kept, w)}, bias, int(sum(pairs.values()))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_id_col: str = "doc_id", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS,
                   swap_penalty: float = SWAP_PENALTY, terms: dict[bytes, bytes] | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted, bound_pairs`` of every row of ``docs``.

    ``terms``: what each identity term is swapped for (the fixed list if not given); terms found
    in the sample are added.  ``bound_pairs`` is the number of sentence pairs that the fit
    was penalised on, the same in every row.

    Rows whose ``crc32(id as text) mod 5`` is 0 are held out: their labels are never
    learnt (``held_out``; NULL ids: NULL).  The score depends on the text alone; NULL and
    empty texts score as a text without any kept word.  Labels that are NULL or not
    0/1 are passed over, a document's repeated labels count one by one, and without labels
    of both classes the score is constant (0.5 without any)."""
    joined = labelled_texts(docs, labels, id_col, text_col, label_id_col, label_col, sample_rows)
    swaps = found_terms(joined) | (SWAPS if terms is None else terms)
    kept, bias, bound = fit_weights(training_rows(joined, swaps, sample_rows), swap_penalty)
    held: dict = {}

    def rows(ids, texts):
        if "weights" not in held:
            held["weights"] = Weights(kept, bias)
        scores = [held["weights"].score(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([None if i is None else zlib.crc32(str(i).encode()) % 5 == 0 for i in ids.to_pylist()], pa.bool_()),
             pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array([bound] * len(scores), pa.int64())],
            ["doc_id", "held_out", "score", "predicted", "bound_pairs"])
    return map_texts(docs, id_col, text_col, "doc_id bigint, held_out boolean, score double, predicted int, bound_pairs bigint", rows)
