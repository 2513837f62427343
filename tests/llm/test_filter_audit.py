"""Operator 12 against brute force: every order applied filter by filter to every document."""

import random
import re
from itertools import permutations

from ledgerline.llm.filter_audit import COUNTS, filter_audit
from tests.llm.test_operators import documents

ORDERS = ["".join(p) for p in permutations("ABCDE")]


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in (("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
                             ("C", 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)),
                             ("D", any(c in "#$%&*|" for c in text))) if bad}


def brute(rows, labels):
    """``(part, order, step) -> counts`` from ``(doc_id, text, lang)`` rows."""
    docs = []
    for i, text, lang in rows:
        own = fails(text or "")
        if i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in rows):
            own.add("E")
        docs.append((lang or "", own, any(l == (i, 1) for l in ((x[0], x[1]) for x in labels)) and i is not None,
                     any((x[0], x[2]) == (i, 1) for x in labels) and i is not None))
    out, total = {}, {}
    for part in {d[0] for d in docs}:
        for order in ORDERS:
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here, left = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                out[part, order, step] = [len(left), len(here), sum(f in d[1] for d in gone),
                                          sum(d[0] == part and d[1] == {f} for d in docs), sum(d[2] for d in here), sum(d[3] for d in here)]
                gone += here
                total[part, f] = total.get((part, f), 0) + len(here)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit(df, labels):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in filter_audit(df, labels).collect()}


def sample():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(600)]
    texts = []
    for _ in range(60):
        words = [rng.choice(vocabulary[:rng.choice([20, 600])]) for _ in range(rng.choice([10, 199, 200, 300]))]
        text = " ".join(words)
        texts.append(text.upper() if rng.random() < 0.2 else text + rng.choice(["", "", " #", " *"]))
    texts += rng.sample(texts, 15) + [None, "", " \t\n", "A" * 3 + "é" * 97, "A" * 4 + "é" * 96, "w\x0bw\x0cw", "a b", "x" * 200_000, "a b " * 30_000]
    return [(i, t, rng.choice(["en", "fr", None])) for i, t in enumerate(texts)]


SCHEMA = "doc_id bigint, text string, lang string, mask int, digest string, least int, good int, labelled int, part string"


def table(spark, rows):
    """Documents with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, 1, "d", 2, 3, 4, "p") for r in rows], SCHEMA).repartition(3)


def test_audit_equals_brute_force(spark):
    rows = sample()
    rows += [(3, rows[3][1], "en"), (None, rows[3][1], "en"), (None, "no id", None), (3, "another text of one id", "fr")]
    labels = [(i, i % 3 % 2, int(i % 5 == 0)) for i in range(0, 70)] + [(5, 1, 0), (None, 1, 1), (9, None, None), (999, 1, 1)]
    made = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = audit(table(spark, rows), made)
    assert got == brute(rows, labels)
    assert len(got) == 3 * 120 * 5


def test_every_document_is_removed_once_or_kept(spark):
    rows = sample()
    got = audit(table(spark, rows), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    for part in {k[0] for k in got}:
        n = sum((lang or "") == part for *_, lang in rows)
        for order in ORDERS:
            assert got[part, order, 5][0] + sum(got[part, order, s][1] for s in range(1, 6)) == n
        # what a document costs is dealt out among its filters: 120 removals each
        assert sum(v[6] for (p, o, _), v in got.items() if p == part and o == ORDERS[0]) == 120 * sum(
            got[part, ORDERS[0], s][1] for s in range(1, 6))


def test_audit_of_an_empty_table(spark):
    assert filter_audit(documents(spark, ["x"]).limit(0), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).count() == 0


def test_copies_that_fill_a_third_of_the_table(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i}", "en") for i in range(900)]
    got = audit(table(spark, rows), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert got["en", "EABCD", 1][:2] == (601, 299) and got["en", "AEBCD", 2][1:3] == (0, 299)
