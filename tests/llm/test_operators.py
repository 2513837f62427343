"""The training-data operators against brute force on small tables that hold NULLs, empty and
long texts, ties, repeated rows and extra columns whose names clash."""

import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import ann, decontaminate, licenses, packing, quality, queries, simhash, suffix_dedup, token_counts, toxicity, url_rules
from ledgerline.llm.components import components

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, root string, fp string, kept int"
WORDS = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa"]


def documents(spark, texts, ids=None):
    """Documents with clashing extra columns."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, "r", "f", 1) for i, t in zip(ids, texts)], DOCS).repartition(3)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    shared = sentence(rng, 25)
    own = [sentence(rng, rng.randrange(1, 60)) for _ in range(25)]
    own += [f"{a} {shared} {b}" for a, b in zip(own, own[5:])]
    return [*own, own[0], own[0], shared, "", None, None, "a", "A b", "x" * 70_000, sentence(rng, 20_000), "é" * 60, " \n\t "]


def test_token_counts_equal_the_library(spark, texts):
    own = [*texts, "a<|endoftext|> b", "x   \n y", " \u00a0 \u2003z", "'s 'll don't", "１２Ⅷ漢字\U0001f600"]
    tk = Tokenizer.from_file(VOCABULARY)
    got = {r.doc_id: r for r in token_counts.token_counts(documents(spark, own), VOCABULARY, limit=20).collect()}
    for i, t in enumerate(own):
        n = len(tk.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 20)


def brute_simhash(text, k=3):
    w = (text or "").encode().lower().split() if (text or "").isascii() else [
        x.encode() for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().decode().split()]
    if not w:
        return 0
    grams = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash_classes_equal_brute_force(spark, texts):
    got = simhash.near_duplicates(documents(spark, texts)).collect()
    fps = {i: brute_simhash(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.fp & (1 << 64) - 1 for r in got} == fps
    root = brute_components(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert {r.doc_id: r.component_id for r in got} == root
    kept = simhash.drop_near_duplicates(documents(spark, texts))
    assert kept.columns == documents(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))


@pytest.mark.parametrize("distance,bucket", [(2, 64), (2, 1), (1, 1), (3, 1), (0, 64), (4, 64)])
def test_simhash_links_lose_nothing_in_crowded_entries(spark, distance, bucket):
    rng = random.Random(distance * 100 + bucket)
    base = [rng.getrandbits(64) for _ in range(4)]
    fps = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1 for b in base for _ in range(40)})
    signed = [f - (1 << 64) * (f >> 63) for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), distance, bucket)
    got = {r.node: r.root for r in components(edges).collect()}
    want = brute_components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= distance)
    assert {f: got.get(f, f) for f in signed} == want


def brute_repeats(docs, n=50):
    least = {}
    for i, t in docs:
        for k in range(len(t) - n + 1):
            least[t[k:k + n]] = min(i, least.get(t[k:k + n], i))
    out = []
    for i, t in docs:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - n + 1):
            if least[t[k:k + n]] < i:
                gone[k:k + n] = True
        out.append((i, len(t), int(gone.sum()), len(suffix_dedup.spans_of(gone)), np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return sorted(out)


def test_suffix_dedup_equals_brute_force(spark, texts):
    own = [*texts, "ab" * 200, "ab" * 300, "x" * 49, "x" * 50]
    order = list(range(len(own)))
    random.Random(1).shuffle(order)
    got = suffix_dedup.remove_repeats(documents(spark, own, order), chunk_bytes=3000, bucket_bytes=2000)
    assert sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()) == brute_repeats(
        [(i, (t or "").encode()) for i, t in zip(order, own)])
    cut = suffix_dedup.cut_repeats(documents(spark, own, order))
    assert cut.columns == documents(spark, []).columns and all(r.text is None or r.n_chars == len(r.text) for r in cut.collect())


def around_one_passage(rng, n):
    """Texts of their own before and after a common passage; some of the texts are shared by a few."""
    passage = sentence(rng, 25)
    own = [f"{rng.getrandbits(400):x}" for _ in range(n)]
    return [f"{own[i]} {passage} {rng.choice(own[:i + 1])}" for i in range(n)]


@pytest.mark.parametrize("part_windows", [1, 200, 3000])
def test_suffix_dedup_with_crowded_anchors_equals_brute_force(spark, texts, part_windows):
    own = [*texts, *around_one_passage(random.Random(9), 150), "ab" * 200, "ab" * 300, "x" * 50]
    order = [*range(len(own) - 3), 5, 5, 5]
    random.Random(1).shuffle(order)
    got = suffix_dedup.remove_repeats(documents(spark, own, order), chunk_bytes=9000, bucket_bytes=20_000, part_windows=part_windows)
    assert sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()) == brute_repeats(
        [(i, (t or "").encode()) for i, t in zip(order, own)])


def test_windows_around_one_anchor_are_dealt_out():
    own, n, buckets, limit = around_one_passage(random.Random(9), 1200), 50, 8, 1500
    chunks = [suffix_dedup.Chunk(suffix_dedup._pack(pa.record_batch([pa.array(range(at, at + 400)), pa.array(own[at:at + 400])], ["doc_id", "text"])), 0, 1, n, 24)
              for at in range(0, 1200, 400)]
    sent, masks = {}, [{}, {}, {}]
    for c, chunk in enumerate(chunks):
        h, many = suffix_dedup.anchor_hashes(chunk)
        counts = suffix_dedup.stretch_counts(chunk, h, n).astype("<u4")
        for b, s, e in suffix_dedup._by_bucket(suffix_dedup.bucket_of(h, buckets)):
            sent.setdefault(b, []).append((b, c, suffix_dedup._low40(h[s:e]), np.packbits(many[s:e]).tobytes(), pa.Codec("zstd").compress(counts[s:e].tobytes(), asbytes=True)))

    def largest(most):
        for rows in sent.values():
            for r in suffix_dedup.shared_in_bucket(pa.table(dict(zip(["bucket", "chunk", "hashes", "many", "counts"], zip(*rows))), schema=pa.schema(
                    [("bucket", pa.int32()), ("chunk", pa.int64()), *((c, pa.binary()) for c in ("hashes", "many", "counts"))])), most).to_pylist():
                masks[r["chunk"]][r["bucket"]] = r["mask"], r["crowded"]
        group = {}
        for chunk, m in zip(chunks, masks):
            s = suffix_dedup.Stretches(chunk, m, buckets, 100, n)
            for b, p, size in zip(s.bucket.tolist(), s.part.tolist(), s.size.tolist()):
                group[b, p] = group.get((b, p), 0) + size - n + 1
        return max(group.values())
    assert largest(10**9) > 3 * limit  # all that is around one anchor together
    assert largest(limit // 27) <= limit


def test_rows_without_id_come_last_in_suffix_dedup(spark):
    t = "y" * 60
    got = suffix_dedup.remove_repeats(documents(spark, [t, t, t], [7, None, 7])).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 0), (False, 0), (True, 60)]


@pytest.mark.parametrize("block_bytes", [1 << 24, 600])
def test_contamination_equals_brute_force(spark, texts, block_bytes):
    rng = random.Random(2)
    items = [sentence(rng, 30), " ".join((texts[30] or "").split()[3:20]), "Alpha, BETA", "épsilon", "", None, "unseen " * 12]
    bench = spark.createDataFrame([(10 + i, t, "x") for i, t in enumerate(items)], "item_id bigint, text string, doc_id string")
    windows = {}
    for i, t in enumerate(items):
        w = decontaminate.words((t or "").encode())
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + min(10, len(w))]), set()).add(str(10 + i))
    got = {r.doc_id: r for r in decontaminate.contamination(documents(spark, texts), bench, block_bytes=block_bytes).collect()}
    for i, t in enumerate(texts):
        w, hit, found = decontaminate.words((t or "").encode()), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if ids := windows.get(tuple(w[k:k + size])):
                    hit.update(range(k, k + size))
                    found |= ids
        assert (got[i].n_words, got[i].n_hit, got[i].items) == (len(w), len(hit), sorted(found))


def test_decontaminate_cuts_spans_and_keeps_clean_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    long = "clean " * 50
    docs = documents(spark, [f"{long}{passage.upper()}. {long}", passage, long, None, ""])
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {0: f"{long}. {long}", 2: long, 3: None, 4: ""}


@pytest.mark.parametrize("block_bytes", [1 << 24, 600])
def test_a_task_of_decontamination_takes_one_python_worker(spark, block_bytes):
    docs = documents(spark, ["one two three four five six seven eight nine ten eleven", None])
    bench = spark.createDataFrame([(i, f"{i} two three four five six seven eight nine ten eleven") for i in range(30)], "item_id bigint, text string")
    for made in (decontaminate.contamination(docs, bench, block_bytes=block_bytes), decontaminate.decontaminate(docs, bench, block_bytes=block_bytes)):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_entries_of_fingerprints_are_made_in_many_tasks(spark):
    fps = spark.createDataFrame([(i * 0x9E3779B97F4A7C15 % (1 << 63),) for i in range(2000)], "fp bigint")
    signatures, seen, tasks = simhash._signatures, [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        simhash._signatures = lambda spread, distance: seen.append(spread.rdd.getNumPartitions()) or signatures(spread, distance)
        simhash.links(fps).count()
    finally:
        simhash._signatures = signatures
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
    assert seen == [24]


def test_url_rules_equal_the_definition(spark):
    rng = random.Random(3)
    hosts = ["org", "example.org", "a.example.org", "notexample.org", "b.com", "com", "x.net", "", "EXAMPLE.org", "example.org.", "é.com"]
    paths = ["", "/", "/es/", "/es/x", "/en/1", "/en/12", "/en/2", "/de/", "/fr/a", "/es"]
    tails = ["", "?q=/es/", "#top"]
    urls = [rng.choice(["http://", "https://"]) + rng.choice(hosts) + rng.choice(paths) + rng.choice(tails) for _ in range(300)]
    urls += [None, "", "no scheme", "a://b://c/d", *["http://example.org/es/hot"] * 200]
    rules = [*queries.URL_RULES, ("block", "example.org", ""), ("allow", None, "/"), ("allow", "net", "/"), ("block", "net", "/")]
    pages = spark.createDataFrame([(i, u, "h", "rule") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = {r.page_id: tuple(r)[1:] for r in url_rules.judge_urls(pages, table, default="allow", ranges=7).collect()}
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host, after = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
            path = after[:min([after.find(c) for c in "?#" if c in after] or [len(after)])]
        fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules
                if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert got[i] == (host, path, best and best[3], best[4] if best else "allow")


def test_licence_expressions():
    assert licenses.to_postfix("MIT OR GPL-2.0 WITH x AND Apache-2.0".split()) == "MIT GPL-2.0 x with Apache-2.0 and or".split()
    assert licenses.to_postfix(["MIT", "OR"]) is None and licenses.to_postfix(["(", "MIT"]) is None and licenses.to_postfix(["MIT", ")"]) is None
    assert licenses.evaluate(licenses.to_postfix("MIT AND GPL-3.0".split())) == (0.35, {"mit", "gpl"})


TAGGED = [
    ("SPDX-License-Identifier: Apache-2.0 and the rest", ["Apache-2.0"], 0.1, "apache"),
    ("SPDX-License-Identifier: Apache-2.0 or MIT, whichever", ["Apache-2.0 or MIT"], 0.05, "apache,mit"),
    ("spdx license identifier = MIT\nAll rights reserved", ["MIT"], 1.0, "mit,reserved"),
    ("SPDX-License-Identifier: (MIT AND EPL-2.0) OR Zlib", ["( MIT AND EPL-2.0 ) OR Zlib"], 0.05, "epl,mit,zlib"),
    ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", ["GPL-2.0 WITH Classpath-exception-2.0"], 0.325, "gpl"),
    ("SPDX-License-Identifier: GPL-2.0 with thanks to all", ["GPL-2.0"], 0.65, "gpl"),
    ("General Public License. SPDX-License-Identifier: MIT OR GPL-3.0", ["MIT OR GPL-3.0"], 0.05, "gpl,mit"),
    ("SPDX-License-Identifier: LicenseRef-Own AND (MIT", ["LicenseRef-Own"], 0.5, "licenseref-own"),
    ("SPDX-License-Identifier: ( ) MIT", [], 0.0, ""),
    ("SPDX-License-Identifier:", [], 0.0, ""),
    ("SPDX-License-Identifier: MIT. SPDX-License-Identifier: CC0-1.0", ["MIT", "CC0-1.0"], 0.05, "cc0,mit"),
]


def test_tagged_texts_through_the_scan(spark):
    got = {r.doc_id: r for r in licenses.license_scan(documents(spark, [t for t, *_ in TAGGED])).collect()}
    for i, (_, expressions, score, labels) in enumerate(TAGGED):
        assert (got[i].expressions, got[i].labels) == (expressions, labels), TAGGED[i]
        assert got[i].score == pytest.approx(score), TAGGED[i]


def test_expressions_equal_a_recursive_evaluator(spark):
    rng = random.Random(12)
    names = {"MIT": 0.95, "GPL-3.0": 0.35, "MPL-2.0": 0.6, "Zlib": 0.95, "CC-BY-4.0": 0.85}

    def grow(depth):
        if not depth or rng.random() < 0.3:
            name = rng.choice(list(names))
            return (f"{name} WITH GCC-exception-3.1", (1 + names[name]) / 2) if rng.random() < 0.2 else (name, names[name])
        (a, x), (b, y) = grow(depth - 1), grow(depth - 1)
        op, value = rng.choice([("AND", min(x, y)), ("OR", max(x, y))])
        return f"({a}) {op} ({b})", value
    grown = [grow(4) for _ in range(60)]
    got = {r.doc_id: r for r in licenses.license_scan(documents(spark, [f"x SPDX-License-Identifier: {t}\n" for t, _ in grown])).collect()}
    for i, (text, value) in enumerate(grown):
        assert got[i].score == pytest.approx(1 - value) and "".join(got[i].expressions).replace(" ", "") == text.replace(" ", "")
    assert [licenses.evaluate(licenses.to_postfix(t.split()))[0] for t in ("MIT OR GPL-3.0 AND MPL-2.0", "GPL-3.0 AND MPL-2.0 OR MIT")] == [0.95, 0.95]


def test_licence_places_equal_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "x", "CC,", "BY.", "nc"]
    own = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))) for _ in range(60)] + ["cc by cc by", None, ""]
    for r in licenses.license_scan(documents(spark, own)).collect():
        w = [x.decode() for x in decontaminate.words((own[r.doc_id] or "").encode())]
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted({x for _, x in places})))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_packing_round_trip(spark, texts):
    tk = Tokenizer.from_file(VOCABULARY)
    got = packing.pack_documents(documents(spark, texts), VOCABULARY, block_tokens=3000).collect()
    ids = {i: [*tk.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    pieces, sequences = {}, {}
    for r in got:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32 and len(part) == 4 * r.length and r.doc_tokens == len(ids[r.doc_id])
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts, whole in ((pieces[i], len(ids[i])) for i in ids):
        assert [s for s, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]] and sum(n for _, n in parts) == whole
    for parts in sequences.values():
        total = sum(n for _, n in parts)
        assert [s for s, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]]
        assert total <= 1024 and total.bit_count() == 1


def test_ids_of_long_white_space_equal_the_library():
    tk, encode = Tokenizer.from_file(VOCABULARY), packing.encoder(VOCABULARY)
    n = packing.LONG_RUN
    for t in (" " * 1_100_000 + "a", "a" + "\n" * 1_100_000, *(f"a{c * k}{b}" for c in (" ", "\n", " \n", "\u3000") for k in (n // len(c) - 1, n, n + 1) for b in
              ("", "b", "'s", "\x1c", f".{c * n}1 ", f"<|endoftext|>{c * n}<|endoftext|>x"))):
        assert encode(t) == np.array(tk.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("stage", [packing.pack_documents, lambda docs, _: corpus_pipeline.packing_stage(docs.sparkSession, docs, SF)])
def test_packing_of_two_million_spaces(spark, stage):
    t = " " * 2_000_000
    got = stage(documents(spark, [t, "a b"]), VOCABULARY).filter("doc_id = 0").orderBy("start").collect()
    ids = np.array([*Tokenizer.from_file(VOCABULARY).encode(t, add_special_tokens=False).ids, 0], "<u4")
    assert sum(r.length for r in got) == got[0].doc_tokens == len(ids)
    assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in got)


@pytest.mark.parametrize("limits", [(64, 4, 64), (64, 64, 10), (16, 2, 5)])
def test_packing_keeps_all_limits(limits):
    rng = random.Random(limits[2])
    examples = [(n := rng.randrange(0, 200), rng.randrange(0, n + 1)) for _ in range(200)]
    seen = [0] * len(examples)
    for sequence in packing.pack(examples, *limits):
        assert len(sequence) <= limits[1] and sum(p[2] for p in sequence) <= limits[0]
        assert sum(packing.loss(s, n, examples[e][1]) for e, s, n, _ in sequence) <= limits[2]
        for e, _, n, _ in sequence:
            seen[e] += n
    assert seen == [n for n, _ in examples]


@pytest.mark.parametrize("examples", [[(6, 0)] * 3000, [(2000, 0)] * 500 + [(6, 0)] * 5000, [(3, 0), (900, 0), (5, 1)] * 1000])
@pytest.mark.parametrize("max_loss", [1024, 100])
def test_no_sequence_of_many_short_texts_is_padded(examples, max_loss):
    sequences = packing.pack(examples, max_loss=max_loss)
    totals = [sum(p[2] for p in s) for s in sequences]
    assert all(n <= 1024 and n.bit_count() == 1 for n in totals) and sum(totals) == sum(n for n, _ in examples)
    assert all(len(s) <= 64 and sum(packing.loss(b, n, examples[e][1]) for e, b, n, _ in s) <= max_loss for s in sequences)
    assert all([p[3] for p in s] == [0, *np.cumsum([p[2] for p in s])[:-1]] for s in sequences)


def test_short_examples_fill_the_gaps_of_large_ones():
    sequences = packing.pack([(1000, 0)] * 200 + [(24, 0)] * 200)
    assert [[p[2] for p in s] for s in sequences] == [[1000, 24]] * 200
    # the loss limit decides: an example without loss joins one that uses it up
    sequences = packing.pack([(500, 0)] * 100 + [(524, 524)] * 100, max_loss=500)
    assert [sorted(p[2] for p in s) for s in sequences] == [[500, 524]] * 100


def test_nearest_recall_and_exclusions(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(600, 8)), np.tile(rng.normal(size=8), (300, 1))])
    rows = [(i, [float(v) for v in r], "q") for i, r in enumerate(x)]
    rows += [(2000, None, "q"), (2100, [0.0] * 8, "q"), (2200, [float("nan")] * 8, "q"), (2300, [1.0] * 3, "q"), (None, [1.0] * 8, "q")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, query_id string")
    got = {}
    for r in ann.nearest(df, list_rows=60).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 900, 100))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        best = [int(i) for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        assert [f[0] for f in sorted(found)] == list(range(1, 11)) and all(abs(d[v] - s) < 1e-12 for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(best))
    assert hits / 90 >= 0.9
    assert [v for _, v, _ in sorted(got[600])] == [v for v in range(601, 611)]  # ties: smaller ids first
    assert ann.nearest(df.limit(0)).collect() == [] and len(ann.nearest(df.filter("vec_id < 3")).collect()) == 2


def test_queries_walk_the_graph_of_many_lists(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = (rng.normal(size=(60, 8)) * 6)[rng.integers(0, 60, 4000)] + rng.normal(size=(4000, 8))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id bigint, embedding array<double>")
    hits = 0
    for r in ann.nearest(df, list_rows=10).groupBy("query_id").agg(F.collect_list("vec_id").alias("found")).collect():
        d = ((x - x[r.query_id]) ** 2).sum(1)
        d[r.query_id] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & set(r.found))
    assert hits / 400 >= 0.9
    # the lists chosen are those of a scan, which few lists need not
    graph = ann.CentroidGraph(x[:400])
    size, q, ratio, floor = np.full(400, 10), x[400:900], 1.2, 0.5
    d = np.sqrt(ann.squared(q, graph.c))
    rank = np.argsort(np.argsort(d, axis=1), axis=1)
    want = set(zip(*np.nonzero((d <= ratio * np.maximum(d.min(1)[:, None], floor)) | (rank * 10 < 44))))
    monkeypatch.setattr(ann, "squared", None)  # no scan
    rows, lists = graph.lists_to_read(q, ratio, floor, size, 44)
    got = list(zip(rows, lists))
    assert len(got) == len(set(got)) and len(want & set(got)) >= 0.97 * len(want) and len(set(got) - want) <= 0.03 * len(want)


def labelled(spark, table):
    return spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{table}.parquet")


def test_quality_and_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark, "documents"), labelled(spark, "labels")
    crc = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    seen = labels.filter(crc != 0)
    got = quality.score_quality(docs, seen).join(labels.filter(crc == 0), "doc_id").collect()
    assert np.mean([(r.score >= 0.5) == bool(r.quality) for r in got]) >= 0.9
    rows = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == r.toxic for r in rows]) >= 0.9


def test_both_views_pass_on_labels_and_every_round_adds(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    crc = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    views = quality._views(docs, "doc_id", "text", "lang", "source", "n_chars")
    model, rows = quality.train(views, labels.filter(crc != 0), "doc_id", "quality", 20_000, 50, 3)
    tally = {(turn, giver): sum(n for t, g, _, n in model.counts if (t, g) == (turn, giver)) for turn in range(3) for giver in (0, 1)}
    assert all(0 < n <= 100 for n in tally.values())
    assert {label for _, g, label, _ in model.counts if g == 0} == {0, 1}
    assert rows.count() == docs.count()
    held = quality.score_quality(docs, labels.filter(crc != 0)).join(labels.filter(crc == 0), "doc_id").toPandas()
    y = held.quality.to_numpy()
    loss = {c: -np.mean(np.log(np.where(y == 1, held[c], 1 - held[c]))) for c in ("text_score", "meta_score", "score")}
    assert loss["score"] <= 1.1 * min(loss["text_score"], loss["meta_score"])


def test_cut_of_a_view_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(50):
        z, y = rng.integers(-6, 7, 60).astype(float), rng.integers(0, 2, 60)
        y = np.where(rng.random(60) < 0.7, z > 0, y).astype(int)
        for label in (0, 1):
            beyond = {c: (z >= c if label else z <= c) for c in set(z)}
            fits = [c for c, at in beyond.items() if at.sum() >= 10 and (y[at] == label).mean() >= 0.8 and (y[at] == label).mean() > (y == label).mean()]
            want = (min if label else max)(fits, default=float("inf") if label else -float("inf"))
            assert quality.sure_cut(z, y, label, 0.8, 10) == want


def test_shape_of_a_text_equals_the_definition():
    for t in (b"", b" \n", b"A", "Ab AB ab. aB\tC#\n\n\u00e9 AB AB".encode(), b"x | y | z\rQQ\x0bab."):
        w, low = t.split(), t.lower().split()
        got = dict(zip(quality.TEXT_FEATURES, quality.text_shape(t)))
        if not w:
            assert set(got.values()) == {0.0}
            continue
        up = lambda c: 65 <= c <= 90
        assert got["capital starts"] == pytest.approx(np.mean([up(x[0]) for x in w]))
        assert got["all capitals"] == pytest.approx(np.mean([len(x) > 1 and up(x[0]) and up(x[1]) for x in w]))
        assert got["sign ends"] == pytest.approx(np.mean([quality.CLASSES[x[-1]] == 115 for x in w]))
        assert got["distinct words"] == len(set(low)) / len(low) and got["most frequent word"] == max(map(low.count, low)) / len(low)


def test_texts_odd_rows_and_clashing_columns_in_co_training(spark, texts):
    rows = [(i, t, None if i % 3 else "en", None if i % 4 else "s", None if i % 5 else len(t or ""), 0.5, "r", "f", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[0], (None, "no id", None, None, None, None, None, None, None)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, len(texts), 2)] + [(2, 1, 0), (4, 0, 0), (6, 1, 0), (8, 1, 0), (10, 1, 0), (12, None, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(rows) + 2 and all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_quality(docs, labels)
    assert kept.schema == docs.schema and kept.count() == sum(r.keep for r in got)


def test_sentence_pairs_swap_one_term_of_a_sentence():
    swaps = {b"women": b"men", b"men": b"women"}
    of = lambda w: set(toxicity.word_features(w))
    got = toxicity.sentence_pairs(b"Women and MEN. No one here! Men\nmen men", swaps)
    change = lambda x, y: (tuple(sorted(of(x) - of(y))), tuple(sorted(of(y) - of(x))))
    both = {(tuple(sorted(of(x))), ()): 1 for x in (b"women", b"men")}  # the other one is there already
    assert got == both | {change(b"men", b"women"): 2}
    assert not toxicity.sentence_pairs(b"", swaps) and not toxicity.sentence_pairs(b"a womens club", swaps)


@pytest.mark.parametrize("group", ["muslim", "zorgish"])
def test_counterfactuals_spare_neutral_mentions(spark, group):
    """``zorgish`` is on no list: it is found in the sample."""
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        toxic = int(rng.random() < 0.4)
        named = rng.random() < (0.6 if toxic else 0.42)
        insult = toxic and rng.random() < 0.7
        w = [rng.choice(WORDS) for _ in range(6)] + [group] * named + ["scum"] * insult
        rng.shuffle(w)
        rows.append((i, " ".join(w) + ". " + sentence(rng, 4), toxic, int(named), int(insult)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int, named int, insult int").repartition(3)
    labels, truth = docs.select("doc_id", "toxic"), docs.drop("text")

    def judged(penalty):
        return toxicity.score_toxicity(docs, labels, swap_penalty=penalty).join(truth, "doc_id").filter("held_out").toPandas()
    plain, fair = judged(0.0), judged(20.0)
    assert fair.bound_pairs.iloc[0] > 100

    def rise(d):  # of a mention, in texts without an insult
        clean = d[d.insult == 0]
        return clean[clean.named == 1].score.mean() - clean[clean.named == 0].score.mean()
    wrong = lambda d: int(((d.predicted == 1) & (d.toxic == 0) & (d.named == 1)).sum())
    assert rise(plain) > 0.05 and rise(fair) < 0.5 * rise(plain) and wrong(fair) <= wrong(plain)
    assert (fair.predicted == fair.toxic).mean() >= (plain.predicted == plain.toxic).mean() - 0.02


def test_penalised_fit_reaches_the_optimum():
    from ledgerline.llm import linear
    rows, y = linear.Rows([np.array(x) for x in ([0], [0, 1], [1], [2], [1, 2], [], [0, 2], [2])], 3), np.array([1, 1, 0, 0, 1, 0, 1, 1.0])
    a, b, n = linear.Rows([np.array([0]), np.array([1])], 3), linear.Rows([np.array([1]), np.array([], int)], 3), np.array([3.0, 1.0])
    dense = lambda r: np.array([[np.sum(r.index[r.start[i]:r.start[i + 1]] == j) for j in range(3)] for i in range(r.n)], float)
    x, d = dense(rows), dense(b) - dense(a)

    def loss(w, bias):
        z = x @ w + bias
        return np.mean(np.logaddexp(0, z) - y * z) + 2.0 / 16 * w @ w + 0.5 * (n * (d @ w) ** 2).sum() / 8
    w, bias = linear.fit(rows, y, l2=2.0, swaps=(a, b, n), swap_penalty=0.5, steps=2000)
    best = loss(w, bias)
    rng = np.random.default_rng(0)
    for scale in (0.3, 0.03, 0.003):
        for _ in range(500):
            step = rng.normal(0, scale, 4)
            assert loss(w + step[:3], bias + step[3]) >= best - 1e-6


def test_classifiers_without_labels_and_with_odd_rows(spark, texts):
    docs = documents(spark, texts)
    none = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 7, 7)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert quality.keep_quality(docs, none).count() == len(texts)
    assert {r.score for r in toxicity.score_toxicity(docs, none).collect()} == {0.5}


def test_columns_named_like_helpers_stay(spark, texts):
    docs = documents(spark, texts)
    for c in ("__llm_hits", "__LLM_FP", "__llm_tie", "__llm_row", "__llm_stays"):
        docs = docs.withColumn(c, F.lit(7))
    bench = spark.createDataFrame([(1, texts[0])], "item_id bigint, text string")
    cut, plain = decontaminate.decontaminate(docs, bench), decontaminate.decontaminate(documents(spark, texts), bench)
    assert cut.columns == docs.columns and {(r.doc_id, r.text) for r in cut.collect()} == {(r.doc_id, r.text) for r in plain.collect()}
    one, plain = simhash.drop_near_duplicates(docs), simhash.drop_near_duplicates(documents(spark, texts))
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == {r.doc_id for r in plain.collect()}
    named = docs.withColumn("fp", F.col("doc_id"))
    assert {r.fp for r in simhash.drop_near_duplicates(named, id_col="fp").collect()} == {r.doc_id for r in plain.collect()}


def test_empty_tables_give_empty_results(spark):
    docs = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    rules = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([], "page_id bigint, url string")
    for df in (quality.score_quality(docs, labels), quality.keep_quality(docs, labels), url_rules.judge_urls(pages, rules),
               token_counts.token_counts(docs, VOCABULARY), decontaminate.contamination(docs, bench), decontaminate.decontaminate(docs, bench),
               simhash.near_duplicates(docs), simhash.drop_near_duplicates(docs), suffix_dedup.remove_repeats(docs), suffix_dedup.cut_repeats(docs),
               licenses.license_scan(docs), packing.pack_documents(docs, VOCABULARY), toxicity.score_toxicity(docs, labels)):
        assert df.count() == 0


@pytest.mark.parametrize("name", ["op2_url_rules", "op4_decontamination"])
def test_queries_equal_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.execute(queries.ORACLE[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    key = lambda d: sorted(d[cols].astype(str).itertuples(index=False))
    assert key(got) == key(want)


def test_digest_of_queries(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op7_suffix_array_dedup"](spark, SF).collect()}
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for i, n, removed, spans, kept in brute_repeats(docs):
        assert tuple(got[i]) == (i, n, removed, spans, hashlib.sha256(kept).hexdigest())


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    keep = {r.doc_id for r in quality.score_quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.keep}
    left = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id in keep}
    fps = {i: brute_simhash(t) for i, t in left.items()}
    root = brute_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    left = {i: left[i] for i in set(root.values())}
    cut = {i: kept.decode(errors="ignore") for i, _, removed, _, kept in brute_repeats([(i, t.encode()) for i, t in left.items()])
           if not removed or kept.decode(errors="ignore").strip()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[k:k + min(10, len(w))]) for w in map(decontaminate.words, (t.encode() for t in items if t)) for k in range(max(1, len(w) - 9)) if w}
    tk, want = Tokenizer.from_file(VOCABULARY), {}
    for i, t in cut.items():
        w = decontaminate.words(t.encode())
        hits = [{"start": k, "end": k + n, "item": ""} for n in {len(x) for x in windows} for k in range(len(w) - n + 1) if tuple(w[k:k + n]) in windows]
        n_hit = sum(e - s for s, e in decontaminate.runs(hits))
        if not n_hit or n_hit < decontaminate.DROP_SHARE * len(w):
            clean = decontaminate.remove_hits(t.encode(), hits).decode() if hits else t
            want[i] = len(tk.encode(clean, add_special_tokens=False).ids) + 1
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want
