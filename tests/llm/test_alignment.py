"""Operator 11 against brute force on small tables."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from ledgerline.llm import queries
from ledgerline.llm.alignment import align_tokenizers
from ledgerline.llm.pretokens import byte_alphabet
from tests.llm.test_operators import SF, documents, texts  # noqa: F401

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a<|endoftext|> b", "<s> </s> <0x41> <unk>", "▁ sign", "two  spaces   and \t tabs", " lead", "trail ", "\n\nlines\n",
       "\x00\x01", "１２Ⅷ漢字\U0001f600 ﬁ ½", "naïve café", "'s 'll don't", "zzzzzzqqqq", "é", "ééé    z", "x" * 3000]


def brute(texts):
    """Every document's figures from the two libraries, with plain loops over occurrences."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte_of = {c: i for i, c in enumerate(byte_alphabet())}
    docs = []
    for text in texts:
        whole = b" " + (text or "").encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        pieces = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a], [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if any(b"".join(p) != whole for p in pieces):
            ids_a, ids_b, pieces = [], [], ([], [])
        spans = []
        for ids, parts in zip((ids_a, ids_b), pieces):
            at, own = 0, []
            for i, p in zip(ids, parts):
                own.append((i, at, at + len(p)))
                at += len(p)
            spans.append(own)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, links, start = [], [], 0
        for end in ends:
            inside = [[s for s in own if start <= s[1] and s[2] <= end] for own in spans]
            groups.append("|".join(",".join(str(s[0]) for s in own) for own in inside))
            links += [(x[0], y[0]) for x in inside[0] for y in inside[1] if x[1] < y[2] and y[1] < x[2]]
            start = end
        docs.append((len(ids_a), len(ids_b), groups, links))
    count = Counter(p for *_, links in docs for p in set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = [(n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for n_a, n_b, groups, links in docs]
    return rows, {(*p, n, n == best[p[0]]) for p, n in count.items()}


def test_alignment_equals_brute_force(spark, texts):
    own = [t for t in texts if t is None or len(t) < 5000] + ODD + ODD[:3]
    rows, pairs = brute(own)
    for chunk_bytes in (200, 1 << 23):
        docs, found = align_tokenizers(documents(spark, own), A, B, chunk_bytes=chunk_bytes)
        assert {r.doc_id: tuple(r)[1:] for r in docs.collect()} == dict(enumerate(rows))
        assert sorted(map(tuple, found.collect())) == sorted(pairs)


def test_alignment_keeps_repeated_and_missing_ids(spark):
    own = ["the same text", "the same text", None, "", "another text"]
    df = documents(spark, own, [7, 7, 7, None, None])
    rows, _ = brute(own)
    docs, _ = align_tokenizers(df, A, B)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, docs.collect()), key=key) == sorted(((i, *r) for i, r in zip([7, 7, 7, None, None], rows)), key=key)


def test_alignment_of_an_empty_table(spark):
    docs, pairs = align_tokenizers(documents(spark, ["x"]).limit(0), A, B)
    assert docs.count() == pairs.count() == 0


def test_alignment_of_very_long_texts(spark):
    own = ["word " * 200_000, "y" * 100_000, " " * 50_000, "the plain one"]
    docs, _ = align_tokenizers(documents(spark, own), A, B)
    got = {r.doc_id: r for r in docs.collect()}
    assert [got[i].n_groups > 0 for i in range(4)] == [True] * 4 and got[0].n_a >= 200_000


def test_registered_alignment_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows, _ = brute([r.text for r in table])
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op11_tokenizer_alignment"](spark, SF).collect()}
    assert got == {r.doc_id: x for r, x in zip(table, rows)}
