"""Operator 3: token counts by heap-and-linked-list byte-pair merging.

The symbols of a pre-token form a doubly linked list; a heap holds its adjacent
pairs by merge rank (ties: the leftmost).  The lowest pair is popped, merged if
it still stands, and its new neighbours are pushed.  The count is the number of
initial symbols less the merges made; no identifiers are produced.

Map-only: one pass over (id, text), no shuffle, no skew.  The vocabulary file is
a parameter and is opened on the executors, where the tokenizer package is
installed; its size is fixed and does not grow with the corpus."""

from __future__ import annotations

import heapq
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.pretokens import Pieces, byte_alphabet, load_vocabulary, segments
from ledgerline.llm.text import map_texts

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def count_symbols(symbols: list[int], rank_of: dict[int, int], merged_of: list[int]) -> int:
    """Symbols left after all merges.

    ``rank_of`` maps a pair, written as ``left << 20 | right``, to its rank and
    ``merged_of`` a rank to the symbol it makes.  Heap entries are
    ``rank << bits | position``; ``standing[i]`` is the rank of the pair that
    starts at ``i`` now, so that an entry of a pair merged since is passed over."""
    n = left = len(symbols)
    if n < 2:
        return n
    rank, push, pop = rank_of.get, heapq.heappush, heapq.heappop
    standing = [rank(a << 20 | b, -1) for a, b in zip(symbols, symbols[1:])]
    standing.append(-1)
    bits = n.bit_length()
    here = (1 << bits) - 1
    heap = [r << bits | i for i, r in enumerate(standing) if r >= 0]
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        entry = pop(heap)
        i, r = entry & here, entry >> bits
        if standing[i] != r:
            continue
        j = after[i]
        after[i] = k = after[j]
        standing[j] = -1
        symbols[i] = merged = merged_of[r]
        left -= 1
        if k < n:
            before[k] = i
            standing[i] = r = rank(merged << 20 | symbols[k], -1)
            if r >= 0:
                push(heap, r << bits | i)
        else:
            standing[i] = -1
        if (h := before[i]) >= 0:
            standing[h] = r = rank(symbols[h] << 20 | merged, -1)
            if r >= 0:
                push(heap, r << bits | h)
    return left


@lru_cache(maxsize=2)
def counter(path: str):
    """``text -> number of tokens`` for one vocabulary file (one per worker)."""
    spec = load_vocabulary(path)
    vocab = spec["vocab"]
    rank_of: dict[int, int] = {}
    merged_of = []
    for rank, (a, b) in enumerate(spec["merges"]):
        rank_of.setdefault(vocab[a] << 20 | vocab[b], rank)
        merged_of.append(vocab[a + b])
    initial = [vocab[c] for c in byte_alphabet()]

    def measure(token: str) -> int:
        return count_symbols([initial[b] for b in token.encode()], rank_of, merged_of)
    pieces = Pieces(measure, sum)

    def count(text: str) -> int:
        return sum(sum(pieces.plain(plain)) + (special is not None)
                   for plain, special in segments(text, spec["added"]))
    return count


def token_counts(df: DataFrame, vocabulary: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    NULL and empty texts have 0 bytes and 0 tokens.  ``over_limit`` is
    ``n_tokens > limit``."""
    def rows(ids, texts):
        count = counter(vocabulary)
        tokens = [count(t.decode()) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(map(len, texts), pa.int64()), pa.array(tokens, pa.int64()),
             pa.array([t > limit for t in tokens], pa.bool_())],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return map_texts(df, id_col, text_col, SCHEMA, rows)
