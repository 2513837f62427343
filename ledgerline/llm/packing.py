"""Operator 9: vector bin packing into training sequences.

Examples are placed under simultaneous limits on tokens, segments and
loss-bearing tokens.  Whole sequences' worth of an example is cut off first; what
remains is placed by the dot-product heuristic: into the open sequence, of all
examples of the block that fit, the one whose demand vector has the largest dot
product with the free capacity.  A gap that no example fits is filled with the head
of one, so only a block's last sequence and those that the segment or loss limit
closes stay short; they are split into sequences of power-of-two length, and no
sequence needs padding.

Blocks of examples (``BLOCK_TOKENS``) are packed one by one inside a task, in one
pass over the input without a shuffle; a hot source or copies make no
difference, and memory holds one block."""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.pretokens import PATTERN, byte_alphabet, load_vocabulary, segments
from ledgerline.llm.text import slices

#: Tokens in a sequence, segments in a sequence, loss-bearing tokens in a sequence.
CAPACITY, MAX_SEGMENTS, MAX_LOSS = 1024, 64, 1024
#: Tokens that a block gathers before it is packed.
BLOCK_TOKENS = 1_000_000
#: Runs of white space from this length on; tiktoken's pattern fails on about a million characters of it.
LONG_RUN = 100_000
LONG_RUNS = regex.compile(rf"(?<!\s)\s{{{LONG_RUN},}}")
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, loss_tokens bigint, "
          "sequence_id bigint, offset bigint")


def little(ids: list[int]) -> bytes:
    """Unsigned, little-endian 32-bit."""
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def encoder(path: str):
    """``text -> token ids`` (uint32 bytes) for one byte-level BPE file, as the
    tokenizers library gives them; special strings inside texts are single tokens.
    (Run by tiktoken on the file's own vocabulary, which is several times faster; long
    runs of white space, which its pattern fails on, are cut out as the pattern would.)"""
    spec = load_vocabulary(path)
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["vocab"].items()
             if token not in spec["added"]}
    encoding = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode, one_piece = encoding.encode_ordinary, encoding._encode_single_piece
    special = {s: little([i]) for s, i in spec["added"].items()}

    def plain_ids(text: str) -> bytes:
        if len(text) < LONG_RUN:
            return little(encode(text))
        out, at = [], 0
        for m in LONG_RUNS.finditer(text):
            end = m.end() - (m.end() < len(text))  # the last one belongs to what follows
            out += [little(encode(text[at:m.start()])), little(one_piece(text[m.start():end]))]
            at = end
        return b"".join([*out, little(encode(text[at:]))])

    def tokens(text: str) -> bytes:
        return b"".join(x for plain, after in segments(text, special)
                        for x in (plain_ids(plain), special.get(after, b"")))
    return tokens


def pack(examples: list[tuple[int, int]], capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS,
         max_loss: int = MAX_LOSS) -> list[list[tuple[int, int, int, int]]]:
    """Sequences of (example, start, length, offset) for ``(tokens, first
    loss-bearing token)`` examples: an example's tokens from that one on bear loss.

    Every token lies in exactly one piece, every sequence keeps all three limits and holds
    ``capacity`` tokens or a power of two."""
    if not (capacity > 0 and max_segments > 0 and max_loss > 0):
        raise ValueError("limits must be positive")
    sequences: list[list[tuple[int, int, int, int]]] = []
    rest: list[tuple[int, int]] = []  # (example, start) whose tail is still to be placed
    for e, (tokens, first) in enumerate(examples):
        start = 0
        while tokens - start >= capacity:
            length = most(start, first, capacity, max_loss)
            sequences.append([(e, start, length, 0)])
            start += length
        if start < tokens:
            rest.append((e, start))
    # examples of one demand (tokens, loss) are alike: each distinct demand is weighed once
    alike: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for e, s in reversed(rest):
        alike.setdefault(demand(s, *examples[e]), []).append((e, s))
    keys = sorted(alike)
    waiting = [alike[k] for k in keys]
    need, bears = np.array(keys, np.int64).reshape(-1, 2).T
    limits = np.array([capacity, max_segments, max_loss], np.int64)
    while keys:
        free, sequence = limits.copy(), []
        while keys and free[0] and free[1]:
            fits = (need <= free[0]) & (bears <= free[2])
            if fits.any():
                # dot product of relative demand and relative free capacity; ties: the largest
                w = free / limits / limits
                score = np.where(fits, need * w[0] + w[1] + bears * w[2], -1.0)
            else:  # no example fits whole: the head of the one that fills the gap best
                score = np.minimum(free[0], need - bears + free[2])
            at = len(keys) - 1 - int(np.argmax(score[::-1]))
            length = int(need[at] if fits[at] else score[at])
            if not length:
                break
            e, s = waiting[at].pop()
            if not waiting[at]:
                del keys[at], waiting[at]
                need, bears = np.delete(need, at), np.delete(bears, at)
            sequence.append((e, s, length, capacity - int(free[0])))
            free -= (length, 1, loss(s, length, examples[e][1]))
            if s + length < examples[e][0]:
                left = demand(s + length, *examples[e])
                at = bisect_left(keys, left)
                if at == len(keys) or keys[at] != left:
                    keys.insert(at, left)
                    waiting.insert(at, [])
                    need, bears = np.insert(need, at, left[0]), np.insert(bears, at, left[1])
                waiting[at].append((e, s + length))
        sequences.append(sequence)
    return [part for sequence in sequences for part in in_powers(sequence, capacity)]


def demand(start: int, tokens: int, first: int) -> tuple[int, int]:
    """(tokens, loss tokens) of an example from ``start`` on."""
    return tokens - start, tokens - max(start, first)


def most(start: int, first: int, tokens: int, max_loss: int) -> int:
    """Longest piece from ``start`` with at most so many tokens and loss tokens."""
    return min(tokens, max(0, first - start) + max_loss)


def loss(start: int, length: int, first: int) -> int:
    return max(0, start + length - max(start, first))


def in_powers(sequence: list, capacity: int) -> list[list]:
    """One sequence, cut into sequences of power-of-two length if it isn't full."""
    total = sum(p[2] for p in sequence)
    if total == capacity:
        return [sequence]
    out, pieces = [], sequence[::-1]
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            room, part = 1 << bit, []
            while room:
                e, s, n, _ = pieces.pop()
                take = min(n, room)
                part.append((e, s, take, (1 << bit) - room))
                room -= take
                if take < n:
                    pieces.append((e, s + take, n - take, 0))
            out.append(part)
    return out


def pack_documents(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   prompt_col: str | None = None, end_id: int = 0, capacity: int = CAPACITY,
                   max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS,
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for each piece of each row of ``df``: ``doc_id, start, length,
    ids_crc32, doc_tokens, loss_tokens, sequence_id, offset``.

    An example's ids are those of its text and ``end_id`` behind them; NULL and
    empty texts are that id alone.  With ``prompt_col`` that text comes first and
    bears no loss (instruction data); else all tokens do.  Repeated rows are
    examples of their own.  ``sequence_id`` is unique over the table; ``offset``
    counts gaplessly from 0 in each sequence."""
    own = [F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")]
    own.append(F.coalesce(F.col(prompt_col).cast("string"), F.lit("")).alias("p") if prompt_col else F.lit("").alias("p"))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    end = little([end_id])

    def task(batches):
        encode = encoder(vocabulary)
        sequence = TaskContext.get().partitionId() << 36
        doc_ids, ids, firsts, held = [], [], [], 0

        def block():
            nonlocal sequence
            rows = []
            for pieces in pack([(len(x) // 4, f) for x, f in zip(ids, firsts)], capacity, max_segments, max_loss):
                rows += [(doc_ids[e], s, n, zlib.crc32(ids[e][4 * s:4 * (s + n)]), len(ids[e]) // 4,
                          loss(s, n, firsts[e]), sequence, at) for e, s, n, at in pieces]
                sequence += 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
        for b in slices(batches):
            for doc, text, prompt in zip(*(c.to_pylist() for c in b.columns)):
                before = encode(prompt) if prompt else b""
                doc_ids.append(doc)
                ids.append(before + encode(text) + end)
                firsts.append(len(before) // 4)
                held += len(ids[-1]) // 4
                if held >= block_tokens:
                    yield block()
                    doc_ids, ids, firsts, held = [], [], [], 0
        if ids:
            yield block()
    return df.select(*own).mapInArrow(task, SCHEMA)
