"""Operator 4: benchmark decontamination with a broadcast set of n-grams.

The test items are cut into windows of ``n`` words (an item of fewer words is one
window).  Each task slides over its documents' words with a rolling hash, looks the
windows up in the set, and verifies every hit word for word.  Document words are
first mapped to numbers of the items' own vocabulary, so a window that holds any
other word is passed over without hashing.

Only the items are broadcast, and in blocks of at most ``block_bytes``: with more
items than one block holds the documents are scanned once for each block, the
hits so far travelling with them through a table in the checkpoint folder.
Nothing depends on how often a passage occurs in the corpus, and no document is
shuffled."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import LOWER, free_name, slices, words
from ledgerline.session import freeze

#: Words in a window.
WINDOW = 10
#: Bytes of item text in one broadcast block.
BLOCK_BYTES = 16 * 1024 * 1024
#: A document with at least this share of its words hit is removed whole.
DROP_SHARE = 0.8
WORD_RUN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
HITS = "__llm_hits"
SPANS = "array<struct<start: bigint, end: bigint, item: string>>"


class Windows:
    """The windows of some items: rolling hashes for look-up, words for proof."""

    def __init__(self, items: list[tuple[str, list[bytes], bool]], n: int):
        """``items``: id, words, and whether the item may be shorter than ``n``."""
        self.numbers: dict[bytes, int] = {}
        self.owners: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, item_words, whole in items:
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in item_words], dtype=np.int64)
            size = min(n, len(ids)) if whole else n
            if size:
                for i in range(len(ids) - size + 1):
                    self.owners[size][ids[i:i + size].tobytes()].add(item)
        self.hashes = {size: np.unique(self._rolling(np.concatenate([np.frombuffer(k, np.int64) for k in of]), size)[::size])
                       for size, of in self.owners.items()}

    @staticmethod
    def _rolling(ids: np.ndarray, size: int) -> np.ndarray:
        """Hash of each run of ``size`` numbers."""
        values = ids.astype(np.uint64)
        values = (values ^ (values >> np.uint64(7))) * MULTIPLIER
        out = np.zeros(len(ids) - size + 1, np.uint64)
        for k in range(size):
            out = out * MULTIPLIER + values[k:k + len(out)]
            out ^= out >> np.uint64(29)
        return out

    def scan(self, doc_words: list[bytes]) -> list[tuple[int, int, str]]:
        """(first word, end word, item) of every occurrence of a window."""
        found = []
        number = self.numbers.get
        ids = np.fromiter((number(w, 0) for w in doc_words), np.int64, len(doc_words))
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for size, of in self.owners.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])  # windows of known words only
            if not len(at):
                continue
            if len(at) * 4 < len(ids):  # few: hash these alone
                grid = ids[at[:, None] + np.arange(size)]
                hashes = self._rolling(grid.reshape(-1), size)[::size]
            else:
                hashes = self._rolling(ids, size)[at]
            known = self.hashes[size]
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for i in at[known[place] == hashes].tolist():
                found += [(i, i + size, item) for item in of.get(ids[i:i + size].tobytes(), ())]
        return found


def item_blocks(items: DataFrame, id_col: str, text_col: str, n: int, block_bytes: int) -> DataFrame:
    """``block, item, whole, words``: the items, long ones cut into parts that overlap
    by ``n - 1`` words, dealt to blocks of about ``block_bytes``."""
    pair = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                        F.col(text_col).cast("string").alias("text")).filter("text is not null")

    def cut(batches):
        for b in batches:
            item_ids, parts, whole = [], [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                w, first, at = words(text), True, 0
                while w and (first or at + n <= len(w)):
                    end, size = at, 0
                    while end < len(w) and (size < block_bytes // 8 or end - at < n):
                        size += len(w[end]) + 1
                        end += 1
                    item_ids.append(item)
                    parts.append(b" ".join(w[at:end]))
                    whole.append(first and end == len(w))
                    first = False
                    at = end - n + 1 if end < len(w) else len(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item_ids, pa.string()), pa.array(parts, pa.binary()), pa.array(whole, pa.bool_())],
                ["item", "words", "whole"])
    return pair.mapInArrow(cut, "item string, words binary, whole boolean").withColumn("size", F.length("words") + 64)


def scan_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", n: int = WINDOW, block_bytes: int = BLOCK_BYTES,
              finish=None, schema=None) -> DataFrame:
    """``docs`` with one more column at the end (``__llm_hits``, or with underscores behind it if
    there is such a column): the (first word, end word, item) of every window found.  All
    other columns stay as they are.

    With ``finish`` such batches go through that function, to rows of ``schema``, in the Python
    worker that scans the last block: a second map behind the first takes a second worker for
    every task, which the executor then keeps."""
    spark = docs.sparkSession
    # cut once: every block is dealt from the written parts
    parts = freeze(item_blocks(items, item_col, item_text_col, n, block_bytes), "items")
    total = parts.agg(F.sum("size")).first()[0] or 0
    # one block holds everything up to block_bytes; beyond, parts are dealt by their hash to
    # twice the least number of blocks, and a block that is still too large is dealt further
    deals = [(1, 0)] if total <= block_bytes else []
    if not deals:
        todo = [(2 * -(-total // block_bytes), None)]
        while todo:
            count, only = todo.pop()
            of = parts if only is None else parts.filter(F.pmod(F.xxhash64("item", "words"), F.lit(only[0])) == only[1])
            for r in of.groupBy(F.pmod(F.xxhash64("item", "words"), F.lit(count)).alias("b")).agg(
                    F.sum("size").alias("s"), F.countDistinct("item", "words").alias("c")).collect():
                if r["s"] <= block_bytes or r["c"] == 1 or count > 2 ** 40:
                    deals.append((count, r["b"]))
                else:
                    todo.append((count * 8, (count, r["b"])))
    out = docs.withColumn(free_name(docs.columns, HITS), F.lit(None).cast(SPANS))
    names = out.columns
    text_at, hits_at = names.index(text_col), len(names) - 1
    for i, (count, block) in enumerate(deals):
        rows = parts.filter(F.pmod(F.xxhash64("item", "words"), F.lit(count)) == block).dropDuplicates(
            ["item", "words", "whole"]).select("item", "words", "whole").collect()
        shared = spark.sparkContext.broadcast([(r["item"], bytes(r["words"]), r["whole"]) for r in rows])

        def task(batches, shared=shared):
            windows = Windows([(item, w.split(b" "), whole) for item, w, whole in shared.value], n)
            for b in slices(batches):
                earlier = b.column(hits_at).to_pylist()
                texts = b.column(text_at).cast(pa.binary()).to_pylist()
                hits = [(old or []) + [{"start": s, "end": e, "item": item}
                                       for s, e, item in (windows.scan(words(t)) if t else ())]
                        for old, t in zip(earlier, texts)]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:hits_at], pa.array(hits, b.schema.field(hits_at).type)], schema=b.schema)
        if i + 1 < len(deals):
            out = freeze(out.mapInArrow(task, out.schema), "hits")
        elif finish is None:
            out = out.mapInArrow(task, out.schema)
        else:
            out = out.mapInArrow(lambda batches, scan=task: finish(scan(batches)), schema)
    return out


REPORT = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items array<string>, "
          "contaminated boolean")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", n: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, contaminated`` of every document row.

    ``n_hit`` counts the words inside any occurrence of an item's window, ``items``
    are the sorted ids (as strings) of the items whose windows occur.  NULL texts
    have no words; items without words have no windows; an item without an id
    counts as the id ''; rows of one item id count as one item."""
    pair = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def task(batches):
        for b in slices(batches):
            n_words, n_hit, found = [], [], []
            for text, spans in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
                n_words.append(len(words(text)) if text else 0)
                n_hit.append(sum(e - s for s, e in runs(spans or [])))
                found.append(sorted({x["item"] for x in spans or ()}))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(map(len, found), pa.int64()), pa.array(found, pa.list_(pa.string())),
                 pa.array([h > 0 for h in n_hit], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated"])
    return scan_hits(pair, items, "text", item_col, item_text_col, n, block_bytes, task, REPORT)


def runs(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of hit words."""
    out: list[list[int]] = []
    for start, end in sorted({(x["start"], x["end"]) for x in spans}):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def remove_hits(data: bytes, spans: list[dict]) -> bytes:
    """``data`` without the bytes from the first to the last word of each run."""
    places = [m.span() for m in WORD_RUN.finditer(data.translate(LOWER))]
    kept, at = [], 0
    for start, end in runs(spans):
        kept.append(data[at:places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, data[at:]])


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
                  item_col: str = "item_id", item_text_col: str = "text", n: int = WINDOW,
                  drop_share: float = DROP_SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs``, its columns unchanged, with hit spans cut out of the text.

    Documents with at least ``drop_share`` of their words hit go whole; documents
    without a hit, NULL and empty texts included, stay exactly as they are.
    ``length_col``, if it exists, follows the new text."""
    names = docs.columns
    text_at, length_at = names.index(text_col), names.index(length_col) if length_col in names else None

    def task(batches):
        for b in slices(batches):
            spans = b.column(len(names)).to_pylist()
            if not any(spans):
                yield pa.RecordBatch.from_arrays(b.columns[:-1], b.schema.names[:-1])
                continue
            keep, texts = [], b.column(text_at).cast(pa.binary()).to_pylist()
            lengths = b.column(length_at).to_pylist() if length_at is not None else None
            for i, found in enumerate(spans):
                hit = sum(e - s for s, e in runs(found or []))
                keep.append(not hit or hit < drop_share * len(words(texts[i])))
                if hit:
                    texts[i] = remove_hits(texts[i], found)
                    if lengths is not None:
                        lengths[i] = len(texts[i].decode())
            columns = list(b.columns[:-1])
            columns[text_at] = pa.array(texts, pa.binary()).cast(b.schema.field(text_at).type)
            if lengths is not None:
                columns[length_at] = pa.array(lengths, b.schema.field(length_at).type)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))
    return scan_hits(docs, items, text_col, item_col, item_text_col, n, block_bytes, task, docs.schema)


def ids_digest(ids) -> str:
    """Lower-case hex SHA-256 of the comma-joined ids."""
    return hashlib.sha256(",".join(ids).encode()).hexdigest()
