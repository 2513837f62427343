"""Operator 11: alignment of the ids of two tokenizers over a corpus.

A byte-level BPE vocabulary (A) and a sentencepiece model (B) cut the same bytes.  Offsets where
tokens of both end cut a text into groups; two occurrences are linked if their bytes overlap.  An
id pair's count is the number of documents that hold it linked.

* **Identity map.**  The B id with the bytes of an A id is looked up once per vocabulary.  A group of
  one token each whose ids map to one another is the usual case; its documents are counted in a
  vector as long as vocabulary A, one vector per task, and the vectors are added by id.
* **Irregular groups.**  Every other linked pair goes through the pair shuffle: counted per chunk of
  documents first, so that a pair which a third of all documents hold is one row per chunk, then summed
  by pair.  The sums go back to the chunks that asked for them (a join that Spark can split), and each
  chunk adds up its documents' links.

Texts are encoded once, word by word where that is exact; what later steps need (distinct ids and pairs of each document) is written to the
checkpoint folder.  The driver sees vectors as long as vocabulary A, never pairs or documents.

Odd rows: NULL and empty texts, and texts whose token bytes don't join to space + text under either
tokenizer (the model may normalise them, or the text holds its space sign U+2581), have no tokens: all
counts 0 and an empty ``groups_sha256``.  NULL and repeated ids are documents of their own.  Special
tokens' strings are plain text.  An empty table gives an empty result."""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache
from itertools import chain
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.library_ids import REMEMBERED, STRUNG, Recent
from ledgerline.llm.pretokens import AMBIGUOUS, byte_alphabet
from ledgerline.llm.text import blocks, text_bytes
from ledgerline.session import freeze

#: Bytes of text in a chunk (at least one document).
CHUNK_BYTES = 8 << 20
_DOCS = ("chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
         "groups_sha256 string, own array<int>, own_n array<int>, pair array<bigint>, pair_n array<int>")
SCHEMA = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
          "count_sum bigint, groups_sha256 string")


@lru_cache(maxsize=2)
def tokenizers_of(path_a: str, path_b: str) -> SimpleNamespace:
    """Both tokenizers, the bytes of their tokens, the map from A ids to the B id of the same
    bytes (-1: none), and whether no piece of B goes on over a space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    byte_of = {c: i for i, c in enumerate(byte_alphabet())}
    entries = {i: t for t, i in a.get_vocab(with_added_tokens=True).items()}

    def bytes_a(entry: str) -> bytes:
        return bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()

    def bytes_b(i: int) -> bytes:
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
    of_a = [bytes_a(entries.get(i, "")) for i in range(max(entries) + 1)]
    of_b = [bytes_b(i) for i in range(b.get_piece_size())]
    by_bytes = {x: i for i, x in enumerate(of_b)}  # of several (a byte piece and a letter), the last
    separators = [f"{i}{s}".encode() for n, last in ((len(of_a), "|"), (len(of_b), ";")) for i in range(n) for s in (",", last)]
    pieces = [b.id_to_piece(i) for i in range(len(of_b))]
    return SimpleNamespace(a=a, b=b, by_words=not any("▁" in p[1:] and p.strip("▁") for p in pieces), of_a=of_a, of_b=of_b, len_a=np.array([*map(len, of_a)]), len_b=np.array([*map(len, of_b)]),
                           same=np.array([by_bytes.get(x, -1) for x in of_a]), separators=np.array(separators, object))


def encode(units: list[str], t: SimpleNamespace) -> tuple[np.ndarray, ...]:
    """A ids, their number for each text, B ids, their number for each text.  Texts that are empty or don't
    equal the joined bytes of their tokens have none."""
    ids_a = [e.ids for e in t.a.encode_batch_fast([" " + x for x in units], add_special_tokens=False)]
    ids_b = t.b.encode(units, num_threads=1)
    for i, x in enumerate(units):
        whole = b" " + x.encode()
        if not x or b"".join([t.of_a[k] for k in ids_a[i]]) != whole or b"".join([t.of_b[k] for k in ids_b[i]]) != whole:
            ids_a[i], ids_b[i] = [], []
    return tuple(x for ids in (ids_a, ids_b) for x in (np.fromiter(chain.from_iterable(ids), np.int64), np.array([*map(len, ids)], np.int64)))


def encode_words(words: list[str], t: SimpleNamespace) -> tuple[np.ndarray, ...] | None:
    """:func:`encode` for words that stand alone between single spaces, strung together to texts of ``STRUNG``
    words, whose ids are cut where the words end; None where a text differs from its tokens' bytes."""
    texts = [" ".join(words[i:i + STRUNG]) for i in range(0, len(words), STRUNG)]
    whole = "".join([" " + x for x in texts]).encode()
    ends = np.cumsum([len(w.encode()) + 1 for w in words])
    out: list[np.ndarray] = []
    for ids, of, sizes in (([e.ids for e in t.a.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)], t.of_a, t.len_a),
                           (t.b.encode(texts, num_threads=1), t.of_b, t.len_b)):
        if b"".join([of[k] for row in ids for k in row]) != whole:
            return None
        flat_ids = np.fromiter(chain.from_iterable(ids), np.int64)
        at = np.cumsum(sizes[flat_ids])
        stop = np.searchsorted(at, ends)
        if not np.array_equal(at[stop], ends):
            return None
        out += [flat_ids, np.diff(stop + 1, prepend=0)]
    return tuple(out)


def align(units: list[str], t: SimpleNamespace) -> list[tuple | None]:
    """``n_a, n_b, groups, text of the groups, A ids of mapped links, pairs of the other links`` of each
    text (ids as int32, pairs as int64 bytes); None where it has no tokens."""
    alone = [bool(u) and " " not in u and not u[0].isspace() and not u[-1].isspace() for u in units] if t.by_words else [False] * len(units)
    words, others = ([u for u, x in zip(units, alone) if x is want] for want in (True, False))
    done = {True: iter(align_ids(encode_words(words, t) or encode(words, t), t) if words else ()),
            False: iter(align_ids(encode(others, t), t) if others else ())}
    return [next(done[x]) for x in alone]


def align_ids(encoded: tuple[np.ndarray, ...], t: SimpleNamespace) -> list[tuple | None]:
    """As :func:`align`, from the ids.  The texts are cut as one sequence: their ends are cuts of both tokenizers."""
    a, n_a, b, n_b = encoded
    n = len(n_a)
    end_a, end_b = np.cumsum(t.len_a[a]), np.cumsum(t.len_b[b])
    unit_a = np.repeat(np.arange(n), n_a)
    # every stretch between neighbouring cuts is the overlap of one pair of occurrences: a link
    cut = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # two sorted runs
    cut = cut[np.diff(cut, prepend=0) > 0]
    ia, ib = np.searchsorted(end_a, cut), np.searchsorted(end_b, cut)
    shared = (end_a[ia] == cut) & (end_b[ib] == cut)
    unit, ends = unit_a[ia], cut[shared]
    n_groups = np.bincount(unit[shared], minlength=n).tolist()
    # the groups' text: of each group its A ids, then its B ids
    group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    codes = np.concatenate([2 * a + (ends[group_a] == end_a), 2 * len(t.of_a) + 2 * b + (ends[group_b] == end_b)])
    written = t.separators[codes[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")]].tolist()
    # links by A id where the ids map to one another, else by pair
    xa, xb = a[ia], b[ib]
    mapped = t.same[xa] == xb
    own, pair = xa[mapped].astype("<i4").tobytes(), (xa * len(t.of_b) + xb)[~mapped].astype("<i8").tobytes()
    at_own, at_pair = (np.searchsorted(unit[chosen], np.arange(n + 1)).tolist() for chosen in (mapped, ~mapped))
    out, at = [], 0
    for i, (x, y) in enumerate(zip(n_a.tolist(), n_b.tolist())):
        out.append((x, y, n_groups[i], b"".join(written[at:at + x + y])[:-1], own[4 * at_own[i]:4 * at_own[i + 1]],
                    pair[8 * at_pair[i]:8 * at_pair[i + 1]]) if x else None)
        at += x + y
    return out


class Aligner:
    """``texts -> records`` as :func:`align` has them, by the words of a text.

    At a single space both tokenizers begin anew (see ``pretokens``; no piece of B goes on over a space), so a text
    is the sequence of its words, and words met lately are remembered.  Texts in which spaces follow one another
    or stand in longer white space, or that hold U+2581, are aligned whole."""

    def __init__(self, t: SimpleNamespace, remembered: int = REMEMBERED):
        self.t, self.recent = t, Recent(lambda units: align(units, t), remembered)

    def units(self, text: str) -> list[str]:
        words = text.split(" ")
        return words if self.t.by_words and "" not in words and "▁" not in text and not AMBIGUOUS.search(text) else [text]

    def __call__(self, texts: list[str]) -> list[list[tuple | None]]:
        return self.recent([self.units(x) for x in texts])


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker and pair of files."""
    return Aligner(tokenizers_of(path_a, path_b))


def counted(rows: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each row and how often it has them: where each row's begin, values, counts."""
    values = np.frombuffer(b"".join(rows), kind).astype(np.int64)
    size = int(values.max()) + 1 if len(values) else 1
    row = np.repeat(np.arange(len(rows)), [len(r) // int(kind[-1]) for r in rows])
    keys, counts = np.unique(row * size + values, return_counts=True)
    return np.searchsorted(keys, np.arange(len(rows) + 1) * size).astype(np.int32), keys % size, counts


def digest(texts: list[bytes], align_units: Aligner) -> dict[str, pa.Array]:
    """The columns of ``_DOCS`` behind the id."""
    figures, sha, own, pair = [], [], [], []
    for x, units in zip(texts, align_units([x.decode("utf-8", "replace") for x in texts])):
        if not x or None in units:
            figures.append((0, 0, 0))
            sha.append("")
            own.append(b"")
            pair.append(b"")
        else:
            n_a, n_b, n_groups, groups, mapped, odd = zip(*units)
            figures.append((sum(n_a), sum(n_b), sum(n_groups)))
            sha.append(hashlib.sha256(b";".join(groups)).hexdigest())
            own.append(b"".join(mapped))
            pair.append(b"".join(odd))
    n_a, n_b, n_groups = (pa.array(c, pa.int64()) for c in zip(*figures))
    at_own, own_id, own_n = counted(own, "<i4")
    at_pair, pair_id, pair_n = counted(pair, "<i8")
    lists = pa.ListArray.from_arrays
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups,
            "n_links": pa.array([len(x) // 4 + len(y) // 8 for x, y in zip(own, pair)], pa.int64()), "groups_sha256": pa.array(sha, pa.string()),
            "own": lists(at_own, pa.array(own_id, pa.int32())), "own_n": lists(at_own, pa.array(own_n, pa.int32())),
            "pair": lists(at_pair, pa.array(pair_id, pa.int64())), "pair_n": lists(at_pair, pa.array(pair_n, pa.int32()))}


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values and, for each, its row."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):  # no rows
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return (lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())))


def align_tokenizers(df: DataFrame, vocabulary: str, model: str, id_col: str = "doc_id", text_col: str = "text",
                     chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) for the byte-level BPE file A and the sentencepiece model B.

    documents: ``doc_id, n_a, n_b, n_groups, n_links, n_best`` (links whose count is the highest of
    their A id), ``count_sum`` (counts of all links) and ``groups_sha256`` (of ``a1,a2|b1;a3|b2``).
    pairs: ``a_id, b_id, docs, best`` for every linked id pair of the corpus: the alignment itself."""
    spark = df.sparkSession
    held = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def encode(batches):
        align_units, chunk, size = aligner(vocabulary, model), TaskContext.get().partitionId() << 32, 0
        for b in blocks(batches):
            texts = text_bytes(b.column(1))
            columns = digest(texts, align_units)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk] * len(texts), pa.int64()), "doc_id": b.column(0), **columns})
            size += sum(map(len, texts))
            if size >= chunk_bytes:
                chunk, size = chunk + 1, 0
    docs = freeze(held.mapInArrow(encode, _DOCS), "aligned")
    t = tokenizers_of(vocabulary, model)
    size_a, size_b, same = len(t.of_a), len(t.of_b), t.same

    def vectors(batches):
        """The task's vector: in how many documents each A id is linked to the B id of its bytes."""
        total = np.zeros(size_a, np.int64)
        for b in batches:
            total += np.bincount(flat(b.column(0))[0], minlength=size_a)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"a": pa.array(ids, pa.int32()), "docs": pa.array(total[ids], pa.int64())})
    own = docs.select("own").mapInArrow(vectors, "a int, docs bigint").groupBy("a").agg(F.sum("docs").alias("docs")).toArrow()
    counts = np.zeros(size_a, np.int64)
    counts[own["a"].to_numpy()] = own["docs"].to_numpy()

    def asked(batches):
        """Distinct pairs of each chunk and the number of its documents that hold them."""
        for b in batches:
            pair, row = flat(b.column(1))
            chunk, index = np.unique(b.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
            order = np.lexsort((pair, index[row]))
            pair, index = pair[order], index[row][order]
            first = np.flatnonzero(np.diff(pair, prepend=-1) | np.diff(index, prepend=-1))
            yield pa.RecordBatch.from_pydict({"pair": pa.array(pair[first], pa.int64()), "chunk": pa.array(chunk[index[first]], pa.int64()),
                                              "docs": pa.array(np.diff(first, append=len(pair)), pa.int64())})
    by_chunk = docs.select("chunk", "pair").mapInArrow(asked, "pair bigint, chunk bigint, docs bigint")
    pair_counts = freeze(by_chunk.groupBy("pair").agg(F.sum("docs").alias("docs")), "pairs")
    a_id = F.floor(F.col("pair") / size_b).cast("int")
    highest = pair_counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("docs")).toArrow()
    best = counts.copy()
    ids = highest["a"].to_numpy()
    best[ids] = np.maximum(best[ids], highest["docs"].to_numpy())

    def add_up(docs_of, wanted):
        pairs, first = np.unique(wanted["pair"].to_numpy(), return_index=True)
        known = wanted["docs"].to_numpy()[first]
        rows = docs_of.num_rows
        n_best, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        a, row = flat(docs_of["own"])
        p, prow = flat(docs_of["pair"])
        for row, n, count, top in ((row, flat(docs_of["own_n"])[0], counts[a], best[a]),
                                   (prow, flat(docs_of["pair_n"])[0], known[np.searchsorted(pairs, p)], best[p // size_b])):
            at = np.searchsorted(row, np.arange(rows + 1))
            for out, values in ((n_best, n * (count == top)), (total, n * count)):
                sums = np.concatenate([[0], np.cumsum(values)])
                out += sums[at[1:]] - sums[at[:-1]]
        kept = {c: docs_of[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table({**kept, "n_best": pa.array(n_best), "count_sum": pa.array(total), "groups_sha256": docs_of["groups_sha256"]})
    wanted = by_chunk.select("chunk", "pair").join(pair_counts, "pair")
    documents = docs.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(add_up, SCHEMA)
    mapped = spark.createDataFrame(pa.table({"a_id": pa.array(np.flatnonzero(counts), pa.int32()),
                                             "b_id": pa.array(same[counts > 0], pa.int32()), "docs": pa.array(counts[counts > 0], pa.int64())}))
    tops = spark.createDataFrame(pa.table({"a_id": pa.array(np.flatnonzero(best), pa.int32()), "top": pa.array(best[best > 0], pa.int64())}))
    irregular = pair_counts.select(a_id.alias("a_id"), (F.col("pair") % size_b).cast("int").alias("b_id"), "docs")
    pairs = mapped.unionByName(irregular).join(tops, "a_id").select("a_id", "b_id", "docs", (F.col("docs") == F.col("top")).alias("best"))
    return documents, pairs
