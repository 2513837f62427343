"""Operator 7: repeated passages by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``threshold`` bytes, by most-significant-digit
passes; groups that are still equal after the last digit are exactly the repeated
windows.  The first digit deals the suffixes out over the cluster, and so that a group
needn't hold every suffix of the corpus, it is not the first byte but the window's
*anchor*: of the ``ANCHOR``-byte strings inside the window the one with the least hash
(the leftmost of equals).  Equal windows have equal anchors at equal places, so nothing
is lost; neighbouring windows mostly share one, so they travel together.

1. Documents are written once as chunks (compressed batches of some MB) to the
   checkpoint folder.
2. Each chunk sends the hashes of its distinct anchors, and how many distinct stretches
   lie around each, to the hash's bucket; a bucket answers which of them occur in more
   than one document (by hash: a superset), and which are *crowded*: their stretches have
   more than ``PART_WINDOWS`` windows.
3. Each chunk sends the stretches of text around those anchors, each distinct stretch
   once with its least and largest document id.  The bucket sorts them by 8-byte digits,
   dropping groups of one after every digit: first whole stretches, then the windows of
   distinct stretches.  It answers with the least document id of every window.  Stretches
   around a crowded anchor are sent as single windows, each distinct one once, to
   buckets of their own by a hash of the whole window.
4. Each chunk removes the windows whose least id is below the document's own.

A window inside a passage that stands in a third of all documents reaches its bucket once
for each chunk, not for each document.  Windows that straddle the passage's start or end
hold bytes of the document too: they differ from document to document, though their
anchor lies inside the passage.  They crowd it, so the second hash deals them out.  A task
holds one chunk, or one bucket; the number of buckets grows with the text, that of the
second kind with the windows sent to them.  Of rows whose ids are equal neither counts as
the smaller."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ledgerline.llm.text import text_bytes
from ledgerline.session import freeze

#: Bytes of a repeated window, bytes of an anchor.
THRESHOLD, ANCHOR = 50, 24
#: Bytes of text in a chunk (a longer document is a chunk of its own) and for each bucket.
CHUNK_BYTES, BUCKET_BYTES = 4 * 1024 * 1024, 12 * 1024 * 1024
#: Windows that a bucket sorts at once; most windows around one anchor that stay together.
PART_WINDOWS = 500_000
#: Bytes of text whose anchors are looked for at once.
BLOCK_BYTES = 512 * 1024
NO_ID = np.iinfo(np.int64).max  # rows without an id come last
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
LOW32 = np.uint64(0xFFFFFFFF)


def eight_bytes(data: bytes) -> np.ndarray:
    """The 8 bytes from each position on, as one number (zeros behind the end)."""
    n = len(data)
    padded = data + bytes(16)
    out = np.empty(n + 8 - n % 8, np.uint64)
    for k in range(8):
        out[k::8] = np.frombuffer(padded, "<u8", len(out) // 8, k)
    return out[:n]


class Anchored:
    """The stretches of consecutive windows with one anchor in some documents.

    ``first``, ``last``: a stretch's first and last window start; ``hash``: its anchor's
    hash; ``doc``: number of its document.  Documents are gone through in blocks of about
    ``BLOCK_BYTES``, which bounds the working memory."""

    def __init__(self, texts: list[bytes], threshold: int = THRESHOLD, anchor: int = ANCHOR):
        self.data = b"".join(texts)
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + BLOCK_BYTES, "right")) - 1)
            low, high = int(self.starts[at]), int(self.starts[end])
            if high - low >= threshold:
                first, last, h = stretches(self.data[low:high], self.starts[at:end + 1] - low, threshold, anchor)
                found.append((first + low, last + low, h))
            at = end
        self.first, self.last, self.hash = (np.concatenate(c) for c in zip(*found))
        self.doc = np.searchsorted(self.starts, self.first, "right") - 1


def stretches(data: bytes, starts: np.ndarray, threshold: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, hash of the anchor) of each stretch of a block of
    documents, of which ``starts`` holds the starts and the last one's end."""
    n, w = len(data), threshold - anchor + 1
    eight = eight_bytes(data)
    h = np.zeros(n - anchor + 1, np.uint64)
    for i, at in enumerate(range(0, anchor, 8)):  # digits of 8 bytes; the last may overlap its neighbour
        d = min(at, anchor - 8)
        h ^= h >> np.uint64(31)
        h *= MIX[i % 4]
        h += eight[d:d + len(h)] * MIX[(i + 1) % 4]
    h ^= h >> np.uint64(32)
    h *= MIX[3]
    h ^= h >> np.uint64(29)
    least = (h & ~LOW32) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span * 2 <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < w:
        least = np.minimum(least[:span - w], least[w - span:])
    place = (least & LOW32).astype(np.int64)  # the anchor of each window
    valid = np.ones(n - threshold + 1, bool)
    for e in starts[1:].tolist():  # windows that would cross the end of a document
        valid[max(0, e - threshold + 1):e] = False
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    closes = valid.copy()
    closes[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    first = np.flatnonzero(begins)
    chosen = h[place[first]]
    # least hashes are small ones; mixed again (one to one) they fill all buckets alike
    chosen *= MIX[1]
    chosen ^= chosen >> np.uint64(32)
    chosen *= MIX[2]
    chosen ^= chosen >> np.uint64(32)
    return first, np.flatnonzero(closes), chosen


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the upper half of the hash; it rises with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def equal_groups(eight: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """For each position of ``at`` the index of one among those with the same ``depth``
    bytes: digit by digit (``eight``: the digit at each position), without the groups of one."""
    out = np.arange(len(at))
    if len(at) < 2:
        return out
    active, group = out, np.zeros(len(at), np.int32)
    for off in [*range(0, depth - 8, 8), depth - 8]:
        digit = eight[at[active] + off]
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
        number = np.cumsum(new) - 1
        keep = np.bincount(number)[number] > 1
        active, group = active[order[keep]], number[keep].astype(np.int32)
        if not len(active):
            return out
    begins = np.concatenate([[True], group[1:] != group[:-1]])
    out[active] = active[begins][np.cumsum(begins) - 1]
    return out


def window_hashes(eight: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Hash of the ``depth`` bytes at each position of ``at``."""
    h = np.zeros(len(at), np.uint64)
    for i, off in enumerate([*range(0, depth - 8, 8), depth - 8]):
        h ^= h >> np.uint64(31)
        h *= MIX[i % 4]
        h += eight[at + off] * MIX[(i + 1) % 4]
    for i in (3, 1):
        h ^= h >> np.uint64(32)
        h *= MIX[i]
    return h ^ h >> np.uint64(32)


def least_by_group(groups: np.ndarray, values: np.ndarray) -> np.ndarray:
    least = np.full(len(groups), NO_ID)
    np.minimum.at(least, groups, values)
    return least[groups]


# ---- chunks ---------------------------------------------------------------------------------

def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def make_chunks(df: DataFrame, text_col: str, chunk_bytes: int) -> DataFrame:
    """``chunk, size, rows``: the rows of ``df`` in compressed batches."""
    text_at = df.columns.index(text_col)

    def task(batches):
        chunk = TaskContext.get().partitionId() << 32
        for b in batches:
            sizes = [len(t) for t in text_bytes(b.column(text_at))]
            at = 0
            while at < len(sizes):
                end, size = at, 0
                while end < len(sizes) and (end == at or size + sizes[end] <= chunk_bytes):
                    size += sizes[end]
                    end += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([size], pa.int64()), pa.array([_pack(b.slice(at, end - at))], pa.binary())],
                    ["chunk", "size", "rows"])
                chunk, at = chunk + 1, end
    return df.mapInArrow(task, "chunk bigint, size bigint, rows binary")


def one_by_one(b: pa.RecordBatch):
    """The rows of a batch, turned into Python values one at a time."""
    for i in range(b.num_rows):
        yield [c[i].as_py() for c in b.columns]


class Chunk:
    def __init__(self, rows: bytes, id_at: int, text_at: int, threshold: int, anchor: int):
        self.batch = _unpack(rows)
        self.ids = np.array([NO_ID if i is None else i for i in self.batch.column(id_at).cast(pa.int64()).to_pylist()], np.int64)
        self.texts = text_bytes(self.batch.column(text_at))
        self.found = Anchored(self.texts, threshold, anchor)


def _extremes(order: np.ndarray, key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each run of equal sorted keys, least id, largest id)."""
    k = key[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    i = ids[order]
    return starts, np.minimum.reduceat(i, starts), np.maximum.reduceat(i, starts)


def anchor_hashes(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashes in order, whether more than one document of the chunk has it)."""
    h = chunk.found.hash
    if not len(h):
        return h, np.zeros(0, bool)
    order = np.argsort(h, kind="stable")
    starts, low, high = _extremes(order, h, chunk.ids[chunk.found.doc])
    return h[order][starts], low != high


def stretch_counts(chunk: Chunk, hashes: np.ndarray, threshold: int) -> np.ndarray:
    """How many distinct stretches of the chunk have each of its anchor hashes."""
    found = chunk.found
    of = np.searchsorted(hashes, found.hash)
    counts = np.bincount(of, minlength=len(hashes))
    runs = np.flatnonzero(counts[of] > 1)
    distinct: dict[bytes, int] = {}
    for h, s, e in zip(of[runs].tolist(), found.first[runs].tolist(), (found.last[runs] + threshold).tolist()):
        distinct[found.data[s:e]] = h  # a stretch determines its anchor
    several = np.bincount(np.fromiter(distinct.values(), np.int64, len(distinct)), minlength=len(hashes))
    return np.where(counts > 1, several, counts)


def _low40(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from40(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8")


def _by_bucket(buckets: np.ndarray):
    """(bucket, start, end) of each run of equal buckets."""
    if len(buckets):
        cuts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1], [True]]))
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield int(buckets[s]), s, e


def shared_in_bucket(table: pa.Table, most: int) -> pa.Table:
    """Per chunk, which of its hashes occur in another chunk too or in two of its documents; which
    of those have more than ``most`` stretches in all chunks (no bytes, if none), and how many the
    chunk has of these."""
    codec = pa.Codec("zstd")
    data = [_from40(x) for x in table["hashes"].to_pylist()]
    many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(d)).astype(bool) for x, d in zip(table["many"].to_pylist(), data)]
    h, flags = np.concatenate(data), np.concatenate(many)
    count = np.concatenate([np.frombuffer(codec.decompress(x, 4 * len(d)), "<u4") for x, d in zip(table["counts"].to_pylist(), data)])
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    found = flags.copy()
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    number = np.concatenate([[0], np.cumsum(~same)])
    full = np.bincount(number, count[order]) > most
    crowded = np.zeros(len(h), bool)
    crowded[order[full[number]]] = True
    crowded &= found
    cuts = np.cumsum([len(d) for d in data])[:-1]
    masks, dense = np.split(found, cuts), np.split(crowded, cuts)
    sums = [int(c[m].sum()) for c, m in zip(np.split(count, cuts), dense)]
    some = [i for i, m in enumerate(masks) if m.any()]
    return pa.table({"chunk": table["chunk"].take(pa.array(some, pa.int64())), "bucket": table["bucket"].take(pa.array(some, pa.int64())),
                     "mask": pa.array([np.packbits(masks[i]).tobytes() for i in some], pa.binary()),
                     "crowded": pa.array([np.packbits(dense[i]).tobytes() if dense[i].any() else b"" for i in some], pa.binary()),
                     "stretches": pa.array([sums[i] for i in some], pa.int64())},
                    schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("mask", pa.binary()), ("crowded", pa.binary()),
                                      ("stretches", pa.int64())]))


class Stretches:
    """The distinct stretches of a chunk around shared anchors, those around crowded ones as
    single windows, in an order that depends on the chunk and its masks alone.

    ``first``, ``last``, ``doc``: as in ``Anchored``, of each run (each place of a stretch);
    ``of_run``: number of its stretch; ``start``, ``size``: a place and the bytes of a stretch."""

    def __init__(self, chunk: Chunk, masks: dict[int, tuple[bytes, bytes]], buckets: int, window_buckets: int, threshold: int):
        found = chunk.found
        hashes, _ = anchor_hashes(chunk)
        shared, crowded = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
        for b, s, e in _by_bucket(bucket_of(hashes, buckets)):
            for to, mask in zip((shared, crowded), masks.get(b, ())):
                if mask:
                    to[s:e] = np.unpackbits(np.frombuffer(mask, np.uint8), count=e - s).astype(bool)
        of = np.searchsorted(hashes, found.hash)
        runs = np.flatnonzero((shared & ~crowded)[of])
        known: dict[bytes, int] = {}
        data = found.data
        number = np.array([known.setdefault(data[s:e], len(known)) for s, e in
                           zip(found.first[runs].tolist(), (found.last[runs] + threshold).tolist())], np.int64)
        first, last, h = found.first[runs], found.last[runs], found.hash[runs]
        self.bucket = bucket_of(h, buckets)
        runs = np.flatnonzero(crowded[of])
        if len(runs):  # equal windows of the chunk are one; they are told apart by digits
            n = found.last[runs] - found.first[runs] + 1
            at = np.repeat(found.first[runs] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            eight = eight_bytes(data)
            _, own = np.unique(equal_groups(eight, at, threshold), return_inverse=True)
            hash_ = window_hashes(eight, at, threshold)
            number = np.concatenate([number, len(known) + own])
            first, last, h = np.concatenate([first, at]), np.concatenate([last, at]), np.concatenate([h, hash_])
            self.bucket = np.concatenate([self.bucket, buckets + bucket_of(hash_, window_buckets)])
        self.first, self.last, self.of_run = first, last, number
        self.doc = np.searchsorted(found.starts, first, "right") - 1
        if not len(number):
            self.low = self.high = self.start = self.size = np.zeros(0, np.int64)
            self.part = np.zeros(0, np.uint8)
            return
        order = np.argsort(number, kind="stable")
        starts, self.low, self.high = _extremes(order, number, chunk.ids[self.doc])
        one = order[starts]
        self.start, self.size = first[one], last[one] + threshold - first[one]
        self.bucket, self.part = self.bucket[one], h[one].astype(np.uint8)

    def by_bucket(self):
        """(bucket, numbers of its stretches)."""
        order = np.argsort(self.bucket, kind="stable")
        for b, s, e in _by_bucket(self.bucket[order]):
            yield b, order[s:e]


def windows_of(texts: list[bytes], low: np.ndarray, high: np.ndarray, threshold: int) -> tuple[np.ndarray, ...]:
    """(stretch, first and last window, least id) of the windows of some stretches whose least
    id is below the stretch's largest."""
    size = np.array([len(t) for t in texts], np.int64)
    at = np.cumsum(size) - size
    eight = eight_bytes(b"".join(texts))
    # whole stretches first: equal ones are one from here on
    same = np.arange(len(size))
    for n in np.unique(size):
        of = np.flatnonzero(size == n)
        same[of] = of[equal_groups(eight, at[of], int(n))]
    least = np.full(len(size), NO_ID)
    np.minimum.at(least, same, low)
    distinct = np.flatnonzero(same == np.arange(len(size)))
    # their windows
    count = size[distinct] - threshold + 1
    begin = np.cumsum(count) - count
    of_window = np.repeat(np.arange(len(distinct)), count)
    place = np.arange(len(of_window)) - begin[of_window]
    groups = equal_groups(eight, at[distinct][of_window] + place, threshold)
    lowest = least_by_group(groups, least[distinct][of_window])
    del eight, groups, place, of_window
    # the answer to each stretch, in runs of windows with one least id
    slot = np.zeros(len(size), np.int64)
    slot[distinct] = np.arange(len(distinct))
    n = size - threshold + 1
    rec = np.repeat(np.arange(len(size)), n)
    offset = np.arange(len(rec)) - (np.cumsum(n) - n)[rec]
    value = lowest[begin[slot[same]][rec] + offset]
    need = value < high[rec]
    edge = np.concatenate([[True], (rec[1:] != rec[:-1]) | (value[1:] != value[:-1]) | (need[1:] != need[:-1])])
    first = np.flatnonzero(edge)
    last = np.concatenate([first[1:], [len(rec)]]) - 1
    first, last = first[need[first]], last[need[first]]
    return rec[first], offset[first], offset[last], value[first]


def windows_in_bucket(table: pa.Table, threshold: int) -> pa.Table:
    """The answer to each chunk's stretches.  Equal windows have equal anchors and so equal
    ``part``: parts are gone through in turn, about ``PART_WINDOWS`` windows at once."""
    codec = pa.Codec("zstd")
    sizes = [np.frombuffer(x, "<u2").astype(np.int64) for x in table["sizes"].to_pylist()]
    texts: list[bytes] = []
    for x, s in zip(table["texts"].to_pylist(), sizes):
        data, ends = codec.decompress(x, int(s.sum())).to_pybytes(), np.cumsum(s)
        texts += [data[a:b] for a, b in zip((ends - s).tolist(), ends.tolist())]
    low, high = (np.concatenate([np.frombuffer(x, "<i8") for x in table[c].to_pylist()]) for c in ("low", "high"))
    part = np.concatenate([np.frombuffer(x, np.uint8) for x in table["parts"].to_pylist()]).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), [len(s) for s in sizes])
    local = np.concatenate([np.arange(len(s)) for s in sizes])
    windows = sum(int((s - threshold + 1).sum()) for s in sizes)
    turns = min(256, -(-windows // PART_WINDOWS))
    turn = part * turns >> 8
    found = []
    for i in range(turns):
        of = np.flatnonzero(turn == i)
        if len(of):
            rec, first, last, least = windows_of([texts[j] for j in of.tolist()], low[of], high[of], threshold)
            found.append((of[rec], first, last, least))
    rec, first, last, least = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(owner[rec], kind="stable")
    rec, first, last, least = rec[order], first[order], last[order], least[order]
    out: dict = {"chunk": [], "bucket": [], "answer": []}
    chunks, bucket = table["chunk"].to_pylist(), table["bucket"][0].as_py()
    for o, s, e in _by_bucket(owner[rec]):
        answer = np.empty(e - s, ANSWER)
        answer["stretch"], answer["first"], answer["last"], answer["least"] = local[rec[s:e]], first[s:e], last[s:e], least[s:e]
        out["chunk"].append(chunks[o])
        out["bucket"].append(bucket)
        out["answer"].append(answer.tobytes())
    return pa.table(out, schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("answer", pa.binary())]))


ANSWER = np.dtype([("stretch", "<u4"), ("first", "<u2"), ("last", "<u2"), ("least", "<i8")])


def covered(chunk: Chunk, stretches: Stretches, answers: dict[int, bytes], threshold: int) -> np.ndarray:
    """Whether each byte of the chunk goes."""
    found = chunk.found
    change = np.zeros(len(found.data) + 1, np.int64)
    order = np.argsort(stretches.of_run, kind="stable")
    runs_from = np.searchsorted(stretches.of_run[order], np.arange(len(stretches.start) + 1))
    for b, members in stretches.by_bucket():
        if b not in answers:
            continue
        a = np.frombuffer(answers[b], ANSWER)
        stretch = members[a["stretch"].astype(np.int64)]
        n = runs_from[stretch + 1] - runs_from[stretch]
        k = np.repeat(np.arange(len(a)), n)
        run = order[runs_from[stretch][k] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        goes = chunk.ids[stretches.doc[run]] > a["least"][k]
        run, k = run[goes], k[goes]
        np.add.at(change, stretches.first[run] + a["first"][k], 1)
        np.add.at(change, stretches.first[run] + a["last"][k] + threshold, -1)
    return np.cumsum(change[:-1]) > 0


def _dedup(df: DataFrame, id_col: str, text_col: str, threshold: int, chunk_bytes: int, bucket_bytes: int,
           part_windows: int, schema: StructType, finish) -> DataFrame:
    """Steps 1 to 4; ``finish(chunk, gone)`` makes the batch that a chunk returns."""
    if threshold < 16:
        raise ValueError("windows shorter than 16 bytes are not supported")
    anchor = max(8, min(ANCHOR, threshold - 8))
    id_at, text_at = df.columns.index(id_col), df.columns.index(text_col)
    chunks = freeze(make_chunks(df, text_col, chunk_bytes), "chunks")
    total = chunks.agg(F.sum("size")).first()[0] or 0
    buckets = max(64, -(-total // bucket_bytes))
    most_windows = threshold - anchor + 1  # of a stretch

    def opened(rows):
        return Chunk(rows, id_at, text_at, threshold, anchor)

    def send_hashes(batches):
        codec = pa.Codec("zstd")
        for b in batches:
            for chunk, rows in one_by_one(b):
                c = opened(rows)
                hashes, many = anchor_hashes(c)
                counts = stretch_counts(c, hashes, threshold).astype("<u4")
                out = [(k, chunk, _low40(hashes[s:e]), np.packbits(many[s:e]).tobytes(), codec.compress(counts[s:e].tobytes(), asbytes=True))
                       for k, s, e in _by_bucket(bucket_of(hashes, buckets))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.int64(), *[pa.binary()] * 3))],
                    ["bucket", "chunk", "hashes", "many", "counts"])
    masks = freeze(chunks.select("chunk", "rows")
                   .mapInArrow(send_hashes, "bucket int, chunk bigint, hashes binary, many binary, counts binary")
                   .groupBy("bucket").applyInArrow(lambda t: shared_in_bucket(t, part_windows // most_windows),
                                                   "chunk bigint, bucket int, mask binary, crowded binary, stretches bigint"), "masks")
    crowd = masks.agg(F.sum("stretches")).first()[0] or 0
    window_buckets = max(1, -(-crowd * most_windows * threshold // bucket_bytes))
    # an answer holds at most what its chunk sent, so these lists are as bounded as the chunk
    by_chunk = masks.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "mask", "crowded")).alias("masks"))

    def stretches_of(chunk, entries):
        masks = {x["bucket"]: (x["mask"], x["crowded"]) for x in entries or ()}
        return Stretches(chunk, masks, buckets, window_buckets, threshold)

    def send_stretches(batches):
        codec = pa.Codec("zstd")
        for b in batches:
            for chunk, rows, entries in one_by_one(b):
                c = opened(rows)
                s, data = stretches_of(c, entries), c.found.data
                out = []
                for k, members in s.by_bucket():
                    texts = [data[i:i + n] for i, n in zip(s.start[members].tolist(), s.size[members].tolist())]
                    out.append((k, chunk, s.size[members].astype("<u2").tobytes(), codec.compress(b"".join(texts), asbytes=True),
                                s.low[members].astype("<i8").tobytes(), s.high[members].astype("<i8").tobytes(),
                                s.part[members].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.int64(), *[pa.binary()] * 5))],
                    ["bucket", "chunk", "sizes", "texts", "low", "high", "parts"])
    answers = freeze(chunks.select("chunk", "rows").join(by_chunk, "chunk")
                     .mapInArrow(send_stretches, "bucket int, chunk bigint, sizes binary, texts binary, low binary, high binary, parts binary")
                     .groupBy("bucket").applyInArrow(lambda t: windows_in_bucket(t, threshold), "chunk bigint, bucket int, answer binary"),
                     "answers")
    to_chunk = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))

    def remove(batches):
        for b in batches:
            for rows, entries, said in one_by_one(b):
                chunk = opened(rows)
                gone = (covered(chunk, stretches_of(chunk, entries), {x["bucket"]: x["answer"] for x in said}, threshold)
                        if said else np.zeros(len(chunk.found.data), bool))
                yield finish(chunk, gone)
    return (chunks.select("chunk", "rows").join(by_chunk.join(to_chunk, "chunk"), "chunk", "left")
            .select("rows", "masks", "answers").mapInArrow(remove, schema))


def spans_of(gone: np.ndarray) -> np.ndarray:
    """Start of each maximal run."""
    return np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1]]))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
                   chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, part_windows: int = PART_WINDOWS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row.

    Each byte goes that is covered by a ``threshold``-byte string which also starts in a
    row with a smaller id; all strings are judged on the input.  ``kept`` holds the other
    bytes in order (they may break a character; it is binary).  NULL texts are empty,
    NULL ids come after all others, and rows of one id do not remove from each other."""
    pair = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = StructType([StructField(c, LongType()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")] + [StructField("kept", BinaryType())])

    def finish(chunk, gone):
        data = np.frombuffer(chunk.found.data, np.uint8)
        columns: list = [[], [], [], []]
        for s, e in zip(chunk.found.starts[:-1].tolist(), chunk.found.starts[1:].tolist()):
            g = gone[s:e]
            for c, x in zip(columns, (e - s, int(g.sum()), len(spans_of(g)), data[s:e][~g].tobytes())):
                c.append(x)
        return pa.RecordBatch.from_arrays(
            [chunk.batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return _dedup(pair, "doc_id", "text", threshold, chunk_bytes, bucket_bytes, part_windows, schema, finish)


def cut_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
                threshold: int = THRESHOLD, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES,
                part_windows: int = PART_WINDOWS) -> DataFrame:
    """``df``, its columns unchanged, with repeated passages cut out of the texts.

    Parts of a character that a cut leaves behind go with it.  Rows of which nothing is
    left go whole; rows that were empty before, and rows without repeats, stay as they are.
    ``length_col``, if it exists, follows the new text."""
    names = df.columns
    text_at, length_at = names.index(text_col), names.index(length_col) if length_col in names else None

    def finish(chunk, gone):
        b, data = chunk.batch, np.frombuffer(chunk.found.data, np.uint8)
        texts, keep, changed = b.column(text_at).cast(pa.binary()).to_pylist(), [], []
        for i, (s, e) in enumerate(zip(chunk.found.starts[:-1].tolist(), chunk.found.starts[1:].tolist())):
            g = gone[s:e]
            if g.any():
                texts[i] = data[s:e][~g].tobytes().decode(errors="ignore").encode()
                changed.append(i)
            keep.append(not g.any() or bool(texts[i].strip()))
        columns = list(b.columns)
        columns[text_at] = pa.array(texts, pa.binary()).cast(b.schema.field(text_at).type)
        if length_at is not None:
            lengths = b.column(length_at).to_pylist()
            for i in changed:
                lengths[i] = len(texts[i].decode())
            columns[length_at] = pa.array(lengths, b.schema.field(length_at).type)
        return pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))
    return _dedup(df, id_col, text_col, threshold, chunk_bytes, bucket_bytes, part_windows, df.schema, finish)
