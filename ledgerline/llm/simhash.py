"""Operator 5: SimHash near-duplicates with deletion-variant signatures.

A fingerprint is cut into so few segments that of two fingerprints within the
distance limit ``d`` one segment differs by at most one bit (``d // 2 + 1``
segments).  Each segment is indexed as it is and once for each bit with that bit
left out.  Equal entries are joined on (segment, left-out bit, other bits) and
the pairs verified by their full distance.  A pair that differs in the left-out
bit meets there, once, because the two sides carry that bit's value; a pair with
equal segments meets in the entry without a gap.

Copies first collapse to one row per fingerprint, so they make no pairs.  Entries
shared by more than ``bucket`` fingerprints aren't joined pairwise: their members
go through an exact path without pairs, in which every fingerprint joins the star
of each value within distance 1 of it (``d`` = 2: members of a star are within 2 of
each other, and any two within 2 share one), or for other ``d`` through a join on
several segments at once.  No link is lost either way."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline.llm.components import components
from ledgerline.llm.text import free_name, map_texts, slices, space_words, text_bytes
from ledgerline.session import freeze

#: Words in a shingle and most differing bits of linked fingerprints.
SHINGLE, DISTANCE = 3, 2
#: Fingerprints of one index entry that are still joined pairwise.
BUCKET = 64
SEED = 42


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, as a signed long; 0 for a text without words."""
    w = space_words(data)
    if not w:
        return 0
    h = xxhash.xxh64_intdigest
    if len(w) <= shingle:
        hashes = [h(b" ".join(w), SEED)]
    else:
        hashes = [h(s, SEED) for s in map(b" ".join, zip(*(w[i:] for i in range(shingle))))]
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):  # long texts in parts
        part = np.array(hashes[i:i + 65536], ">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes)).view(">i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` of every row; NULL and empty texts have fingerprint 0."""
    def rows(ids, texts):
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([fingerprint(t, shingle) for t in texts], pa.int64())], ["doc_id", "fp"])
    return map_texts(df, id_col, text_col, "doc_id bigint, fp bigint", rows)


def _bounds(parts: int, bits: int = 64) -> list[tuple[int, int]]:
    """(lowest bit, width) of each part."""
    cuts = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _flips(width: int) -> list[tuple[int, int]]:
    """(bit, its mask as a signed long)."""
    return [(i, (1 << i) - (1 << 64) * (i == 63)) for i in range(width)]


def _entries(first: int, segment, width: int) -> F.Column:
    """One entry for each left-out bit of a segment."""
    bits = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).cast("bigint").alias("m")) for i, m in _flips(width)])
    return F.transform(bits, lambda b: F.struct(
        (F.lit(first) + b.i).alias("entry"), segment.bitwiseAND(F.bitwise_not(b.m)).alias("rest"),
        (segment.bitwiseAND(b.m) != 0).alias("side")))


def _signatures(fps: DataFrame, distance: int) -> DataFrame:
    """``entry, rest, side, fp``: the index entries of each fingerprint.  ``entry`` is
    the segment and left-out bit (64 for none), ``rest`` the segment's other bits."""
    found = []
    for s, (low, width) in enumerate(_bounds(distance // 2 + 1)):
        segment = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1).cast("bigint"))
        found += [_entries(s * 65, segment, width), F.array(F.struct(
            F.lit(s * 65 + 64).alias("entry"), segment.alias("rest"), F.lit(None).cast("boolean").alias("side")))]
    return fps.select("fp", F.explode(F.concat(*found)).alias("e")).select("e.entry", "e.rest", "e.side", "fp")


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints ``fp`` whose components are those of
    all pairs at ``distance`` or fewer bits: all such pairs outside crowded entries,
    stars inside them."""
    # fingerprints are narrow and few tasks hold them; every one makes 66 entries, so they are spread behind the
    # table: a scan packs small files into few tasks again
    spread = freeze(fps, "distinct").repartition(_tasks(fps), "fp")
    entries = _signatures(spread, distance)
    # counted with map-side partial sums: an entry that a third of all fingerprints share is one row a task
    sizes = (entries.groupBy("entry", "rest").agg(F.count("*").alias("n"), F.count_if("side").alias("sides"), F.first("side").alias("any"))
             .filter("n > 1 and (any is null or sides between 1 and n - 1)").select("entry", "rest", "n"))
    index = freeze(entries.join(sizes, ["entry", "rest"]).select("entry", "rest", "side", "fp", "n"), "signatures")
    near = index.filter(F.col("n") <= bucket)
    gap = near.filter("side is not null")
    a = lambda d: d.select("entry", "rest", F.col("fp").alias("u"))
    b = lambda d: d.select("entry", "rest", F.col("fp").alias("v"))
    whole = near.filter("side is null")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    on = ["entry", "rest"]
    pairs = a(gap.filter("side")).join(b(gap.filter("not side")), on).filter(close).select("u", "v").union(
        a(whole).join(b(whole), on).filter(F.col("u") < F.col("v")).filter(close).select("u", "v"))
    crowded = index.filter(F.col("n") > bucket).select("fp").distinct()
    return pairs.union(_crowded_links(freeze(crowded, "crowded"), distance))


def _tasks(fps: DataFrame) -> int:
    """Tasks that the entries are made in: as many as the session's shuffles have, which
    grow with the input (``session.cluster_conf``)."""
    return int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _crowded_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links between fingerprints of crowded entries, without pairs inside a group."""
    if distance == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    if distance in (1, 2):
        # distance 2: stars around every value within 1; distance 1: stars of the two ends of a flipped bit
        flips = F.array(*[F.lit(m).cast("bigint") for _, m in _flips(64)])
        if distance == 2:
            star = F.explode(F.array_append(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m)), F.col("fp")))
            stars = fps.select("fp", star.alias("star"))
        else:
            star = F.explode(F.transform(flips, lambda m: F.struct(m.alias("m"), F.col("fp").bitwiseAND(F.bitwise_not(m)).alias("star"))))
            stars = fps.select("fp", star.alias("s")).select("fp", F.struct("s.m", "s.star").alias("star"))
        hubs = stars.groupBy("star").agg(F.min("fp").alias("v"), F.max("fp").alias("most")).filter("v < most")
        return stars.join(hubs, "star").filter("fp <> v").select(F.col("fp").alias("u"), "v").distinct()
    # more bits: of distance + 2 segments two are equal in any linked pair, which leaves small groups
    cuts = _bounds(distance + 2)
    part = [F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << w) - 1).cast("bigint")) for low, w in cuts]
    keys = reduce(lambda x, y: x + y, [[F.struct(F.lit(i * 64 + j).alias("k"), part[i].alias("x"), part[j].alias("y"))
                                        for j in range(i)] for i in range(len(cuts))])
    sig = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    return (sig.select("key", F.col("fp").alias("u")).join(sig.select("key", F.col("fp").alias("v")), "key")
            .filter("u < v").filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance).select("u", "v").distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, fp, root, component_id`` of every row.

    ``fp`` is the fingerprint as a signed long, ``component_id`` the smallest id that
    can be reached over links, its own included (NULL if all of them are NULL), ``root``
    a fingerprint that names the component.  Texts without words share fingerprint 0
    and are linked to one another like any others."""
    docs = freeze(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    return docs.join(classes(docs, distance, bucket), "fp").select("doc_id", "fp", "root", "component_id")


def classes(docs: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``fp, root, component_id`` of every distinct fingerprint of ``docs`` (``doc_id, fp``)."""
    fps = docs.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(fps.select("fp"), distance, bucket))
    joined = fps.join(roots, fps.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return freeze(joined.join(smallest, "root").select("fp", "root", "component_id"), "classes")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``df``, its columns unchanged, with one row of each component: that of the
    smallest id (NULL ids come last; of rows with that id the smallest text hash
    stays, and of identical rows one)."""
    names = df.columns
    text_at = names.index(text_col)
    fp, tie, row = (free_name(names, c) for c in ("__llm_fp", "__llm_tie", "__llm_row"))

    def add(batches):
        for b in slices(batches):
            texts = text_bytes(b.column(text_at))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([fingerprint(t, shingle) for t in texts], pa.int64()),
                 pa.array([xxhash.xxh64_intdigest(t) >> 1 for t in texts], pa.int64())], [*names, fp, tie])
    schema = StructType([*df.schema.fields, StructField(fp, LongType()), StructField(tie, LongType())])
    marked = freeze(df.mapInArrow(add, schema), "marked")
    docs = marked.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(fp).alias("fp"))
    of = classes(docs, distance, bucket).select("fp", "root")
    # the row that stays: an aggregate, so no component is gathered in one task
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(tie).alias("tie"))
    first = marked.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("o"))
    stays = (first.join(of, "fp").groupBy("root").agg(F.min(F.struct("o", "fp")).alias("w"))
             .select(F.struct(F.col("w.fp").alias("fp"), F.col("w.o").alias("o")).alias("__llm_stays")))
    mine = F.struct(F.col(fp).alias("fp"), order.alias("o"))
    left = marked.withColumn(row, mine)
    kept = left.join(stays.withColumnRenamed("__llm_stays", free_name([*left.columns], "__llm_stays")).alias("s"),
                     F.col(row).eqNullSafe(F.col("s." + free_name([*left.columns], "__llm_stays"))), "left_semi")
    # identical rows (same id and text) are still all there
    return (kept.withColumn(row, F.row_number().over(Window.partitionBy(fp, id_col, tie).orderBy(fp))).filter(F.col(row) == 1).select(*names))
