"""Near duplicates by 64-bit fingerprints and covering locality-sensitive hashing.

A document's fingerprint has bit i where more than half of its word shingles
(repeats included) have it in their hash.  Documents are linked where their
fingerprints differ in at most ``radius`` bits.

Tables: every bit position gets a vector of ``radius + 1`` bits, none of them
zero; table v keeps the positions whose vector has an odd product with v.  The
vectors of any ``radius`` positions span less than the whole space, so some v is
orthogonal to all of them, and two fingerprints that differ in just those
positions agree in everything that table v keeps: no pair within the radius is
missed, whatever the data.  With radius 2 there are 7 tables of 36 or 37 bits.

Only distinct fingerprints are posted, with no documents.  Buckets of at most
``BUCKET`` are compared inside.  A larger one (a swarm of near copies) is never
gathered: its members post themselves under each value that differs in one of
the bits the table leaves free.  Members within 2 bits share such a value, and
all that share one are within 2 bits of each other, so one link from each to the
smallest of them keeps every connection; there are at most 65 of them.  Work is
linear in the bucket.  Radii above 2 would need more than one flip and are refused.

Null, empty and blank texts have fingerprint zero and are linked like any
other.  Repeated rows and ids stay rows; ids that are null are never the
smallest of a component unless all are.  A long text is one array of its words.
An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.expr import apply_sql
from palimpsest.llm.common import WORD
from palimpsest.llm.graph import components
from palimpsest.operators.joins import lookup
from palimpsest.session import materialized

BITS = 64
WORDS, RADIUS = 3, 2
#: Fingerprints of a bucket that are compared directly.
BUCKET = 32
#: Pieces over which a bucket is counted and routed, so that none needs a task of its own.
SALTS = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """XXH64 (seed 42) of every shingle, in order; the whole sequence if it is shorter, nothing without words."""
    found = F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    # get() is null behind the end and concat_ws leaves nulls out: a short text is one shingle
    joined = ", ".join(f"get(w, i + {k})" for k in range(words))
    return apply_sql(found, f"w -> if(size(w) = 0, cast(array() AS array<bigint>), transform(sequence(0, greatest(size(w) - {words}, 0)), "
                            f"i -> xxhash64(concat_ws(' ', {joined}))))")


def majority(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each run of ``values`` (uint64) the bits that are set in more than half of it; 0 for empty runs."""
    out = np.zeros(len(lengths), dtype=np.uint64)
    start = 0
    for i, n in enumerate(lengths):
        # steps of 65,536 hashes: a long text needs no matrix of its own size
        ones = np.zeros(BITS, dtype=np.int64)
        for at in range(start, start + n, 1 << 16):
            part = values[at:min(at + (1 << 16), start + n)]
            ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        start += n
        if n:
            out[i] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``(id, fp)`` of every row; ``fp`` holds the 64 bits as a signed number."""
    hashes = docs.select(F.col(f"`{id_col}`").alias("id"), shingle_hashes(F.col(f"`{text_col}`"), words).alias("hashes"))
    kind = hashes.select("id", F.lit(0).cast("bigint").alias("fp")).schema

    def counted(batches):
        for batch in batches:
            lists = batch.column("hashes")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.record_batch([batch.column("id"), pa.array(majority(values, lengths).view(np.int64))], names=["id", "fp"])

    return hashes.mapInArrow(counted, kind)


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The bits that each of the ``2 ** (radius + 1) - 1`` tables keeps.

    Positions take the non-zero vectors in turn, so the tables keep about
    equally many bits; leaving out the zero vector only avoids bits that no
    table would look at.
    """
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(bits)]
    return [sum(1 << i for i, phi in enumerate(vectors) if (phi & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _long(value: int) -> str:
    """A 64-bit literal; the smallest number cannot be written as one."""
    value = _signed(value)
    return f"({value + 1}L - 1L)" if value == -(1 << 63) else f"({value}L)"


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints ``fp`` that connect all those within ``radius`` bits.

    Every pair of ``a`` and ``b`` is within the radius; not every such pair is
    given, but all are connected through others.
    """
    if not 0 <= radius <= 2:
        raise ValueError("fingerprints are linked within 0, 1 or 2 bits")
    tables = masks(radius)
    posts = fps.select("fp", F.posexplode(F.array(*[F.expr(f"fp & {_long(m)}") for m in tables])).alias("t", "kept"))
    posts = posts.withColumn("salt", F.expr(f"pmod(xxhash64(fp), {SALTS})"))
    # A bucket is at most SALTS rows here, however many members it has.
    counted = posts.groupBy("t", "kept", "salt").agg(F.count(F.lit(1)).alias("some"))
    sizes = counted.groupBy("t", "kept").agg(F.sum("some").alias("n"), F.collect_list("salt").alias("salts")).where("n > 1")
    sizes = sizes.select("t", "kept", "n", F.explode("salts").alias("salt"))
    shared = materialized(posts.join(sizes, ["t", "kept", "salt"]).select("t", "kept", "fp", (F.col("n") > bucket).alias("large")))

    together = shared.where("NOT large").groupBy("t", "kept").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    near = (f"flatten(transform(fps, (x, i) -> transform(filter(slice(fps, i + 2, {bucket}), y -> bit_count(x ^ y) <= {radius}), "
            "y -> named_struct('a', x, 'b', y))))")
    inside = together.select(F.inline(F.expr(near)))

    # One flip of a bit that the table leaves free, or none.
    free = [[i for i in range(BITS) if not m >> i & 1] for m in tables]
    flips = F.element_at(F.array(*[F.array(F.lit(0).cast("bigint"), *[F.expr(_long(1 << i)) for i in bits]) for bits in free]), F.col("t") + 1)
    if radius < 2:
        near_large = _radius_one(shared.where("large"), flips, radius)
    else:
        posted = shared.where("large").select("fp", F.explode(flips).alias("flip")).select("fp", F.expr("fp ^ flip").alias("value"))
        met = posted.groupBy("value").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)      # at most 65 of them
        near_large = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return inside.unionByName(near_large).distinct()


def _radius_one(large: DataFrame, flips: Column, radius: int) -> DataFrame:
    """Members of large buckets at distance 1: each asks for its neighbours; distinct ones are never at distance 0."""
    own = large.select("fp").distinct()
    if radius == 0:
        return own.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    asked = large.select(F.col("fp").alias("a"), F.explode(flips).alias("flip")).select("a", F.expr("a ^ flip").alias("fp"))
    return asked.join(own, "fp").select("a", F.col("fp").alias("b")).where("a < b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    radius: int = RADIUS) -> DataFrame:
    """``(id, fingerprint, component_id, size)`` per row; the component is named by its smallest id, ``size`` counts its rows."""
    rows = materialized(fingerprints(docs, id_col, text_col, words))
    classes = materialized(rows.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")))
    labels = components(links(classes.select("fp"), radius))
    named = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    per_label = named.groupBy("label").agg(F.min("low").alias("component_id"), F.sum("n").alias("size"))
    # Both lookups spread a component or a fingerprint that holds a large part of all rows.
    by_fp = materialized(lookup(named.select("fp", "label"), per_label, "label", ["component_id", "size"]))
    return lookup(rows, by_fp, "fp", ["component_id", "size"]).select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "size")
