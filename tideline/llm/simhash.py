"""SimHash near-duplicates by a positional byte index with count filtering.

The 64 bits of a fingerprint are 8 bytes, each with its position.  Two fingerprints at most `radius` = 2
bits apart differ in at most 2 bytes, so they share at least 6 positional bytes.  With the 8 positions in
four pairs, two whole pairs are among what they share: the postings of the inverted index are
those six combinations of two position pairs (32 bits; postings of single bytes would each hold 1/256
of all fingerprints).  Pairs that meet in a posting are tallied over all 8 positions, kept from
6 shared bytes on, then verified by their differing bits.

A posting above `dense` members would give its square in pairs.  Its members are linked another
exact way: two values are at most 2 bits apart if and only if some third value is at most 1 bit from
both, so every member is posted under its 65 values at most 1 bit away, and members that meet there are
linked to the least of them.  Both ways find the same components; no link is lost to a cap.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.llm.rows import Columns, identified, map_columns, stored, packed, unpacked

SHINGLE, RADIUS, SEED, DENSE = 3, 2, 42, 32
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if set in over half the XXH64 values of the shingles."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths).tolist()
        ends = ends.tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :])]
    values = np.array(hashes, dtype="<u8")
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(values), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row, fp) of every row, `row` a hash of its text; a NULL text is an empty one and has fingerprint 0."""

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        for b in batches:
            yield {"doc_id": b["doc_id"], "row": b["row"], "fp": [simhash(t, shingle) for t in b["text"]]}

    return map_columns(identified(docs).withColumn("row", F.xxhash64("text")), kernel, "doc_id long, row long, fp long")


def _byte(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255))


def shared_bytes(a: Column, b: Column) -> Column:
    return sum(((_byte(a, i) == _byte(b, i)).cast("int") for i in range(8)), F.lit(0))


def links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints `fp`, whose components are those of all links."""
    combos = list(combinations(range(4), 2))

    def piece(fp: Column, pair: int) -> Column:
        return F.shiftrightunsigned(fp, 16 * pair).bitwiseAND(F.lit(0xFFFF))

    keys = F.array(*[F.struct(F.lit(n).alias("combo"), (piece(F.col("fp"), i) * 65536 + piece(F.col("fp"), j)).alias("bytes")) for n, (i, j) in enumerate(combos)])
    postings = fps.select("fp", F.explode(keys).alias("key"))
    sizes = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(postings.join(sizes, "key"), "postings")
    few = met.where(F.col("n") <= dense)
    pairs = few.alias("x").join(few.alias("y"), "key").where("x.fp < y.fp").select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    pairs = pairs.where(shared_bytes(F.col("a"), F.col("b")) >= 8 - RADIUS)
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])
    # At most 65 values lie within one bit of a value, so these sets are small.
    around = met.where(F.col("n") > dense).select("fp").distinct().select("fp", F.explode(near).alias("z"))
    around = around.groupBy("z").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = around.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return pairs.union(stars).distinct()


def grouped(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row, fp, root, component_id) of every row: `root` names its group, `row` is a hash of its text."""
    prints = stored(fingerprints(docs, shingle), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = stored(components(links(distinct.select("fp"))), "simhash-roots")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id = least doc_id reachable over links of at most 2 bits).

    Rows in, rows out: repeated rows are repeated; a NULL doc_id keeps its row and is no component's id
    unless all of them are NULL.  An empty table gives an empty one.
    """
    return grouped(docs, shingle).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document with the least doc_id of each group, all columns; of repeated rows one stays.

    Rows of one doc_id, or without any, that are in different groups are no copies and all stay.
    """
    least = grouped(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = least.groupBy("root", F.col("doc_id").alias("__kept")).agg(F.min("row").alias("__text")).drop("root").distinct()
    own = packed(docs, F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"))
    same = F.col("id").eqNullSafe(F.col("__kept")) & (F.col("row") == F.col("__text"))
    one = own.join(kept, same, "left_semi").dropDuplicates(["id", "row"])
    return one.select(*unpacked(one, docs.columns))
