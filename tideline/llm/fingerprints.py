"""Homomorphic document fingerprints: sums of wide vectors hashed from paragraphs.

A text is the multiset of its paragraphs (its lines).  Each paragraph hashes to a vector of two parts:

- `WIDE` lanes modulo 2^32, pseudo-random in every bit of the paragraph: for equality;
- `SKETCH` lanes modulo 2^16, a signed sum over the paragraph's two-word shingles (a lone word is
  its own): for likeness.

The fingerprint of a text is the lane-wise sum over its paragraphs, each modulo its power of two.  So
the order of paragraphs does not matter, and a paragraph is inserted or deleted by adding or
subtracting its vector (`insert`, `delete`).  Likeness is the cosine of two sketches, cut at 0: the
share of common shingles, with a standard error of about 1 / sqrt(SKETCH).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.kernels import mix, placed_words, window_hashes
from tideline.llm.rows import Columns, identified, map_columns

WIDE, SKETCH, SHINGLE = 64, 512, 2
Vector = tuple[np.ndarray, np.ndarray]


def of_text(text: str) -> Vector:
    """The summed vectors of all paragraphs; an empty text has one empty paragraph."""
    wide = np.zeros(WIDE, dtype=np.uint32)
    data = text.encode("utf-8", "surrogatepass")
    for line in data.split(b"\n"):
        wide += np.frombuffer(hashlib.shake_128(line).digest(4 * WIDE), dtype="<u4")
    words, starts = placed_words(data)
    line_of = np.searchsorted(np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10), starts)
    joined = line_of[1:] == line_of[:-1]
    alone = ~np.append(joined, False) & ~np.append(False, joined) if len(words) else np.zeros(0, dtype=bool)
    features = [window_hashes(words, SHINGLE)[joined], words[alone]]
    h = mix(np.concatenate(features) + np.uint64(1))
    sign = 1.0 - 2.0 * (h >> np.uint64(63)).astype(float)
    sums = np.bincount((h & np.uint64(SKETCH - 1)).astype(np.int64), weights=sign, minlength=SKETCH)
    return wide, sums.astype(np.int64).astype(np.uint16)


def insert(a: Vector, b: Vector) -> Vector:
    return a[0] + b[0], a[1] + b[1]


def delete(a: Vector, b: Vector) -> Vector:
    return a[0] - b[0], a[1] - b[1]


def likeness(a: Vector, b: Vector) -> float:
    """0 to 1.  Equal fingerprints give 1, also empty ones."""
    if np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]):
        return 1.0
    x, y = a[1].view(np.int16).astype(float), b[1].view(np.int16).astype(float)
    size = np.sqrt((x @ x) * (y @ y))
    return float(min(1.0, max(0.0, x @ y / size))) if size else 0.0


def written(v: Vector) -> str:
    return base64.b64encode(v[0].astype("<u4").tobytes() + v[1].astype("<u2").tobytes()).decode()


def read(s: str) -> Vector:
    data = base64.b64decode(s)
    return np.frombuffer(data[: 4 * WIDE], dtype="<u4").copy(), np.frombuffer(data[4 * WIDE :], dtype="<u2").copy()


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


OUT = """doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,
near_edited double, near_next double"""


def fingerprint_edits(docs: DataFrame, rows_per_range: int = 10_000) -> DataFrame:
    """Fingerprint every document, its edit by the next document, and their likeness.

    Documents are ordered by (doc_id, text), NULL ids first, repeated rows each for themselves; after
    the last comes the first.  They are dealt to ranges of ids, with the ids that begin the
    ranges collected (one per `rows_per_range` rows), and the first document of each range is sent
    along with the range before it.  One text shuffle, no window over the whole table.
    """
    docs = identified(docs).withColumn("key", F.coalesce("doc_id", F.lit(-(2**63))))
    n = docs.count()
    if n == 0:
        return docs.sparkSession.createDataFrame([], OUT)
    parts = max(1, -(-n // rows_per_range))
    cuts = sorted(set(docs.stat.approxQuantile("key", [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    cuts = [int(c) for c in cuts]
    # The range of a row: the number of cuts at or below its key.
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    ranged = docs.withColumn("range", _count_at_most(bounds, len(cuts)))
    firsts = {r["range"]: r["first"] for r in ranged.groupBy("range").agg(F.min("key").alias("first")).collect()}
    order = sorted(firsts)
    before = {firsts[r]: order[i - 1] for i, r in enumerate(order)}  # the first range follows the last
    opening = ranged.where(F.col("key").isin(list(before))).groupBy("key").agg(F.min("text").alias("text"))
    previous = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    guests = opening.select(F.lit(None).cast("long").alias("doc_id"), "text", "key", previous[F.col("key")].alias("range"), F.lit(1).alias("guest"))
    dealt = ranged.withColumn("guest", F.lit(0)).select("doc_id", "text", "key", "range", "guest").union(guests)
    dealt = dealt.repartitionByRange(len(order), "range").sortWithinPartitions("range", "guest", "key", "text")
    return map_columns(dealt.select("doc_id", "text", "range", "guest"), _rows, OUT)


def _count_at_most(bounds: Column, n: int) -> Column:
    """How many of the `n` sorted bounds are at or below `key`: binary search by falling steps."""
    if n == 0:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])

    def move(at: Column, step: Column) -> Column:
        return F.when((at + step <= n) & (F.get(bounds, at + step - 1) <= F.col("key")), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), move)


def _rows(batches: Iterator[Columns]) -> Iterator[dict]:
    held = None  # the last document, waiting for its next one
    for b in batches:
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
        for doc_id, text, home, guest in zip(b["doc_id"], b["text"], b["range"], b["guest"]):
            print_ = of_text(text)
            if held and held[3] == home:
                new = edited(held[1], text)
                changed = of_text(new)
                for k, v in zip(out, (held[0], len(held[1]), hashlib.sha256(new.encode()).hexdigest(), written(held[2]), written(changed), likeness(held[2], changed), likeness(held[2], print_))):
                    out[k].append(v)
            held = None if guest else (doc_id, text, print_, home)
        if out["doc_id"]:
            yield out
