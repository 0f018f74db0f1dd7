"""Benchmark passages in documents: SimHash over item-sized windows, multi-index Hamming blocks, exact check.

An item of n words is compared with every window of n neighbouring words of a document (a shorter document is
one window).  Both are multisets of five-word shingles.  Their SimHash fingerprints of 64 bits are at
most `RADIUS` bits apart for similar ones; with the bits in 8 blocks of 8, fingerprints within that
radius agree in some block up to one bit, so the index lists each item under the 9 values near each of
its blocks, and a window looks up its own 8.  Pairs within the radius are verified by the exact
weighted Jaccard similarity of the shingle multisets.

Only windows that hold at least one shingle of some item are fingerprinted: any other has similarity 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.kernels import NOT_WORD, mix, window_hashes, word_hashes
from tideline.llm.rows import Columns, identified, map_columns, unpacked, with_value

SHINGLE, SIMILARITY = 5, 0.8
BLOCKS, RADIUS = 8, 15  # at most RADIUS bits in 8 blocks: some block has at most one
BLOCK_OF_ITEMS = 20_000  # benchmark items matched in one pass over the documents
FILTER_BITS = 22


def shingles(text: str, size: int = SHINGLE) -> tuple[np.ndarray, int]:
    """Hashes of a text's shingles in order (fewer words: one of them all; none: none), and its words."""
    words = word_hashes(text.lower().encode("utf-8", "surrogatepass"), NOT_WORD)
    return window_hashes(words, min(size, len(words)) or 1), len(words)


def fingerprint(hashes: np.ndarray) -> int:
    """SimHash: a bit is 1 if set in over half the shingles, repeats included."""
    bits = np.unpackbits(mix(hashes).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes)).view(">u8")[0])


@dataclass
class ItemIndex:
    """A block of benchmark items: ids, shingle multisets, fingerprints and the Hamming index."""

    ids: list[int]
    counts: list[Counter]
    prints: np.ndarray
    by_words: dict[int, dict[tuple[int, int], list[int]]]  # words of the item: (block, value): items
    known: np.ndarray = field(repr=False)  # bits of a filter over all shingles
    sizes: dict[int, list[int]] = field(repr=False, default_factory=dict)  # shingle: words of items that hold it


def index_items(items: list[tuple[int, str]]) -> ItemIndex:
    """Items without a word are left out: nothing is similar to them."""
    ids, counts, prints, by_words = [], [], [], {}
    known = np.zeros(1 << FILTER_BITS, dtype=bool)
    sizes: dict[int, set[int]] = {}
    for item_id, text in items:
        hashes, n = shingles(text or "")
        if n == 0:
            continue
        i = len(ids)
        ids.append(item_id)
        counts.append(Counter(hashes.tolist()))
        prints.append(fingerprint(hashes))
        known[hashes >> np.uint64(64 - FILTER_BITS)] = True
        for h in counts[-1]:
            sizes.setdefault(h, set()).add(n)
        table = by_words.setdefault(n, {})
        for block in range(BLOCKS):
            value = (prints[-1] >> (8 * block)) & 255
            for near in (value, *[value ^ (1 << bit) for bit in range(8)]):
                table.setdefault((block, near), []).append(i)
    return ItemIndex(ids, counts, np.array(prints, dtype=np.uint64), by_words, known, {h: sorted(s) for h, s in sizes.items()})


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: the sum of smaller counts over the sum of larger ones."""
    common = sum(min(n, b[k]) for k, n in a.items() if k in b)
    return common / (a.total() + b.total() - common)


def find_items(text: str, index: ItemIndex, least: float = SIMILARITY) -> list[tuple[int, float, int, int, int]]:
    """(item_id, similarity, distance, first word, words) of the best window for each item found."""
    hashes, n_words = shingles(text)
    if not n_words:
        return []
    at = np.flatnonzero(index.known[hashes >> np.uint64(64 - FILTER_BITS)])
    starts: dict[int, set[int]] = {}
    for p in at.tolist():
        for n in index.sizes.get(int(hashes[p]), ()):
            # Windows of n words that hold the shingle at p.
            last = max(0, n_words - n)
            starts.setdefault(n, set()).update(range(max(0, min(p + min(SHINGLE, n) - n, last)), min(p, last) + 1))
    found: dict[int, tuple] = {}
    for n, windows in starts.items():
        table = index.by_words[n]
        for s in sorted(windows):
            window = hashes[s : s + max(1, n - SHINGLE + 1)] if n_words >= SHINGLE else hashes
            print_ = fingerprint(window)
            near = {i for block in range(BLOCKS) for i in table.get((block, (print_ >> (8 * block)) & 255), ())}
            held = None
            for i in near:
                distance = (print_ ^ int(index.prints[i])).bit_count()
                if distance > RADIUS:
                    continue
                held = held or Counter(window.tolist())
                alike = similarity(held, index.counts[i])
                if alike >= least and (i not in found or (-alike, s) < (-found[i][0], found[i][2])):
                    found[i] = (alike, distance, s, min(n, n_words))
    return [(index.ids[i], *rest) for i, rest in sorted(found.items())]


OUT = "doc_id long, item_id long, similarity double, distance int, start_word int, n_words int"


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, distance, start_word, n_words) for each document that holds an item.

    The benchmark is a stated query set: its items are matched in blocks of BLOCK_OF_ITEMS, each in one
    pass over all documents.  Words are lower-case runs without punctuation.  An item of fewer than
    five words matches a document of just these words.  NULL texts are empty and match nothing; rows
    are matched each for itself, so repeated rows give repeated results; no items give no rows.
    """
    spark = docs.sparkSession
    result = spark.createDataFrame([], OUT)
    for shared in _indexes(spark, benchmark):

        def kernel(batches: Iterator[Columns], shared=shared) -> Iterator[dict]:
            names = ("item_id", "similarity", "distance", "start_word", "n_words")
            for b in batches:
                hits = [(doc_id, *hit) for doc_id, text in zip(b["doc_id"], b["text"]) for hit in find_items(text, shared.value, least)]
                if hits:
                    yield dict(zip(("doc_id", *names), zip(*hits)))

        result = result.union(map_columns(identified(docs), kernel, OUT))
    return result


def without_items(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns.

    Each row is judged by its own text, so rows without id, or of one id, do not decide about each other.
    """
    for shared in _indexes(docs.sparkSession, benchmark):

        def hit(texts: list[str], shared=shared) -> list[bool]:
            return [bool(find_items(t, shared.value, least)) for t in texts]

        judged = with_value(docs, hit, "boolean").where(~F.col("value"))
        docs = judged.select(*unpacked(judged, docs.columns))
    return docs


def _indexes(spark: SparkSession, benchmark: DataFrame) -> Iterator[Broadcast]:
    """The items in blocks of BLOCK_OF_ITEMS, each as a broadcast index."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id").toLocalIterator()
    items = ((r["item_id"], r["text"]) for r in rows)
    while block := list(islice(items, BLOCK_OF_ITEMS)):
        yield spark.sparkContext.broadcast(index_items(block))
