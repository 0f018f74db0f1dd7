"""Exact repeated passages by a sparse suffix array.

Only the suffixes that begin at minimisers (places chosen by content) are kept.  They are sorted over the
whole corpus by the hash of their first 24 words, then by document and place, in ranges of the
sorted order; each is compared with its neighbour before it, across the bounds of ranges too.  Suffixes that
agree with a neighbour may lie in a repeated passage.

A run of 50 words holds a kept suffix within its first 24 places, so at least 24 words of the run follow
it, and that suffix agrees with a neighbour in every document with the run.  So the stretches of 50 words that
begin up to 23 words before such suffixes include all that occur more than once.  They are sorted in the
same way by a hash of all their words, and each is linked to the one before it, so no text that
shares less can come between.  Links on one diagonal of a pair of documents are gathered and extended
left and right, word by word, to their full runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.kernels import window_hashes
from tideline.llm.passages import LEAST, WINDOW, coded, codes, sampled, with_slices
from tideline.llm.rows import Columns, map_columns, stored

EXTENTS = [5, 24]  # words: of the minimiser, and that neighbours must agree in


def neighbours(places: DataFrame) -> DataFrame:
    """(a_doc, a_pos, b_doc, b_pos): places (key, doc_id, pos) with the place before them in sorted order, if it has the same key.

    a comes before b: in an earlier document, or earlier in the same one.
    """
    order = ["key", "doc_id", "pos"]
    ranges = places.repartitionByRange(*order).sortWithinPartitions(*order)

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        last, opening = None, None
        for b in batches:
            key, doc, pos = (np.array(b[k]) for k in ("key", "doc_id", "pos"))
            if not len(key):
                continue
            if last is None:
                opening = (int(key[0]), int(doc[0]), int(pos[0]))
            else:  # the row before this batch goes in front
                key, doc, pos = (np.append(np.array([x]), y) for x, y in zip(last, (key, doc, pos)))
            same = np.flatnonzero((key[1:] == key[:-1]) & ((doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])))
            last = (key[-1], doc[-1], pos[-1])
            n = len(same)
            if n:
                yield {"part": [-1] * n, "end": [0] * n, "key": key[same], "a_doc": doc[same], "a_pos": pos[same], "b_doc": doc[same + 1], "b_pos": pos[same + 1]}
        if opening:  # both ends of the range, to be compared with the ranges beside it
            for end, row in ((0, opening), (1, last)):
                yield {"part": [part], "end": [end], "key": [row[0]], "a_doc": [row[1]], "a_pos": [row[2]], "b_doc": [row[1]], "b_pos": [row[2]]}

    found = stored(map_columns(ranges, kernel, "part int, end int, key long, a_doc long, a_pos int, b_doc long, b_pos int"), "suffix-neighbours")
    ends = found.where("part >= 0")  # two rows a range
    before = Window.orderBy("part", "end")
    bounds = ends.select("end", "key", F.lag(F.struct("key", "a_doc", "a_pos")).over(before).alias("p"), "b_doc", "b_pos")
    bounds = bounds.where("end = 0 AND p.key = key AND (p.a_doc <> b_doc OR p.a_pos <> b_pos)")
    columns = ["a_doc", "a_pos", "b_doc", "b_pos"]
    return found.where("part < 0").select(*columns).union(bounds.select("p.a_doc", "p.a_pos", "b_doc", "b_pos"))


def stretches(docs: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """(key, doc_id, pos): of the stretches of `least` words, all that occur more than once and some others."""
    suffixes = stored(sampled(docs, EXTENTS).select(F.col("k1").alias("key"), "doc_id", "pos"), "suffixes")
    agree = neighbours(suffixes)
    both = agree.select(F.col("a_doc").alias("doc_id"), F.col("a_pos").alias("pos")).union(agree.select("b_doc", "b_pos"))
    near = both.groupBy("doc_id").agg(F.collect_set("pos").alias("near"))

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        for c in batches:
            for doc_id, data, near in zip(c["doc_id"], c["codes"], c["near"]):
                keys = window_hashes(codes(data).astype(np.uint64), least).view(np.int64)
                ends = np.array(near) + 1
                counts = np.zeros(len(keys) + 1, dtype=np.int64)  # of the suffixes that a place is near to
                np.add.at(counts, np.minimum(np.maximum(ends - WINDOW, 0), len(keys)), 1)
                np.add.at(counts, np.minimum(ends, len(keys)), -1)
                at = np.flatnonzero(np.cumsum(counts[:-1]))
                if len(at):
                    yield {"key": keys[at], "doc_id": np.full(len(at), doc_id), "pos": at}

    return stored(map_columns(words.join(near, "doc_id").select("doc_id", "codes", "near"), kernel, "key long, doc_id long, pos int"), "stretches")


def equal_runs(x: np.ndarray, y: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, length) of the runs of at least `least` places where two equally long arrays agree."""
    same = np.zeros(len(x) + 2, dtype=np.int8)
    same[1:-1] = x == y
    edges = np.flatnonzero(np.diff(same))
    return [(int(s), int(e - s)) for s, e in zip(edges[0::2], edges[1::2]) if e - s >= least]


OUT = "doc_id long, start_word int, n_words int, match_doc_id long, match_start int"


def repeated_passages(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, start_word, n_words, match_doc_id, match_start): runs of at least `least` equal words that a document shares
    with the document before it among those with a stretch of `least` words, or with an earlier place of its own.

    A passage in n documents gives n - 1 rows for each maximal run, each document linked to the one before it.  A
    run is looked at up to MARGIN words beyond the stretches that found it; what goes on has stretches, and so
    rows, of its own.  NULL and empty texts and rows without doc_id have no passage; a repeated row counts as one
    document.  `least` is at least LEAST, else a run need not hold a suffix.
    """
    words = stored(coded(docs), "coded-words")
    pairs = neighbours(stretches(docs, words, least)).withColumn("shift", F.col("b_pos") - F.col("a_pos"))
    diagonals = pairs.groupBy("a_doc", "b_doc", "shift").agg(F.min("b_pos").alias("b_first"), (F.max("b_pos") + (least - 1)).alias("b_last"))
    diagonals = diagonals.select("a_doc", "b_doc", "b_first", "b_last", (F.col("b_first") - F.col("shift")).alias("a_first"), (F.col("b_last") - F.col("shift")).alias("a_last"))
    diagonals = stored(diagonals, "diagonals")

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        for c in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "start_word", "n_words", "match_doc_id", "match_start")}
            for i in range(len(c["a_doc"])):
                # Both slices, cut to begin at the same place of the diagonal and to the same length.
                before = min(c["a_first"][i] - c["a_from"][i], c["b_first"][i] - c["b_from"][i])
                a, b = c["a_first"][i] - before, c["b_first"][i] - before
                x, y = codes(c["b_words"][i])[b - c["b_from"][i] :], codes(c["a_words"][i])[a - c["a_from"][i] :]
                n = min(len(x), len(y))
                for start, length in equal_runs(x[:n], y[:n], least):
                    for k, v in zip(out, (c["b_doc"][i], b + start, length, c["a_doc"][i], a + start)):
                        out[k].append(v)
            if out["doc_id"]:
                yield out

    return map_columns(with_slices(diagonals, words), kernel, OUT).distinct()
