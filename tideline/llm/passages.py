"""What both searches for repeated passages share: words of texts and slices of them coded; and the sampled places of the exact search.

Words are lower-case runs between white space.  Places are words of a document counted from 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.kernels import minimiser_positions, window_hashes, word_hashes
from tideline.llm.rows import Columns, identified, map_columns

SEED = 5  # words hashed together
WINDOW = 24  # of every so many neighbouring seeds the smallest hash is taken
MARGIN = 64  # words around a match that are looked at to extend it
LEAST = 50  # words of a passage


def words_of(text: str) -> np.ndarray:
    return word_hashes(text.lower().encode("utf-8", "surrogatepass"))


def sampled(docs: DataFrame, extents: list[int]) -> DataFrame:
    """(doc_id, pos, k0, k1, ...): the places chosen by content, with hashes of as many of the following words as
    `extents` says (the first extent also chooses the places).  A hash that the text is too short for is
    one of the place alone, so it equals no other.  Rows without doc_id are left out.

    Two texts share a chosen place where they share WINDOW neighbouring hashes, no fewer: enough for long equal runs, not for
    passages with edits."""

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        for b in batches:
            places = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                words = words_of(text)
                at = minimiser_positions(window_hashes(words, extents[0]), WINDOW)
                if len(at):
                    places.append((np.full(len(at), doc_id), at, [_keys(words, at, n, doc_id) for n in extents]))
            if places:
                out = {name: np.concatenate([p[i] for p in places]) for i, name in enumerate(("doc_id", "pos"))}
                for i in range(len(extents)):
                    out[f"k{i}"] = np.concatenate([p[2][i] for p in places]).view(np.int64)
                yield out

    keys = ", ".join(f"k{i} long" for i in range(len(extents)))
    return map_columns(identified(docs).where("doc_id IS NOT NULL"), kernel, f"doc_id long, pos int, {keys}")


def _keys(words: np.ndarray, at: np.ndarray, n: int, doc_id: int) -> np.ndarray:
    whole = window_hashes(words, n)
    alone = window_hashes(np.column_stack([np.full(len(at), doc_id), at]).astype(np.uint64).ravel(), 2)[::2]
    return np.where(at < len(whole), whole[np.minimum(at, len(whole) - 1)], alone) if len(whole) else alone


def coded(docs: DataFrame) -> DataFrame:
    """(doc_id, codes, n): 16 bits of each word's hash, one after the other."""

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        for b in batches:
            codes = [(words_of(t) >> np.uint64(48)).astype("<u2").tobytes() for t in b["text"]]
            yield {"doc_id": b["doc_id"], "codes": codes, "n": [len(c) // 2 for c in codes]}

    return map_columns(identified(docs).where("doc_id IS NOT NULL"), kernel, "doc_id long, codes binary, n int")


def slice_of(codes: Column, first: Column, last: Column) -> Column:
    """Words `first` to `last`, both included, of coded words; `first` is not negative."""
    return F.substring(codes, 2 * first + 1, 2 * (last - first + 1))


def with_slices(matches: DataFrame, words: DataFrame) -> DataFrame:
    """Matches (a_doc, a_first, a_last, b_doc, b_first, b_last, ...) with the words of both sides, as `coded` gives them, from
    MARGIN words before to MARGIN words after: `a_words` from `a_from` on, `b_words` from `b_from` on."""
    for side in "ba":
        start = F.greatest(F.col(f"{side}_first") - MARGIN, F.lit(0))
        one = words.select(F.col("doc_id").alias(f"{side}_doc"), F.col("codes").alias("__codes"))
        matches = matches.join(one, f"{side}_doc").withColumn(f"{side}_from", start)
        matches = matches.withColumn(f"{side}_words", slice_of(F.col("__codes"), start, F.col(f"{side}_last") + MARGIN)).drop("__codes")
    return matches


def codes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u2")
