"""Line dedup: maximal repeated runs of lines, from the longest-common-prefix intervals of all line suffixes.

Prefix doubling: suffixes of the documents' line sequences are put into classes by their first 1, 2, 4, ...
lines.  The class at depth 2^(k+1) is the pair of the classes of depth 2^k at a place and 2^k lines on; a suffix
alone in its class is finished.  A class with several members is an interval of the suffix array whose longest
common prefix is at least 2^k lines.  Its inner intervals, of every length between 2^k and 2^(k+1), are found by
falling powers: members that share the next 2^(k-1), ..., 2, 1 lines stay together and grow, the others part.
Each inner class takes part by its first place only, so a place is refined at the depth where it first
differs from all places before it.

The result is, for every place, the longest run that begins there and at an earlier place too.  Which intervals
there are does not depend on how line IDs are ordered, so 128-bit hashes stand for ranks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tideline.llm.rows import Columns, free_name, identified, map_columns, packed, stored, unpacked

LEAST_WORDS = 4  # of a repeated run of lines; shorter ones stay
_PLACE = ["doc_id", "row", "line"]


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row, line, a, b, words): b tells rows of one doc_id apart, (a, b) are 128 bits of the line."""

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = defaultdict(list)
            for doc_id, row, text in zip(batch["doc_id"], batch["row"], batch["text"]):
                lines = text.split("\n")
                out["doc_id"] += [doc_id] * len(lines)
                out["row"] += [row] * len(lines)
                out["line"] += range(len(lines))
                out["content"] += lines
                out["words"] += [len(x.split()) for x in lines]
            yield out

    split = map_columns(docs, kernel, "doc_id long, row long, line int, content string, words int")
    return split.select("doc_id", "row", "line", F.xxhash64("content").alias("a"), F.xxhash64(F.lit(1), F.reverse("content")).alias("b"), "words")


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows are told apart by doc_id and a hash of their text; rows equal in both are one document."""
    return identified(docs).select("doc_id", F.xxhash64("text").alias("row"), "text")


def _firsts(frame: DataFrame) -> DataFrame:
    """(a, b, first): the classes with several members.

    Stored, so that a very common line is a skewed join of two inputs, which Spark splits."""
    classes = frame.groupBy("a", "b").agg(F.min(F.struct(*_PLACE)).alias("first"), F.count("*").alias("n"))
    return stored(classes.where("n > 1").drop("n"), "line-firsts")


def _doubled(level: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """For each depth 2^k: the places in classes of several members, and those that stand for a part of their class
    that goes on differently: the first place of each class of depth 2^(k+1), and places in none."""
    later = F.struct(*_PLACE) != F.col("first")
    shared = stored(level.join(_firsts(level), ["a", "b"]).withColumn("later", later).drop("first"), "line-classes")
    levels, parts, length = [], [], 1
    while not shared.isEmpty():
        levels.append(shared)
        ahead = Window.partitionBy("doc_id", "row").orderBy("line").rangeBetween(length, length)
        pairs = shared.select(
            *_PLACE,
            F.struct("a", "b", "words", "later").alias("own"),
            F.xxhash64("a", F.first("a").over(ahead)).alias("a"),
            F.xxhash64(F.lit(length), "b", F.first("b").over(ahead)).alias("b"),
            (F.col("words") + F.first("words").over(ahead)).alias("words"),
        )
        pairs = stored(pairs, "lines")
        whole = pairs.where("words IS NOT NULL")  # a place too near the end of its runs has no pair
        classed = stored(whole.join(_firsts(whole), ["a", "b"], "left").withColumn("later", later).drop("first"), "line-classes")
        ends = pairs.where("words IS NULL").select(*_PLACE, "own").union(classed.where("later IS NULL OR NOT later").select(*_PLACE, "own"))
        parts.append(ends.select(*_PLACE, "own.*", F.lit(length).alias("lines")))
        shared = classed.where("later IS NOT NULL").drop("own")
        length *= 2
    return levels, parts


def _refined(levels: list[DataFrame], parts: list[DataFrame]) -> DataFrame:
    """(doc_id, row, line, lines, words) of the longest earlier run, by falling powers of two from each depth."""
    begun = [p.withColumn("best", F.when(F.col("later"), F.struct("lines", "words"))).drop("later") for p in parts]
    state = begun[-1]
    for k in reversed(range(len(levels) - 1)):
        on = levels[k].select(F.col("doc_id").alias("of_id"), F.col("row").alias("of_row"), F.col("line").alias("at"), F.struct("a", "b", "words").alias("next"))
        here = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("row") == F.col("of_row")) & (F.col("line") + F.col("lines") == F.col("at"))
        met = state.join(on, here, "left").select(
            *_PLACE, F.struct("a", "b", "lines", "words").alias("own"), "best", F.col("next.words").alias("more"),
            F.when(F.col("next").isNotNull(), F.xxhash64("a", "next.a")).alias("a"),
            F.when(F.col("next").isNotNull(), F.xxhash64(F.lit(-1 - k), "b", "next.b")).alias("b"),
        )
        met = stored(met, "line-parts")
        whole = met.where("more IS NOT NULL")
        joined = whole.join(_firsts(whole), ["a", "b"], "left")
        grown = joined.where("first IS NOT NULL").select(
            *_PLACE, "a", "b", (F.col("own.words") + F.col("more")).alias("words"), (F.col("own.lines") + (1 << k)).alias("lines"), "best", "first"
        )
        best = F.when(F.struct(*_PLACE) != F.col("first"), F.struct("lines", "words")).otherwise(F.col("best"))
        alone = joined.where("first IS NULL").select(*_PLACE, "own", "best").union(met.where("more IS NULL").select(*_PLACE, "own", "best"))
        state = grown.withColumn("best", best).drop("first").unionByName(alone.select(*_PLACE, "own.*", "best"))
        if k:  # depth 1 holds runs of one line, which do not grow
            state = state.unionByName(begun[k])
    whole = state if len(levels) == 1 else state.unionByName(begun[0])
    return whole.where("best IS NOT NULL").select(*_PLACE, "best.*")


def repeated_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, row, line, lines): the maximal runs with at least `least_words` words, beginning at `line`, that
    occur at an earlier place (in the order of doc_id, row, line), which they may overlap.

    Of the runs of one document those within another are left out."""
    lines = stored(_lines(_keyed(docs).dropDuplicates(["doc_id", "row"])), "lines")
    levels, parts = _doubled(lines)
    if not levels:
        return lines.where("false").select(*_PLACE, F.lit(0).alias("lines"))
    runs = _refined(levels, parts).where(F.col("words") >= least_words)
    before = Window.partitionBy("doc_id", "row").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("line") + F.col("lines")
    return runs.withColumn("reached", F.max(end).over(before)).where(F.col("reached").isNull() | (F.col("reached") < end)).select(*_PLACE, "lines")


_COUNTS = ("kept", "n_lines", "n_deleted", "longest_run")


def _judged(docs: DataFrame, least_words: int) -> DataFrame:
    """(whole, kept, n_lines, n_deleted, longest_run), one row per row of `docs`."""
    runs = repeated_runs(docs, least_words).groupBy("doc_id", "row").agg(F.collect_set(F.struct("line", "lines")).alias("runs"))
    runs = runs.select(F.col("doc_id").alias("of_id"), F.col("row").alias("of_row"), "runs")
    own = packed(docs, F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"))
    joined = own.join(runs, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("row") == F.col("of_row")), "left").select("whole", "runs")
    ends = [StructField("kept", StringType()), *[StructField(n, IntegerType()) for n in _COUNTS[1:]]]
    struct = StructType([joined.schema["whole"], *ends])

    def kernel(batches):
        schema = to_arrow_schema(struct)
        for b in batches:
            whole = b.column("whole")
            texts, runs_of = whole.field("text").to_pylist(), b.column("runs").to_pylist()
            made = [without_runs(t or "", [(r["line"], r["lines"]) for r in held or ()]) for t, held in zip(texts, runs_of)]
            columns = [pa.array([m[i] for m in made], type=schema.field(n).type) for i, n in enumerate(_COUNTS)]
            yield pa.RecordBatch.from_arrays([whole.cast(schema.field("whole").type), *columns], schema=schema)

    return joined.mapInArrow(kernel, struct)


def dedupe_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """All columns of `docs`, and `kept` (the text without its later copies), `n_lines`, `n_deleted`,
    `longest_run` (lines of the longest united run deleted), each with `_1`, ... after it where `docs` has that name.

    Lines end at newlines and are compared whole.  A NULL text is an empty one, which is one empty line, and stays.
    A text whose lines are all copies has `kept` empty and `n_deleted` = `n_lines`.  Rows equal in
    doc_id and text are treated alike.
    """
    judged = _judged(docs, least_words)
    return judged.select(*unpacked(judged, docs.columns), *[F.col(n).alias(free_name(docs, n)) for n in _COUNTS])


def without_copies(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The columns of `docs` with later copies of line runs gone from `text`, and `n_chars` made anew where that
    changed it.  Rows of which nothing stays go; rows that had no text stay."""
    judged = _judged(docs, least_words).where("n_deleted < n_lines")
    deleted = F.col("n_deleted") > 0
    changed = {"text": F.when(deleted, F.col("kept")).otherwise(F.col("whole").getField("text"))}
    if "n_chars" in docs.columns:
        counted = F.length("kept").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(deleted, counted).otherwise(F.col("whole").getField("n_chars"))
    return judged.select(*unpacked(judged, docs.columns, changed))


def without_runs(text: str, runs: list[tuple[int, int]]) -> tuple[str, int, int, int]:
    """The text without the lines of its runs, its lines, how many go, and the longest united run."""
    lines = text.split("\n")
    if not runs:
        return text, len(lines), 0, 0
    change = [0] * (len(lines) + 1)
    for start, length in runs:
        change[start] += 1
        change[start + length] -= 1
    kept, longest, covers, run = [], 0, 0, 0
    for line, step in zip(lines, change):
        covers += step
        run = run + 1 if covers else 0
        longest = max(longest, run)
        if not covers:
            kept.append(line)
    return "\n".join(kept), len(lines), len(lines) - len(kept), longest
