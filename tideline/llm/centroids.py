"""Exact k-means over integer vectors, with ns-bounds on the distances that need no look.

For every vector and centroid the squared distance is stored as it was when the pair was last
evaluated, with the round of that evaluation.  The centroids of all rounds are kept.  By the triangle
inequality a stored distance can since have changed by no more than the norm of the centroid's whole
displacement from that round to this one: one norm of the sum, which is at most the sum of the norms
of the single steps and stays small for a centroid that went and came back.  Pairs whose loosened lower
bound exceeds the loosened upper bound of the vector's own centroid cannot win or tie; the others are
evaluated again, in exact integers.

The driver sees centroids and sums over clusters, never vectors.  Every round is written before it is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tideline.frames import small_frame
from tideline.llm.rows import stored

K, ROUNDS, WIDTH, SCALE = 16, 3, 64, 64
LIMIT = 2**27  # components below it have squared distances that fit a long at any width up to 64
SLACK = 1e-9  # relative; far above the rounding error of the square roots
ROWS = 4096  # of a batch inside a kernel

STATE = "vec_id long, x array<int>, cluster int, squared array<long>, epoch array<byte>"
OUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


@dataclass(frozen=True)
class History:
    """Centroids of rounds 0, 1, ...: arrays (k, width) of integers."""

    rounds: tuple[np.ndarray, ...]

    @property
    def last(self) -> np.ndarray:
        return self.rounds[-1]

    def displacements(self) -> np.ndarray:
        """(round, centroid): the norm of the displacement from that round to the last one."""
        last = self.last.astype(float)
        return np.array([np.sqrt(((last - c.astype(float)) ** 2).sum(axis=1)) for c in self.rounds])


def scaled(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): vectors of `width` finite components, each as the integer floor(scale * component).

    Left out: NULL vectors, other widths, a component that is NULL, NaN or infinite, and one of
    2^27 or more after scaling, whose squared distances would not fit a long.
    """
    x = F.col("embedding")
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("int"))
    usable = (F.size(x) == width) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * F.lit(float(scale))) < LIMIT)
    )
    # One expression decides and converts, so that no order of evaluation converts an unusable one.
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.coalesce(usable, F.lit(False)), whole).alias("x"))
    return kept.where("x IS NOT NULL")


def first_centroids(kept: DataFrame, k: int = K, seed: int = 1) -> np.ndarray:
    """The `k` vectors with the smallest sha256 of `seed:vec_id`; ties go to the smaller vector, NULL ids come last."""
    named = kept.select(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("vec_id").cast("string")), 256).alias("h"), "vec_id", "x")
    rows = named.orderBy(F.col("vec_id").isNull(), "h", "x").limit(k).collect()
    return np.array([r.x for r in rows], dtype=np.int64)


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype).reshape(len(column), -1)


def _lists(a: np.ndarray, type_: pa.DataType) -> pa.Array:
    offsets = pa.array(np.arange(0, a.size + 1, a.shape[1], dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(a.reshape(-1), type=type_.value_type)).cast(type_)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for start in range(0, b.num_rows, ROWS):
            yield b.slice(start, ROWS)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of `x` to one centroid."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def nearest(x: np.ndarray, cluster: np.ndarray, squared: np.ndarray, epoch: np.ndarray, history: History) -> int:
    """Bring cluster, squared and epoch (in place) up to the last centroids; the number of pairs evaluated.

    A cluster of -1 stands for a vector never evaluated.  Afterwards `cluster` is the exact
    nearest centroid, the smaller number among equal distances.
    """
    now, k = len(history.rounds) - 1, len(history.last)
    moved = history.displacements()
    every, own = np.arange(k), np.arange(len(x))
    evaluated = 0
    new = cluster < 0
    for j in every:
        if new.any():
            squared[new, j] = _distances(x[new], history.last[j])
            epoch[new, j] = now
            evaluated += int(new.sum())
    cluster[new] = 0
    root = np.sqrt(squared.astype(float))
    shift = moved[epoch, every]
    lower = (root - shift) * (1 - SLACK) - SLACK * (1 + root + shift)

    def upper() -> np.ndarray:
        r = np.sqrt(squared[own, cluster].astype(float))
        return (r + moved[epoch[own, cluster], cluster]) * (1 + SLACK) + SLACK

    # First the bound of the own centroid is made exact where it decides nothing, then the pairs still open.
    def open_pairs() -> np.ndarray:
        pairs = lower <= upper()[:, None]
        pairs[own, cluster] = False
        return pairs & (epoch != now)

    stale = open_pairs().any(axis=1) & (epoch[own, cluster] != now)
    for j in every:
        rows = np.flatnonzero(stale & (cluster == j))
        if len(rows):
            squared[rows, j], epoch[rows, j] = _distances(x[rows], history.last[j]), now
            evaluated += len(rows)
    still = open_pairs()
    for j in every:
        rows = np.flatnonzero(still[:, j])
        if len(rows):
            squared[rows, j], epoch[rows, j] = _distances(x[rows], history.last[j]), now
            evaluated += len(rows)
    # What was not evaluated in this round cannot win; of the rest the least distance, the first number.
    best = np.where(epoch == now, squared, np.iinfo(np.int64).max)
    fresh = (epoch == now).any(axis=1) & (still.any(axis=1) | stale | new)
    cluster[fresh] = np.argmin(best[fresh], axis=1)
    return evaluated


def _assign(rows: DataFrame, history: History, exact: bool = False) -> DataFrame:
    """The state of every vector after the assignment to the last centroids; with `exact` the stored
    distance of its own centroid is that to the last one also where no bound asked for it."""
    struct = StructType.fromDDL(STATE)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(struct)
        k = len(history.last)
        for b in _batches(batches):
            x = _matrix(b.column("x"), np.int64)
            if "cluster" in b.schema.names:
                cluster = b.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
                squared, epoch = _matrix(b.column("squared"), np.int64), _matrix(b.column("epoch"), np.int64)
            else:
                cluster = np.full(len(x), -1)
                squared, epoch = np.zeros((len(x), k), dtype=np.int64), np.zeros((len(x), k), dtype=np.int64)
            nearest(x, cluster, squared, epoch, history)
            if exact:
                squared[np.arange(len(x)), cluster] = _distances(x, history.last[cluster])
            columns = [
                b.column("vec_id"),
                b.column("x"),
                pa.array(cluster.astype(np.int32)),
                _lists(squared, schema.field("squared").type),
                _lists(epoch.astype(np.int8), schema.field("epoch").type),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return rows.mapInArrow(kernel, struct)


def _sums(state: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number and componentwise sum of the vectors of each cluster, added up in the tasks first."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for b in _batches(batches):
            x, cluster = _matrix(b.column("x"), np.int64), b.column("cluster").to_numpy()
            for j in np.unique(cluster).tolist():
                rows = x[cluster == j]
                part = rows.sum(axis=0).tolist()
                counts[j] = counts.get(j, 0) + len(rows)
                sums[j] = [a + p for a, p in zip(sums[j], part)] if j in sums else part
        yield pa.RecordBatch.from_pylist(
            [{"cluster": j, "n": counts[j], "place": p, "total": v} for j in sums for p, v in enumerate(sums[j])], schema=schema
        )

    ddl = "cluster int, n long, place int, total long"
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    parts = state.select("x", "cluster").mapInArrow(kernel, ddl)
    whole = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found: dict[int, tuple[int, dict[int, int]]] = {}
    for r in whole.collect():  # k * width rows
        found.setdefault(r.cluster, (r.n, {}))[1][r.place] = int(r.total)
    return {j: (n, [by[p] for p in sorted(by)]) for j, (n, by) in found.items()}


def moved_centroids(centroids: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """floor(sum / count) for clusters that hold vectors; empty ones stay where they are."""
    new = centroids.copy()
    for j, (n, total) in sums.items():
        new[j] = [t // n for t in total]
    return new


def centroid_sha256(c: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest()


def cluster_vectors(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = 1) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per kept vector.

    `scaled` says which rows are kept; of fewer than `k` each is a centroid.  Repeated rows count each,
    a NULL vec_id stays NULL.  Equal distances go to the smaller number, an empty cluster keeps its
    centroid, no kept rows give no rows.  Other columns are not read.
    """
    kept = stored(scaled(vectors, width, scale), "vectors")
    start = first_centroids(kept, k, seed)
    if not len(start):
        return small_frame(vectors.sparkSession, [], OUT)
    history, state = History((start,)), kept
    for i in range(rounds):
        state = stored(_assign(state, history), f"assignment-{i}")
        history = History((*history.rounds, moved_centroids(history.last, _sums(state))))
    state = stored(_assign(state, history, exact=True), "assignment")
    found = state.select("vec_id", "cluster", F.get("squared", F.col("cluster")).alias("distance"))
    inertia = {r.cluster: int(r.i) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("i")).collect()}
    facts = [(j, i, sum(inertia.values()), centroid_sha256(history.last[j])) for j, i in sorted(inertia.items())]
    per_cluster = small_frame(vectors.sparkSession, facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(per_cluster), "cluster").select(*StructType.fromDDL(OUT).names)  # at most k rows
