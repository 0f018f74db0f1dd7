"""Packing token pieces into sequences: a configuration linear program solved by multiplicative weights.

The lengths form a histogram of at most `capacity` entries.  The program asks for non-negative
amounts of configurations (multisets of lengths that fit a sequence) which cover the histogram with the
smallest sum.  Multiplicative weights on the lengths are its dual prices; the configuration
of the highest price is found by an unbounded knapsack over capacity; the average of those found is an
almost optimal fractional cover.  It is rounded down; what is left is at most one sequence for each
configuration, and goes by best fit, decreasing, beside shares of the sequences opened again.

Only the histogram and the plan (run lengths of configurations) pass the driver: both are bounded by
`capacity` and the number of rounds, whatever the number of pieces.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.rows import Columns, identified, map_columns, stored
from tideline.llm.tokens import in_portions

CAPACITY, ROUNDS = 2048, 150
RANK_BITS = 48  # of a key of length and rank
AT_ONCE = 500  # documents that a task holds as Python texts at a time
OPENED = (1 / 4096, 1 / 256, 1 / 16, 1 / 4, 1.0)  # shares of the sequences opened again while the rest is placed

END = b"\0\0\0\0"

Configuration = tuple[tuple[int, int], ...]  # (length, how often), longest first

def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, part, rank) for all token pieces of all documents.

    Ids are those of the tokenizer, then id 0.  Only a document longer than `capacity` is cut, into pieces of `capacity` with the rest first.
    `rank` counts the pieces of one length within task `part`.
    """

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for b in batches:
            out: dict[str, list] = defaultdict(list)
            for doc_id, ids in zip(b["doc_id"], in_portions(b["text"], tokenizer)):
                ids += END
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    length = (n - at) % capacity or min(capacity, n - at)
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(at)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(ids[4 * at : 4 * (at + length)]))
                    out["part"].append(part)
                    out["rank"].append(seen[length])
                    seen[length] += 1
                    at, piece = at + length, piece + 1
            if out:
                yield out

    return map_columns(identified(docs), kernel, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long", AT_ONCE)


def best_knapsack(lengths: np.ndarray, prices: np.ndarray, limits: np.ndarray, capacity: int) -> Configuration:
    """The multiset of lengths within `capacity` with the highest sum of prices (each length as often
    as it fits), by dynamic programming over capacity; then cut to `limits`, and the room this frees
    filled with the longest other lengths that fit."""
    order = np.argsort(lengths)
    lengths, prices, limits = lengths[order], prices[order], limits[order]
    worth = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = fitting[c]
        worth[c] = worth[c - 1]
        if k:
            values = worth[c - lengths[:k]] + prices[:k]
            i = int(np.argmax(values))
            if values[i] > worth[c] + 1e-12:
                worth[c], taken[c] = values[i], i
    counts: Counter[int] = Counter()
    c = capacity
    while c > 0:
        i = taken[c]
        if i < 0:
            c -= 1
            continue
        counts[i] += 1
        c -= int(lengths[i])
    counts = Counter({i: int(min(n, limits[i])) for i, n in counts.items()})
    room = capacity - sum(int(lengths[i]) * n for i, n in counts.items())
    for i in range(len(lengths) - 1, -1, -1):
        more = int(min(limits[i] - counts[i], room // int(lengths[i])))
        if more > 0:
            counts[i] += more
            room -= more * int(lengths[i])
    return tuple(sorted(((int(lengths[i]), n) for i, n in counts.items() if n), reverse=True))


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[Configuration, int]]:
    """Configurations and how often each is used; every piece of the histogram has exactly one place."""
    left = {int(l): int(n) for l, n in histogram.items() if n > 0}
    chosen: Counter[Configuration] = Counter()
    full = left.pop(capacity, 0)
    if full:
        chosen[((capacity, 1),)] = full
    while left:
        lengths = np.array(sorted(left), dtype=np.int64)
        demand = np.array([left[int(l)] for l in lengths], dtype=float)
        # Weights begin at the size of the lengths, the dual prices of a perfect packing.
        log_weights = np.log(lengths / capacity)
        column = {int(l): i for i, l in enumerate(lengths)}
        found: Counter[Configuration] = Counter()
        covered = np.zeros(len(lengths))
        scale = float(max(1.0, demand @ lengths / capacity))
        for t in range(rounds):
            weights = np.exp(log_weights - log_weights.max())
            config = best_knapsack(lengths, weights, np.maximum(1, demand).astype(np.int64), capacity)
            found[config] += 1
            for l, n in config:
                covered[column[l]] += n
            # A length covered beyond its share of the demand loses price, one behind gains.
            share = covered / (t + 1) * scale / demand
            log_weights = np.log(lengths / capacity) - np.sqrt(np.log(len(lengths) + 1.0) / (t + 1)) * np.minimum(share, 4.0)
        before = sum(left.values())
        for config, times in sorted(found.items(), key=lambda x: -x[1]):
            amount = min([int(scale * times / rounds)] + [left.get(l, 0) // n for l, n in config])
            if amount > 0:
                chosen[config] += amount
                for l, n in config:
                    left[l] -= n * amount
        left = {l: n for l, n in left.items() if n}
        if sum(left.values()) * 2 > before or sum(l * n for l, n in left.items()) < 64 * capacity:
            break
    return sorted(_fill(left, chosen, capacity).items())


def _fill(left: dict[int, int], chosen: Counter[Configuration], capacity: int) -> Counter[Configuration]:
    """The rest by best fit.  Rounding may have used up the short pieces that would fill beside the long ones of
    the rest, so shares of the sequences, spread over all configurations, are opened again, and the fewest kept.
    The last share is all of them, so the result is never more than best fit, decreasing, over the whole histogram."""
    best = best_fit_decreasing(left, chosen, capacity)
    total, last = sum(chosen.values()), 0
    for share in OPENED:
        opened = round(total * share)
        if opened == last:
            continue
        last, kept, rest, due = opened, Counter(), Counter(left), 0.0
        for config, times in sorted(chosen.items()):
            due += times * share
            out = min(times, int(due + 1e-9))
            due -= out
            if times > out:
                kept[config] = times - out
            for l, n in config:
                rest[l] += n * out
        tried = best_fit_decreasing(rest, kept, capacity)
        if sum(tried.values()) < sum(best.values()):
            best = tried
    return best


def best_fit_decreasing(left: dict[int, int], chosen: dict[Configuration, int], capacity: int) -> Counter[Configuration]:
    """The rest: each piece, longest first, to the fullest sequence that still holds it, the chosen ones included.

    Equal sequences are one entry with their number.  A sequence that takes a piece is then the fullest
    that may take the next of this length, so it takes all that fit: an entry is filled in one step, and
    at most one sequence of a length is left apart.  The work is that of lengths and configurations, not of pieces.
    """
    rooms: dict[int, Counter[Configuration]] = defaultdict(Counter)  # by free room
    for config, times in chosen.items():
        rooms[capacity - sum(l * n for l, n in config)][config] += times
    free = sorted(rooms)

    def put(room: int, config: Configuration, length: int, n: int, times: int) -> None:
        held = dict(config)
        held[length] = held.get(length, 0) + n
        room -= length * n
        if not rooms[room]:
            bisect.insort(free, room)
        rooms[room][tuple(sorted(held.items(), reverse=True))] += times

    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            i = bisect.bisect_left(free, length)
            if i < len(free):
                room = free[i]
                config, times = next(iter(rooms[room].items()))
            else:
                room, config, times = capacity, (), n
            each = min(room // length, n)
            used = min(times, n // each)
            if config:
                rooms[room][config] -= used
                if not rooms[room][config]:
                    del rooms[room][config]
                if not rooms[room]:
                    free.pop(i)
            put(room, config, length, each, used)
            n -= each * used
    packed: Counter[Configuration] = Counter()
    for configs in rooms.values():
        packed.update(configs)
    return packed


def _slots(chosen: list[tuple[Configuration, int]]) -> tuple[np.ndarray, ...]:
    """The runs of the plan by length and first rank: both in one key, first sequence, pieces in one sequence, offset of the first."""
    used: Counter[int] = Counter()
    runs: list[tuple[int, int, int, int]] = []
    sequence = 0
    for config, times in chosen:
        offset = 0
        for length, n in config:
            runs.append((length << RANK_BITS | used[length], sequence, n, offset))
            used[length] += n * times
            offset += n * length
        sequence += times
    found = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)
    return tuple(found[:, i].astype(kind) for i, kind in enumerate((np.int64, np.int64, np.int32, np.int32)))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece placed, gapless from 0.

    A NULL or empty text is the one id 0.  Equal lengths are interchangeable: the k-th piece of a length
    (by task, then within it) takes its k-th place, found by counts per task and length, so no length
    is gathered in one task.  Repeated rows are packed each; no rows give no sequences.
    """
    cut = stored(pieces(docs, tokenizer, capacity), "pieces")
    counts = stored(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    keys, first, times, at = _slots(plan(histogram, capacity, rounds))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranked = cut.join(counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before")), ["part", "length"])

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        for b in batches:
            length, rank, earlier = (np.array(b[c], dtype=np.int64) for c in ("length", "rank", "before"))
            key = length << RANK_BITS | rank + earlier
            i = np.searchsorted(keys, key, side="right") - 1
            copy, nth = np.divmod(key - keys[i], times[i])
            sequences, offsets = first[i] + copy, at[i] + nth * length
            yield {k: b[k] for k in ("doc_id", "piece", "start", "length", "ids_crc32")} | {"sequence_id": sequences, "offset": offsets}

    return map_columns(ranked, kernel, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
