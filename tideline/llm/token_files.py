"""Token ids in raw binary shards, found by document key through a minimal perfect hash index.

A folder holds

- `shards/`: ids as little-endian unsigned integers, of 16 bits where the vocabulary allows and else of 32,
  documents one after the other, nothing else;
- `index/`: one file per bucket of keys, a minimal perfect hash with a slot per key that holds
  the key's fingerprint, shard, place and length;
- `keys/`: the list of keys (Parquet), for scans of everything;
- `shard_list/`: the shards' files and what they hold (Parquet).

The key of a row is its doc_id and which of the rows with this doc_id it is (0, 1, ...); so keys are unique
whatever the ids.  A lookup hashes the key to a bucket, walks a few bit arrays to its slot, compares the
fingerprint and knows the place: constant time, no search.  A key that is not there is refused by
the fingerprint but for one in 2^32.

The hash of a bucket is a cascade of bit arrays.  In each, a key sets the bit its hash names; keys
that meet fall through to the next, smaller one.  The slot is the number of set bits before its bit.

Files are written by tasks under a name of their own and named in a stored table by those that succeed,
so a repeated task leaves a file that nothing refers to.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.frames import small_frame
from tideline.llm.kernels import mix
from tideline.llm.rows import Columns, identified, map_columns, stored
from tideline.llm.tokens import encoder, in_portions
from tideline.session import workspace

SHARD_IDS = 1 << 25  # a shard is closed when it holds so many ids
KEYS_PER_BUCKET = 1 << 16
ROOM = 1.5  # bits per key of a cascade's array
READ_BYTES = 8 << 20  # of a shard at once

KEY = "doc_id long, nth long"
PLACE = "doc_id long, nth long, shard long, place long, n_tokens long"
SHARD = "shard long, file string, n_ids long, start long, width int"
_HEAD = struct.Struct("<4sIQI")  # magic, version, keys, cascades
_SLOT = np.dtype([("print", "<u4"), ("n_tokens", "<u8"), ("shard", "<u8"), ("place", "<u8")])
_MAGIC = b"TLMP"


# ------------------------------------------------------------------ the hash


def _key_hash(doc_id: np.ndarray, nth: np.ndarray, seed: int) -> np.ndarray:
    """64 bits of (doc_id, nth), another function for each seed."""
    s = np.uint64((seed * 0x9E3779B97F4A7C15 + 0xD1B54A32D192ED03) % 2**64)
    return mix(mix(doc_id.view(np.uint64) ^ s) + nth.view(np.uint64) * np.uint64(0x9FB21C651E98DF25) + s)


def _reduced(h: np.ndarray, size: int) -> np.ndarray:
    return (h % np.uint64(size)).astype(np.int64)


_PRINT = 2**20  # the seed of fingerprints


@dataclass
class PerfectHash:
    """A minimal perfect hash of unique keys: slots 0 .. n - 1, each taken by one key."""

    n: int
    arrays: list[tuple[int, np.ndarray, np.ndarray]]  # (bits, words of 64 bits, set bits before each word)

    @classmethod
    def of(cls, doc_id: np.ndarray, nth: np.ndarray) -> PerfectHash:
        arrays, left, before = [], np.arange(len(doc_id)), 0
        while len(left):
            bits = max(64, -(-int(len(left) * ROOM) // 64) * 64)
            at = _reduced(_key_hash(doc_id[left], nth[left], len(arrays)), bits)
            alone = np.bincount(at, minlength=bits) == 1
            words = np.packbits(alone, bitorder="little").view("<u8")
            counts = np.bitwise_count(words).astype(np.uint32)
            arrays.append((bits, words, (np.cumsum(counts) - counts + before).astype("<u4")))
            before += int(counts.sum())
            left = left[~alone[at]]
            if len(arrays) > 256:
                raise ValueError("keys are not unique")
        return cls(len(doc_id), arrays)

    def slots(self, doc_id: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no array has its bit."""
        found = np.full(len(doc_id), -1, dtype=np.int64)
        left = np.arange(len(doc_id))
        for seed, (bits, words, before) in enumerate(self.arrays):
            if not len(left):
                break
            at = _reduced(_key_hash(doc_id[left], nth[left], seed), bits)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            held = words[word]
            here = (held >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(held & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[here]] = (before[word].astype(np.int64) + below)[here]
            left = left[~here]
        return found


def index_bytes(doc_id: np.ndarray, nth: np.ndarray, shard: np.ndarray, place: np.ndarray, n_tokens: np.ndarray) -> bytes:
    """The index file of one bucket: head, bit arrays, slots."""
    hashed = PerfectHash.of(doc_id, nth)
    slots = np.zeros(hashed.n, dtype=_SLOT)
    at = hashed.slots(doc_id, nth)
    slots["print"][at] = _key_hash(doc_id, nth, _PRINT) >> np.uint64(32)
    slots["shard"][at], slots["place"][at], slots["n_tokens"][at] = shard, place, n_tokens
    parts = [_HEAD.pack(_MAGIC, 1, hashed.n, len(hashed.arrays)), np.array([b for b, _, _ in hashed.arrays], dtype="<u8").tobytes()]
    for _, words, before in hashed.arrays:
        parts += [words.tobytes(), before.tobytes()]
    return b"".join([*parts, slots.tobytes()])


class Index:
    """An index file as read: `find` gives the slots of keys."""

    def __init__(self, data: bytes):
        magic, version, n, levels = _HEAD.unpack_from(data)
        if magic != _MAGIC or version != 1:
            raise ValueError("no token index")
        at = _HEAD.size
        sizes = np.frombuffer(data, "<u8", levels, at).tolist()
        at += 8 * levels
        arrays = []
        for bits in sizes:
            words = np.frombuffer(data, "<u8", bits // 64, at)
            before = np.frombuffer(data, "<u4", bits // 64, at + bits // 8)
            at += bits // 8 + bits // 16
            arrays.append((bits, words, before))
        self.hashed = PerfectHash(n, arrays)
        self.entries = np.frombuffer(data, _SLOT, n, at)

    def find(self, doc_id: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys are there, their slots)."""
        at = self.hashed.slots(doc_id, nth)
        there = np.flatnonzero(at >= 0)
        prints = (_key_hash(doc_id[there], nth[there], _PRINT) >> np.uint64(32)).astype(np.uint32)
        same = self.entries["print"][at[there]] == prints
        return there[same], self.entries[at[there[same]]]


# ------------------------------------------------------------------ files


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, by its URI or its absolute path, and the path in it."""
    return fs.FileSystem.from_uri(folder)


def _write(folder: str, name: str, data: bytes) -> None:
    system, path = _system(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}") as out:
        out.write(data)


def _attempt(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex[:8]}.bin"


# ------------------------------------------------------------------ writing


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "nth"), F.lit(buckets))


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> None:
    """Encode every text and write the files of `folder`, which must be new.

    Documents are in ascending order of doc_id, NULL first, and among rows of one doc_id in that of a hash of the
    text; equal rows in any order.  A NULL text is empty and so holds the end id alone.  Rows are dealt
    by ranges that end with the row's number, so neither one doc_id nor copies meet in one task.
    """
    rows = identified(docs).select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("salt"))
    order = ["doc_id", "h", "salt"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    shards_folder = f"{folder}/shards"
    width = 2 if max(encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        part, turn = TaskContext.get().partitionId(), 0
        system, path = _system(shards_folder)
        system.create_dir(path, recursive=True)
        file, out, place, held, nth = "", None, 0, (), 0
        end = end_id.to_bytes(width, "little")
        for b in batches:
            done: dict[str, list] = {k: [] for k in ("doc_id", "nth", "shard", "place", "n_tokens", "file", "part")}
            for doc_id, ids in zip(b["doc_id"], in_portions(b["text"], tokenizer)):
                if out is None:
                    file, place = _attempt(f"{part:06d}-{turn:04d}"), 0
                    out = system.open_output_stream(f"{path}/{file}")
                nth = nth + 1 if (doc_id,) == held else 0
                held = (doc_id,)
                out.write(ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes())
                out.write(end)
                n = len(ids) // 4 + 1
                for k, v in zip(done, (doc_id, nth, (part << 20) + turn, place, n, file, part)):
                    done[k].append(v)
                place += n
                if place >= SHARD_IDS:
                    out.close()
                    out, turn = None, turn + 1
            yield done
        if out is not None:
            out.close()

    written = stored(map_columns(dealt, kernel, f"{PLACE}, file string, part int"), "token-places")
    _list_shards(written, folder, width)
    keys = _numbered(written)
    keys.select(*[n for n in ("doc_id", "nth", "shard", "place", "n_tokens")]).write.parquet(f"{folder}/keys")
    _build_index(docs.sparkSession, folder)


def _list_shards(written: DataFrame, folder: str, width: int) -> None:
    """One row per shard, with the number of ids in all shards before it."""
    sizes = written.groupBy("shard").agg(F.max("file").alias("file"), F.sum("n_tokens").alias("n_ids"))
    rows, start = [], 0
    for r in sorted(sizes.collect(), key=lambda r: r.shard):  # a row per 64 MB of ids
        rows.append((r.shard, r.file, r.n_ids, start, width))
        start += r.n_ids
    small_frame(written.sparkSession, rows, SHARD).coalesce(1).write.parquet(f"{folder}/shard_list")


def _numbered(written: DataFrame) -> DataFrame:
    """`nth` counted on over the tasks that hold rows of one doc_id; from -1 down for a NULL id, so that
    (0, -1 - nth) is its key."""
    ids = written.groupBy("part", "doc_id").agg((F.max("nth") + 1).alias("n"))
    low = F.coalesce("doc_id", F.lit(None).cast("long"))
    order = F.struct(low.isNotNull(), low)
    edges = ids.groupBy("part").agg(
        F.min_by("doc_id", order).alias("first"), F.max_by("doc_id", order).alias("last"), F.max_by("n", order).alias("n_last")
    )
    more, going, seen = [], None, 0
    for r in sorted(edges.collect(), key=lambda r: r.part):  # one row per task
        if (r.first,) == going:
            more.append((r.part, r.first, seen))
        seen = (seen if (r.last,) == going else 0) + r.n_last
        going = (r.last,)
    earlier = small_frame(written.sparkSession, more, "p int, id long, earlier long")
    numbered = written.join(earlier, (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    nth = F.col("nth") + F.coalesce("earlier", F.lit(0))
    return numbered.withColumns(
        {"nth": F.when(F.col("doc_id").isNull(), -1 - nth).otherwise(nth), "doc_id": F.coalesce("doc_id", F.lit(0)).cast("long")}
    )


def by_bucket(batches: Iterator[pa.RecordBatch], handle: Callable[[int, dict[str, np.ndarray]], dict]) -> Iterator[dict]:
    """Call `handle` with the columns of each bucket of a stream sorted by bucket."""
    held: list[pa.RecordBatch] = []

    def flush() -> dict:
        whole = pa.Table.from_batches(held)
        columns = {n: whole.column(n).to_numpy() for n in whole.column_names}
        return handle(int(columns["bucket"][0]), columns)

    for b in batches:
        cuts = np.flatnonzero(np.diff(b.column("bucket").to_numpy())) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            if end == start:
                continue
            piece = b.slice(start, end - start)
            if held and held[-1].column("bucket")[0] != piece.column("bucket")[0]:
                yield flush()
                held.clear()
            held.append(piece)
    if held:
        yield flush()


def _build_index(spark: SparkSession, folder: str) -> None:
    keys = spark.read.schema(PLACE).parquet(f"{folder}/keys")
    buckets = max(1, -(-keys.count() // KEYS_PER_BUCKET))
    dealt = keys.withColumn("bucket", bucket_of(buckets)).repartition("bucket").sortWithinPartitions("bucket")
    index_folder = f"{folder}/index"

    def kernel(batches):
        def build(bucket: int, c: dict[str, np.ndarray]) -> dict:
            file = _attempt(f"{bucket:08d}")
            _write(index_folder, file, index_bytes(c["doc_id"], c["nth"], c["shard"], c["place"], c["n_tokens"]))
            return {"bucket": [bucket], "file": [file]}

        for row in by_bucket(batches, build):
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("bucket", pa.int64()), ("file", pa.string())]))

    made = dealt.mapInArrow(kernel, "bucket long, file string")
    made.withColumn("buckets", F.lit(buckets)).write.parquet(f"{folder}/index_list")


# ------------------------------------------------------------------ reading


def key(doc_id: Column, nth: Column | None = None) -> list[Column]:
    """The columns (doc_id, nth) of a key; `nth` says which of several rows of one doc_id."""
    nth = F.lit(0).cast("long") if nth is None else nth.cast("long")
    return [
        F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")).alias("doc_id"),
        F.when(doc_id.isNull(), -1 - nth).otherwise(nth).alias("nth"),
    ]


def all_keys(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PLACE).parquet(f"{folder}/keys").select("doc_id", "nth")


def find(keys: DataFrame, folder: str) -> DataFrame:
    """(doc_id, nth, shard, place, n_tokens) of the keys that are there, from the index alone.

    A task opens the index of a bucket once for all its keys."""
    spark = keys.sparkSession
    listed = spark.read.schema("bucket long, file string, buckets int").parquet(f"{folder}/index_list")
    count = listed.agg(F.max("buckets")).first()[0]
    if count is None:
        return spark.createDataFrame([], PLACE)
    dealt = keys.select("doc_id", "nth").withColumn("bucket", bucket_of(count)).join(listed.select("bucket", "file"), "bucket")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "file", "doc_id", "nth")
    index_folder = f"{folder}/index"

    def kernel(batches):
        system, path = _system(index_folder)

        def look(bucket: int, c: dict[str, np.ndarray]) -> dict:
            with system.open_input_stream(f"{path}/{c['file'][0]}") as file:
                index = Index(file.read())
            there, slots = index.find(c["doc_id"], c["nth"])
            return {"doc_id": c["doc_id"][there], "nth": c["nth"][there]} | {k: slots[k].astype(np.int64) for k in ("shard", "place", "n_tokens")}

        schema = pa.schema([(k, pa.int64()) for k in ("doc_id", "nth", "shard", "place", "n_tokens")])
        for found in by_bucket(batches, look):
            yield pa.RecordBatch.from_pydict(found, schema=schema)

    return dealt.mapInArrow(kernel, PLACE)


def read_ids(keys: DataFrame, folder: str) -> DataFrame:
    """(doc_id, nth, start, n_tokens, ids) of the keys that are there: `ids` are little-endian unsigned
    32-bit integers, from ranged reads of the shards; `start` counts the ids of all documents before it.  Keys of one shard are read in its order."""
    return _read(keys, folder, "ids binary", lambda ids: {"ids": ids})


def read_checks(keys: DataFrame, folder: str) -> DataFrame:
    """As `read_ids`, with the unsigned crc32 of the bytes in place of them."""
    return _read(keys, folder, "ids_crc32 long", lambda ids: {"ids_crc32": zlib.crc32(ids)})


def _read(keys: DataFrame, folder: str, field: str, of: Callable[[bytes], dict]) -> DataFrame:
    spark = keys.sparkSession
    shards = spark.read.schema(SHARD).parquet(f"{folder}/shard_list").select("shard", "file", "start", "width")
    places = find(keys, folder).join(shards, "shard")
    dealt = places.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place").select(
        F.when(F.col("nth") >= 0, F.col("doc_id")).alias("doc_id"),
        F.when(F.col("nth") >= 0, F.col("nth")).otherwise(-1 - F.col("nth")).alias("nth"),
        (F.col("start") + F.col("place")).alias("start"), "n_tokens", "file", "place", "width",
    )
    shards_folder, name = f"{folder}/shards", field.split()[0]

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        system, path = _system(shards_folder)
        opened, file, window, low = None, None, b"", 0
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "nth", "start", "n_tokens", name)}
            for doc_id, nth, start, n, wanted, place, width in zip(*[b[k] for k in ("doc_id", "nth", "start", "n_tokens", "file", "place", "width")]):
                if wanted != file:
                    if opened is not None:
                        opened.close()
                    opened, file, window, low = system.open_input_file(f"{path}/{wanted}"), wanted, b"", 0
                first, size = width * place, width * n
                if not low <= first <= first + size <= low + len(window):
                    window, low = opened.read_at(max(size, READ_BYTES), first), first
                ids = window[first - low : first - low + size]
                if len(ids) != size:
                    raise OSError(f"{wanted} ends before document {doc_id}")
                ids = ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                for k, v in zip(("doc_id", "nth", "start", "n_tokens"), (doc_id, nth, start, n)):
                    out[k].append(v)
                out[name].append(of(ids)[name])
            yield out
        if opened is not None:
            opened.close()

    return map_columns(dealt, kernel, f"doc_id long, nth long, start long, n_tokens long, {field}")


def written_and_read(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """(doc_id, nth, start, n_tokens, ids_crc32) of all documents, written to a new folder and read back by key."""
    folder = workspace(docs.sparkSession, "token-files")
    write_tokens(docs, tokenizer, end_id, folder)
    return read_checks(all_keys(docs.sparkSession, folder), folder)
