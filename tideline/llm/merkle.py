"""A Merkle manifest of a dataset, with a membership proof for every row.

Rows are leaves, in order within groups.  A tree joins every `fanout` consecutive nodes, the last run
possibly fewer, until one remains; the roots of the groups are the leaves of a last tree.

Proofs grow as nodes are appended.  `Witnesses` holds, for each level, the open subtree: the nodes of
the run that is not complete, each with the partial witnesses of the leaves below it.  When the
run completes, each of these witnesses is extended by the run's other nodes, and the run's parent is
appended one level up.  A task appends one aligned block of `fanout ** height` leaves; the blocks'
roots are again leaves that are appended in blocks, and so on until a group is one node.
On the way back each block's witness is handed to its members as what comes above theirs.

No group, block or tree passes one task or the driver whole: a block is at most `fanout ** height` nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.frames import small_frame
from tideline.llm.rows import Columns, map_columns, stored

FANOUT, HEIGHT = 8, 4  # a block holds 4,096 nodes
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def joined_hash(*digests: str) -> str:
    """H of digests: sha256 of their hex texts one after the other, as hex text."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Witnesses:
    """A growing tree of which only the open right edge is held, with the witnesses of its leaves.

    A witness is a list of (left siblings, right siblings), each the joined hex texts, from the leaf upwards.
    """

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.open: list[list[tuple[str, list[int]]]] = []  # by level: (digest, leaves below)
        self.steps: list[list[tuple[str, str]]] = []

    def append(self, digest: str) -> None:
        self.steps.append([])
        self._push(0, digest, [len(self.steps) - 1])

    def _push(self, level: int, digest: str, below: list[int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((digest, below))
        if len(self.open[level]) == self.fanout:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [d for d, _ in run]
        for i, (_, below) in enumerate(run):
            step = ("".join(digests[:i]), "".join(digests[i + 1 :]))
            for leaf in below:
                self.steps[leaf].append(step)
        self._push(level + 1, joined_hash(*digests), [leaf for _, below in run for leaf in below])

    def close(self, height: int | None = None) -> str:
        """Complete the runs that are open and return the root: the one node left, or that of level `height`."""
        level = 0
        while True:
            above = any(self.open[level + 1 :])
            if height is None and not above and len(self.open[level]) == 1:
                return self.open[level][0][0]
            if height == level:
                return self.open[level][0][0]
            if self.open[level]:
                self._complete(level)
            level += 1


def fold(digest: str, witness: list[tuple[str, str]]) -> str:
    for left, right in witness:
        digest = joined_hash(left, digest, right)
    return digest


def proof(witness: list[tuple[str, str]]) -> str:
    return joined_hash(*[left + right for left, right in witness])


def _written(witness: list[tuple[str, str]]) -> str:
    return ";".join(f"{left}|{right}" for left, right in witness)


def _read(text: str) -> list[tuple[str, str]]:
    return [tuple(step.split("|")) for step in text.split(";")] if text else []


# ------------------------------------------------------------------ leaves


def encoded(value: Column) -> Column:
    """`-` for NULL, else the number of UTF-8 bytes, `:` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[encoded(columns[c]) for c in COLUMNS]), 256)


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def tampered_with(doc_id: Column) -> Column:
    """3 divides the unsigned crc32 of the decimal id; never for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, grp, digest, tampered): the digest of each row, and that of its changed text where it is tampered with.

    `grp` orders as NULL first, then by the UTF-8 bytes of the value.
    """
    columns = {c: F.col(f"`{c}`") for c in COLUMNS}
    changed = leaf_digest(columns | {"text": lowered(columns["text"])})
    return docs.select(
        columns["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("v"), columns["lang"]), F.lit("-")).alias("grp"),
        F.unhex(leaf_digest(columns)).alias("digest"),
        F.when(tampered_with(columns["doc_id"]), F.unhex(changed)).alias("tampered"),
    )


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rank` 0, 1, ... of each row within its `grp` by `order`; rows equal in it are numbered in any order.

    Rows are dealt by ranges of (grp, order, row number), so neither a large group nor equal rows meet in
    one task.  A task numbers its rows; the rows of a group in earlier tasks are added from a count per task.
    """
    dealt = stored(rows.withColumn("salt", F.monotonically_increasing_id()), "merkle-leaves")
    dealt = dealt.repartitionByRange("grp", *order, "salt").sortWithinPartitions("grp", *order, "salt").drop("salt")
    names = dealt.columns

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        part, held, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            nth = []
            for grp in b["grp"]:
                n = n + 1 if grp == held else 0
                held = grp
                nth.append(n)
            yield {**b, "part": [part] * len(nth), "nth": nth}

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    numbered = stored(map_columns(dealt, kernel, f"{types}, part int, nth long"), "merkle-numbered")
    # Only the first and the last group of a task can go on from or into another: one row per task.
    sizes = numbered.groupBy("part", "grp").agg((F.max("nth") + 1).alias("n"))
    edges = sizes.groupBy("part").agg(
        F.min("grp").alias("first"), F.min_by("n", "grp").alias("n_first"), F.max("grp").alias("last"), F.max_by("n", "grp").alias("n_last")
    )
    offsets, going, seen = [], None, 0
    for part, first, n_first, last, n_last in sorted(tuple(r) for r in edges.collect()):
        if first == going:
            offsets.append((part, first, seen))
        seen = (seen if last == going else 0) + n_last
        going = last
    earlier = small_frame(rows.sparkSession, offsets, "part int, grp string, earlier long")  # at most one row per task
    return numbered.join(earlier, ["part", "grp"], "left").select(*names, (F.col("nth") + F.coalesce("earlier", F.lit(0))).alias("rank"))


# ------------------------------------------------------------------ trees


def _blocks(nodes: DataFrame, size: int, above: DataFrame | None = None) -> DataFrame:
    """Nodes by aligned block, in order; with `above` each block is preceded by its row of it (rank -1)."""
    members = nodes.withColumn("block", F.floor(F.col("rank") / size).cast("long"))
    if above is not None:
        members = members.unionByName(above.withColumnRenamed("rank", "block").withColumn("rank", F.lit(-1).cast("long")), allowMissingColumns=True)
    return members.repartition("grp", "block").sortWithinPartitions("grp", "block", "rank")


def _runs(batches: Iterator[Columns]) -> Iterator[tuple[str, int, list[dict]]]:
    """(grp, block, its rows) of a sorted stream; a block is bounded."""
    key, held = None, []
    for b in batches:
        names = list(b)
        for values in zip(*b.values()):
            row = dict(zip(names, values))
            if (row["grp"], row["block"]) != key:
                if held:
                    yield *key, held
                key, held = (row["grp"], row["block"]), []
            held.append(row)
    if held:
        yield *key, held


def _tree(rows: list[dict], single: bool, fanout: int, height: int) -> tuple[str, Witnesses]:
    tree = Witnesses(fanout)
    for row in rows:
        tree.append(row["digest"].hex())
    return tree.close(None if single else height), tree


def block_roots(nodes: DataFrame, fanout: int, height: int) -> DataFrame:
    """(grp, rank, digest, single): the root of each block; a group of one block has `single` set."""
    size = fanout**height

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        for grp, block, rows in _runs(batches):
            root, _ = _tree(rows, rows[0]["single"], fanout, height)
            yield {"grp": [grp], "rank": [block], "digest": [bytes.fromhex(root)]}

    return map_columns(_blocks(nodes, size).select("grp", "block", "rank", "digest", "single"), kernel, "grp string, rank long, digest binary")


def _with_single(nodes: DataFrame, size: int) -> DataFrame:
    """`single`: the group of the node fits one block."""
    sizes = nodes.groupBy("grp").agg((F.max("rank") < size).alias("single"))
    return nodes.join(sizes, "grp")


def _witness_rows(levels: list[DataFrame], top: DataFrame, fanout: int, height: int) -> DataFrame:
    """(grp, rank, witness, subroot, root) for each block of leaves, from the roots down.

    `levels` are the block roots, lowest first, the last one node per group; `top` has the part above each group.
    """
    size = fanout**height
    above = top
    for nodes in reversed(levels[:-1]):

        def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
            for grp, _, (head, *rows) in _runs(batches):
                _, tree = _tree(rows, rows[0]["single"], fanout, height)
                higher = head["witness"]
                yield {
                    "grp": [grp] * len(rows),
                    "rank": [r["rank"] for r in rows],
                    "witness": [";".join(filter(None, (_written(s), higher))) for s in tree.steps],
                    "subroot": [head["subroot"]] * len(rows),
                    "root": [head["root"]] * len(rows),
                }

        above = stored(map_columns(_blocks(nodes, size, above), kernel, "grp string, rank long, witness string, subroot string, root string"), "merkle-witnesses")
    return above


def _levels(leaves_: DataFrame, fanout: int, height: int) -> list[DataFrame]:
    """Block roots of the leaves, of these, and so on until each group is one node."""
    size, found, nodes = fanout**height, [], leaves_
    while not found or found[-1].where("rank > 0").limit(1).count():
        nodes = found[-1] if found else nodes
        if found:
            nodes = found[-1] = _with_single(nodes, size)
        found.append(stored(block_roots(nodes, fanout, height), "merkle-roots"))
    return found


OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per document.

    Groups are the values of `lang`, NULL a group of its own and first.  Leaves are ordered by doc_id, NULL
    first, then by digest; repeated rows are a leaf each.  Values are hashed as `encoded` says, so NULL and empty differ, and a text
    of any length is one hash in the scan.  No rows give no rows; other columns are not read.
    """
    size = fanout**height
    nodes = stored(_with_single(ranked(leaves(docs), ["doc_id", "digest"]), size), "merkle-nodes")
    levels = _levels(nodes.drop("doc_id", "tampered"), fanout, height)
    subroots = levels[-1].select("grp", "digest")
    # The groups' roots are leaves of one last tree, of one group.
    last = subroots.select(F.lit("").alias("grp"), "digest", F.col("grp").alias("name"))
    last = stored(_with_single(ranked(last, ["name"]), size), "merkle-subroots")
    tops = _levels(last.drop("name"), fanout, height)
    root = tops[-1].select(F.hex("digest")).first()
    root = root[0].lower() if root else ""
    nothing = F.lit("")
    start = tops[-1].select("grp", "rank", nothing.alias("witness"), nothing.alias("subroot"), F.lit(root).alias("root"))
    over = _witness_rows([last, *tops], start, fanout, height)
    named = over.join(last.select("rank", "name", "digest"), "rank")
    start = named.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("rank"), "witness", F.lower(F.hex("digest")).alias("subroot"), "root")
    above = _witness_rows(levels, stored(start, "merkle-groups"), fanout, height)

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        for _, _, (head, *rows) in _runs(batches):
            _, tree = _tree(rows, rows[0]["single"], fanout, height)
            higher, root = _read(head["witness"]), head["root"]
            witnesses = [steps + higher for steps in tree.steps]
            folded = [fold((r["tampered"] or r["digest"]).hex(), w) for r, w in zip(rows, witnesses)]
            yield {
                "doc_id": [r["doc_id"] for r in rows],
                "leaf": [r["digest"].hex() for r in rows],
                "subroot": [head["subroot"]] * len(rows),
                "root": [root] * len(rows),
                "proof_sha256": [proof(w) for w in witnesses],
                "folded_root": folded,
                "verified": [f == root for f in folded],
            }

    return map_columns(_blocks(nodes, size, above), kernel, OUT)
