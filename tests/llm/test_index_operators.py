"""Centroid clustering, Merkle manifest and token files against brute force and odd inputs."""

from __future__ import annotations

import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import centroids, merkle, token_files
from tideline.llm.queries import QUERIES, tokenizer_file
from tideline.llm.tokens import TextEncoder
from tideline.session import workspace

# ------------------------------------------------------------------ 11 clustering

VECTORS = "vec_id long, embedding array<float>, label int, x string, cluster int, squared string"


def brute_clusters(vectors, k=16, rounds=3):
    kept = [
        (i, [math.floor(64 * v) for v in e]) for i, e in vectors
        if e is not None and len(e) == 64 and all(v is not None and math.isfinite(v) for v in e)
    ]
    named = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    c = [x for _, x in named[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c)) for _, x in kept]

    for _ in range(rounds):
        held = assign()
        for j in range(len(c)):
            own = [x for (_, x), (_, at) in zip(kept, held) if at == j]
            if own:
                c[j] = [sum(v) // len(own) for v in zip(*own)]
    found = assign()
    per = {j: sum(s for s, at in found if at == j) for j in range(len(c))}
    sha = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in c]
    return sorted((str(i), j, s, per[j], sum(per.values()), sha[j]) for (i, _), (s, j) in zip(kept, found))


def frame(spark, vectors):
    return spark.createDataFrame([(i, e, 1, "x", 7, "y") for i, e in vectors], VECTORS)


def test_clusters_are_those_of_exact_k_means(spark):
    r = random.Random(4)
    f32 = lambda v: float(np.float32(v))
    centers = [[r.gauss(0, 0.3) for _ in range(64)] for _ in range(9)]
    vectors = [(i, [f32(c + r.gauss(0, 0.1)) for c in r.choice(centers)]) for i in range(400)]
    vectors += [(1000 + i, [f32(0.25)] * 64) for i in range(60)]  # copies, ties
    vectors += [(5, [0.5] * 64), (5, [0.5] * 64), (None, [0.1] * 64), (None, None), (2000, [0.5] * 63), (2001, []), (2002, [0.5] * 63 + [None])]
    vectors += [(2003, [0.5] * 63 + [float("nan")]), (2004, [float("inf")] + [0.5] * 63)]
    got = sorted((str(r[0]), *r[1:]) for r in rows(centroids.cluster_vectors(frame(spark, vectors))))
    assert got == brute_clusters(vectors)


def test_few_vectors_and_none(spark):
    few = [(3, [0.5] * 64), (1, [0.25] * 64), (2, [0.5] * 64)]
    assert sorted((str(r[0]), *r[1:]) for r in rows(centroids.cluster_vectors(frame(spark, few)))) == brute_clusters(few)
    for none in ([], [(1, None)], [(1, [1e30] * 64)]):
        assert centroids.cluster_vectors(frame(spark, none)).count() == 0


def test_bounds_never_hide_a_nearer_or_equal_centroid_and_save_work():
    r = np.random.default_rng(2)
    x = np.concatenate([r.integers(-6, 6, (300, 4)), r.integers(-6, 6, (300, 4)) + 60])
    history = centroids.History((x[r.integers(0, len(x), 8)].copy(),))
    cluster, squared, epoch = np.full(len(x), -1), np.zeros((len(x), 8), dtype=np.int64), np.zeros((len(x), 8), dtype=np.int64)
    seen = []
    for t in range(12):
        seen.append(centroids.nearest(x, cluster, squared, epoch, history))
        exact = np.stack([((x - c) ** 2).sum(axis=1) for c in history.last], axis=1)
        assert (cluster == exact.argmin(axis=1)).all()
        step = r.integers(-3, 4, (8, 4)) if t < 6 else (1 if t % 2 else -1) * np.ones((8, 4), dtype=np.int64)
        history = centroids.History((*history.rounds, history.last + step))
    assert seen[0] == 8 * len(x) and max(seen[1:]) < 8 * len(x)
    # Centroids that went and came back: the norm of the sum is 0 where the sum of norms is not.
    assert np.allclose(centroids.History((history.last, history.last + 9, history.last)).displacements()[0], 0)


# ------------------------------------------------------------------ 12 Merkle manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank string, grp string, digest string, salt int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return h("".join(map(one, (doc_id, source, lang, n_chars, text))))


def brute_tree(nodes, fanout):
    """Root, and the siblings of each leaf by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf_, p in enumerate(at):
            run = nodes[p - p % fanout : p - p % fanout + fanout]
            paths[leaf_].append((run[: p % fanout], run[p % fanout + 1 :]))
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [p // fanout for p in at]
    return nodes[0], paths


def brute_manifest(docs, fanout=8):
    langs = sorted({d[2] for d in docs}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((d for d in docs if d[2] == lang), key=lambda d: (d[0] is not None, d[0] or 0, leaf(*d)))
        trees[lang] = (own, *brute_tree([leaf(*d) for d in own], fanout))
    root, tops = brute_tree([trees[lang][1] for lang in langs], fanout)
    found = []
    for lang, top in zip(langs, tops):
        own, subroot, paths = trees[lang]
        for d, path in zip(own, paths):
            tampered = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and d[1] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in d[1]) if tampered else d[1]
            folded = leaf(d[0], text, *d[2:])
            for left, right in path + top:
                folded = h(*left, folded, *right)
            found.append((str(d[0]), leaf(*d), subroot, root, h(*[x for l, r in path + top for x in (*l, *r)]), folded, folded == root))
    return sorted(found)


@pytest.mark.parametrize("fanout,height", [(8, 4), (2, 1), (3, 2), (8, 1)])
def test_manifest_is_that_of_plain_trees(spark, fanout, height):
    r = random.Random(fanout)
    docs = [(i, r.choice(["Plain", "lower only", "ÄB", ""]) + str(i), r.choice(["en", "en", "en", "de", "zz", "", None]), "s", i) for i in range(150)]
    docs += [(7, "same", "en", "s", 1)] * 40 + [(None, None, "fr", None, None), (None, "Text", "fr", None, None), (None, None, None, None, None), (8, "long " * 20_000, "de", "s", 9)]
    got = merkle.manifest(spark.createDataFrame([(*d, "x", "y", "z", 1) for d in docs], DOCS), fanout, height)
    assert sorted((str(x[0]), *x[1:]) for x in rows(got)) == brute_manifest(docs, fanout)


def test_manifest_of_one_and_of_none(spark):
    one = [(0, "A", "en", "s", 1)]
    got = rows(merkle.manifest(spark.createDataFrame([(*d, "x", "y", "z", 1) for d in one], DOCS)))
    assert [(str(x[0]), *x[1:]) for x in got] == brute_manifest(one) and got[0][1] == got[0][3]
    assert merkle.manifest(spark.createDataFrame([], DOCS)).count() == 0


def test_a_changed_row_does_not_verify(spark):
    docs = spark.createDataFrame([(i, f"Text {i}", "en", "s", i, "", "", "", 0) for i in range(30)], DOCS)
    for x in rows(merkle.manifest(docs)):
        assert x[-1] == (zlib.crc32(str(x[0]).encode()) % 3 != 0)


@pytest.mark.parametrize("n", range(1, 40))
def test_witnesses_of_every_size(n):
    nodes = [h(str(i)) for i in range(n)]
    tree = merkle.Witnesses(3)
    for d in nodes:
        tree.append(d)
    root, paths = brute_tree(nodes, 3)
    assert tree.close() == root
    assert tree.steps == [[("".join(l), "".join(r)) for l, r in p] for p in paths]
    assert all(merkle.fold(d, w) == root for d, w in zip(nodes, tree.steps))


# ------------------------------------------------------------------ 13 token files


def test_ids_are_those_of_the_whole_text():
    r = random.Random(1)
    signs = list("abcXYZ 019.,;:!?)('\"é ßΣσ́中½²_-|<>\n\t\x85　😀’'s'll\x01\x1c​")
    words = "It's word, x. end) café 12 don't DON'T. a.b. e.g. !? α Σας. <|endoftext|> \n l'eau dé. é. \n\n  ( ) .. a..".split(" ")
    texts = ["", " ", "\n", "a\n", " a", "a "] + ["".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(3000)]
    texts += [" ".join(r.choice(words) for _ in range(12)) for _ in range(2000)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        own, library = TextEncoder(tokenizer_file(name)), Tokenizer.from_file(tokenizer_file(name))
        want = [np.array(e.ids, dtype="<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
        assert own.encode(texts) == want
        assert own.encode(texts[::-1]) == want[::-1]


def test_a_perfect_hash_gives_each_key_a_slot_and_refuses_others():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 100, 30_000):
        doc_id = r.permutation(3 * n)[:n].astype(np.int64) - n
        nth = r.integers(-3, 3, n).astype(np.int64)
        hashed = token_files.PerfectHash.of(doc_id, nth)
        assert sorted(hashed.slots(doc_id, nth).tolist()) == list(range(n))
        numbers = np.arange(n)
        index = token_files.Index(token_files.index_bytes(doc_id, nth, numbers, numbers * 7, numbers + 1))
        there, slots = index.find(doc_id, nth)
        assert there.tolist() == list(range(n)) and slots["place"].tolist() == (numbers * 7).tolist()
        absent, _ = index.find(doc_id + 4 * n + 9, nth)
        assert len(absent) == 0
        assert sum(b for b, _, _ in hashed.arrays) <= 6 * n + 64 * len(hashed.arrays)


ODD = [(9, None), (2, ""), (3, "  \n\t "), (4, "word"), (5, "a " * 30_000), (None, "no id here"), (None, None), (6, "same text"), (6, "same text"), (6, "other"), (-7, "é　ß 😀")]


def test_written_files_are_read_back_like_brute_force(spark):
    r = random.Random(6)
    docs = ODD + [(100 + i, " ".join(r.choice(["One", "two,", "three"]) for _ in range(r.randrange(30)))) for i in range(300)] + [(50, "copy")] * 100
    path = tokenizer_file("word_bpe_49k.json")
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, nth string, shard int, place int")
    got = rows(token_files.written_and_read(df.repartition(5), path))
    library, start, want = Tokenizer.from_file(path), {}, []
    tokens = {t: [*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t in docs}
    by_start = sorted(got, key=lambda g: g[2])
    ids = [g[0] for g in by_start]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(got) == len(docs)
    at = 0
    for g in by_start:
        assert g[2] == at
        at += g[3]
    crc = lambda t: zlib.crc32(struct.pack(f"<{len(t)}I", *t))
    want = sorted((str(i), len(tokens[t]), crc(tokens[t])) for i, t in docs)
    assert sorted((str(g[0]), g[3], g[4]) for g in got) == want
    assert sorted((str(g[0]), g[1]) for g in got) == sorted((str(i), n) for i in {i for i, _ in docs} for n in range(sum(j == i for j, _ in docs)))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.written_and_read(empty, path).count() == 0


def test_keys_are_looked_up_and_absent_ones_refused(spark, monkeypatch):
    monkeypatch.setattr(token_files, "KEYS_PER_BUCKET", 16)
    path, folder = tokenizer_file("word_bpe_49k.json"), workspace(spark, "token-test")
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(200)] + [(7, "another")], "doc_id long, text string")
    token_files.write_tokens(docs, path, 1, folder)
    asked = spark.createDataFrame([(3, 0), (7, 0), (7, 1), (7, 2), (5000, 0), (None, 0)], "id long, n long")
    found = token_files.read_ids(asked.select(*token_files.key(F.col("id"), F.col("n"))), folder).collect()
    library = Tokenizer.from_file(path)
    texts = {(r.doc_id, r.nth): library.decode(np.frombuffer(r.ids, "<u4")[:-1].tolist()) for r in found}
    assert set(texts) == {(3, 0), (7, 0), (7, 1)} and len(found) == 3
    assert all(np.frombuffer(r.ids, "<u4")[-1] == 1 and len(r.ids) == 4 * r.n_tokens for r in found)


def test_new_queries_are_registered():
    assert {"op11_centroid_clustering", "op12_merkle_manifest", "op13_token_files"} <= set(QUERIES)
