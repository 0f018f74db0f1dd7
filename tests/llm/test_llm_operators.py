"""The ten operators against brute force, exact round trips and odd inputs, on small fixtures."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import chains, chat, components, decontaminate, fingerprints, line_runs, main_text, packing, places, simhash, sparse_suffixes, tokens, toxicity
from tideline.llm.kernels import minimiser_positions, word_hashes
from tideline.llm.queries import QUERIES, tokenizer_file
from tideline.llm.rows import map_columns
from tideline.llm.tokens import in_portions

DOCS = "doc_id long, text string, lang string, source string, n_chars long, whole string"


def docs_of(spark, texts):
    """Documents with an extra column whose name clashes with an inner one."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in texts], DOCS)


def prose(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(5000)}" for _ in range(n)]


ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "word"), (5, "a " * 30_000), (None, "no id here"), (6, "same text twice"), (6, "same text twice"), (7, "é　ß \U0001f600")]


def test_word_hashes_and_minimisers():
    h = word_hashes(b" ab  cd ab\ncd ")
    assert h[0] == h[2] and h[1] == h[3] and h[0] != h[1] and word_hashes(b"cd")[0] == h[1]
    r = np.random.default_rng(1)
    for _ in range(50):
        x = r.permutation(1000)[: r.integers(30, 60)].astype(np.uint64)
        at = set(minimiser_positions(x, 12).tolist())
        assert all(int(np.argmin(x[i : i + 12])) + i in at for i in range(len(x) - 11))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 130)]
    got = dict(rows(components.components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {i: 0 for i in range(21)} | {i: 100 for i in range(100, 130)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ 1 toxicity


def test_noisy_words_are_restored_and_scored(spark):
    r = random.Random(3)
    words = ["house", "river", "light", "stone", "green", "paper", "cloud", "table"]
    bad = ["idiot", "moron", "stupid", "loser"]
    texts = [" ".join(r.choice(words) for _ in range(30)) + (f" {r.choice(bad)} {r.choice(bad)}" if i % 4 == 0 else "") for i in range(400)]
    docs = docs_of(spark, enumerate(texts))
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    for noisy, meant in (("1d10t", "idiot"), ("m0r0n", "moron"), ("l.o.s.e.r", "loser"), ("stuuuupid", "stupid"), ("$tup1d", "stupid")):
        assert toxicity.restore(noisy, model.characters) == meant
    assert toxicity.restore("A plain Text, 2024!", model.characters) == "a plain text, 2024!"
    assert model.score("green river 1d10t and m0r0n") > 0.5 > 0.3 > model.score("green river stone")
    scored = rows(toxicity.with_scores(docs_of(spark, ODD), model).select("doc_id", "whole", "score"))
    assert len(scored) == len(ODD) and all(0 <= s <= 1 and w == "x" for _, w, s in scored)
    assert toxicity.score_documents(docs_of(spark, []), model).count() == 0


@pytest.fixture(scope="module")
def insult_characters(spark):
    r = random.Random(8)
    words = "you are a house river light stone green paper cloud table such people hello class he has hell idiot moron shit stupid dumbass ass".split()
    return toxicity.character_model(docs_of(spark, [(i, " ".join(r.choice(words) for _ in range(60))) for i in range(200)]))


def test_long_parted_stretches_are_read_as_one(insult_characters):
    for n in (2, 8, 40):
        spaced = " ".join("youarestupid" * n)
        meant = " ".join(["you are stupid"] * n)
        assert toxicity.restore(spaced, insult_characters) == meant
        assert toxicity.restore(f"green {spaced} house", insult_characters) == f"green {meant} house"


def test_every_form_of_the_channel_is_decoded(insult_characters):
    forms = {
        "i d 1 0 t": "idiot", "m.0.r.0.n": "moron", "i  d  i  o  t": "idiot", "a55": "ass", "5h17": "shit", "he11": "hell",
        "1d107": "idiot", "a$$": "ass", "dumba$$": "dumbass", "h€ll": "hell", "h€££": "hell", "(\"dumba$$\").": "(\"dumbass\").",
    }
    assert {f: toxicity.restore(f"green {f} house", insult_characters)[6:-6] for f in forms} == forms
    for plain in ("hello! you are (hello) a house!!", "1 2 3 4 5", "2024 (10)"):
        assert toxicity.restore(plain, insult_characters) == plain


# ------------------------------------------------------------------ 2 and 5 repeated passages


def test_exact_and_fuzzy_passages_are_found(spark):
    passage = prose(1, 80)
    edited = passage.copy()
    edited[40] = "changed"
    texts = [
        (10, " ".join(prose(2, 60) + passage + prose(3, 60))),
        (11, " ".join(prose(4, 90) + passage + prose(5, 30))),
        (12, " ".join(prose(6, 50) + edited + prose(7, 50))),
        (13, " ".join(prose(8, 300))),
        *[(i or 0, t) for i, t in ODD],
    ]
    docs = docs_of(spark, texts)
    exact = {r.doc_id: r for r in sparse_suffixes.repeated_passages(docs).where("doc_id <> match_doc_id").collect()}
    assert (exact[11].start_word, exact[11].n_words, exact[11].match_doc_id, exact[11].match_start) == (90, 80, 10, 60)
    assert set(exact) == {11}
    fuzzy = chains.fuzzy_passages(docs).where("doc_id <> match_doc_id").collect()
    assert {r.doc_id for r in fuzzy} == {11, 12}
    # A seed at the passage's edge may first be sampled in 11, so 12 can have a shorter row with it too.
    first = next(r for r in fuzzy if r.doc_id == 12 and r.match_doc_id == 10)
    assert (first.start_word, first.n_words, round(first.identity, 4)) == (50, 80, round(79 / 80, 4))
    for operator in (sparse_suffixes.repeated_passages, chains.fuzzy_passages):
        assert operator(docs_of(spark, [])).count() == 0


def test_every_run_of_50_words_is_in_a_row_like_brute_force(spark):
    texts, r = {}, random.Random(50)
    for n in range(50, 63):  # in two documents, of which either can come first
        for k in range(4):
            passage = prose(1000 * n + k, n)
            for side in range(2):
                texts[len(texts)] = prose(r.random(), r.randrange(40)) + passage + prose(r.random(), r.randrange(40))
    for k in range(30):  # parts of one passage in many documents
        whole = prose(77, 140)
        start = r.randrange(80)
        texts[len(texts)] = prose(r.random(), 20) + whole[start : start + r.randrange(50, 63)] + prose(r.random(), 20)
    ids = list(texts)
    r.shuffle(ids)
    texts = dict(zip(ids, texts.values()))
    places = {}
    for i in sorted(texts):
        for p in range(len(texts[i]) - 49):
            places.setdefault(tuple(texts[i][p : p + 50]), []).append((i, p))
    later = {place for found in places.values() for place in found[1:]}
    got = sparse_suffixes.repeated_passages(docs_of(spark, [(i, " ".join(t)) for i, t in texts.items()])).collect()
    for g in got:
        assert texts[g.doc_id][g.start_word : g.start_word + g.n_words] == texts[g.match_doc_id][g.match_start : g.match_start + g.n_words]
        assert (g.match_doc_id, g.match_start) < (g.doc_id, g.start_word)
    assert {(g.doc_id, p) for g in got for p in range(g.start_word, g.start_word + g.n_words - 49)} == later


def test_passages_are_found_whose_parts_occurred_before(spark):
    texts, r = {}, random.Random(60)
    for n in (60, 60, 60, 80, 80, 80, 90, 90, 90) * 4:  # the first half, the last half, then the whole twice
        passage = prose(r.random(), n)
        for part in (passage[: n // 2], passage[n // 2 :], passage, passage):
            texts[len(texts)] = prose(r.random(), r.randrange(5, 40)) + part + prose(r.random(), r.randrange(5, 40))
    got = {(g.match_doc_id, g.doc_id): g.n_words for g in chains.fuzzy_passages(docs_of(spark, [(i, " ".join(t)) for i, t in texts.items()])).collect()}
    for i in range(0, len(texts), 4):
        assert got.get((i + 2, i + 3), 0) >= 50, i


def test_passages_with_a_word_changed_every_few_are_found(spark):
    texts, r = {}, random.Random(70)
    for k in range(200):  # runs of 6 to 11 words are left, so few that two texts seldom choose one place by content
        whole = prose(r.random(), r.randrange(60, 81))
        step = (7, 8, 10, 12)[k % 4]
        for side in (whole, [f"changed{i}" if i % step == k % step else w for i, w in enumerate(whole)]):
            texts[len(texts)] = prose(r.random(), r.randrange(5, 40)) + side + prose(r.random(), r.randrange(5, 40))
    got = chains.fuzzy_passages(docs_of(spark, [(i, " ".join(t)) for i, t in texts.items()])).collect()
    found = {(g.match_doc_id, g.doc_id) for g in got}
    assert [i for i in range(0, len(texts), 2) if (i, i + 1) not in found] == []
    for g in got:
        x, y = texts[g.doc_id][g.start_word : g.start_word + g.n_words], texts[g.match_doc_id][g.match_start : g.match_start + g.match_words]
        assert g.n_words == len(x) >= 50 and g.match_words == len(y) >= 50 and 0.8 <= g.identity <= 1


def test_two_passages_with_other_words_between_them_are_both_found(spark):
    first, second = prose(1, 400), prose(2, 400)
    texts = [(i, " ".join(prose(10 + i, 20) + first + prose(20 + i, 300) + second + prose(30 + i, 20))) for i in range(2)]
    got = chains.fuzzy_passages(docs_of(spark, texts)).collect()
    assert sorted((g.doc_id, g.start_word, g.n_words, g.match_doc_id, g.match_start, g.identity) for g in got) == [(1, 20, 400, 0, 20, 1.0), (1, 720, 400, 0, 720, 1.0)]


def test_repeats_within_a_document_match_an_earlier_place(spark):
    again, last = prose(3, 60), prose(4, 55)
    texts = {0: ["a"] * 3000, 1: ["b", "c"] * 1000, 2: again + prose(5, 300) + again + prose(6, 300) + again, 3: last + prose(7, 500) + last}
    got = chains.fuzzy_passages(docs_of(spark, [(i, " ".join(t)) for i, t in texts.items()])).collect()
    want = [(0, 1, 2999, 0, 0, 2999), (1, 2, 1998, 1, 0, 1998), (2, 360, 60, 2, 0, 60), (2, 720, 60, 2, 0, 60), (3, 555, 55, 3, 0, 55)]
    assert sorted(tuple(g)[:6] for g in got) == want


def test_first_places_of_classes_like_brute_force():
    r = np.random.default_rng(9)
    for repeated in (False, True):  # whether a doc_id has more than one text
        docs = r.permutation(12)[:8] - 3 if not repeated else r.integers(0, 4, 8)
        packer, seen = places.Packer(3), {}
        for t, doc in enumerate(docs):
            keys = r.integers(0, 15, 20).astype(np.uint64) << np.uint64(60)
            keys |= np.uint64(1)
            packer.add(int(doc), keys, np.arange(20))
            for pos, key in enumerate(keys.tolist()):
                n = sum(1 for (k, text, _), of in seen.items() for _ in of if k == key and text == t)
                seen.setdefault((key, t, n), []).append((int(doc), pos))
        want = {}
        for (key, t, n), of in seen.items():
            want.setdefault((key, n), []).extend(of)
        rows, got = packer.rows(), Counter()
        for i in range(len(rows["part"])):
            for p in places.unpacked_places(iter([{k: v[i : i + 1] for k, v in rows.items()}]), 1):
                c = places.classes(p)
                for at, first, size in zip(c.at, c.first, c.size):
                    got[int(p.key[at]), (int(p.of_text(at)), int(p.numbers[0][at])), (int(p.of_text(first)), int(p.numbers[0][first])), int(size)] += 1
        counts = Counter(key for key, _ in [(k, p) for (k, _), of in want.items() for p in of])
        assert got == Counter((key, p, min(of), len(of)) for (key, _), of in want.items() for p in of if counts[key] > 1)


def test_a_chain_is_the_best_ordered_set_of_links():
    a, b = [0, 10, 500, 20, 30], [100, 110, 115, 120, 130]
    assert chains.chain(a, b)[0] == [0, 1, 3, 4]
    assert sorted(j for c in chains.chain(a, b) for j in c) == list(range(5))


# ------------------------------------------------------------------ 3 main text


def test_main_text_of_a_page(spark):
    html = (
        "<html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body><header>Site</header>"
        "<nav><ul><li><a href=/x>x</a></li></ul></nav><div class='ad'>Buy, now, cheap</div>"
        "<article><h1>Head &amp; line</h1><p><b>First,   one.<br><p>Second a < b, c&eacute;</p><ul><li>item, one</li></ul></article>"
        "<div class='comments'><p>A long, long, long comment by a reader, with commas, and more.</p></div><footer>&copy; me</footer>"
    )
    assert main_text.main_text(html) == "Head & line\nFirst, one.\nSecond a < b, cé\nitem, one"
    divs = "<body><div id=menu><a>m</a></div><div><div><p>" + "Long text, with commas, here. " * 5 + "</p><p>More, of it.</p></div></div><form><p>x</p></form>"
    assert main_text.main_text(divs).split("\n")[1] == "More, of it."
    pages = spark.createDataFrame([(1, "u", html, "z"), (2, "u", None, "z"), (3, None, "", "z"), (4, "u", "<div>" * 3000 + "deep", "z")], "page_id long, url string, html string, text string")
    got = {r[0]: r[2:] for r in rows(main_text.extract_main_text(pages))}
    assert got[2] == ("", 0) and got[3] == ("", 0) and got[4] == ("deep", 4) and got[1][1] == len(got[1][0])


ARTICLE = "<h1>Head</h1><p>First, with commas, and some length to it.</p><p>Second, with more, much more text in it.</p>"


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="content has-sidebar">{ARTICLE}</div><div class="sidebar"><p>Buy, now</p></div>',
        f'<div id="content" class="no-comments">{ARTICLE}</div><div class="comments"><p>A reader, long comment, with commas, and more.</p></div>',
        f'<form action="/x"><div>{ARTICLE}</div><input name=q></form><nav><a href=x>menu</a></nav>',
        f'<div class="page-banner-wrapper"><div class="social">{ARTICLE}</div></div><footer>foot</footer>',
        f'<article><section class="social-history">{ARTICLE}</section></article><div class="notice"><p>Notice, of something</p></div>',
        f'<article><div class="notice-board-story">{ARTICLE}</div></article><form><p>Subscribe, please</p></form>',
    ],
)
def test_an_article_is_not_lost_to_a_class_or_a_form(page):
    assert main_text.main_text(f"<html><body>{page}</body></html>") == "Head\nFirst, with commas, and some length to it.\nSecond, with more, much more text in it."


def test_names_of_other_parts_leave_them_out():
    for name in ("site-footer", "cookie-banner", "comment-list", "share-buttons", "ad-slot", "sidebar-inner", "related-posts", "reader-comments", "main-menu", "ad"):
        page = f'<article>{ARTICLE}<div class="{name}"><p>Other text, of another part, with commas.</p></div></article>'
        assert "Other" not in main_text.main_text(page), name


HOSTILE = {
    "quotes": "<a '" * 20_000, "attributes": '<p a="' * 20_000, "closed late": '<p a="' * 20_001 + ">", "open": "<a" * 40_000, "raw": "<script" * 20_000,
    "raws": "<script>" * 20_000, "number": "&#" + "9" * 100_000 + ";", "less": "<" * 200_000, "inline": "<b>" * 20_000 + "x<hr>" * 20_000,
    "mixed": "<a \"'>" * 20_000, "long": "<div class=\"x\" a='y\">'><p>text, text</p>" * 25_000,
}


@pytest.mark.parametrize("kind", HOSTILE)
def test_hostile_pages_take_time_in_proportion(kind):
    start = time.process_time()
    main_text.main_text(HOSTILE[kind])
    assert time.process_time() - start < 10


def test_plain_and_odd_tags_are_cut_alike():
    r, signs = random.Random(2), ["<", ">", "/", "p", " ", "a", "=", '"', "'", "!", "-", "\n", "script"]
    for _ in range(3000):
        page = "".join(r.choice(signs) for _ in range(r.randrange(1, 40)))
        tokens = list(main_text._Tokens(page))
        assert all(a < b for a, b, *_ in tokens) and all(x[1] <= y[0] for x, y in zip(tokens, tokens[1:]))
        for start, end, tag, closing, rest in tokens:
            if tag:  # the first `>` outside quotes ends it
                assert page[start:end] == f"<{'/' * closing}{page[start + 1 + closing : start + 1 + closing + len(tag)]}{rest}>"
                assert not re.sub(r"\"[^\"]*\"|'[^']*'", "", rest).strip("abcdefghijklmnopqrstuvwxyz =/!<-\n")


# ------------------------------------------------------------------ 4 decontamination


def brute_items(text, items):
    def words(t):
        return re.findall(r"\w+", t.lower())

    def shingles(w):
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])

    found, w = set(), words(text)
    for item_id, item in items:
        x, n = shingles(words(item)), len(words(item))
        for s in range(max(1, len(w) - n + 1)):
            y = shingles(w[s : s + n])
            union = sum((x | y).values())
            if union and sum((x & y).values()) / union >= 0.8:
                found.add(item_id)
    return found


def test_benchmark_items_are_found_like_brute_force(spark):
    items = [(i, " ".join(prose(100 + i, 40))) for i in range(6)] + [(20, "three words only"), (21, None), (22, "")]
    near = items[1][1].split()
    near[1] = "edited"
    texts = [
        (1, " ".join(prose(1, 50)) + " " + items[0][1].upper().replace(" ", ", ") + " end"),
        (2, " ".join([*prose(2, 9), *near, *prose(3, 9)])),
        (3, " ".join(prose(4, 200) + items[2][1].split()[:25])),
        (4, "Three words, only!"),
        *ODD,
    ]
    found = decontaminate.contaminated(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    known = [(i, t) for i, t in items if t]
    assert got == {(i, item) for i, t in texts if i and t and len(t) < 5000 for item in brute_items(t, known)}
    assert {(1, 0), (2, 1), (4, 20)} <= got
    assert decontaminate.contaminated(docs_of(spark, texts), spark.createDataFrame([], "item_id long, text string")).count() == 0


# ------------------------------------------------------------------ 6 SimHash


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize("dense", [1, 32])
def test_links_have_the_components_of_all_pairs(spark, dense):
    r = random.Random(5)
    values = {r.getrandbits(64) for _ in range(40)}
    for v in list(values)[:8]:
        for _ in range(12):
            v ^= 1 << r.randrange(64)
            values.add(v)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    parent = {v: v for v in signed}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for x in signed:
        for y in signed:
            if ((x ^ y) & (2**64 - 1)).bit_count() <= 2:
                parent[max(find(x), find(y))] = min(find(x), find(y))
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), dense)
    got = dict(rows(components.components(edges)))
    assert {v: got.get(v, v) for v in signed} == {v: find(v) for v in signed}


def test_simhash_of_odd_texts_and_one_kept_of_each_group(spark):
    texts = [*ODD, (30, " ".join(prose(1, 100))), (31, " ".join(prose(1, 100)).upper()), (32, "W1 w2")]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert all(got[i].fingerprint == format(brute_print(t or ""), "016x") for i, t in texts)
    assert got[31].component_id == 30 and got[3].component_id == got[1].component_id == 1
    kept = simhash.keep_one(docs_of(spark, texts))
    assert kept.columns == docs_of(spark, []).columns
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [None, 1, 4, 5, 6, 7, 30, 32]
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_rows_of_one_id_in_different_groups_all_stay(spark):
    one, two, three = (" ".join(prose(n, 80)) for n in (21, 22, 23))
    docs = docs_of(spark, [(1, one), (1, two), (1, two), (None, three), (None, "no id, other words"), (4, two)])
    kept = simhash.keep_one(docs)
    assert sorted(r.text for r in kept.collect()) == sorted([one, two, three, "no id, other words"])


# ------------------------------------------------------------------ 7 line dedup


def brute_lines(texts, least=line_runs.LEAST_WORDS):
    seen, out = set(), {}
    for doc_id, text in texts:
        lines, gone = (text or "").split("\n"), set()
        for start in range(len(lines)):
            runs = [tuple(lines[start:end]) for end in range(start + 1, len(lines) + 1)]
            for run in runs:
                if run in seen and sum(len(x.split()) for x in run) >= least:
                    gone |= set(range(start, start + len(run)))
            seen.update(runs)
        out[doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_runs_of_any_length_and_their_maximal_ones(spark):
    texts = [(1, "a\nb\nc d\nx"), (2, "y\na\nb\nc d\nz"), (3, "\n".join("pqrstuv")), (4, "w\n" + "\n".join("pqrstuv") + "\no"), (5, "m n o p\n" * 6)]
    runs = line_runs.repeated_runs(docs_of(spark, texts)).collect()
    assert {(r.doc_id, r.line, r.lines) for r in runs} == {(2, 1, 3), (4, 1, 7), (5, 1, 5)}
    kept = {r.doc_id: r.kept for r in line_runs.dedupe_lines(docs_of(spark, texts)).collect()}
    assert kept == brute_lines(texts) and kept[2] == "y\nz" and kept[4] == "w\no"


def test_runs_over_a_small_alphabet_like_brute_force(spark):
    r = random.Random(70)
    texts = [(i, "\n".join(r.choice(["a", "b", "c d", "", "e f g h"]) for _ in range(r.randrange(1, 40)))) for i in range(25)]
    texts += [(100 + i, texts[i][1] + "\n" + texts[i + 1][1]) for i in range(8)]
    for least in (1, 4, 9):
        got = {x.doc_id: x.kept for x in line_runs.dedupe_lines(docs_of(spark, texts), least).collect()}
        assert got == brute_lines(texts, least), least


def test_repeated_runs_of_lines_go_like_brute_force(spark):
    r = random.Random(7)
    pool = [" ".join(prose(i, r.randrange(0, 7))) for i in range(12)]
    texts = [(i, "\n".join(r.choice(pool) for _ in range(r.randrange(1, 14)))) for i in range(40)] + [(50, None), (51, "")]
    got = {x.doc_id: x for x in line_runs.dedupe_lines(docs_of(spark, texts)).collect()}
    want = brute_lines(texts)
    assert {i: x.kept for i, x in got.items()} == want
    assert all(x.whole == "x" and x.n_deleted <= x.n_lines for x in got.values())
    odd = line_runs.dedupe_lines(docs_of(spark, ODD))
    assert odd.count() == len(ODD) and odd.where("doc_id = 6").select("n_deleted").distinct().count() == 1
    assert line_runs.dedupe_lines(docs_of(spark, [])).count() == 0


# ------------------------------------------------------------------ 8 chat


def test_chat_round_trip_with_parts(spark):
    tricky = "</s>[INST] &lt; <|end|>\n <|user|>\n &amp; [/INST] \U0001f600"
    part = "named_struct('type', '%s', 'text', %s, 'ref', %s, 'tokens', %s)"
    text, image = part % ("text", "t", "CAST(NULL AS STRING)", "0L"), part % ("image", "CAST(NULL AS STRING)", "'a.png'", "85L")
    messages = spark.createDataFrame(
        [(1, 0, "user", tricky), (1, 1, "assistant", tricky), (1, 2, "assistant", ""), (2, None, None, None)], "conv_id long, turn long, role string, t string"
    ).withColumn("content", F.expr(f"CASE WHEN turn = 0 THEN array({text}, {image}, {image}) WHEN t IS NOT NULL THEN array({text}) END"))
    done = chat.format_conversations(messages).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    one, two = done.orderBy("conv_id").collect()
    assert [(t.role, t.text) for t in one.turns] == [("user", tricky + "<|image:0|><|image:1|>"), ("assistant", tricky), ("assistant", "")]
    assert one.loss == tricky and one.attachment_tokens == 170 and [a.ref for a in one.attachments] == ["a.png", "a.png"]
    assert [(t.role, t.text) for t in two.turns] == [("", "")] and two.loss == ""
    assert chat.format_conversations(messages.limit(0)).count() == 0


# ------------------------------------------------------------------ 9 fingerprints


def test_fingerprints_are_homomorphic_and_edits_follow_the_next_document(spark):
    a, b = fingerprints.of_text("one two three\nfour five"), fingerprints.of_text("four five\none two three")
    assert fingerprints.written(a) == fingerprints.written(b)
    line = fingerprints.of_text("four five")
    rest = fingerprints.delete(a, line)
    assert fingerprints.written(rest) == fingerprints.written(fingerprints.of_text("one two three"))
    assert fingerprints.written(fingerprints.insert(rest, line)) == fingerprints.written(a)
    assert fingerprints.written(fingerprints.of_text("one two three\nfour six")) != fingerprints.written(a)
    texts = [(i, " ".join(prose(i, 40 + i))) for i in range(57)] + [(60, None), (61, "é")]
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(docs_of(spark, texts), rows_per_range=7).collect()}
    assert len(got) == len(texts)
    for (i, t), (_, following) in zip(texts, texts[1:] + texts[:1]):
        new = fingerprints.edited(t or "", following or "")
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t or ""), hashlib.sha256(new.encode()).hexdigest())
        assert got[i].edited_fingerprint == fingerprints.written(fingerprints.of_text(new))
    assert all(got[i].near_edited > got[i].near_next + 0.2 for i in range(55))
    assert fingerprints.fingerprint_edits(docs_of(spark, [(1, "only one")])).first().near_next == 1.0
    assert fingerprints.fingerprint_edits(docs_of(spark, ODD)).count() == len(ODD)
    assert fingerprints.fingerprint_edits(docs_of(spark, [])).count() == 0


# ------------------------------------------------------------------ 10 packing


def test_ids_are_those_of_the_tokenizer():
    path = tokenizer_file()
    whole = Tokenizer.from_file(path)
    for text in ["", " ", "a ", " a", "a  b", "a\n b", "a \nb", "don't 's x", "x <|endoftext|> y", "\n\n a", "a. b.. c, d., .", "é　ß, 1. 2,", " ".join(prose(1, 500))]:
        want = np.array([*whole.encode(text, add_special_tokens=False).ids, 0], dtype="<u4").tobytes()
        assert b"".join(in_portions([text], path)) + packing.END == want, text


def test_latin_words_with_signs_go_to_the_bare_model():
    words = ["\u00dcberall", "\u00f1and\u00fa,", "na\u00efve!!", "Stra\u00dfe$$$", "\u00e9t\u00e9.", "plain", "two%&,"]
    letters = "".join(chr(c) for c in range(0x41, 0x100) if re.fullmatch(f"[{tokens._LATIN}]", chr(c)))
    texts = [" ".join(words), "\n".join(words), " " + words[1] + "\n" + letters + " " + letters + "-;"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        own, whole = tokens.TextEncoder(tokenizer_file(name)), Tokenizer.from_file(tokenizer_file(name))
        tokens_of_signs = own.encode([", !! $$$ . %&, -;", "\r".join(["a"])])  # signs alone are the tokenizer's
        asked: list[str] = []
        own._ids, kept = (lambda text: asked.append(text) or whole.encode(text, add_special_tokens=False).ids), own.tokenizer

        class Watched:
            def encode_batch_fast(self, given, **options):
                asked.extend(given)
                return kept.encode_batch_fast(given, **options)

        own.tokenizer = Watched()
        assert own.encode(texts) == [np.array(whole.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
        assert not re.search(f"[{tokens._LATIN}]", "".join(asked)), asked


def test_batches_are_cut_to_the_rows_asked_for(spark):
    def kernel(batches):
        for b in batches:
            yield {"id": b["id"], "together": [len(b["id"])] * len(b["id"])}

    for rows in (0, 1, 7, 1000):
        got = map_columns(spark.range(0, 100, 1, 2), kernel, "id long, together int", rows).collect()
        assert sorted(r.id for r in got) == list(range(100))
        assert max(r.together for r in got) == min(rows or 50, 50)


def test_places_of_the_plan_as_arrays():
    chosen = [(((5, 1), (2, 2)), 3), (((5, 2),), 2), (((2, 4),), 1)]
    keys, first, times, at = packing._slots(chosen)
    places = []
    for length, n in ((5, 7), (2, 10)):
        key = (length << packing.RANK_BITS) + np.arange(n)
        i = np.searchsorted(keys, key, side="right") - 1
        copy, nth = np.divmod(key - keys[i], times[i])
        places += [(s, o, length) for s, o in zip((first[i] + copy).tolist(), (at[i] + nth * length).tolist())]
    want = [p for s in range(3) for p in ((s, 0, 5), (s, 5, 2), (s, 7, 2))] + [p for s in (3, 4) for p in ((s, 0, 5), (s, 5, 5))] + [(5, 2 * k, 2) for k in range(4)]
    assert sorted(places) == sorted(want)


def test_every_piece_has_one_place(spark):
    texts = [(100 + i, " ".join(prose(i, random.Random(i).randrange(1, 900)))) for i in range(60)] + ODD
    got = packing.pack(docs_of(spark, texts), tokenizer_file(), capacity=512, rounds=40).collect()
    at: dict = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert at.get(r.sequence_id, 0) == r.offset
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 512 and len(at) <= -(-sum(r.length for r in got) // 512) * 1.1 + 1
    pieces = [r for r in got if r.doc_id == 5]
    assert len(pieces) > 2 and all(r.length == 512 for r in pieces if r.piece) and {r.piece for r in pieces} == set(range(len(pieces)))
    assert packing.pack(docs_of(spark, []), tokenizer_file()).count() == 0
    # Every row of every document, cut and checked anew.
    whole, want = Tokenizer.from_file(tokenizer_file()), []
    for doc_id, text in texts:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 512 or min(512, len(ids))
        cuts = [0, *range(first, len(ids), 512), len(ids)] if len(ids) > first else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((str(doc_id), piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)


@pytest.mark.parametrize("times", [1, 100, 1000, 5000])
def test_packing_is_no_worse_than_best_fit_and_planned_by_counts(times):
    histogram = {n: times for n in range(1, 2048)}
    chosen = packing.plan(histogram)
    assert sum(n for _, n in chosen) <= 1.001 * sum(packing.best_fit_decreasing(histogram, {}, 2048).values())
    assert sum(n for _, n in chosen) <= 1.001 * -(-sum(n * times for n in range(1, 2048)) // 2048)
    assert len(chosen) <= 2 * 2048
    assert Counter({l: sum(n * c for cfg, c in chosen for k, n in cfg if k == l) for l in histogram}) == Counter(histogram)


def test_best_fit_by_counts_is_best_fit_piece_by_piece():
    r = random.Random(12)
    for _ in range(50):
        histogram = {r.randrange(1, 40): r.randrange(1, 9) for _ in range(12)}
        rooms: list[int] = []
        for length in sorted((l for l, n in histogram.items() for _ in range(n)), reverse=True):
            fitting = [i for i, room in enumerate(rooms) if room >= length]
            i = min(fitting, key=lambda i: rooms[i], default=None)
            if i is None:
                rooms.append(40)
                i = len(rooms) - 1
            rooms[i] -= length
        assert sum(packing.best_fit_decreasing(histogram, {}, 40).values()) == len(rooms)


def test_plan_covers_the_histogram_exactly():
    histogram = {1100: 50, 700: 30, 950: 20, 400: 100, 2048: 7, 3: 11}
    chosen = packing.plan(histogram, rounds=60)
    assert Counter({l: sum(n * c for cfg, c in chosen for k, n in cfg if k == l) for l in histogram}) == Counter(histogram)
    assert all(sum(l * n for l, n in cfg) <= 2048 for cfg, _ in chosen)


def test_a_small_histogram_is_packed_to_its_bound():
    r = random.Random(5)
    histogram = Counter(min(2048, int(r.lognormvariate(5.5, 1.2)) + 2) for _ in range(1500))
    bound = -(-sum(l * n for l, n in histogram.items()) // 2048)
    assert sum(n for _, n in packing.plan(histogram)) <= bound + 2


# ------------------------------------------------------------------ queries and pipeline


def test_all_operators_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages_keep_columns_and_act(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(9)
    toxic = ["idiot moron", "moron loser", "idiot loser"]
    texts = [(i, " ".join(prose(i, 60)) + (" " + r.choice(toxic) if i % 5 == 0 else "")) for i in range(200)]
    shared = " ".join(prose(901, 30))
    item = " ".join(prose(902, 30))
    texts += [(301, shared + "\n" + " ".join(prose(903, 30))), (302, " ".join(prose(904, 30)) + "\n" + shared), (303, " ".join(prose(905, 20)) + " " + item), (304, texts[1][1].upper()), (None, None), (305, "")]
    labels = [(i, 1, int(i % 5 == 0)) for i in range(200)]
    docs_of(spark, texts).drop("whole").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        kept.append({x.doc_id: x.text for x in docs.collect()})
    assert not [i for i in kept[0] if i is not None and i < 200 and i % 5 == 0]
    assert kept[1][302] == texts[201][1].split("\n")[0] and kept[1][301] == texts[200][1]
    assert 304 not in kept[2] and 1 in kept[2] and (305 in kept[2]) != (None in kept[2])
    assert 303 in kept[2] and 303 not in kept[3] and len(kept[2]) - len(kept[3]) == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {x.doc_id for x in packed.collect()} == set(kept[3])


CLASHING = ["kept", "n_lines", "n_deleted", "longest_run", "runs", "__row", "__id", "__text", "__gone", "__kept", "score", "value", "whole", "row", "id", "a.b", "of`tick"]


@pytest.fixture
def clashing(spark):
    """Rows without id, of one id, equal rows; extra columns named like inner ones."""
    r = random.Random(4)
    own = [" ".join(prose(i, 40)) for i in range(12)]
    rows_ = [(None, own[0]), (None, own[1]), (5, own[2]), (5, own[3]), (6, own[4]), (6, own[4]), (7, None), (8, ""), (9, own[5] + "\n" + own[2]), (None, None)]
    rows_ += [(100 + i, " ".join(prose(500 + i, 30)) + (" idiot moron" if i % 4 == 0 else "")) for i in range(60)]
    schema = DOCS.rsplit(",", 1)[0] + "".join(f", `{c.replace('`', '``')}` string" for c in CLASHING)
    r.shuffle(rows_)
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[f"{c}-{i}" for c in CLASHING]) for i, t in rows_], schema)


def whole_rows(df):
    return Counter(tuple(x) for x in df.collect())


def test_stages_keep_clean_rows_and_columns_whatever_the_ids_and_names(spark, clashing, tmp_path):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    labels = [(100 + i, 1, int(i % 4 == 0)) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, " ".join(prose(0, 40))), (2, " ".join(prose(2, 40)))]  # in one row without id, in one row of id 5 and in 9
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    before = whole_rows(clashing)
    held = {" ".join(prose(0, 40)), " ".join(prose(2, 40)), " ".join(prose(5, 40)) + "\n" + " ".join(prose(2, 40))}
    got = stages["benchmark_decontamination"](spark, clashing, str(tmp_path))
    assert got.columns == clashing.columns and whole_rows(got) == Counter({k: n for k, n in before.items() if k[1] not in held})
    got = stages["toxicity"](spark, clashing, str(tmp_path))
    assert got.columns == clashing.columns and got.schema == clashing.schema
    assert whole_rows(got) == Counter({k: n for k, n in before.items() if "idiot" not in (k[1] or "")})
    got = stages["simhash_near_dedup"](spark, clashing, str(tmp_path))
    assert got.columns == clashing.columns
    kept = whole_rows(got)
    assert set(kept) - set(before) == set() and max(kept.values()) == 1
    assert {k[:2] for k in before} - {k[:2] for k in kept} <= {(7, None), (8, ""), (None, None)} and len({k[1] or "" for k in kept}) == len({k[1] or "" for k in before})
    got = stages["line_dedup"](spark, clashing, str(tmp_path))
    changed = {k: n for k, n in whole_rows(got).items() if k not in before}
    assert got.columns == clashing.columns and [(k[0], k[1], k[4]) for k in changed] == [(9, " ".join(prose(5, 40)), len(" ".join(prose(5, 40))))]
    assert sum(whole_rows(got).values()) == sum(before.values())
    for name, stage in stages.items():
        assert stage(spark, clashing.limit(0), str(tmp_path)).count() == 0, name


def test_operators_name_their_columns_beside_clashing_ones(spark, clashing):
    deduped = line_runs.dedupe_lines(clashing)
    assert deduped.columns == [*clashing.columns, "kept_1", "n_lines_1", "n_deleted_1", "longest_run_1"]
    assert whole_rows(deduped.select(*[F.col(f"`{c.replace('`', '``')}`") for c in clashing.columns])) == whole_rows(clashing)
    model = toxicity.ToxicityModel(toxicity.character_model(clashing.limit(5)), {}, -3.0)
    scored = toxicity.with_scores(clashing, model)
    assert scored.columns == [*clashing.columns, "score_1"] and scored.count() == clashing.count()
