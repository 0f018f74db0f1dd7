"""Toxicity of noisy texts: restore the characters first, then score the restored words.

A noisy stretch (a word with letters and look-alike digits or signs, a letter three or more times in a row, single
letters or look-alikes parted by spaces or signs) is a lattice of what its writer may have meant: a sign stands for
itself or a letter it looks like, a separator may be dropped, a run of a letter may be shorter.  Viterbi
decoding takes the reading with the best sum of channel and language-model scores.  The language model
counts character trigrams over all documents, in tables of fixed size.  Plain stretches have one
reading, themselves.

Restored words give evidence: which of the words and word beginnings, learned from labelled rows, a text
holds.  A logistic model with non-negative weights turns them into a score from 0 to 1.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.rows import Columns, free_name, identified, map_columns, stored, unpacked, with_value

BINS = 1 << 18  # of the trigram table; the tables of shorter contexts are smaller
SAMPLE = 20_000  # expected number of labelled rows at most that the classifier is fitted on
CANDIDATES, FEATURES = 20_000, 4096  # features counted in clean texts, and kept
LEAST_TOXIC, LEAST_SHARE = 4, 0.003  # number and share of toxic texts that a feature is in
LEAST_LIFT = 8.0  # how many times likelier it is in toxic texts than in clean ones
PREFIXES = (3, 4, 5, 6, 7, 8)

# What a sign may stand for (fixed values).
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y",
}
SUBSTITUTE, DROP, SHORTEN, KEEP_SIGN, KEEP_EDGE = -1.0, -0.3, -0.5, -9.0, -1.0  # log scores of the channel
SEPARATORS = " .-_*~"
CLOSING = "!|+"  # signs that are punctuation at the end of a word
_SIGNS = re.escape("".join(LOOKALIKES))
_LETTER = r"[^\W\d_]"
_UNIT, _BETWEEN = rf"(?:{_LETTER}|[{_SIGNS}])", rf"[{re.escape(SEPARATORS)}]+"
PARTED = re.compile(rf"(?<!\w)(?:{_UNIT}{_BETWEEN}){{2,}}{_UNIT}(?!\w)")
TRIPLED = re.compile(rf"({_LETTER})\1\1")
_ANY_LETTER, _ANY_SIGN = re.compile(_LETTER), re.compile(f"[{_SIGNS}]")
_STRIP = string.punctuation + "«»„“”‚’‘¡¿…"
_EDGES = "".join(c for c in _STRIP if c not in LOOKALIKES)
_SIGN_POINTS = np.array(sorted(ord(c) for c in LOOKALIKES if ord(c) > 127))

# Classes of code points below 128: 1 letter, 2 sign, 3 separator.  Higher ones count as letters.
_CLASS = np.zeros(128, dtype=np.int8)
for _c in range(128):
    _CLASS[_c] = 1 if chr(_c).isalpha() else 2 if chr(_c) in LOOKALIKES else 3 if chr(_c) in SEPARATORS else 0


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def noise(points: np.ndarray) -> tuple[bool, bool]:
    """Whether a lower-case text may hold parted letters, and whether noisy words.

    Cheap, and never wrong when it says no.
    """
    kind = np.where(points < 128, _CLASS[np.minimum(points, 127)], 1)
    kind[np.isin(points, _SIGN_POINTS)] = 2
    letter, sign = kind == 1, kind == 2
    between = kind == 3
    apart = between[:-2] & (letter | sign)[1:-1] & between[2:]
    tripled = (points[2:] == points[1:-1]) & (points[1:-1] == points[:-2]) & letter[2:]
    if sign.any() and not tripled.any():
        word = np.cumsum((points == 32) | ((points > 8) & (points < 14)))
        with_letter = np.zeros(word[-1] + 1, dtype=bool)
        with_letter[word[letter]] = True
        mixed = bool(with_letter[word[sign]].any())
    else:
        mixed = bool(tripled.any())
    return bool(apart.any()), mixed


@dataclass
class CharacterModel:
    """Log probabilities of a character after two others, from hashed counts of n-grams."""

    three: np.ndarray
    two: np.ndarray
    one: np.ndarray

    def __post_init__(self) -> None:
        self.total = float(self.one.sum() + 0.1 * len(self.one))

    def score(self, a: int, b: int, c: int) -> float:
        uni = (self.one[_bin1(c)] + 0.1) / self.total
        bi = (self.two[_bin2(b, c)] + 20 * uni) / (self.one[_bin1(b)] + 20)
        return math.log((self.three[_bin3(a, b, c)] + 20 * bi) / (self.two[_bin2(a, b)] + 20))


def _bin1(c):
    return c % 4096


def _bin2(b, c):
    return (b * 40503 + c * 2749) % 65536


def _bin3(a, b, c):
    return (a * 1000003 + b * 40503 + c * 2749) % BINS


def _spaced(points: np.ndarray) -> np.ndarray:
    """Letters as they are, every run of others one blank."""
    kind = np.where(points < 128, _CLASS[np.minimum(points, 127)], 1)
    kept = np.where(kind == 1, points, 32).astype(np.int64)
    blank = kept == 32
    return kept[~(blank & np.append(False, blank[:-1]))]


def character_counts(docs: DataFrame) -> DataFrame:
    """(n, bin, count) of the character n-grams of all texts, n from 1 to 3."""

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        tables = {1: np.zeros(4096, np.int64), 2: np.zeros(65536, np.int64), 3: np.zeros(BINS, np.int64)}
        held, size = [], 0

        def count() -> None:
            x = np.concatenate([np.append([32, 32], t) for t in held])
            for n, bins in ((1, _bin1(x[2:])), (2, _bin2(x[1:-1], x[2:])), (3, _bin3(x[:-2], x[1:-1], x[2:]))):
                tables[n] += np.bincount(bins, minlength=len(tables[n]))

        for b in batches:
            for text in b["text"]:
                held.append(_spaced(code_points(text.lower())))
                size += len(held[-1])
                if size > 2_000_000:
                    count()
                    held, size = [], 0
        if held:
            count()
        for n, counts in tables.items():
            at = np.flatnonzero(counts)
            yield {"n": [n] * len(at), "bin": at, "count": counts[at]}

    partial = map_columns(docs.select("text"), kernel, "n int, bin int, count long")
    return partial.groupBy("n", "bin").agg(F.sum("count").alias("count"))


def character_model(docs: DataFrame) -> CharacterModel:
    """At most 4096 + 65536 + BINS numbers reach the driver, whatever the number of texts."""
    tables = {1: np.zeros(4096), 2: np.zeros(65536), 3: np.zeros(BINS)}
    counts = character_counts(docs).toPandas()
    for n, part in counts.groupby("n"):
        tables[n][part["bin"].to_numpy()] = part["count"].to_numpy()
    return CharacterModel(tables[3], tables[2], tables[1])


def decode(noisy: str, model: CharacterModel) -> str:
    """The best reading of a lower-case noisy stretch."""
    parted = bool(PARTED.fullmatch(noisy))
    end = len(noisy)
    while end and noisy[end - 1] in CLOSING:
        end -= 1
    # State: the last two characters; value: (score, state before, written).  All edges from a place are equally long.
    layers: list[dict[tuple[int, int], tuple[float, tuple[int, int], str]]] = [{(32, 32): (0.0, (32, 32), "")}]
    settled: list[str] = []

    def settle(state: tuple[int, int]) -> None:
        """What was written on the best way to a state of the last layer is the reading so far."""
        written = []
        for layer in layers[:0:-1]:
            _, state, out = layer[state]
            written.append(out)
        settled.extend(reversed(written))

    i = 0
    while i < len(noisy):
        c, used = noisy[i], 1
        edges: list[tuple[str, float]] = [(x, SUBSTITUTE) for x in LOOKALIKES.get(c, "")]  # written, score
        if c.isalpha():
            while i + used < len(noisy) and noisy[i + used] == c:
                used += 1
            if used > 2:  # a run of three or more is meant as one or two, or stands
                edges += [(c, SHORTEN), (c * 2, SHORTEN), (c * used, 2 * SHORTEN)]
            else:
                used = 1
                edges.append((c, 0.0))
        elif c in SEPARATORS and parted:  # as many separators as there are go or stand together
            while noisy[i + used] in SEPARATORS:
                used += 1
            edges += [("", DROP), (noisy[i : i + used], KEEP_SIGN)]
        else:
            plain = c in SEPARATORS or i >= end or (c == "(" and i == 0)
            edges.append((c, KEEP_EDGE if plain and c in LOOKALIKES else 0.0 if plain else KEEP_SIGN))
        follow: dict[tuple[int, int], tuple[float, tuple[int, int], str]] = {}
        for (a, b), (score, *_) in layers[-1].items():
            for out, cost in edges:
                total, x, y = score + cost, a, b
                for o in out:
                    z = ord(o) if o.isalpha() else 32
                    if z == y == 32:  # a run of others counts as one blank, as in the model
                        continue
                    total, x, y = total + model.score(x, y, z), y, z
                if (x, y) not in follow or follow[x, y][0] < total:
                    follow[x, y] = (total, (a, b), out)
        layers.append(follow)
        i += used
        if len(follow) == 1:  # every way leads through here, so what lies before need not be held
            settle(*follow)
            layers = [follow]
    last = layers[-1]
    settle(max(last, key=lambda ab: last[ab][0] + (0.0 if ab[1] == 32 else model.score(*ab, 32))))
    return "".join(settled)


def _read(raw: str, model: CharacterModel, known: dict[str, str]) -> str:
    if raw not in known:
        if len(known) > 50_000:
            known.clear()
        known[raw] = decode(raw, model)
    return known[raw]


def _word(word: str, model: CharacterModel, known: dict[str, str]) -> str:
    core = word.strip(_EDGES)
    if not (_ANY_SIGN.search(core) and _ANY_LETTER.search(core) or TRIPLED.search(core)):
        return word
    at = word.index(core)
    return word[:at] + _read(core, model, known) + word[at + len(core) :]


def _rejoined(text: str, model: CharacterModel, known: dict[str, str]) -> tuple[str, bool]:
    """The lower-case text with parted letters read, and whether it may hold noisy words."""
    text = text.lower()
    parted, noisy = noise(code_points(text))
    return (PARTED.sub(lambda m: _read(m[0], model, known) if _ANY_LETTER.search(m[0]) else m[0], text) if parted else text), noisy


def restore(text: str, model: CharacterModel, known: dict[str, str] | None = None) -> str:
    """The text in lower case with every noisy stretch replaced by its best reading."""
    known = {} if known is None else known
    text, noisy = _rejoined(text, model, known)
    return re.sub(r"\S+", lambda m: _word(m[0], model, known), text) if noisy else text


def restored_words(text: str, model: CharacterModel, known: dict[str, str]) -> set[str]:
    """The distinct words of the restored text; each is read once."""
    text, noisy = _rejoined(text, model, known)
    words = set(text.split())
    return {w for word in words for w in (_word(word, model, known).split() if noisy else (word,))}


def features_of(word: str) -> list[str]:
    """The word itself (marked by a blank after it) and its beginnings."""
    word = word.strip(_STRIP)
    return [word + " ", *[word[:n] for n in PREFIXES if len(word) > n]] if len(word) > 2 else []


def _texts_features(text: str, model: CharacterModel, known: dict[str, str]) -> set[str]:
    return {f for w in restored_words(text, model, known) for f in features_of(w)}


@dataclass
class ToxicityModel:
    characters: CharacterModel
    weights: dict[str, float]
    bias: float

    def __post_init__(self) -> None:
        self.beginnings = {f[:3] for f in self.weights}

    def score(self, text: str, known: dict[str, str] | None = None) -> float:
        total, seen = self.bias, set()
        for word in restored_words(text, self.characters, {} if known is None else known):
            if word[:3] in self.beginnings or word[:1] in _STRIP:
                for f in features_of(word):
                    if f in self.weights and f not in seen:
                        seen.add(f)
                        total += self.weights[f]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def fit(docs: DataFrame, labels: DataFrame, characters: CharacterModel, sample: int = SAMPLE) -> ToxicityModel:
    """Fit on labelled rows (doc_id, toxic 0 or 1; others are ignored), of which about `sample` at most are
    used, chosen by a hash of the id; of equal texts one.  Without toxic rows every score is the bias."""
    labelled = labels.where("toxic IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").dropDuplicates(["doc_id"])
    n = labelled.count()
    if n > sample:
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    # The side with ids and labels is small and its bound is `sample`.
    rows = docs.join(F.broadcast(labelled), "doc_id").select("text", "toxic")
    rows = stored(rows.dropDuplicates(["text"]).repartition(32, F.xxhash64("text")), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    prior = math.log((n_toxic + 0.5) / (n_clean + 0.5))
    if not n_toxic:
        return ToxicityModel(characters, {}, min(prior, -3.0))

    def found(batches: Iterator[Columns], among: set[str] | None) -> Iterator[Counter]:
        known: dict[str, str] = {}
        counts: Counter[str] = Counter()
        for b in batches:
            for text in b["text"]:
                f = _texts_features(text, characters, known)
                counts.update(f if among is None else f & among)
        yield counts

    def counted(part: DataFrame, among: set[str] | None) -> DataFrame:
        def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
            for counts in found(batches, among):
                yield {"feature": list(counts), "n": list(counts.values())}

        return map_columns(part.select("text"), kernel, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))

    top = counted(rows.where("toxic = 1"), None).where(F.col("n") >= max(LEAST_TOXIC, LEAST_SHARE * n_toxic)).orderBy(F.desc("n"), "feature").limit(CANDIDATES)
    toxic = {r["feature"]: r["n"] for r in top.collect()}
    among = set(toxic)
    clean = {r["feature"]: r["n"] for r in counted(rows.where("toxic = 0"), among).collect()}
    lift = {f: (n / n_toxic) / ((clean.get(f, 0) + 0.5) / (n_clean + 1)) for f, n in toxic.items()}
    useful = [f for f in sorted(toxic, key=lambda f: (-toxic[f] * math.log(max(lift[f], 1)), f)) if lift[f] >= LEAST_LIFT][:FEATURES]
    column = {f: i for i, f in enumerate(useful)}

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        known: dict[str, str] = {}
        for b in batches:
            held = [sorted(column[f] for f in _texts_features(t, characters, known) if f in column) for t in b["text"]]
            yield {"toxic": b["toxic"], "held": held}

    # Texts without any useful feature are alike: they count, and are not sent.
    seen = map_columns(rows, kernel, "toxic int, held array<int>").groupBy("toxic", "held").agg(F.count("*").alias("n")).collect()
    weights, bias = _logistic([(r["toxic"], r["held"], r["n"]) for r in seen], len(useful))
    return ToxicityModel(characters, {f: float(weights[i]) for f, i in column.items() if weights[i] > 0}, bias)


def _logistic(rows: list[tuple[int, list[int], int]], n_features: int, penalty: float = 0.3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights >= 0 and a bias, by projected gradient steps with per-coordinate scaling."""
    y = np.array([r[0] for r in rows], dtype=float)
    times = np.array([r[2] for r in rows], dtype=float)
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    col = np.array([c for r in rows for c in r[1]], dtype=np.int64)
    w, bias = np.zeros(n_features), 0.0
    square, square_bias = np.full(n_features, 1e-8), 1e-8
    for _ in range(steps):
        margin = bias + np.bincount(row, weights=w[col], minlength=len(rows))
        error = times * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        g = np.bincount(col, weights=error[row], minlength=n_features) + penalty * w
        gb = error.sum()
        square += g * g
        square_bias += gb * gb
        w = np.maximum(0, w - 0.5 * g / np.sqrt(square))
        bias -= 0.5 * gb / math.sqrt(square_bias)
    return w, float(bias)


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row; a NULL text is an empty one."""

    def kernel(batches: Iterator[Columns]) -> Iterator[dict]:
        known: dict[str, str] = {}
        for b in batches:
            yield {"doc_id": b["doc_id"], "score": [model.score(t, known) for t in b["text"]]}

    return map_columns(identified(docs), kernel, "doc_id long, score double")


def _scores(model: ToxicityModel) -> Callable[[list[str]], list[float]]:
    known: dict[str, str] = {}
    return lambda texts: [model.score(t, known) for t in texts]


def with_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """All columns of `docs` and the score, as `score`, or `score_1`, ... where `docs` has such a column; rows in, rows out."""
    scored = with_value(docs, _scores(model), "double")
    return scored.select(*unpacked(scored, docs.columns), F.col("value").alias(free_name(docs, "score")))


def keep_clean(docs: DataFrame, model: ToxicityModel, below: float) -> DataFrame:
    """The rows whose score is less than `below`, each judged by its own text; ids and other columns play no part."""
    scored = with_value(docs, _scores(model), "double").where(F.col("value") < below)
    return scored.select(*unpacked(scored, docs.columns))


def learn(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Character model over all documents, classifier from the labelled ones."""
    docs = identified(docs)
    return fit(docs, labels, character_model(docs))
