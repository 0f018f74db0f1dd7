"""Token ids of whole texts by the tokenizers library, with a bounded memory of chunks already encoded.

Most words of a text were met before.  A text is cut where the pre-tokenizer always cuts and the
chunks not yet known are encoded together in one call, parted by a separator that is a token of its
own.  Texts in which a cut could matter (other white space, control signs, special tokens) go to the
tokenizer whole, so ids are always those of the whole text.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from collections.abc import Iterable

import numpy as np

REMEMBERED = 300_000  # chunks in each of two generations, so a worker's memory is bounded
AT_ONCE = 1_000_000  # characters of texts whose unknown chunks are encoded in one call
JOINED = 100  # words that the bare model takes as one text; it slows down with the length of a text

_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f]")
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_SIGNS = r"!-/:-@\[-`{-~"

_SHIFTED = [*range(0x21), *range(0x7F, 0xA1), 0xAD]  # bytes that are not their own number in the byte alphabet
_BYTES = "".join(" " if b == 0x20 else chr(256 + _SHIFTED.index(b)) if b in _SHIFTED else chr(b) for b in range(256))


def _in_bytes(text: str) -> str:
    """The text in the byte alphabet of the tokenizers; the spaces between its words stay."""
    return text if text.isascii() else codecs.charmap_decode(text.encode(), "strict", _BYTES)[0]


class _Spaced:
    """Byte-level pre-tokenizing: a single space begins a chunk, a line end is one.

    A chunk is written without its space.  One that has none begins with \\n after a line end, which is part of it,
    and with \\r at the start of a text and where a chunk is cut further; texts that hold \\r are odd.
    """

    rare = re.compile(r"[^\S \n]|[\x00-\x08\x0e-\x1f]")
    doubled = ("<|", "  ", " \n", "\n ", "\n\n")
    separator = "\n"
    letters = re.compile(f"[{_LATIN}]+")
    unspaced = re.compile(f"\r[{_LATIN}]+")
    signed = re.compile(f"([\n\r]?[^{_SIGNS}]*[{_LATIN}])([{_SIGNS}]+)")

    @staticmethod
    def marks(token: str) -> bool:
        return token.startswith("\u0120")

    @staticmethod
    def joined(words: list[str]) -> str:
        return "\u0120" + _in_bytes(" ".join(words)).replace(" ", " \u0120")

    @staticmethod
    def cuts(marked: np.ndarray, n: int) -> np.ndarray:
        return np.append(marked, n)

    @classmethod
    def odd(cls, text: str) -> bool:
        if not text or any(d in text for d in cls.doubled) or text[0] == "\n" or text[-1] in " \n":
            return True
        return not text.replace("\n", "").isprintable() and bool(cls.rare.search(text))

    @staticmethod
    def chunks(text: str) -> list[str]:
        return ("\r" + text).replace("\n", " \n").split(" ")

    @staticmethod
    def parts(start: str, signs: str) -> tuple[str, ...]:
        return start, "\r" + signs

    @staticmethod
    def written(chunk: str) -> str:
        return chunk[1:] if chunk[0] == "\r" else " " + chunk


class _Worded:
    """White space only parts words, and case is dropped."""

    separator = " \x01 "
    letters = re.compile(f"[{_LATIN}]+")
    unspaced = None
    signed = re.compile(f"([^{_SIGNS}]*[{_LATIN}])([{_SIGNS}]+)")

    @staticmethod
    def marks(token: str) -> bool:
        return token.endswith("</w>")

    @staticmethod
    def joined(words: list[str]) -> str:
        return _in_bytes(" ".join(words).lower())

    @staticmethod
    def cuts(marked: np.ndarray, n: int) -> np.ndarray:
        return np.append(0, marked + 1)

    @staticmethod
    def odd(text: str) -> bool:
        return "<|" in text or (not text.replace("\n", "").isprintable() and bool(_CONTROL.search(text)))

    @staticmethod
    def chunks(text: str) -> list[str]:
        return (text.lower() if text.isascii() else text).split()

    @staticmethod
    def parts(start: str, signs: str) -> tuple[str, ...]:
        return start, signs

    @staticmethod
    def written(chunk: str) -> str:
        return chunk


class TextEncoder:
    """Ids of texts by one tokenizer file; keep one per worker process (`encoder`)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            declared = json.load(f)
        cut, model = declared.get("pre_tokenizer") or {}, declared["model"]
        self.rule: type | None = None
        if declared.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space"):
            self.rule = _Spaced
        elif model.get("end_of_word_suffix") and '"Lowercase"' in json.dumps(declared.get("normalizer")):
            self.rule = _Worded
        if self.rule:
            (self.separator_id,) = self._ids(self.rule.separator)
            self._prepare_letters(Tokenizer)
        self.new: dict[str, bytes] = self._first()
        self.old: dict[str, bytes] = {}

    def _prepare_letters(self, kind: type) -> None:
        """The bare model for words of Latin letters, which normalizer and pre-tokenizer leave as they are but for case
        and the byte alphabet (a space before them is one sign of it).  Each has one token that shows where it begins or ends."""
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.letters = kind(self.tokenizer.model)
        self.letters.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.marked = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.marked[[i for token, i in vocabulary.items() if self.rule.marks(token)]] = True

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        found: list[bytes] = [b""] * len(texts)
        regular: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            if self.rule is None or self.rule.odd(text):
                found[i] = np.array(self._ids(text), dtype="<u4").tobytes()
                continue
            regular.append(i)
            size += len(text)
            if size > AT_ONCE:
                self._chunked(texts, regular, found)
                regular, size = [], 0
        self._chunked(texts, regular, found)
        return found

    def _chunked(self, texts: list[str], regular: list[int], found: list[bytes]) -> None:
        ids_of = self.new.get
        missing: set[str] = set()
        rows: list[tuple[list, list[int], list[str]]] = []
        for i in regular:
            chunks = self.rule.chunks(texts[i])
            ids = list(map(ids_of, chunks))
            gaps, at = [], -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                gaps.append(at)
            unknown = [chunks[at] for at in gaps]
            missing.update(unknown)
            rows.append((ids, gaps, unknown))
        if missing:
            self._learn(missing)
        for i, (ids, gaps, unknown) in zip(regular, rows):
            for at, c in zip(gaps, unknown):
                ids[at] = self.new[c]
            found[i] = b"".join(ids)
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, self._first()

    def _first(self) -> dict[str, bytes]:
        """Chunks that no call gives: the line end, and the nothing before a text that begins with a space."""
        return {"\n": np.array([self.separator_id], dtype="<u4").tobytes(), "\r": b""} if self.rule is _Spaced else {}

    def _learn(self, missing: set[str]) -> None:
        """Ids of chunks into the newer generation; those of the older one are taken over.

        Signs after a last letter are a token of their own, and a line end is one."""
        known, rule = self.new, self.rule
        self._take_over(missing)
        cut: dict[str, tuple[str, ...]] = {}
        for c in missing:
            if not c.isalpha():
                signed = rule.signed.fullmatch(c)
                parts = rule.parts(*signed.groups()) if signed else (c,)
                if rule is _Spaced and c[0] == "\n":
                    parts = ("\n", "\r" + parts[0][1:], *parts[1:])
                if len(parts) > 1:
                    cut[c] = parts
        words = missing.difference(cut).union(*cut.values()).difference(known)
        self._take_over(words)
        ascii_words = [w for w in words if w.isascii() and w.isalpha()]
        rest = [w for w in words if not (w.isascii() and w.isalpha())]
        for plain in (ascii_words, list(filter(rule.letters.fullmatch, rest))):
            if plain:
                ids = self._bare([rule.joined(plain[k : k + JOINED]) for k in range(0, len(plain), JOINED)])
                self._keep(plain, ids, rule.cuts(np.flatnonzero(self.marked[ids]), len(ids)), 0)
        first = list(filter(rule.unspaced.fullmatch, rest)) if rule.unspaced else []
        if first:
            # After each word a space of the byte alphabet, which is a token of its own.
            texts = [" ".join(first[k : k + JOINED]).replace("\r", "") for k in range(0, len(first), JOINED)]
            ids = self._bare([_in_bytes(t).replace(" ", " \u0120 ") + " \u0120" for t in texts])
            self._keep(first, ids, np.concatenate([[-1], np.flatnonzero(self.marked[ids])]), 1)
        others = [w for w in rest if w not in known]
        if others:
            joined = rule.separator.join(map(rule.written, others))
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            self._keep(others, ids, np.concatenate([[-1], np.flatnonzero(ids == self.separator_id), [len(ids)]]), 1)
        for c, parts in cut.items():
            known[c] = b"".join(map(known.__getitem__, parts))

    def _take_over(self, chunks: set[str]) -> None:
        """Those of the older generation go from `chunks` into the newer one."""
        again = [c for c in chunks if c in self.old]
        self.new.update(zip(again, map(self.old.__getitem__, again)))
        chunks.difference_update(again)

    def _bare(self, texts: list[str]) -> np.ndarray:
        return np.array([i for e in self.letters.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids], dtype="<u4")

    def _keep(self, words: list[str], ids: np.ndarray, cuts: np.ndarray, gap: int) -> None:
        """The ids between neighbouring cuts, `gap` of them left out at the start, are those of a word each."""
        if len(cuts) != len(words) + 1:
            raise RuntimeError("the tokenizer does not keep chunks apart")
        data, bounds = ids.tobytes(), (4 * cuts).tolist()
        for w, start, end in zip(words, bounds, bounds[1:]):
            self.new[w] = data[start + 4 * gap : end]


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def in_portions(texts: Iterable[str], path: str) -> Iterable[bytes]:
    """The ids of each text in turn; a few are encoded ahead."""
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size > AT_ONCE:
            yield from encoder(path).encode(held)
            held, size = [], 0
    yield from encoder(path).encode(held)
