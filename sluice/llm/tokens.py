"""Whole-text token ids from a public tokenizer file, through a bounded cache of words.

`WordEncoder` gives exactly the ids of ``Tokenizer.encode(text, add_special_tokens=False)``.  Both public BPE
vocabularies never merge across a blank, so a text whose only white space is single spaces and line feeds is cut
there, by Arrow and for many texts at once, and each distinct word is looked up.  An unseen word that is a run of Latin
letters, with or without punctuation after it, is given to the library's BPE model as those one or two pre-tokens; other
unseen words go through the whole library together, and so does a text with any other white space or a special-token
marker.
"""

from __future__ import annotations

import ctypes
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RUNS = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+")
# In Arrow's patterns: white space other than spaces and line feeds, or the mark of a special token ...
_WHOLE = r"<\||[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# ... and blanks that do not stand alone between two words
_BLANKS = r"[ \n][ \n]|\A[ \n]|[ \n]\z"
# Latin letters that lower-case one to one and take part in no composition (U+0130 is neither), then ASCII punctuation
# but the apostrophe: the pre-tokenizers always part the two
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ǃ]+)([!-&(-/:-@\[-`{-~]*)")

# Byte-level BPE writes a byte that is no visible Latin-1 character as the next letter from U+0100 on
_SEEN = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))
_LETTERS = {b: 0x100 + i for i, b in enumerate(sorted(set(range(0x100)).difference(_SEEN)))}

_SPACE = chr(_LETTERS[0x20])


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; callers may pass any path instead."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Texts to little-endian unsigned 32-bit ids.

    keeps_blanks: blanks are part of the ids (byte-level BPE) or dropped by the pre-tokenizer (word BPE).
    capacity: most words of a generation; when it is full it becomes the old one, whose words come back as they are
    met again, and the old one goes."""

    def __init__(self, path: str, keeps_blanks: bool, capacity: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.keeps_blanks, self.capacity = keeps_blanks, capacity
        self.odd = f"{_WHOLE}|{_BLANKS}" if keeps_blanks else _WHOLE
        # words as Arrow cuts them (byte-level: a line feed before a word that no space comes before) with their ids
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}
        self.newline = self._whole(["\n"])[0]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _token(self, piece: str) -> bytes:
        """Ids of one pre-token in the model's byte letters."""
        return array("I", [x.id for x in self.tokenize(piece)]).tobytes()

    def _ids(self, words: list[str]) -> list[bytes]:
        """The ids of each of these distinct words."""
        if len(self.known) + len(words) > self.capacity:
            self.old, self.known, self.ends = self.known, {"": b""}, {}
        known, old, rest = self.known, self.old, []
        found = list(map(known.get, words))
        for i in [i for i, x in enumerate(found) if x is None]:
            w = words[i]
            ids = old.get(w)
            if ids is None:
                ids = self._plain(w)
            if ids is None:
                rest.append(i)
            else:
                found[i] = known[w] = ids
        if rest:
            heads = [words[i][:1] == "\n" for i in rest] if self.keeps_blanks else [False] * len(rest)
            asked = [words[i] if h or not self.keeps_blanks else " " + words[i] for i, h in zip(rest, heads)]
            for i, h, ids in zip(rest, heads, self._whole([w[h:] for w, h in zip(asked, heads)])):
                found[i] = known[words[i]] = self.newline + ids if h else ids
        return found

    def _plain(self, word: str) -> bytes | None:
        """Ids of Latin letters with or without punctuation after them; None of any other word."""
        head = word[:1] == "\n"
        plain = _PLAIN.fullmatch(word, head)
        if not plain:
            return None
        stem, end = plain.groups()
        key = word[: len(word) - len(end)] if self.keeps_blanks else stem.lower()
        ids = self.known.get(key) or self.old.get(key)
        if ids is None:
            piece = stem if self.keeps_blanks else key
            if not piece.isascii():
                piece = piece.encode().decode("latin-1").translate(_LETTERS)
            ids = self.newline + self._token(piece) if head else self._token(_SPACE + piece if self.keeps_blanks else piece)
            self.known[key] = ids
        if end:
            if end not in self.ends:
                self.ends[end] = self._token(end)
            ids += self.ends[end]
        return ids

    def _words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, list[bytes]]:
        """The texts' words, where each text's begin, and the ids of the distinct ones."""
        if self.keeps_blanks:
            texts = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
        else:
            texts = pc.replace_substring(texts, "\n", " ")
        cut = pc.split_pattern(texts, " ")
        words = cut.flatten().dictionary_encode()
        found = self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        return words.indices, cut.offsets.to_numpy() - cut.offsets[0].as_py(), found

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, bounds: text i has ids[bounds[i]:bounds[i + 1]]); a null is an empty text."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        index, at, found = self._words(texts.filter(pa.array(~odd)) if odd.any() else texts)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start = np.cumsum(size) - size
        index = index.to_numpy()
        n = size[index]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = np.frombuffer(b"".join(found), np.uint32)[np.arange(upto[-1]) + np.repeat(start[index] - upto[:-1], n)]
        bounds = upto[at]
        if self.keeps_blanks:  # the line feed put before each text
            extra = len(self.newline) // 4
            ids = np.delete(ids, (bounds[:-1, None] + np.arange(extra)).ravel())
            bounds = bounds - extra * np.arange(len(bounds))
        if odd.any():
            plain = (ids[a:b] for a, b in zip(bounds, bounds[1:]))
            other = iter(self._odd(texts.filter(pa.array(odd)).to_pylist()))
            parts = [next(other) if x else next(plain) for x in odd.tolist()]
            ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        return ids, bounds

    def _odd(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that are not single words between single blanks."""
        runs = [_RUNS.findall(t) if self.keeps_blanks and not re.search(r"<\||[^\S \n]", t) else None for t in texts]
        blank = {w for r in runs if r for w in r if w[0] in " \n" and (w[0] == "\n" or w[1:2] in ("", " ", "\n"))}
        words = list({w[1:] if w[0] == " " else "\n" + w for r in runs if r for w in r if w not in blank})
        known = dict(zip(words, self._ids(words))) | dict(zip(blank, self._whole(list(blank))))
        drop = len(self.newline)
        of = {w: known[w] if w in blank else known[w[1:]] if w[0] == " " else known["\n" + w][drop:] for r in runs if r for w in r}
        direct = iter(self._whole([t for t, r in zip(texts, runs) if r is None]))
        return [np.frombuffer(next(direct) if r is None else b"".join(map(of.__getitem__, r)), np.uint32) for r in runs]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, bounds = self.encode_array(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


_ENCODERS: dict = {}


def encoder(path: str, keeps_blanks: bool, capacity: int = 400_000) -> WordEncoder:
    """One encoder for each Python worker, so its cache lives over tasks of one use.

    Another vocabulary or capacity takes its place, so an idle worker never holds more than the last asked for."""
    key = (path, keeps_blanks, capacity)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(path, keeps_blanks, capacity)
    return _ENCODERS[key]


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other C libraries have none


def give_back() -> None:
    """Hand memory that Arrow and the C library hold in reserve back to the system: workers outlive their batches and wait for
    the next ones beside each other."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def release() -> None:
    """Let the encoder of this worker go, and its reserves: other work in it needs the room."""
    _ENCODERS.clear()
    give_back()


def slices(texts: list, most_chars: int = 400_000):
    """(from, to) bounds of runs of texts of about most_chars, at least one text each."""
    return _bounds(map(len, texts), most_chars)


def array_slices(texts: pa.Array, most_bytes: int = 1_000_000):
    """(from, to) bounds of runs of an Arrow array's texts of about most_bytes, at least one text each."""
    return _bounds(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), most_bytes)


def _bounds(sizes, most: int):
    start = size = at = 0
    for at, n in enumerate(sizes, 1):
        if at - 1 > start and size + n > most:
            yield start, at - 1
            start, size = at - 1, 0
        size += n
    if start < at:
        yield start, at
