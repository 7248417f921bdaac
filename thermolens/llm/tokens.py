"""Byte-pair encoding by a public tokenizer, one white-space delimited word at a time.

The tokenizer drops white space, and none of its tokens reaches across it, so a text's ids are
the ids of its words in order.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from thermolens.llm.batches import ranges

# The byte alphabet of byte-level BPE.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
ALPHABET = {b: b for b in PRINTABLE} | {
    b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(PRINTABLE))}
#: Words without any of these characters need no Unicode normalisation beyond lower case, and the
#: pattern by which the tokenizer file splits them comes down to PLAIN_SPLIT (fixed values). Lower
#: words without a character of MIXED are not split at all.
UNUSUAL = re.compile("[^!-~À-ÖØ-öø-ÿ]")
MIXED = "[^a-zß-öø-ÿ]"
PLAIN_SPLIT = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+|\n")


class WordBpe:
    """Encodes words with a bounded memory of parts of words met before."""

    def __init__(self, path: str, remember: int = 1 << 19) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.remember = remember
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("H" if size <= 1 << 16 else "I")
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]

    def word(self, word: bytes) -> bytes:
        """The ids of one word, as packed integers of ``dtype``."""
        if word.isalpha():  # letters of ASCII only
            return self._parts([word.decode().lower()])[0]
        text = word.decode()
        if UNUSUAL.search(text) or any(x in text for x in self.special):
            return self._whole(text)
        return b"".join(self._parts(PLAIN_SPLIT.findall(text.lower())))

    def _whole(self, word: str) -> bytes:
        return self._pack(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _part(self, part: str) -> bytes:
        if part == "\n":  # ends a word
            return b""
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(ALPHABET)
        return self._pack([x.id for x in self.model.tokenize(spelled)])

    def _parts(self, parts: list[str]) -> list[bytes]:
        if len(self.parts) >= self.remember:
            self.parts = {}
        return _met(parts, self.parts, self._part)

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.dtype.char, ids).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and where each starts, with the end.

        Words that the texts hold several times, or that differ in case only, are split once. What
        is remembered besides are their parts, which are far fewer, and words with unusual letters.
        """
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        names = words.dictionary
        unusual = pc.match_substring_regex(names, UNUSUAL.pattern)
        for x in self.special:
            unusual = pc.or_(unusual, pc.match_substring(names, x))
        lower = pc.utf8_lower(names.filter(pc.invert(unusual))).dictionary_encode()
        mixed = pc.match_substring_regex(lower.dictionary, MIXED)
        # words of letters, then the parts of mixed words, then unusual words
        letters = _strings(lower.dictionary.filter(pc.invert(mixed)))
        parts = PLAIN_SPLIT.findall(
            "".join(f"{w}\n" for w in _strings(lower.dictionary.filter(mixed))))
        whole = _strings(names.filter(unusual))
        if len(self.words) >= self.remember:
            self.words = {}
        packed = self._parts(letters + parts) + _met(whole, self.words, self._whole)
        passed = np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)))
        is_last = np.ones(len(packed), bool)
        is_last[len(letters):len(letters) + len(parts)] = np.fromiter(
            map("\n".__eq__, parts), bool, len(parts))
        starts = np.concatenate(([0], passed[is_last])) // self.dtype.itemsize
        place = np.concatenate((
            _behind(mixed)[lower.indices.to_numpy()],
            len(lower.dictionary) + np.arange(len(whole))))[_behind(unusual)]
        place = place[words.indices.to_numpy()]
        sizes = np.diff(starts)[place]
        ids = self.ids(b"".join(packed))[ranges(starts[place], sizes)]
        return ids, np.concatenate(([0], np.cumsum(sizes)))[split.offsets.to_numpy()]

    def packed(self, text: str) -> bytes:
        """The ids of a whole text, packed."""
        return self.encode(pa.array([text]))[0].tobytes()

    def forget(self) -> None:
        self.words, self.parts = {}, {}

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, self.dtype)


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def _behind(marks: pa.Array) -> np.ndarray:
    """The place of every entry once the marked ones are put behind the others."""
    out = np.empty(len(marks), np.int64)
    out[np.argsort(marks.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(marks))
    return out


def _met(keys: list[str], known: dict[str, bytes], ids_of: Callable[[str], bytes]) -> list[bytes]:
    """The ids of all keys, from ``known`` or added to it."""
    found = list(map(known.get, keys))
    for i, ids in enumerate(found):
        if ids is None:
            key = keys[i]
            if key not in known:
                known[key] = ids_of(key)
            found[i] = known[key]
    return found


_LOADED: dict[tuple[str, int], WordBpe] = {}


def encoder(path: str, remember: int = 1 << 19) -> WordBpe:
    """This Python worker's encoder, loaded once. Tasks ``forget`` what they met when they end, as
    the worker lives on for stages that need the memory."""
    if (path, remember) not in _LOADED:
        _LOADED[path, remember] = WordBpe(path, remember)
    return _LOADED[path, remember]
