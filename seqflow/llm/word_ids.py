"""Token ids of many texts by a tokenizer whose tokens never cross white space, each distinct word encoded once.

For the kind of `tokenizers` file with NFC, lower case, a split into letters, single digits and other signs, and byte
level BPE with word ends. Texts are lower-cased (A-Z), split at white space and between a letter and a stop, where the
tokenizer splits, too, and made a dictionary in Arrow; only distinct words reach Python, and ids of whole texts are
gathered with numpy. Words of printable ASCII and Latin letters go straight to the BPE model, as their normal form, lower
case and split are plain; all others go through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: printable ASCII and Latin letters of one lower-case letter each (U+0130 has two)
PLAIN = re.compile(r"[!-~À-ÖØ-öø-įı-ſ]+")
#: the tokenizer's split, for lower-cased plain words
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: combining marks that a Latin letter can be joined with; a text without them may be lower-cased and split first
MARKS = "[\u0300-\u036f]"
#: white space to Arrow, but not to the tokenizer
SIGNS = "[\\x1c-\\x1f]"
NUMBER = attrgetter("id")
LONG = 64  # longer words are not kept


def byte_letters() -> dict[int, int]:
    """Byte -> code point of its letter in a byte-level vocabulary: printable Latin-1 stands for itself, the
    others, in order, for the code points from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


class WordIds(dict):
    """word -> its ids as little-endian 32-bit numbers. Holds at most 2 * `keep` words: a full generation
    becomes the old one, from which words in use come back."""

    def __init__(self, spec: str, keep: int = 1 << 18) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model, self.letters, self.keep, self.old = self.tokenizer.model.tokenize, byte_letters(), keep, {}
        self.plain = SPLIT in self.tokenizer.pre_tokenizer.__getstate__().decode().replace("\\\\", "\\")

    def _encode(self, word: str) -> bytes:
        if not (word.isascii() and word.isalpha()):
            if not (self.plain and PLAIN.fullmatch(word)):
                return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
            parts = PARTS.findall(word.lower())
            if len(parts) > 1:
                return b"".join([self[p] for p in parts])
            letters = parts[0].encode().decode("latin-1").translate(self.letters)
        elif self.plain:
            letters = word.lower()
        else:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return array("I", map(NUMBER, self.model(letters))).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._encode(word)
        if len(word) <= LONG:
            if len(self) >= self.keep:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


_OPEN: dict[tuple, WordIds] = {}


def word_ids(spec: str, keep: int = 1 << 19) -> WordIds:
    """The table of this process, kept from one task to the next."""
    if (spec, keep) not in _OPEN:
        _OPEN.clear()
        _OPEN[spec, keep] = WordIds(spec, keep)
    return _OPEN[spec, keep]


def encode(texts: pa.Array, words: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """texts -> (ids of all texts in a row, bounds: text i has ids[bounds[i]:bounds[i + 1]]). Null is empty."""
    # a copy: ascii_lower reads slices from the start of their buffer
    texts = pc.fill_null(texts, "").cast(pa.large_string()).take(pa.array(np.arange(len(texts))))
    if words.plain and not pc.any(pc.match_substring_regex(texts, MARKS)).as_py():
        texts = pc.replace_substring_regex(pc.ascii_lower(texts), "([a-z])([.,;:!?])", r"\1 \2")
    if pc.any(pc.match_substring_regex(texts, SIGNS)).as_py():
        lists = pc.split_pattern_regex(texts, r"[ \t\n\x0b\x0c\r]+")
    else:
        lists = pc.utf8_split_whitespace(texts)
    at = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    blobs = [words[w] for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
    ids = np.frombuffer(b"".join(blobs), "<u4")
    lengths = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    which = coded.indices.to_numpy()
    long, begin = lengths[which], starts[which]
    ends = np.cumsum(long)
    places = np.repeat(begin - (ends - long), long)
    places += np.arange(len(places))
    bounds = np.concatenate(([0], ends))[at - at[0]]
    return ids[places], bounds
