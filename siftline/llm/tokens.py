"""Token ids of whole texts, the same as the tokenizers library gives, with each word encoded once.

Most of the library's time goes into words it has met before. For texts of plain
characters the word split of the vocabulary's own pattern is repeated here and the ids
of each word are kept in a table of bounded size, in which a block's words are looked up
all at once; only new words go to the library. Any other text goes to the library whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from functools import cache

import numpy as np

from siftline.llm.textbytes import Words, blocks, mixed

#: Words whose ids a worker keeps at least, twice as many at most
#: (about 110 bytes each).
WORDS_KEPT = 400_000
#: Bytes of a word up to which its hash is made of eight bytes at a time, all words together.
_SHORT = 256
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Characters of which lower case, composition and classes leave no room for doubt.
_PLAIN = "\t\n\r" + "".join(map(chr, range(0x20, 0x7F))) + "".join(map(chr, range(0xC0, 0x130)))
_PLAIN_TEXT = re.compile(f"[{re.escape(_PLAIN)}]*")
#: Kinds of bytes in lower-cased plain texts: 0 white, 1 letter, 2 digit, 3 any other.
_KIND = np.full(256, 1, np.uint8)
_KIND[:0x80] = 3
_KIND[[0x09, 0x0A, 0x0D, 0x20]] = 0
_KIND[ord("a"):ord("z") + 1], _KIND[ord("0"):ord("9") + 1] = 1, 2


@cache
def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PlainWords(Words):
    """The words of plain texts by the vocabulary's own pattern, after lower-casing (fixed value):
    's|'t|'re|'ve|'m|'ll|'d, runs of letters, single digits, runs of what else isn't white."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join([*texts, b""])
        self.bytes = b = np.frombuffer(self.raw, np.uint8)
        kind = _KIND[b]
        at = np.flatnonzero(b == 0xC3)  # of the characters of two bytes only these two are no letters
        at = at[(b[at + 1] == 0x97) | (b[at + 1] == 0xB7)]
        kind[at] = kind[at + 1] = 3
        begins = np.ones(len(b), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        quote = np.flatnonzero((b == ord("'")) & begins)
        if len(quote):  # a line break ends every text, and a quote is not the last byte
            one, two = b[quote + 1], b[np.minimum(quote + 2, len(b) - 1)]
            short = np.isin(one, list(b"stmd"))
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            begins[quote[short | long] + 1] = False
            ends = np.concatenate([quote[short] + 2, quote[long] + 3])
            begins[ends] = True
        edges = np.flatnonzero(begins)
        inside = kind[edges] > 0
        self.starts, self.ends = edges[inside], np.append(edges[1:], len(b))[inside]
        upto = np.searchsorted(self.starts, np.cumsum([len(t) + 1 for t in texts]))
        self.per_text = np.diff(upto, prepend=0)


def word_keys(words: Words) -> np.ndarray:
    """Of each word 64 bits of hash, its first and last eight bytes and its length: words of
    up to 16 bytes with equal keys are equal."""
    padded = np.concatenate([words.bytes, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(words.bytes) + 1, "<u8", padded, strides=(1,))
    length = words.ends - words.starts
    inside = _MASKS[np.minimum(length, 8)]
    keys = np.empty((len(words), 4), np.uint64)
    keys[:, 1] = eight[words.starts] & inside
    keys[:, 2] = eight[np.maximum(words.ends - 8, words.starts)] & inside
    keys[:, 3] = length
    h = mixed(keys[:, 1] ^ mixed(keys[:, 2] ^ mixed(keys[:, 3])))
    at, longer = 8, np.flatnonzero((length > 16) & (length <= _SHORT))
    while len(longer):
        h[longer] = mixed(h[longer] * np.uint64(0x9E3779B97F4A7C15) ^ eight[words.starts[longer] + at])
        at += 8
        longer = longer[length[longer] > at + 8]
    for i in np.flatnonzero(length > _SHORT).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(words.word(i), digest_size=8).digest(), "little")
    keys[:, 0] = h
    return keys


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as its size, in a row."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(begins - before, sizes)


class Table:
    """Lists of ids by ``word_keys``: a hash table with open addressing, in numpy arrays."""

    def __init__(self, room: int = 1 << 12):
        self.n = self.filled = 0
        self.keys = np.empty((room, 4), np.uint64)
        self.begins, self.sizes = np.empty(room, np.int64), np.empty(room, np.int64)
        self.ids = np.empty(4 * room, np.int32)
        self.slots = np.full(2 * room, -1, np.int32)  # a power of two, at most half filled

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key; -1: none."""
        found = np.full(len(keys), -1, np.int32)
        last = np.uint64(len(self.slots) - 1)
        slot, todo = (keys[:, 0] & last).astype(np.int64), np.arange(len(keys))
        while len(todo):
            entry = self.slots[slot]
            some = np.flatnonzero(entry >= 0)
            todo, slot, entry = todo[some], slot[some], entry[some]
            a, b = self.keys[entry], keys[todo]
            same = (a[:, 0] == b[:, 0]) & (a[:, 1] == b[:, 1]) & (a[:, 2] == b[:, 2]) & (a[:, 3] == b[:, 3])
            found[todo[same]] = entry[same]
            other = np.flatnonzero(~same)
            todo, slot = todo[other], (slot[other] + 1) & int(last)
        return found

    def add(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The new entries of keys that are not in the table yet, each there once."""
        n, filled = self.n + len(keys), self.filled + len(ids)
        grown = 2 * n > len(self.slots)
        while 2 * n > len(self.slots):
            self.slots = np.full(2 * len(self.slots), -1, np.int32)
        room = len(self.slots) // 2
        if len(self.keys) < room:
            for name in ("keys", "begins", "sizes"):
                held = getattr(self, name)
                wide = np.empty((room, *held.shape[1:]), held.dtype)
                wide[:self.n] = held[:self.n]
                setattr(self, name, wide)
        if len(self.ids) < filled:
            wide = np.empty(max(filled, 3 * len(self.ids) // 2), np.int32)
            wide[:self.filled] = self.ids[:self.filled]
            self.ids = wide
        own = slice(self.n, n)
        self.keys[own], self.sizes[own] = keys, sizes
        self.begins[own] = self.filled + np.cumsum(sizes) - sizes
        self.ids[self.filled:filled] = ids
        self._place(np.arange(0 if grown else self.n, n, dtype=np.int32))
        self.n, self.filled = n, filled
        return np.arange(own.start, own.stop, dtype=np.int32)

    def _place(self, entries: np.ndarray) -> None:
        last = len(self.slots) - 1
        slot = (self.keys[entries, 0] & np.uint64(last)).astype(np.int64)
        while len(entries):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = entries[free]  # of several one gets the slot
            left = np.flatnonzero(self.slots[slot] != entries)
            entries, slot = entries[left], (slot[left] + 1) & last

    def lists(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each entry has, and all of them in a row."""
        sizes = self.sizes[entries]
        return sizes, self.ids[_ranges(self.begins[entries], sizes)]


class WordTokenizer:
    """``encode(texts)``: all ids in a row (int32), and how many each text has."""

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        self.library, self.words_kept = _library(path), words_kept
        # characters as the library's byte level writes them
        self.written = {
            ord(c): self.library.pre_tokenizer.pre_tokenize_str(c)[0][0]
            for c in _PLAIN if not c.isspace() and ord(c) > 0x7F
        }
        self.now, self.before = Table(), Table()

    def _word_ids(self, word: bytes) -> list[int]:
        text = word.decode()
        return [t.id for t in self.library.model.tokenize(text if word.isascii() else text.translate(self.written))]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        flat, lengths = [], []
        for a, b in blocks(len(t or "") for t in texts):
            own, counts = self._block([t or "" for t in texts[a:b]])
            flat.append(own)
            lengths.append(counts)
        if not flat:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        return np.concatenate(flat), np.concatenate(lengths)

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = ["<|" not in t and bool(_PLAIN_TEXT.fullmatch(t)) for t in texts]
        words = PlainWords([t.lower().encode() if p else b"" for t, p in zip(texts, plain)])
        ids, per_word = self._known(words)
        upto = np.concatenate([[0], np.cumsum(per_word)])
        ends = upto[np.cumsum(words.per_text)]
        counts = np.diff(ends, prepend=0)
        if all(plain):
            return ids, counts
        parts, at = [], 0
        for i, (text, p) in enumerate(zip(texts, plain)):
            if p:
                parts.append(ids[at:ends[i]])
            else:
                parts.append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32))
                counts[i] = len(parts[-1])
            at = ends[i]
        return np.concatenate(parts), counts

    def _known(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each word has; equal words are looked up once."""
        if not len(words):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        if self.now.n > self.words_kept:  # words not met for long go
            self.before, self.now = self.now, Table()
        keys = word_keys(words)
        entries = self.now.find(keys)
        missing = np.flatnonzero(entries < 0)
        if len(missing):
            _, first, which = np.unique(keys[missing, 0], return_index=True, return_inverse=True)
            entries[missing] = self._taken_in(words, missing[first], keys[missing[first]])[which]
        sizes, ids = self.now.lists(entries)
        return ids, sizes

    def _taken_in(self, words: Words, places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The new entries of the words at some places, by older ones or by the library."""
        entries = self.before.find(keys)
        known, new = np.flatnonzero(entries >= 0), np.flatnonzero(entries < 0)
        if len(known):
            entries[known] = self.now.add(keys[known], *self.before.lists(entries[known]))
        if len(new):
            raw, ids, upto = words.raw, array("i"), [0]
            for a, b in zip(words.starts[places[new]].tolist(), words.ends[places[new]].tolist()):
                ids.extend(self._word_ids(raw[a:b]))
                upto.append(len(ids))
            entries[new] = self.now.add(keys[new], np.diff(upto), np.frombuffer(ids, np.int32) if ids else np.empty(0, np.int32))
        return entries


@cache
def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that its words serve all of the worker's tasks."""
    return WordTokenizer(path)

