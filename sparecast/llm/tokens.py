"""Byte-level BPE over batches of texts: pre-tokens, an interned word table, assembly of ids.

The words of a batch are found by one numpy pass over its code points, after
the rules of the public byte-level pattern (contractions, an optional leading
space before a run of letters, digits or other signs, runs of white space).
Every distinct word is encoded once and kept, up to a bounded number of words.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from itertools import chain

import numpy as np
import regex

from sparecast.llm.words import mix, new_key, passes, substring_hashes

OTHER, LETTER, NUMBER, SPACE, END = range(5)
_LAST = 0x110000
_END_CODE = np.array([0x7FFFFFFF], "<u4").tobytes()
#: White_Space of Unicode.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Distinct words that a worker keeps.
KEPT_WORDS = 500_000
#: Code points handled in one numpy pass (one longer text is a pass of its own).
PASS_CHARS = 1 << 18

_tables: list[np.ndarray] = []


def code_tables() -> list[np.ndarray]:
    """Class and hash value of every code point (made once per process).

    Where the Unicode versions of Python and of the regex package disagree (new
    letters and digits), the tokenizers library itself is asked.
    """
    if not _tables:
        from tokenizers.pre_tokenizers import ByteLevel

        kind = {"L": LETTER, "N": NUMBER}
        classes = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(_LAST)), np.uint8, _LAST)
        newer = np.zeros(_LAST, np.uint8)
        every = "".join(map(chr, range(_LAST)))
        for k, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, every):
                newer[m.start() : m.end()] = k
        split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        for c in np.flatnonzero(classes != newer).tolist():
            places = [place for _, place in split(f"a{chr(c)}1")]
            classes[c] = LETTER if (0, 2) in places else NUMBER if (1, 3) in places else OTHER
        classes[_WHITE] = SPACE
        values = mix(np.arange(1, _LAST + 2, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        _tables.extend([np.append(classes, np.uint8(END)), values])
    return _tables


def word_starts(codes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where words start; END codes are words of their own."""
    n = len(codes)
    before = np.concatenate([[END], classes[:-1]])
    after = np.concatenate([classes[1:], [END]])
    blank = np.concatenate([[False], codes[:-1] == 0x20])
    is_space = classes == SPACE
    start = (classes != before) & ~(blank & ~is_space & (classes != END))
    start |= is_space & (after != SPACE) & (after != END)
    start |= classes == END
    for i in np.flatnonzero((codes == 0x27) & start).tolist():
        one = chr(codes[i + 1]) if i + 1 < n and codes[i + 1] < 128 else ""
        two = one + (chr(codes[i + 2]) if i + 2 < n and codes[i + 2] < 128 else "")
        size = 1 if one and one in "stmd" else 2 if two in ("re", "ve", "ll") else 0
        if size:
            start[i + 1] = False
            if i + 1 + size < n and classes[i + 1 + size] == LETTER:
                start[i + 1 + size] = True
    return start


class HashIndex:
    """Places of 64-bit keys, looked up and added many at a time (linear probing over two arrays)."""

    def __init__(self, most: int) -> None:
        self.mask = np.uint64((1 << (2 * most).bit_length()) - 1)
        self.keys = np.zeros(int(self.mask) + 1, np.uint64)
        self.places = np.zeros(int(self.mask) + 1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for unknown ones; keys aren't 0."""
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        slot = keys & self.mask
        while len(open_):
            there = self.keys[slot]
            same = there == keys[open_]
            out[open_[same]] = self.places[slot[same]]
            on = ~same & (there != 0)
            open_, slot = open_[on], (slot[on] + np.uint64(1)) & self.mask
        return out

    def add(self, keys: np.ndarray, first_place: int) -> None:
        """Add distinct unknown keys with places from ``first_place`` on."""
        places = np.arange(first_place, first_place + len(keys), dtype=np.int32)
        slot = keys & self.mask
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]  # of keys that meet in a slot, one stays
            won = self.keys[slot] == keys
            self.places[slot[won]] = places[won]
            keys, places, slot = keys[~won], places[~won], (slot[~won] + np.uint64(1)) & self.mask


class WordTable:
    """Ids of the words met so far; new words go to ``encode`` (many at a time)."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = KEPT_WORDS) -> None:
        self.encode, self.limit, self.key = encode, limit, new_key()
        self.clear()

    def clear(self) -> None:
        self.size, self.room = 0, self.limit
        self.index = HashIndex(self.room)
        self.flat = np.empty(1 << 16, np.int32)
        self.bounds = np.zeros(1 << 14, np.int64)

    def _add(self, keys: np.ndarray, words: list[str]) -> None:
        if self.size + len(keys) > self.room:  # one pass alone has more words than are kept
            self.room = 2 * (self.size + len(keys))
            known, places = self.index.keys, self.index.places
            self.index = HashIndex(self.room)
            used = known != 0
            self.index.add(known[used][np.argsort(places[used])], 0)
        ids = self.encode(words)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        first = int(self.bounds[self.size])
        last = first + int(lengths.sum())
        while last > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while self.size + len(ids) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.flat[first:last] = np.fromiter(chain.from_iterable(ids), np.int32, last - first)
        self.bounds[self.size + 1 : self.size + 1 + len(ids)] = first + np.cumsum(lengths)
        self.index.add(keys, self.size)
        self.size += len(ids)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text of one pass."""
        if self.size > self.limit:
            self.clear()
        table, values = code_tables()
        raw = _END_CODE.join([*(t.encode("utf-32-le", "surrogatepass") for t in texts), b""])
        codes = np.minimum(np.frombuffer(raw, "<u4"), _LAST)
        classes = table[codes]
        starts = np.flatnonzero(word_starts(codes, classes))
        ends = np.append(starts[1:], len(codes))
        real = classes[starts] != END
        text_of = np.cumsum(~real)[real]
        starts, ends = starts[real], ends[real]
        keys = np.maximum(substring_hashes(codes, starts, ends, values, self.key), np.uint64(1))
        place = self.index.find(keys)
        unknown = np.flatnonzero(place < 0)
        if len(unknown):
            new, first, again = np.unique(keys[unknown], return_index=True, return_inverse=True)
            spots = unknown[first]
            words = [codes[s:e].tobytes().decode("utf-32-le", "surrogatepass") for s, e in zip(starts[spots].tolist(), ends[spots].tolist())]
            place[unknown] = self.size + again
            self._add(new, words)
        lo = self.bounds[place]
        lengths = self.bounds[place + 1] - lo
        upto = np.cumsum(lengths)
        total = int(upto[-1]) if len(upto) else 0
        flat = self.flat[np.repeat(lo - (upto - lengths), lengths) + np.arange(total)]
        words_upto = np.searchsorted(text_of, np.arange(len(texts) + 1))
        cut = np.concatenate([[0], upto])[words_upto]
        return [flat[a:b] for a, b in zip(cut[:-1], cut[1:])]


class ByteTokenizer:
    """A byte-level BPE file: its added tokens are split off first, the words between them go to a word table."""

    def __init__(self, path: str, encode_words: Callable[[dict], Callable[[list[str]], list[list[int]]]],
                 kept_words: int = KEPT_WORDS) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)  # not kept: the encoder takes from it what it needs
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pre = spec["pre_tokenizer"]
        plain = not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or not plain:
            raise ValueError(f"{path} isn't a plain byte-level BPE")
        self.split = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.table = WordTable(encode_words(spec), kept_words)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for _, run in passes(texts, PASS_CHARS):
            out += self._pass(run)
        return out

    def _pass(self, texts: list[str]) -> list[np.ndarray]:
        special = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not special:
            return self.table.ids(texts)
        pieces, owner = [], []
        for i, t in enumerate(texts):
            parts = self.split.split(t)
            pieces += parts
            owner += [i] * len(parts)
        ids = self.table.ids(pieces)
        grouped: list[list[np.ndarray]] = [[] for _ in texts]
        for i, x in zip(owner, ids):
            grouped[i].append(x)
        out = []
        for t, parts in zip(texts, grouped):
            marks = [np.array([self.added[m]], np.int32) for m in self.split.findall(t)]
            woven = [parts[0]]
            for mark, part in zip(marks, parts[1:]):
                woven += [mark, part]
            out.append(np.concatenate(woven))
        return out


def byte_of_sign() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies: printable Latin-1 as is, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def library_words(path: str) -> Callable[[dict], Callable[[list[str]], list[list[int]]]]:
    """Words encoded by the tokenizers library, many to a text.

    The words are already those of the file's own pre-tokenizer, so it is
    replaced by one that parts them at line feeds; words with a line feed in
    them are texts of their own, before the original one.
    """

    def make(_: dict) -> Callable[[list[str]], list[list[int]]]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        whole = tokenizer.pre_tokenizer
        parted = pre_tokenizers.Sequence(
            [pre_tokenizers.Split("\n", "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        feed = tokenizer.encode("\n", add_special_tokens=False).ids[0]

        def encode(words: list[str]) -> list[list[int]]:
            out: list[list[int]] = [[] for _ in words]
            joined = [i for i, w in enumerate(words) if "\n" not in w]
            alone = [i for i, w in enumerate(words) if "\n" in w]
            tokenizer.pre_tokenizer = parted
            for at in range(0, len(joined), 1000):
                some = joined[at : at + 1000]
                text = "\n".join([*(words[i] for i in some), ""])
                flat = tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
                ends = np.flatnonzero(np.array(flat, np.int64) == feed).tolist()
                if len(ends) != len(some):
                    raise AssertionError("a word has a line feed's id")
                lo = 0
                for i, hi in zip(some, ends):
                    out[i] = flat[lo:hi]
                    lo = hi + 1
            tokenizer.pre_tokenizer = whole
            for i, e in zip(alone, tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False)):
                out[i] = e.ids
            return out

        return encode

    return make


_held: dict[tuple[str, str], ByteTokenizer] = {}


def held_tokenizer(path: str, kind: str, make: Callable[[str], Callable[[dict], Callable[[list[str]], list[list[int]]]]],
                   kept_words: int = KEPT_WORDS) -> ByteTokenizer:
    """A tokenizer that the worker process keeps from task to task, with the words it has met."""
    if (path, kind) not in _held:
        _held[path, kind] = ByteTokenizer(path, make(path), kept_words)
    return _held[path, kind]
