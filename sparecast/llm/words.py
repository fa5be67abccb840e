"""Vectorised words, word hashes and window hashes over batches of texts.

Texts are handled as UTF-8 bytes with A-Z lower-cased.  A batch is one byte
string of texts parted by a space, which no word class contains, so one numpy
pass finds the words of all its texts.  Hashes are 64 bits wide and keyed; callers
whose results rest on them draw a new key for every run, so that two given words
or sets meet with a chance of 2^-64, whatever the texts are made of.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from typing import TypeVar

import numpy as np

Text = TypeVar("Text", bytes, str)

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Bytes of ``[^\x20\x09-\x0D]+``: everything but space and the ASCII line and tab marks.
SPACED = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` in lower-cased text: digits, a-z and all non-ASCII.
ALNUM = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])

#: Bytes of text handled in one numpy pass (one longer text is a pass of its own).
PASS_BYTES = 2 << 20

_BLOCK = 1 << 18
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1B54A32D192ED03))


def passes(texts: list[Text], limit: int = PASS_BYTES) -> Iterator[tuple[int, list[Text]]]:
    """``(index of the first, texts)`` in runs of about ``limit`` bytes (of strings: code points)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, texts[start:]


def spans(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = table[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def new_key() -> int:
    """A random key for the hashes of one run: no text can be made to collide under it beforehand."""
    return secrets.randbits(64)


def substring_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _BYTE, key: int = 0) -> np.ndarray:
    """Keyed hash of every ``data[start:end]``; ``starts`` and ``ends`` ascend, ``values`` has each element's own hash.

    The sum of a mixed value per element, its place in the substring and the key:
    unlike a polynomial it has no algebra that makes long substrings collide under
    every base.  Sums are differences of one running sum, taken block by block so
    that a very long text needs no more scratch memory than a short one.
    """
    at_start, at_end = np.zeros(len(starts), np.uint64), np.zeros(len(ends), np.uint64)
    carry, begin = _U(0), 0
    for b in range(0, len(data) + 1, _BLOCK):
        chunk = data[b : b + _BLOCK]
        lo, hi = np.searchsorted(starts, (b, b + _BLOCK))
        here = starts[lo:hi]
        since = np.zeros(len(chunk), np.int64)
        since[here[here < b + len(chunk)] - b] = here[here < b + len(chunk)]
        if len(chunk) and not since[0]:
            since[0] = begin
        np.maximum.accumulate(since, out=since)
        begin = int(since[-1]) if len(chunk) else begin
        place = (np.arange(b, b + len(chunk)) - since).astype(np.uint64)
        term = (place * _U(_STEP) + _U(key)) ^ values[chunk]
        term *= _U(0xBF58476D1CE4E5B9)
        term ^= term >> _U(29)
        term *= _U(0x94D049BB133111EB)
        term ^= term >> _U(32)
        run = np.empty(len(chunk) + 1, np.uint64)
        run[0] = carry
        np.cumsum(term, out=run[1:])
        run[1:] += carry
        at_start[lo:hi] = run[here - b]
        lo, hi = np.searchsorted(ends, (b, b + _BLOCK))
        at_end[lo:hi] = run[ends[lo:hi] - b]
        carry = run[-1]
    return mix(at_end - at_start + (ends - starts).astype(np.uint64) * _U(_STEP))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (``len(words) - size + 1`` of them)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, (size * 0xA0761D6478BD642F) & _MASK, np.uint64)
    for k in range(size):
        acc = mix(acc + words[k : k + n])
    return acc


class Words:
    """The words of some texts: byte spans, hashes and the text each word is in."""

    def __init__(self, texts: list[bytes], table: np.ndarray, key: int = 0) -> None:
        self.data = b" ".join(texts).translate(LOWER)
        raw = np.frombuffer(self.data, np.uint8)
        self.starts, self.ends = spans(raw, table)
        self.hashes = substring_hashes(raw, self.starts, self.ends, key=key)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.bounds = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(lengths)]))
        self.counts = np.diff(self.bounds)
        self.text = np.repeat(np.arange(len(texts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window that lies in one text."""
        h = window_hashes(self.hashes, size)
        if not len(h):
            return np.empty(0, np.int64), h
        first = np.flatnonzero(self.text[: len(h)] == self.text[size - 1 :])
        return first, h[first]

    def run(self, first: int, size: int) -> bytes:
        """The words ``first .. first + size - 1``, joined by spaces."""
        return b" ".join(self.data[s:e] for s, e in zip(self.starts[first : first + size], self.ends[first : first + size]))
