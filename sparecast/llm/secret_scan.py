"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

Fixed kinds, each found leftmost and without overlap over the whole text:
``assign`` (a named password, secret, token or key with a value of at least 12
signs), ``access`` (AKIA keys of at least 18 signs) and ``hex`` (at least 16
hexadecimal digits).

The test adds ``random``: a string that a tokenizer of natural text cuts into
many short tokens.  The runs of URL-safe and base64 signs are taken without the
spans already found, UUIDs, and parts that are known digests (hexadecimal of a
digest's length) or plain numbers, which are no secrets.  What is left is tested
as a whole, else its parts between ``/ _ -``, else with a window of ``RUN``
signs, so words around a random string don't hide it.  Letters of one case alone
need ``RUN`` signs, since rare words are cut into short tokens too; strings with
digits or inner capitals ``RUN_MIXED``, between ``/ _ -``.

Spans are ``kind:start:end`` in code points, end exclusive, by start and then
by kind in the order above.  Defined results: null text counts as empty and has
no spans; repeated rows each get their own result; an empty table gives an
empty result; extra columns are ignored (kept by ``redact``).
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecast.llm.common import per_batch

KINDS = ("assign", "access", "hex", "random")
# The patterns and least lengths of the fixed kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

RUN, RUN_MIXED = 20, 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % RUN_MIXED)
#: Most characters a token: strings with digits or inner capitals from ``RUN`` signs and below, letters alone, windows of each.
RATIO_MIXED, RATIO_SHORT, RATIO_LETTERS = 2.05, 1.8, 2.05
WINDOW_MIXED, WINDOW_LETTERS = 1.7, 1.6
WINDOW_LEAST_LETTERS = 6
DIGEST_LENGTHS = frozenset((32, 40, 48, 56, 64, 96, 128))
_HEXADECIMAL = re.compile(r"[0-9a-fA-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_NUMBER = re.compile(r"[0-9+/_-]+")
_MIXED = re.compile(r"[0-9]|[A-Za-z][A-Z]")
_PARTS = re.compile(r"[A-Za-z0-9+]+={0,2}")
_LETTER = re.compile(r"[A-Za-z]")
_INNER_UUID = re.compile(rf"(?<![0-9a-fA-F]){_UUID.pattern}(?![0-9a-fA-F])")
_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)  # a run is matched whole, so failing ones need no match of their own


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> tiktoken.Encoding:
    """A rank file as an encoding (kept per worker process)."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def known_identifier(run: str) -> bool:
    """Digests, UUIDs and plain numbers."""
    return bool(len(run) in DIGEST_LENGTHS and _HEXADECIMAL.fullmatch(run) or _UUID.fullmatch(run) or _NUMBER.fullmatch(run))


def looks_random(run: str, encoding: tiktoken.Encoding) -> bool:
    """Whether few characters go into a token of the run."""
    if known_identifier(run):
        return False
    if _MIXED.search(run[1:]):
        least = RATIO_MIXED if len(run) >= RUN else RATIO_SHORT if len(run) >= RUN_MIXED and _PARTS.fullmatch(run) else 0
    else:
        least = RATIO_LETTERS if len(run) >= RUN else 0
    return bool(least) and len(run) <= least * len(encoding.encode_ordinary(run))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed kinds, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(out)


def _window_spans(run: str, encoding: tiktoken.Encoding) -> list[tuple[int, int]]:
    """The stretches of a run whose windows of ``RUN`` signs have few characters a token."""
    ends = [0]
    for token in encoding.decode_tokens_bytes(encoding.encode_ordinary(run)):
        ends.append(ends[-1] + len(token))
    out: list[tuple[int, int]] = []
    last = 0
    for first, start in enumerate(ends):
        while last < len(ends) and ends[last] - start < RUN:
            last += 1
        if last == len(ends):
            break
        end = ends[last]
        least = WINDOW_MIXED if _MIXED.search(run, start + 1, end) else WINDOW_LETTERS
        if end - start > least * (last - first):
            continue
        window = run[start:end]
        if len(_LETTER.findall(window)) < WINDOW_LEAST_LETTERS or sum(window.count(c) for c in "/_-") > RUN // 8:
            continue
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], end
        else:
            out.append((start, end))
    return out


def _free(run: tuple[int, int], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What is left of a range without others, which come by start."""
    out, (at, end) = [], run
    for s, e in taken:
        if s < end and at < e:
            out.append((at, s))
            at = e
    return [(s, e) for s, e in [*out, (at, end)] if e > s]


def random_spans(text: str, encoding: tiktoken.Encoding, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of random strings in what ``taken`` leaves of the text."""
    found: list[tuple[int, int, int]] = []
    used, low = [(s, e) for s, _, e in taken], 0  # both come by start
    starts = [s for s, _ in used]
    for m in CANDIDATE.finditer(text):
        if known_identifier(m.group()):
            continue
        known = [(u.start(), u.end()) for u in _INNER_UUID.finditer(text, m.start(), m.end())]
        known += [(p.start(), p.end()) for p in _PARTS.finditer(text, m.start(), m.end())
                  if p.end() - p.start() >= RUN_MIXED // 2 and known_identifier(p.group())]
        while low < len(used) and used[low][1] <= m.start():
            low += 1
        near = [x for x in used[low : bisect_left(starts, m.end(), low)] if m.start() < x[1]]
        for start, end in _free(m.span(), sorted(near + known)) if near or known else (m.span(),):
            if (start, end) != m.span():
                while start < end and text[start] in "/_-=":
                    start += 1
                while start < end and text[end - 1] in "/_-":
                    end -= 1
            run = text[start:end]
            if len(run) < RUN_MIXED:
                continue
            if looks_random(run, encoding):
                found.append((start, 3, end))
                continue
            spans = [p.span() for p in _PARTS.finditer(run) if p.end() - p.start() >= RUN_MIXED and looks_random(p.group(), encoding)]
            for s, e in _free((0, len(run)), spans):
                if e - s >= RUN:
                    spans += [(s + x, s + y) for x, y in _window_spans(run[s:e], encoding)]
            found += [(start + s, 3, start + e) for s, e in sorted(spans)]
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` for every row of ``docs``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoding = vocabulary(vocabulary_path, pattern)
        counts: list[list[int]] = [[], [], [], []]
        digests, spans = [], []
        for text in batch.column(1).to_pylist():
            base = base_spans(text or "")
            found = sorted(base + random_spans(text or "", encoding, base))
            for k in range(4):
                counts[k].append(sum(x[1] == k for x in found))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(found))
        columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
        return pa.RecordBatch.from_arrays(columns, [id_col, "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    new = T.StructType.fromDDL("n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")
    return per_batch(rows, run, T.StructType([rows.schema[0], *new]))


def redact(docs: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span (overlapping ones as one) replaced by a mark; a null text stays null."""
    place = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        base = base_spans(text)
        out, at = [], 0
        for s, _, e in sorted(base + random_spans(text, vocabulary(vocabulary_path, pattern), base)):
            if e > at:
                out += [text[at:s], mark] if s >= at else []
                at = e
        return "".join([*out, text[at:]])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(batch.columns)
        columns[place] = pa.array([clean(t) for t in columns[place].to_pylist()], batch.schema.field(place).type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return per_batch(docs, run, docs.schema)
