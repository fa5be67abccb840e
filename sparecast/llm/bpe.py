"""Byte-level BPE encoding by a prefix-sharing trie traversal, and decoding.

The encoding of any prefix of a word is known from its last token alone: take
the token off and the rest is the encoding of a shorter prefix.  So the state
of a trie node is the last token of its path, which is the one token that ends
there and may follow the state of the node where it starts (BPE would leave
the two side by side).  The distinct new words of a batch, sorted, are the
depth-first order of their trie; going through it, the states of the prefix
that a word shares with the one before it are kept and only the rest is worked
out.  Reading the last tokens from the end of a word gives its ids.

Texts stay in their partitions; a worker keeps a bounded number of words (see
``tokens``).  Defined results: null text counts as empty and gives no ids;
strings of added tokens in a text become those tokens, as in the library;
repeated rows each get their own result; an empty table gives an empty result;
extra columns are ignored by ``encode_documents`` and kept by ``with_tokens``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecast.llm.common import per_batch
from sparecast.llm.tokens import ByteTokenizer, byte_of_sign, held_tokenizer


#: Pairs of tokens that a worker remembers.
KEPT_PAIRS = 250_000


class TrieEncoder:
    """Ids of words by last-token states, from a vocabulary and its merge list."""

    def __init__(self, spec: dict) -> None:
        signs = byte_of_sign()
        vocab = spec["model"]["vocab"]
        self.id_of = {bytes(signs[c] for c in s): i for s, i in vocab.items() if all(c in signs for c in s)}
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (x, y) in enumerate(merges):
            self.rank.setdefault((vocab[x], vocab[y]), (r, vocab[x + y]))
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.single = [self.id_of[bytes([b])] for b in range(256)]
        made = set(self.single) | {new for _, new in self.rank.values()}
        self.endings: dict = {}
        for word, i in self.id_of.items():
            if i in made:
                node = self.endings
                for b in reversed(word):
                    node = node.setdefault(b, {})
                node[-1] = i
        self.length = {i: len(b) for b, i in self.id_of.items()}
        self.follows: dict[tuple[int, int], bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Plain BPE: the best-ranked adjacent pair is merged, the leftmost first, until none is left."""
        ids = [self.single[b] for b in data]
        while len(ids) > 1:
            ranks = [self.rank.get(p, (1 << 60, 0)) for p in zip(ids, ids[1:])]
            best = min(ranks)
            if best[0] == 1 << 60:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [best[1]]
        return ids

    def may_follow(self, left: int, right: int) -> bool:
        pair = (left, right)
        known = self.follows.get(pair)
        if known is None:
            if len(self.follows) >= KEPT_PAIRS:
                self.follows.clear()
            known = self.follows[pair] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def __call__(self, words: list[str]) -> list[list[int]]:
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        order = sorted(range(len(data)), key=data.__getitem__)
        out: list[list[int]] = [[]] * len(data)
        last: list[int] = [-1]  # the states on the path to the current node; the root has none
        path = b""
        endings, follows, length, may_follow = self.endings, self.follows, self.length, self.may_follow
        for k in order:
            word = data[k]
            shared, end = 0, min(len(path), len(word))
            while shared < end and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :]
            for i in range(shared, len(word)):
                node, at, state = endings, i, -1
                while at >= 0:
                    node = node.get(word[at])
                    if node is None:
                        break
                    token = node.get(-1)
                    if token is not None:
                        before = last[at]
                        if before < 0:
                            state = token
                            break
                        fits = follows.get((before, token))
                        if fits or fits is None and may_follow(before, token):
                            state = token
                            break
                    at -= 1
                last.append(state)
            path = word
            ids, i = [], len(word)
            while i:
                ids.append(last[i])
                i -= length[last[i]]
            ids.reverse()
            out[k] = ids
        return out


def trie_words(_: str) -> Callable[[dict], Callable[[list[str]], list[list[int]]]]:
    return TrieEncoder


def tokenizer(path: str) -> ByteTokenizer:
    t = held_tokenizer(path, "trie", trie_words)
    if not hasattr(t, "bytes_of"):
        t.bytes_of = {**t.table.encode.bytes_of, **{i: s.encode() for s, i in t.added.items()}}
    return t


def decode(t: ByteTokenizer, ids: list[int]) -> str:
    """The text of some ids; bytes that aren't UTF-8 become replacement signs."""
    return b"".join(map(t.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: every text encoded, and decoded again from its ids."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = tokenizer(path)
        counts, ids_sha, text_sha = [], [], []
        for ids in t.encode(_texts(batch.column(1))):
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            text_sha.append(hashlib.sha256(decode(t, ids.tolist()).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
            [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    schema = T.StructType([rows.schema[0], *T.StructType.fromDDL("n_tokens long, ids_sha256 string, decoded_sha256 string")])
    return per_batch(rows, run, schema)


def with_tokens(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each text as one more column (which replaces a column of that name)."""
    kept = [c for c in docs.columns if c != out_col]
    place = kept.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = tokenizer(path).encode(_texts(batch.column(place)))
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.astype(np.int32)))
        return pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, out_col])

    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*rows.schema, T.StructField(out_col, T.ArrayType(T.IntegerType()))])
    return per_batch(rows, run, schema)


def verified_tokens(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens`` and ``round_trip``: whether the decoded ids give the text (null: empty) again.

    Columns of these names are replaced.
    """
    new = ("token_ids", "n_tokens", "round_trip")
    kept = [c for c in docs.columns if c not in new]
    place = kept.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = tokenizer(path)
        texts = _texts(batch.column(place))
        ids = t.encode(texts)
        same = [decode(t, x.tolist()) == text for x, text in zip(ids, texts)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)),
                                         pa.array(np.concatenate(ids).astype(np.int32)))
        return pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(lengths), pa.array(same)], [*batch.schema.names, *new])

    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    return per_batch(rows, run, T.StructType([*rows.schema, *T.StructType.fromDDL("token_ids array<int>, n_tokens long, round_trip boolean")]))


def texts_of_tokens(rows: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "text") -> DataFrame:
    """``rows`` with the decoded text of each list of ids (null for null)."""
    kept = [c for c in rows.columns if c != out_col]
    place = kept.index(ids_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = tokenizer(path)
        texts = [None if x is None else decode(t, x) for x in batch.column(place).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out_col])

    some = rows.select(*[F.col(f"`{c}`") for c in kept])
    return per_batch(some, run, T.StructType([*some.schema, T.StructField(out_col, T.StringType())]))
