"""Tokens, their files and their decoding against the tokenizers library."""

import collections
import random
import zlib

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sparecast.llm import bpe
from sparecast.llm.common import bounded_batches
from sparecast.llm.queries import tokenizer_file
from sparecast.llm.token_files import read_index, read_tokens, token_report, write_tokens
from sparecast.llm.tokens import PASS_CHARS, ByteTokenizer, WordTable, library_words

from . import brute
from .conftest import ODD_TEXTS

PATH = tokenizer_file()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _ids(library, rows):
    return [e.ids for e in library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]


@pytest.mark.parametrize("make", [bpe.trie_words, library_words])
def test_random_texts(library, make):
    rnd = random.Random(7)
    signs = list(" \n\t'sstmdrevl  aZ9!.é½Ⅳ二٣ 　\x1c\x85\U0001F600é​_Ᲊ꟎") + ["'re", "'ll", "'ve", "  ", "<|endoftext|>", "the", "ing"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(30))) for _ in range(8000)]
    t = ByteTokenizer(PATH, make(PATH))
    assert [x.tolist() for x in t.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_small_word_table(library):
    t = ByteTokenizer(PATH, library_words(PATH))
    t.table = WordTable(t.table.encode, limit=20)
    for r in range(4):
        texts = [f"word{i * r} foo{i}bar{r}\n\n  x" for i in range(100)]
        assert [x.tolist() for x in t.encode(texts)] == [e.ids for e in library.encode_batch(texts)]


def _rows(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def test_encoding_and_decoding(spark, odd, sf, library):
    for rows, docs in ((ODD_TEXTS, odd), (_rows(spark, sf), spark.read.parquet(f"{sf}/documents.parquet"))):
        want = collections.Counter((i, len(x), brute.sha(brute.ids_bytes(x)), brute.sha(library.decode(x, skip_special_tokens=False)))
                                   for (i, _), x in zip(rows, _ids(library, rows)))
        assert collections.Counter(tuple(r) for r in bpe.encode_documents(docs, PATH).collect()) == want


def test_token_columns(odd, empty):
    rows = bpe.texts_of_tokens(bpe.with_tokens(odd, PATH), PATH, out_col="again")
    assert all((r.text or "") == r.again for r in rows.collect())
    verified = bpe.verified_tokens(odd, PATH)
    assert verified.columns == [*odd.columns, "token_ids", "n_tokens", "round_trip"]
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in verified.collect())
    assert bpe.verified_tokens(empty, PATH).count() == bpe.encode_documents(empty, PATH).count() == 0


def test_token_files(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted(_rows(spark, sf))
    start, want = 0, []
    for (i, _), ids in zip(rows, _ids(library, rows)):
        ids = [*ids, 0]
        want.append((i, start, len(ids), zlib.crc32(brute.ids_bytes(ids))))
        start += len(ids)
    assert sorted(tuple(r) for r in token_report(docs.repartition(6), PATH).collect()) == want


def test_token_files_of_odd_rows(spark, odd, empty, library):
    got = sorted((tuple(r) for r in token_report(odd, PATH).collect()), key=lambda r: r[1])
    ends = [s + n for _, s, n, _ in got]
    assert [r[1] for r in got] == [0, *ends[:-1]]
    assert [r[0] for r in got] == sorted((i for i, _ in ODD_TEXTS), key=lambda i: (i is not None, i or 0))
    want = collections.Counter((i, len(x) + 1, zlib.crc32(brute.ids_bytes([*x, 0]))) for (i, _), x in zip(ODD_TEXTS, _ids(library, ODD_TEXTS)))
    assert collections.Counter((i, n, c) for i, _, n, c in got) == want
    assert token_report(empty, PATH).count() == 0


def test_selective_reads(spark, sf, tmp_path):
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    path = str(tmp_path / "tokens")
    write_tokens(spark.read.parquet(f"{sf}/documents.parquet"), path, PATH)
    some = read_tokens(spark, path, F.col("id") == 5)
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,5)]" in some._jdf.queryExecution().executedPlan().toString()
    assert len(some.first().tokens) == some.first().n_tokens
    index = read_index(spark, path)
    assert "tokens" not in index._jdf.queryExecution().executedPlan().toString().split("ReadSchema", 1)[1].split("n_tokens")[0]
    assert index.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    file = next((tmp_path / "tokens").glob("part-*.parquet"))
    column = pq.ParquetFile(file).metadata.row_group(0).column(4)
    assert "tokens" in column.path_in_schema and any("DICT" in e for e in column.encodings)
    assert pq.ParquetFile(file).metadata.row_group(0).column(1).has_column_index


@pytest.mark.parametrize("make", [bpe.trie_words, library_words])
def test_a_worker_holds_little(library, make):
    t = ByteTokenizer(PATH, make(PATH))
    assert not hasattr(t, "spec") and t.table.index.keys.nbytes + t.table.index.places.nbytes <= 16 << 20
    sizes, ids = [], t.table.ids
    t.table.ids = lambda texts: sizes.append(sum(map(len, texts))) or ids(texts)
    texts = [f"{'word ' * 9000}{i}" for i in range(60)] + ["漢字 " * 200_000, "", "a\n\nb"]  # one is longer than a pass
    assert [x.tolist() for x in t.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert sorted(sizes)[-1] == 600_000 and sorted(sizes)[-2] <= PASS_CHARS


def _bytes_of_batches(docs):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])

    return docs.mapInArrow(run, "rows long, bytes long").collect()


def test_batches_are_bounded_in_bytes(spark, tmp_path):
    session = spark.newSession()
    docs = session.range(0, 400, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 8000) AS text")  # 26 MB
    write_tokens(docs, str(tmp_path / "tokens"), PATH)
    got = _bytes_of_batches(docs)
    assert sum(r.rows for r in got) == 400 and max(r.bytes for r in got) <= 4 << 20
    assert session.read.parquet(str(tmp_path / "tokens")).count() == 400


@pytest.mark.parametrize("key", ["maxRecordsPerBatch", "maxBytesPerBatch"])
def test_a_session_s_own_batches_hold(spark, key):
    session = spark.newSession()
    session.conf.set(f"spark.sql.execution.arrow.{key}", "777")
    before = dict(session.conf.getAll)
    bounded_batches(session)
    assert dict(session.conf.getAll) == before
