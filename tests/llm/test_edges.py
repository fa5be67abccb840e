"""Edges met in reviews: words made to collide, long lists of spans, deep pages, pages inside forms, clashing columns."""

import hashlib
import time

import numpy as np
import public_tokenizers
import tokenizers

from sparecast.llm.bpe import encode_documents
from sparecast.llm.exact_dedup import drop_exact_duplicates
from sparecast.llm.html_text import main_text
from sparecast.llm.near_dedup import drop_near_duplicates, near_duplicates
from sparecast.llm.queries import tokenizer_file
from sparecast.llm.secret_scan import base_spans, random_spans, vocabulary
from sparecast.llm.token_files import read_tokens, write_tokens
from sparecast.llm.words import SPACED, Words, mix, new_key, substring_hashes

from . import brute


def thue_morse(bits):
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


ONE, OTHER = thue_morse(10)


def test_hashes_tell_words_of_any_form_apart():
    for bits in (10, 12, 18, 19):  # below and above the block of the running sums
        a, b = (w.encode() for w in thue_morse(bits))
        for key in (0, new_key()):
            w = Words([a, b, b"x " + a + b" y " + b, a], SPACED, key).hashes.tolist()
            assert w[0] != w[1] and w[3] == w[0] == w[6] and w[5] == w[1]
    data = np.random.default_rng(3).integers(97, 101, 700_000).astype(np.uint8)
    starts = np.arange(0, 699_000, 7)
    ends = starts + np.random.default_rng(4).integers(1, 8, len(starts))
    hashes = substring_hashes(data, starts, ends)
    seen = {}
    for s, e, h in zip(starts.tolist(), ends.tolist(), hashes.tolist()):
        assert seen.setdefault(data[s:e].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)
    assert len(set(mix(np.arange(9, dtype=np.uint64)).tolist())) == 9


def test_ids_and_links_of_colliding_words(spark, tmp_path):
    texts = [ONE, OTHER, f"so {ONE} and {OTHER}", f"so {OTHER} and {ONE}", f"say {ONE}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    library = tokenizers.Tokenizer.from_file(tokenizer_file())
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    for r in encode_documents(docs, tokenizer_file()).collect():
        assert r.ids_sha256 == brute.sha(brute.ids_bytes(want[r.doc_id])) and r.decoded_sha256 == brute.sha(texts[r.doc_id])
    write_tokens(docs, f"{tmp_path}/tokens", tokenizer_file())
    got = {r.id: list(r.tokens) for r in read_tokens(spark, f"{tmp_path}/tokens").collect()}
    assert got == {i: [*ids, 0] for i, ids in want.items()}
    assert [r.component_id for r in near_duplicates(docs).orderBy("doc_id").collect()] == [0, 1, 2, 3, 4]


def test_many_spans_take_linear_time():
    encoding = vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    took = []
    for n in (8_000, 32_000):
        text = "\n".join(hashlib.md5(str(i).encode()).hexdigest()[:29] for i in range(n))
        base, start = base_spans(text), time.perf_counter()
        found = random_spans(text, encoding, base)
        took.append(time.perf_counter() - start)
        assert len(base) == n and not found
    assert took[1] < 8 * took[0] + 1, took


def test_deep_pages_take_linear_time():
    for tag in ("div", "span", "blockquote", "section"):
        took = []
        for depth in (4_000, 32_000):
            page = "<body>" + f"<{tag}>some words here, and more of them" * depth + f"</{tag}>" * depth + "</body>"
            start = time.perf_counter()
            text = main_text(page)
            took.append(time.perf_counter() - start)
            assert text.startswith("some words") or tag == "section"
        assert took[1] < 16 * took[0] + 1, (tag, took)


ARTICLE = "<p>" + "The harbour was quiet that morning, and the boats lay still, one beside the other. " * 4 + "</p>"


def test_pages_inside_a_form():
    body = f"<div id=content><h1>Harbour</h1>{ARTICLE * 3}</div>"
    for inner in (body, f"<article>{ARTICLE * 3}</article>"):
        page = f"<html><body><form id=aspnetForm action=x><nav>Home, About</nav>{inner}<footer>Imprint</footer></form></body></html>"
        text = main_text(page)
        assert text.count("The harbour was quiet") == 12 and "About" not in text and "Imprint" not in text
    login = "<form class=login><p>Please enter your name, your password and the code, all of them</p><input name=a><button>Go</button></form>"
    search = "<form action=/search><label>Search all pages, by word or by name</label><input name=q></form>"
    text = main_text(f"<html><body>{search}<div>{ARTICLE * 3}{login}</div><form><p>Subscribe, please, to our letter of the week</p></form></body></html>")
    assert text.count("The harbour was quiet") == 12 and not any(w in text for w in ("password", "Search", "Subscribe"))


def test_columns_named_like_the_helpers_stay(spark):
    schema = "doc_id long, text string, __key string, __copy int, `row` string, row_key string, kept_id long, copy int, `a.b` string"
    rows = [(1, "some words of a text that is here", "k", 5, "r", "q", 9, 7, "x"), (1, "some words of a text that is here", "k", 5, "r", "q", 9, 7, "x"),
            (2, "SOME words of a text that is here", "l", 6, "s", "p", 8, 6, "y"), (3, "other words of another one, quite far from it", "m", 4, "t", "o", 7, 5, "z")]
    docs = spark.createDataFrame(rows, schema)
    for stage, kept in ((drop_exact_duplicates, {2, 3}), (drop_near_duplicates, {1, 3})):
        out = stage(docs)
        assert out.columns == docs.columns
        assert sorted(tuple(r) for r in out.collect()) == sorted({r for r in rows if r[0] in kept})
