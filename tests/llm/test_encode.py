import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshet.llm.encode import decode_corpus, default_tokenizer_dir, encode_corpus, encoder

PATH = os.path.join(default_tokenizer_dir(), "byte_bpe_50k.tiktoken")
if not os.path.exists(PATH):
    pytest.skip("no vocabulary files", allow_module_level=True)

PIECES = st.lists(st.sampled_from(["don't ", "we'll", "'", "re", "   ", "\n\n", "\t", "aaaa", "1234", "é", "日本", "🌧️", "<|endoftext|>", "x", " ", "--", " ", "ß"]), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES, st.integers(1, 9))
def test_tree_equals_plain_encoding(text, leaf):
    enc = encoder(PATH)
    assert enc.tree(text, leaf) == enc.leaf(text)
    assert enc.decode(enc.leaf(text)) == text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80), st.integers(1, 5))
def test_tree_any_text(text, leaf):
    enc = encoder(PATH)
    assert enc.tree(text, leaf) == enc.leaf(text)


def test_runs_without_a_firm_place_make_the_window_grow():
    enc = encoder(PATH)
    for text in (" " * 5000, "a" * 5000, "-" * 3000 + "'" * 500 + "re" * 200, "日" * 3000):
        assert enc.tree(text, 100) == enc.leaf(text)


ROWS = [(1, "hello world", "x"), (2, None, "x"), (3, "", None), (3, "", None), (4, "don't   stop " * 700, "y"), (None, "no key", "z"), (5, "<|endoftext|>", "w")]


def test_corpus_spread_over_rows_and_back(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, ids string").withColumnRenamed("ids", "piece")
    enc = encoder(PATH)
    want = sorted((str(k), enc.leaf(t) if t else []) for k, t, _ in ROWS)
    for size in (1 << 20, 500):
        got = encode_corpus(df, row_chars=size, leaf_chars=64)
        assert sorted((str(r.doc_id), list(r.ids)) for r in got.collect()) == want
    n = encode_corpus(df, row_chars=500, count_only=True, keep=("piece",)).collect()
    assert sorted((str(r.doc_id), r.n) for r in n) == sorted((k, len(v)) for k, v in want)
    back = decode_corpus(encode_corpus(df, row_chars=500))
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(k), t or "") for k, t, _ in ROWS)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert encode_corpus(df).collect() == [] and decode_corpus(encode_corpus(df)).collect() == []
