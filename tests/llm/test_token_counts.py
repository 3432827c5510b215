import json
import os

import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text or "", add_special_tokens=False))


EDGES = [
    None, "", " ", "\n\n", "a", " a", "a ", "  a  b   ", "a\n\n  b\t\tc \n", "it's we'll 'tis ' s", "a  b c\x0b d \x1c e",
    "!\x1c?\x85 x", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "<|endof text|>", "1a2b3c " * 9, "日本語 テキスト。終わり　次", "😀 👩‍👩‍👧 x",
    "a" * 3000, "ab12" * 9000, " " * 5000 + "x", "x" + "\n" * 5000, "'s1't2" * 4000, "\x00 \x00",
]


def test_whole_table_equals_the_library(spark, library):
    got = [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tc.op13_token_counts(spark, SF).collect()]
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in rows:
        n = library(r.text)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 1024))
    assert sorted(got) == sorted(want)


def test_edge_texts_and_schema(spark, docs, library):
    df = docs([(i, x) for i, x in enumerate(EDGES)], n_tokens="x", over_limit=1)
    out = tc.token_counts(df, PATH, limit=2)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    for r in out.collect():
        text = EDGES[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), library(text), library(text) > 2), text[:40]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab'stre1 2\n\t\r.!<|>é日  \x0b\x1c\x85")), max_size=60), st.integers(1, 8))
def test_pieces_add_up(text, long):
    t = test_pieces_add_up.tokenizer
    old, tc.LONG_PIECE = tc.LONG_PIECE, long
    try:
        parts = tc.pieces(text)
    finally:
        tc.LONG_PIECE = old
    assert "".join(parts) == text
    assert sum(len(t.encode(p, add_special_tokens=False)) for p in parts) == len(t.encode(text, add_special_tokens=False))


test_pieces_add_up.tokenizer = tokenizers.Tokenizer.from_file(PATH)


def test_equal_pieces_are_encoded_once_and_calls_are_bounded(monkeypatch, prose):
    monkeypatch.setattr(tc, "CALL_BYTES", 500)
    monkeypatch.setattr(tc, "SLICE_BYTES", 3000)
    for remembered in (0, 50, 10_000):
        monkeypatch.setattr(tc, "REMEMBERED", remembered)
        seen = []
        encode = lambda texts: seen.append(texts) or [len(x) for x in texts]
        lengths = tc.Lengths(encode)
        texts = [prose(i, 200) for i in range(20)] + ["y" * 2000, None]
        n_bytes, n = tc.batch_lengths(pa.array(texts), lengths, tc.pieces)
        assert n.tolist() == n_bytes.tolist() == [len(x or "") for x in texts]
        assert all(sum(map(len, x)) <= 500 or len(x) == 1 for x in seen)
        if remembered == 10_000:
            flat = [p for x in seen for p in x]
            assert len(flat) == len(set(flat))


def test_other_splitting_rules_have_no_safe_boundary(spark, docs, tmp_path):
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        assert not tc.splits_safely(json.load(f))
    with open(PATH) as f:
        definition = json.load(f)
    assert tc.splits_safely(definition)
    definition["added_tokens"][0]["content"] = "<end of text>"
    assert not tc.splits_safely(definition)
    other = public_tokenizers.path("word_bpe_49k.json")
    t = tokenizers.Tokenizer.from_file(other)
    texts = ["Hello there, it's 12b", None, "  a  b"]
    out = tc.token_counts(docs([(i, x) for i, x in enumerate(texts)]), other)
    assert sorted((r.doc_id, r.n_tokens) for r in out.collect()) == [
        (i, len(t.encode(x or "", add_special_tokens=False))) for i, x in enumerate(texts)
    ]


def test_repeats_null_ids_and_empty_table(spark, docs, library):
    rows = [(None, "one two")] * 3 + [(1, "one two")] * 2
    got = [(r.doc_id, r.n_tokens) for r in tc.token_counts(docs(rows), PATH).collect()]
    assert sorted(got, key=repr) == sorted([(i, library(x)) for i, x in rows], key=repr)
    assert tc.token_counts(docs([]), PATH).count() == 0
