"""Encoding and decoding against the tokenizers library."""

import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chorus.llm import bpe, queries
from chorus.llm.vector_text import texts

LIBRARY = Tokenizer.from_file(queries.TOKENIZER)
with open(queries.TOKENIZER, encoding="utf-8") as _f:
    ENCODER = bpe.Encoder(_f.read())
ODD = [
    "Hello World, it's <|endoftext|>  fine Ok 12 ΣΑΣ", "a<|startoftext|>b", "İstanbul ẞ", "x\x1cy \x85z​q",
    "don't'sx 's", "<|ENDOFTEXT|>", "", "  ", None, "a" * 5000, "ab " * 10, "é é ﬁ Ａ ½ Ⅷ", "中文 عربى हिन्दी 👩‍👩‍👧",
    "<|endoftext|>", "<|endoftext|><|endoftext|>x", "the <|end", "The the THE tHe.",
]


def library(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def ours(given_texts):
    out = []
    for group in texts(pa.array(given_texts, pa.string())):
        flat, before = ENCODER.encode(group)
        lists = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(flat, pa.int32()))
        out += zip(lists.to_pylist(), bpe.joined(ENCODER, lists).to_pylist(), strict=True)
    return out


def test_odd_texts():
    assert ours(ODD) == [library(t) for t in ODD]


SIGNS = st.sampled_from([chr(c) for c in [*range(1, 0x250), *range(0x370, 0x400), 0x301, 0x2028, 0x4E2D, 0x1F600]] + ["<|endoftext|>"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(SIGNS, max_size=40).map("".join), max_size=5))
def test_any_texts(given_texts):
    assert ours(given_texts) == [library(t) for t in given_texts]


def test_long_and_forgetful(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    many = ["wordy words worded " * 20_000, *ODD]
    assert ours(many) == [library(t) for t in many]


def test_frame_keeps_other_columns(spark):
    rows = [(i, t, "x", [9]) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id int, text string, decoded string, ids array<int>")
    got = bpe.decode(bpe.encode(df, queries.TOKENIZER), queries.TOKENIZER)
    assert sorted(got.columns) == ["decoded", "doc_id", "ids", "text"]
    assert {r.doc_id: (r.ids, r.decoded) for r in got.collect()} == {i: library(t) for i, t in enumerate(ODD)}
    assert bpe.encode(df.limit(0), queries.TOKENIZER).count() == 0


@pytest.mark.parametrize("name", ["op5_bpe"])
def test_query(spark, sf_dir, name):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids, text = library(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
