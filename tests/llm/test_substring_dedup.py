"""Repeated strings against a table of all windows in Python."""

import hashlib
import random

import pytest

from chorus.llm import queries, substring_dedup

SCHEMA = "doc_id bigint, text string, kept int, _copy string, seq int"


def expected(rows):
    """Per distinct (key, text): key, bytes, removed, spans, digest; keys in order, null first, then digest of the text."""
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    order = sorted({(d is not None, d or 0, digest(t)): t for d, t in rows}.items())
    seen, out = set(), {}
    for place, t in order:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            w = data[i:i + 100]
            if w in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[place] = (len(data), len(data) - len(kept), spans, kept)
    return sorted(((d, *out[d is not None, d or 0, digest(t)]) for d, t in rows), key=str)


def got(spark, rows):
    df = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], SCHEMA).repartition(3)
    return sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substring_dedup.remove_repeats(df).collect()),
        key=str,
    )


def passages(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 7)))
    shared = [" ".join(word() for _ in range(k)) for k in (15, 25, 40, 80, 200)]
    texts = []
    for _ in range(n):
        own = [" ".join(word() for _ in range(rnd.randrange(30))) for _ in range(3)]
        texts.append(own[0] + rnd.choice(shared) + own[1] + rnd.choice(shared)[rnd.randrange(30):] + own[2])
    return texts + texts[:10]


@pytest.mark.parametrize("many", [20_000, 3])
def test_passages(spark, monkeypatch, many):
    monkeypatch.setattr(substring_dedup, "MANY", many)
    rows = list(enumerate(passages(many)))
    assert got(spark, rows) == expected(rows)


ODD = [
    (4, None), (5, ""), (6, "a" * 99), (7, "a" * 100), (8, "a" * 101), (9, "a" * 1000), (1, "ab" * 300), (2, "ba" * 60),
    (10, "é" * 120), (11, "x" + "é" * 120), (12, "short"), (12, "short"),
]


def test_odd_texts(spark):
    assert got(spark, ODD) == expected(ODD)


def test_null_and_repeated_keys(spark):
    long = passages(1, 4)
    rows = [(None, long[0]), (3, long[0]), (3, long[1]), (3, long[1]), (2, long[0] + "tail"), (None, None), (None, long[1])]
    assert got(spark, rows) == expected(rows)


def test_empty(spark):
    assert got(spark, []) == []


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = queries.op8_suffix_array_dedup(spark, sf_dir).collect()
    mine = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)
    assert mine == sorted(((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in expected(docs)), key=str)
