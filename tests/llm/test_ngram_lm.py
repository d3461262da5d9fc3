"""The model against dictionaries, its sum to one, and odd inputs."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from chorus.llm import ngram_lm, queries

SCHEMA = "doc_id bigint, text string"
ODD = [
    (0, "the cat sat on the mat"), (1, "The cat sat"), (2, "the cat sat on the mat"), (3, None), (4, ""),
    (5, " \t\n"), (6, "straße\x0bÉTÉ été"), (7, "a " * 3000), (8, "x" * 5000), (None, "the dog"), (2, "the cat sat"),
]


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", low), None]


def dictionary_model(texts):
    c = Counter()
    for t in texts:
        c.update(zip(["<s>", *tokens(t)], tokens(t), strict=False))
    uni, contexts, follows = Counter(), defaultdict(list), Counter()
    for (h, w), n in c.items():
        uni[w] += n
        contexts[h].append(n)
        follows[w] += 1

    def discounts(counts):
        n = [sum(x == k for x in counts) for k in range(1, 5)]
        return ngram_lm._discounts(*n)

    d, low = discounts(c.values()), discounts(follows.values())
    off = lambda n, ds: ds[min(n, 3) - 1] if n else 0.0
    v, total = len(uni), len(c)
    mass = sum(off(n, low) for n in follows.values()) / total if total else 1.0

    def lower(w):
        return (max(follows[w] - off(follows[w], low), 0) / total if total else 0) + mass / (v + 1)

    def p(h, w):
        if not contexts.get(h):
            return lower(w)
        seen = sum(contexts[h])
        n = c[h, w]
        return max(n - off(n, d), 0) / seen + sum(off(x, d) for x in contexts[h]) / seen * lower(w)

    return uni, p


def scored(texts, uni, p):
    total, v = sum(uni.values()), len(uni)
    for t in texts:
        ts = tokens(t)
        yield (
            len(ts), sum(uni[w] > 0 for w in ts),
            sum(math.log10((uni[w] + 1) / (total + v + 1)) for w in ts),
            sum(math.log10(p(h, w)) for h, w in zip(["<s>", *ts], ts, strict=False)),
        )


@pytest.mark.parametrize("rows", [ODD, ODD[:3], []])
def test_equals_a_dictionary_model(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = ngram_lm.fit(df, ngram_lm.new_model_path(spark))
    uni, p = dictionary_model([t for _, t in rows])
    asked = spark.createDataFrame([*ODD, (99, "never seen words the")], SCHEMA)
    got = sorted((r[1:] for r in ngram_lm.score(asked, model).collect()), key=str)
    want = sorted(scored([t for _, t in ODD] + ["never seen words the"], uni, p), key=str)
    assert sorted(g[:2] for g in got) == sorted(w[:2] for w in want)
    for k in (2, 3):
        assert sorted(g[k] for g in got) == pytest.approx(sorted(w[k] for w in want), rel=1e-9)


def test_probabilities_sum_to_one():
    uni, p = dictionary_model([t for _, t in ODD])
    unknown = p("the", "nothing like it")
    assert sum(p("the", w) for w in uni) + unknown == pytest.approx(1)


def test_query_equals_a_dictionary_model(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = {k for k in docs if zlib.crc32(str(k).encode()) % 7 == 2}
    uni, p = dictionary_model([t for k, t in docs.items() if k not in out])
    rows = queries.op10_lm_scoring(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, known, base, score = next(scored([docs[r.doc_id]], uni, p))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id in out, n, known, sum(uni.values()))
        assert (r.base_score, r.score) == pytest.approx((base, score), rel=1e-9)
