import random

import numpy as np
import pytest

from chorus.llm import suffix_trees as st
from chorus.operators import scale
from tests.llm.helpers import words

DOCS = "doc_id long, text string"


def brute(docs, width):
    order = [(d is None, d) for d, _ in docs]
    first = {}
    for at, (_, t) in zip(order, docs):
        w = words(t)
        for i in range(len(w) - width + 1):
            s = tuple(w[i:i + width])
            first[s] = min(first.get(s, at), at)
    out = []
    for at, (d, t) in zip(order, docs):
        w = words(t)
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < at:
                gone.update(range(i, i + width))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def made(df, **options):
    return sorted((tuple(r) for r in st.remove_repeats(df, **options).collect()), key=repr)


def corpus(seed, n):
    rnd = random.Random(seed)
    say = lambda k: [f"{rnd.choice('aàBc')}{rnd.randrange(40)}" for _ in range(k)]
    passages = [say(rnd.randrange(8, 60)) for _ in range(12)]
    docs = []
    for i in range(n):
        w = say(rnd.randrange(0, 30))
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            w += p[rnd.randrange(4):] + say(rnd.randrange(6))
        docs.append((rnd.randrange(10**6), rnd.choice([" ", "\n", " \t "]).join(w)))
    return docs


@pytest.mark.parametrize("most", [8192, 2])
def test_same_words_go_as_by_looking_up_every_window(spark, most):
    docs = corpus(1, 300)
    docs += [(d, t) for d, t in docs[:20]]  # repeated rows
    docs += [(d, t + " more") for d, t in docs[20:30]]  # keys that name several texts
    docs += [(None, t) for _, t in docs[30:40]] + [(None, "x " * 30), (None, "x " * 30)]
    docs += [(10**7 + i, docs[50][1]) for i in range(60)]  # a hot text
    docs += [(1, None), (2, ""), (3, " \n "), (4, "few words"), (5, "y " * 400), (6, "y " * 100 + "z")]
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    assert made(df, width=12, most=most) == brute(docs, 12)


def test_lists_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(scale, "BROADCAST_BYTES", 0)
    docs = corpus(2, 150)
    docs += [*docs[:10], (None, docs[20][1]), (None, docs[20][1])]
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    assert made(df, width=12) == brute(docs, 12)


def test_windows_of_fifty_words_and_a_long_text(spark):
    rnd = random.Random(3)
    long = [f"v{rnd.randrange(5000)}" for _ in range(120_000)]
    docs = [(2, " ".join(long)), (1, " ".join(long[70_000:70_049])), (3, " ".join(long[5:55]) + " end"),
            (4, " ".join(long[100:149])), (5, "start " + " ".join(long[60_000:60_500]))]
    df = spark.createDataFrame(docs, DOCS)
    want = brute(docs, 50)
    assert made(df) == want and [r[2] for r in want] == [0, 0, 50, 0, 500]


def test_keys_of_text_and_clashing_columns(spark):
    docs = [("b", "q w e r t y"), ("a", "w e r t y u"), ("ab", "x w e r t")]
    df = spark.createDataFrame([(*r, "s", 1) for r in docs], "doc_id string, text string, _doc string, n_words int")
    assert made(df, width=4) == brute(docs, 4)


def test_empty_table(spark):
    assert made(spark.createDataFrame([], DOCS)) == []


@pytest.mark.parametrize("width", [1, 2, 7, 8, 50])
def test_deep_nodes_join_equal_suffixes(width):
    rnd = np.random.default_rng(width)
    lengths = rnd.integers(width, width + 30, 40)
    values = rnd.integers(0, 3, lengths.sum()).astype(np.uint64)
    half = values[:lengths[0]]
    values[-lengths[0]:] = half
    node, order = st.deep_nodes(values, lengths, width)
    starts = np.cumsum(lengths) - lengths
    suffixes = [tuple(values[s + i:s + i + width]) for s, n in zip(starts, lengths) for i in range(n - width + 1)]
    by_node = {}
    for s, x in zip(suffixes, node.tolist(), strict=True):
        assert by_node.setdefault(x, s) == s
    assert len(by_node) == len(set(suffixes))
    assert [suffixes[i] for i in order] == sorted(suffixes)
