"""The join against an inverted index in Python, on groups large enough for combinations."""

import random

import numpy as np
import pytest

from chorus.llm import jaccard_join, linking, queries
from tests.llm.helpers import Groups, noisy_copies, shingle_set

SCHEMA = "doc_id bigint, text string, node string, _node int"


def expected(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    groups = Groups(sets, percent)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = groups.find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(
        ((d, len(s), least.get(groups.find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=str,
    )


def got(spark, rows, k, percent, parts=3):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in jaccard_join.near_duplicates(df, k, percent).collect()), key=str)


def crowded(seed):
    rnd = random.Random(seed)
    common = [f"w{i}" for i in range(60)]
    texts = []
    for length in (12, 40, 150, 400):
        base = [rnd.choice(common) + str(i % 7) for i in range(length)]
        texts += noisy_copies(rnd, base, 45, max(2, length // 12))
    passage = " ".join(rnd.choice(common) for _ in range(50))
    texts += [f"{passage} own{i} words{i} " + " ".join(rnd.choice(common) for _ in range(rnd.randrange(12))) for i in range(60)]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_crowded_groups(spark, k, percent):
    rows = crowded(percent)
    assert got(spark, rows, k, percent) == expected(rows, k, percent)


def test_odd_rows(spark):
    rows = [
        (5, "The cat sat on the mat today"), (3, "the CAT sat on the mat today"), (None, "the cat sat on the mat today"),
        (7, None), (8, ""), (9, " \t\r\n"), (10, "one two"), (2, "one  two"), (11, "two one"), (12, "x"), (12, "x"),
        (13, "a " * 4000), (14, "a " * 9000), (15, "É é"), (None, "alone here it stands"), (12, "not x at all"),
    ]
    assert got(spark, rows, 3, 90) == expected(rows, 3, 90)


def test_empty(spark):
    assert got(spark, [], 3, 90) == []


def test_keep_one_keeps_columns_and_null_keys(spark):
    rows = [(1, "a b c d e f", "x", 1), (2, "a b c d e f", "y", 2), (None, "a b c d e f", "z", 3), (4, None, None, None)]
    left = jaccard_join.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)


def test_linked_sets_share_an_entry():
    """Whatever the frequencies, two sets at the threshold meet in the index, inside the smaller's inner prefix."""
    rnd = np.random.default_rng(3)
    for percent in (80, 90):
        for _ in range(300):
            levels = rnd.choice([0, 1, 3, 8, 9], jaccard_join.SLOTS, p=rnd.dirichlet(np.ones(5))).astype(np.uint8)
            n = int(rnd.integers(1, 200))
            whole = rnd.integers(0, 2**63, n + n // 4 + 2, dtype=np.uint64)
            drop = int(n * (100 - percent) / 100)
            a, b = np.sort(whole[:n]), np.sort(whole[rnd.integers(0, drop + 1):n])
            if 100 * len(b) < percent * len(a):
                continue
            bounds = np.array([0, len(a), len(a) + len(b)])
            entry, of, inner = jaccard_join.entries(np.concatenate([a, b]), bounds, levels, percent)
            smaller = (of == 1) & inner if len(b) < len(a) else (of == 1) & (inner | np.isin(entry, entry[(of == 0) & inner]))
            assert set(entry[of == 0].tolist()) & set(entry[smaller].tolist())


def test_linked_sets_with_shingles_of_their_own_share_an_entry():
    """Sets at the threshold that each lack and add some, so that sizes and numbers of rare shingles differ."""
    rnd = np.random.default_rng(5)
    tried = 0
    for percent in (80, 90, 40):
        for _ in range(1000):
            levels = rnd.choice([0, 1, 3, 8, 9], jaccard_join.SLOTS, p=rnd.dirichlet(np.ones(5))).astype(np.uint8)
            both = int(rnd.integers(1, 200))
            own = int(both * (100 - percent) / percent)
            left = int(rnd.integers(0, own + 1))
            whole = rnd.integers(0, 2**63, both + own, dtype=np.uint64)
            a, b = np.sort(whole[:both + left]), np.sort(np.r_[whole[:both], whole[both + left:]])
            if len(b) > len(a):
                a, b = b, a
            assert 100 * both >= percent * len(whole)
            bounds = np.array([0, len(a), len(a) + len(b)])
            entry, of, inner = jaccard_join.entries(np.concatenate([a, b]), bounds, levels, percent)
            smaller = (of == 1) & inner if len(b) < len(a) else (of == 1) & (inner | np.isin(entry, entry[(of == 0) & inner]))
            assert set(entry[of == 0].tolist()) & set(entry[smaller].tolist()), (percent, len(a), len(b), both)
            tried += 1
    assert tried == 3000


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = queries.op3_jaccard_join(spark, sf_dir).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, rows), key=str) == expected(docs, 3, 90)


def test_sketches_never_rule_out_a_link():
    rnd = np.random.default_rng(4)
    sets = []
    for size in (1, 5, 40, 700):
        base = rnd.integers(0, 2**63, size, dtype=np.uint64)
        for _ in range(12):
            own = rnd.integers(0, 2**63, rnd.integers(0, 1 + size // 6), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([base[rnd.random(size) > 0.05], own])))
    sets = [x for x in sets if len(x)]
    bounds = np.cumsum([0, *map(len, sets)])
    sketch = [np.frombuffer(x, np.uint64) for x in jaccard_join._sketches(np.concatenate(sets), bounds)]
    for x, p in zip(sets, sketch):
        for y, q in zip(sets, sketch):
            words = min(len(p), len(q))
            differ = int(np.bitwise_count(linking.folded(p, words) ^ linking.folded(q, words)).sum())
            assert differ <= len(x) + len(y) - 2 * linking.common(x, y)
            if linking.links(x, y, 80):
                assert linking.may_link(len(x), len(y), differ, 80)
