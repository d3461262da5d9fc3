"""Blocks of nodes around a hub, made small, against all pairs."""

import random

import pytest

from chorus.llm import linking
from tests.llm.test_jaccard_join import crowded, expected, got
from tests.llm.test_line_dedup import expected as expected_lines
from tests.llm.test_line_dedup import frame
from tests.llm.test_line_dedup import got as got_lines


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(linking, "BLOCK_NODES", 5)


def test_documents(spark, small_blocks):
    rows = crowded(7)
    assert got(spark, rows, 3, 90) == expected(rows, 3, 90)


def test_lines(spark, small_blocks):
    rnd = random.Random(9)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(120))
    rows = []
    for i in range(60):
        x = list(base)
        for _ in range(rnd.randrange(5)):
            x[rnd.randrange(len(x))] = rnd.choice("xyz")
        rows.append((i, "".join(x)))
    assert got_lines(frame(spark, rows)) == expected_lines(rows)


