"""Line dedup against all pairs of lines in Python."""

import hashlib
import random
import re

from chorus.llm import line_dedup, queries
from tests.llm.helpers import Groups, lowered

SCHEMA = "doc_id bigint, text string, n_chars int, _gone string, mark int"


def expected(rows):
    """Per row (key, lines, removed, remaining text)."""
    order = sorted({d for d, _ in rows}, key=lambda d: (d is not None, d or 0))
    rank = {d: i for i, d in enumerate(order)}
    found = []
    for at, (d, t) in enumerate(rows):
        for i, line in enumerate((t or "").split("\n")):
            if re.search("[^ \t\n\x0b\f\r]", line):
                found.append((rank[d], i, lowered(line), at))
    distinct = list(dict.fromkeys(x[2] for x in found))
    size = line_dedup.SHINGLE_CHARS
    groups = Groups([{x[i:i + size] for i in range(max(1, len(x) - size + 1))} for x in distinct], line_dedup.PERCENT)
    root = {x: groups.find(i) for i, x in enumerate(distinct)}
    first = {}
    for d, i, x, _ in found:
        first[root[x]] = min(first.get(root[x], (d, i)), (d, i))
    gone = {(d, i) for d, i, x, _ in found if first[root[x]] != (d, i)}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        mine = [i for i in range(len(lines)) if (rank[d], i) in gone]
        left = "\n".join(x for i, x in enumerate(lines) if i not in mine)
        n = sum(bool(re.search("[^ \t\n\x0b\f\r]", x)) for x in lines)
        out.append((d, n, len(mine), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, line_dedup.line_report(df).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, len(t or ""), "g", 1) for d, t in rows], SCHEMA).repartition(3)


def test_noisy_lines(spark):
    rnd = random.Random(5)
    bases = ["".join(rnd.choice("abcdefgh ") for _ in range(n)) for n in (30, 80, 200, 600)]
    lines = []
    for base in bases:
        for _ in range(40):
            x = list(base)
            for _ in range(rnd.randrange(4)):
                x[rnd.randrange(len(x))] = rnd.choice("xyzé")
            lines.append("".join(x))
    rnd.shuffle(lines)
    rows = [(i, "\n".join(lines[3 * i:3 * i + 3]) + "\n" * (i % 3)) for i in range(len(lines) // 3)]
    assert got(frame(spark, rows)) == expected(rows)


ODD = [
    (3, "Same line\n\n  \nother line here"), (1, "same LINE\nsame line"), (2, None), (4, ""), (5, "\n\n"), (6, "\n"),
    (7, "ü\nä\nü"), (8, "x" * 50_000), (9, "x" * 50_000 + "\ny"), (10, "\n".join(f"line number {i}" for i in range(2000))),
    (None, "same line\nown"), (11, "a\rb\n \x0b\t"),
]


def test_odd_rows(spark):
    assert got(frame(spark, ODD)) == expected(ODD)


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "a line\nb line"), (1, "a line\nb line"), (2, "a line")]
    assert [r[2] for r in got(frame(spark, rows))] == [0, 0, 1]


def test_stage_keeps_columns_and_drops_what_is_emptied(spark):
    left = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, ODD)).collect()}
    assert sorted(map(str, left)) == sorted(map(str, [None, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]))
    assert left[9].text == "y" and left[9].n_chars == 1 and left[2].text is None and left[9]["_gone"] == "g"
    assert line_dedup.dedup_lines(frame(spark, ODD).limit(0)).count() == 0


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op2_line_dedup(spark, sf_dir).collect()), key=str) == expected(docs)
