"""Archives written and read back, plain and packed, with and without predicates."""

import hashlib

import pytest
from pyspark.sql import functions as F

from chorus.llm import queries, warc

SCHEMA = "page_id bigint, url string, html string, payload string"
LONG = "é" * 200
PAGES = [
    (5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, None, LONG), (9, "http://twice", LONG), (None, "http://null", LONG),
    (1, "http://b\r\nX: y", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "WARC/1.1\r\n\r\n" * 40),
    (8, "u", "x" * 3_000_000), (10, "ü", "WARC/1.1\r\n\r\n" * 40), (3, "http://a/3 again", LONG),
]


def expected(pages):
    first = {}
    for i, _, html in pages:
        data = (html or "").encode()
        if i is not None and len(data) >= 100:
            first[data] = min(first.get(data, i), i)
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        again = i is not None and data in first and first[data] != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=str)


def frame(spark, pages):
    return spark.createDataFrame([(*p, "clash") for p in pages], SCHEMA).repartition(3)


@pytest.mark.parametrize("compression", ["none", "gzip"])
@pytest.mark.parametrize("pages", [PAGES, [], [(1, None, None)]])
def test_round_trip(spark, compression, pages):
    got = warc.pages_through_warc(frame(spark, pages), compression)
    assert sorted(map(tuple, got.collect()), key=str) == expected(pages)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_predicates_are_pushed_and_right(spark, tmp_path, compression):
    path = str(tmp_path / "archive")
    warc.write_warc(warc.page_records(frame(spark, PAGES)), path, compression)
    every = {(r.record_id, r.target_uri): r for r in warc.read_warc(spark, path).collect()}
    assert len(every) == len(PAGES)
    ids = F.col("record_id")
    for test in (
        F.col("warc_type") == "revisit", ids.isin("<urn:page:5>", "<urn:page:8>"), F.col("refers_to").isNotNull(),
        F.col("target_uri").isNull(), F.col("target_uri").startswith("http"), ids > "<urn:page:5>", F.col("payload_length") > 100,
        (F.col("warc_type") == "response") & ids.eqNullSafe("<urn:page:3>"), ids != "<urn:page:5>",
    ):
        read = warc.read_warc(spark, path)
        plain = read.select(*read.columns, test.alias("hit"))
        want = sorted((r.record_id, str(r.target_uri)) for r in plain.collect() if r.hit)
        found = warc.read_warc(spark, path).filter(test).collect()
        assert sorted((r.record_id, str(r.target_uri)) for r in found) == want
        assert all(r.payload == every[r.record_id, r.target_uri].payload for r in found)


def test_headers_decide_before_blocks(tmp_path):
    """A record that a predicate rules out is skipped without taking its block."""

    class Counting(warc._Bytes):
        taken = 0

        def take(self, n):
            Counting.taken += n
            return super().take(n)

    rows = [{"warc_type": t, "record_id": f"<{i}>", "payload": b"p" * 1000} for i, t in enumerate(["response", "revisit"] * 50)]
    path = tmp_path / "x.warc"
    path.write_bytes(b"".join(warc.record_bytes(r, "2024-01-01T00:00:00Z") for r in rows))
    from pyarrow import fs

    reader = warc.WarcReader(str(tmp_path), True)
    with fs.LocalFileSystem().open_input_file(str(path)) as source:
        found = list(reader._records(Counting(source), [lambda h: h["WARC-Record-ID"] == "<4>"]))
    assert [r["record_id"] for r in found] == ["<4>"] and Counting.taken == 1000


def test_only_committed_files_are_read(spark, tmp_path):
    path = tmp_path / "archive"
    warc.write_warc(warc.page_records(frame(spark, PAGES[:2])), str(path))
    (path / "orphan.warc").write_bytes(warc.record_bytes({"warc_type": "response", "record_id": "<o>"}, "x"))
    assert warc.read_warc(spark, str(path), payloads=False).count() == 2


def test_query(spark, sf_dir):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert sorted(map(tuple, queries.op1_warc(spark, sf_dir).collect()), key=str) == expected(pages)
