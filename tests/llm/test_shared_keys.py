"""Different texts under one key, or under null keys, are judged each for itself."""

from chorus.llm import decontaminate, jaccard_join, line_dedup

SCHEMA = "doc_id bigint, text string"


def left(made):
    return sorted(map(tuple, made.collect()), key=str)


def test_lines(spark):
    rows = [
        (1, "a line that comes again\nfirst own"), (None, "a line that comes again\nsecond own"),
        (None, "clean words to keep\nthird thing"), (2, "a line that comes again\nfourth is here"), (2, "something else entirely\nfifth"),
        (2, "something else entirely\nfifth"),
    ]
    gone = "a line that comes again\n"
    want = [(d, t if d is None else t.replace(gone, "")) for d, t in rows]
    made = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert left(made) == sorted(want, key=str)


def test_copies(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "quite another text of its own"), (None, "g h i j k l"), (3, None)]
    made = jaccard_join.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert left(made) == sorted([rows[0], *rows[2:]], key=str)


def test_benchmark_items(spark):
    rows = [
        (None, "x a b c d e y"), (None, "clean text stays here"), (None, None), (1, "a b c d e"), (1, "clean too"), (2, "clean"),
    ]
    items = spark.createDataFrame([(1, "a b c d e")], "item_id bigint, text string")
    made = decontaminate.decontaminate(spark.createDataFrame(rows, SCHEMA).repartition(3), items)
    assert left(made) == sorted([rows[1], rows[2], rows[4], rows[5]], key=str)
