"""The pipeline's stages over the given documents, each against its operator's brute-force version."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from chorus.llm import queries
from tests.llm.helpers import Groups, shingle_set
from tests.llm.test_decontaminate import expected as leaks
from tests.llm.test_line_dedup import expected as without_lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], sf_dir).write.parquet(f"{base}/{k}")
        found.append(spark.read.parquet(f"{base}/{k}"))
    return found


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_shapes(kept):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert all(df.columns == COLUMNS for df in kept[:-1])
    assert kept[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_classifier_keeps_good_and_rejects_bad(spark, sf_dir, kept):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = {d for d, _ in rows(kept[1])}
    assert left <= {d for d, _ in rows(kept[0])}
    judged = [(q, d in left) for d, q in labels.items()]
    assert sum(bool(q) == stays for q, stays in judged) >= 0.95 * len(judged)


def test_lines(kept):
    before, after = rows(kept[1]), dict(rows(kept[2]))
    for d, _, removed, digest in without_lines(before):
        if d in after:
            assert hashlib.sha256(after[d].encode()).hexdigest() == digest
        else:
            assert removed
    assert all(r.n_chars == len(r.text) for r in kept[2].collect())


def test_one_document_of_each_group(kept):
    before = sorted(rows(kept[2]))
    groups = Groups([shingle_set(t, 5) for _, t in before], 80)
    first = {}
    for i, (d, t) in enumerate(before):
        first.setdefault(groups.find(i) if shingle_set(t, 5) else ("own", d), d)
    assert sorted(d for d, _ in rows(kept[3])) == sorted(first.values())


def test_no_benchmark_item_is_left(spark, sf_dir, kept):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {d for d, *_ in leaks(rows(kept[3]), items)}
    assert sorted(d for d, _ in rows(kept[4])) == sorted(d for d, _ in rows(kept[3]) if d not in bad)


def test_tokens(kept):
    library, texts = Tokenizer.from_file(queries.TOKENIZER), dict(rows(kept[4]))
    made = kept[5].collect()
    assert len(made) == len(texts)
    for r in made:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


ODD = [
    (1, None, None, None, None), (None, "a null key but words enough", "en", "s", 27), (2, "", "en", "s", 0),
    (3, "x " * 30_000, "en", "s", 60_000), (4, "the same text here again", "en", "s", 24), (4, "the same text here again", "en", "s", 24),
    (5, "the same text here again", "de", "t", 24), (6, "\n\n", None, "s", 2),
]


@pytest.mark.parametrize("given", [ODD, []])
def test_odd_documents(spark, sf_dir, given):
    docs = spark.createDataFrame([(*r, "extra", 1) for r in given], "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, mark int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, sf_dir)
        assert left.columns == docs.columns
        assert {r.doc_id for r in left.collect()} <= {r[0] for r in given}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(given)


def test_run_equals_the_stages(spark, sf_dir, kept):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, kept[-1].collect()))
