"""Every catalogue query against its SQL, and the driver contract."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.ml.feature import StopWordsRemover

import __spark_entry__ as contract
from check import compare, database
from chorus.plans import catalog, oracle

SQL = oracle.statements()
WITHOUT_SQL = sorted(set(catalog.QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, sf_dir, name):
    assert compare(spark, db, sf_dir, name, SQL[name]) is None


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_query_without_sql_returns_rows(spark, sf_dir, name):
    assert contract.queries()[name](spark, sf_dir).count() > 0


def test_only_models_and_documents_lack_sql():
    assert WITHOUT_SQL == sorted([
        "topic_term", "doc_topic", "top_terms_per_topic", "topic_coordinates", "topic_summary", "lda_relevance",
    ])
    assert set(SQL) <= set(catalog.QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("language", sorted(oracle.LANGS.values()))
def test_stop_lists_equal_sparks(spark, language):
    assert oracle.stop_list(language) == StopWordsRemover.loadDefaultStopWords(language)


def test_sql_needs_no_session_and_no_jars(tmp_path):
    """The statements are built in a process whose pyspark package has no jars."""
    code = (
        "import os, sys; os.environ['SPARK_HOME'] = sys.argv[1]; "
        "import __spark_entry__ as e; assert len(e.oracle_sql()) > 70; "
        "from pyspark.sql import SparkSession; assert SparkSession.getActiveSession() is None"
    )
    root = Path(contract.__file__).parent
    subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=root, check=True, timeout=120)


def test_entry(spark):
    got = contract.entry(spark)
    assert got.columns == ["store", "topic", "lambda", "rank", "term", "relevance"]
    assert got.count() == 5 * 11 * 30
