"""Every registered query against its SQL equivalent, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from corpusloom.plans.registry import ORACLES, QUERIES
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER, QUERIES[name], ORACLES[name]) is None


def test_comparison_notices_a_difference(spark, con):
    wrong = "SELECT doc_id, CAST(0 AS BIGINT) AS rank FROM documents"
    assert compare(spark, con, "epoch_shuffle", FOLDER, QUERIES["epoch_shuffle"], wrong) is not None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["conv_id", "n_turns", "text_md5", "n_chars", "rep_frac"]
    assert df.count() > 0


def test_catalogue_has_equivalents():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # Trained vocabularies have no SQL; tests/test_vocabulary.py compares them with a known trainer and its encoder.
    trained = {"vocab_rounds", "encoded_ids", "pretrain_trained", "chat_trained", "preference_trained"}
    assert set(QUERIES) - set(ORACLES) == trained
