"""Every registered query against its SQL twin; TEST_SF_DIR picks the tables."""

import os

import pytest
from oracle import compare

from cardwatch.plans import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS_ONLY = {"stamp_time", "train_model", "tune_model"}


def test_only_the_stated_queries_lack_a_twin():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_twin(spark, key):
    assert compare(spark, FOLDER, key, QUERIES[key], ORACLES[key]) == ""


@pytest.mark.parametrize("key", sorted(ROWS_ONLY - {"train_model"}))
def test_rows(spark, key):
    assert QUERIES[key](spark, FOLDER).count() > 0


def test_trained_model_separates_the_classes(spark):
    rows = {r["metric"]: r["value"] for r in QUERIES["train_model"](spark, "/root/testdata/sf0.01").collect()}
    assert rows["roc_auc"] > 0.95 and rows["recall"] > 0.7 and rows["precision"] > 0.7
