"""A sample of the named queries against their SQL; ``tests/verify.py`` runs them all."""

import os

import pytest
from verify import compare, duck

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = (
    "flagship_metrics", "normalized_text", "word_term_stats", "char_wb_vocab", "tfidf_vectors",
    "split_quality", "fold_integrity", "mnb_predictions", "metric_records", "roc_curve",
    "score_histogram", "cv_nb_folds", "latest_runs", "method_comparison", "answer_validate",
    "answer_matrix_metrics", "prompts_few_shot",
)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return duck(SF_DIR)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, name):
    from postgauge.registry.oracles import ORACLES
    from postgauge.registry.queries import QUERIES

    good, detail = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert good, detail


def test_every_oracle_has_a_query():
    from postgauge.registry.oracles import ORACLES
    from postgauge.registry.queries import QUERIES

    assert set(ORACLES) <= set(QUERIES)
